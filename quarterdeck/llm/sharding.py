"""Sharding by a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own (an
offset and a skip drawn from its name). Shards take turns claiming their next
free slot until the table is full, so each has nearly the same number of slots,
and few slots change owner when a shard comes or goes. A row goes to the owner
of slot ``hash(key) mod size``: the table is broadcast (its size is a fixed
parameter) and each placement is one lookup.

A null key goes where the hash of null goes, unless ``fallback`` columns are
given to hash in its place. Equal keys go to the same shard; repeated rows are
each placed; an empty table gives an empty result; texts are not read, however
long. Columns that have the results' names (``slot_col``, ``shard_col``) are
replaced, unless one of them is the key, which is an error; other columns stay.
"""

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm import names

SLOTS = 65_537
SHARDS = 256


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> np.ndarray:
    """Owner (index into ``shards``) of each slot; a shard of weight w takes w turns a round."""
    if not _is_prime(slots) or not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("slots must be a prime, and shards distinct and no more than slots")
    offset = [xxhash.xxh64_intdigest(s, 1) % slots for s in shards]
    skip = [xxhash.xxh64_intdigest(s, 2) % (slots - 1) + 1 for s in shards]
    turns = [k for k in range(len(shards)) for _ in range(weights[k] if weights else 1)]
    if not turns:
        raise ValueError("no shard has a weight")
    owner, at, free = [-1] * slots, list(offset), slots
    while free:
        for k in turns:
            while owner[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % slots
            owner[at[k]] = k
            free -= 1
            if not free:
                break
    return np.array(owner, np.int32)


def slot(key: Column, slots: int = SLOTS, fallback: tuple[Column, ...] = ()) -> Column:
    hashed = F.xxhash64(key)
    if fallback:
        hashed = F.when(key.isNull(), F.xxhash64(*fallback)).otherwise(hashed)
    return F.pmod(hashed, F.lit(slots)).cast("int")


def table(spark: SparkSession, shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    """(slot, shard), ``slots`` rows."""
    owner = lookup_table(shards, slots, weights)
    return spark.createDataFrame([(k, shards[i]) for k, i in enumerate(owner.tolist())], "slot int, shard string")


def place(df: DataFrame, shards: list[str], key_col: str = "doc_id", slots: int = SLOTS, weights: list[int] | None = None, fallback: tuple[str, ...] = (), slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and shard of each row."""
    if clash := {slot_col, shard_col} & {key_col, *fallback}:
        raise ValueError(f"{sorted(clash)} is both a key and a result")
    placed = df.drop(shard_col).withColumn(slot_col, slot(F.col(key_col), slots, tuple(map(F.col, fallback))))
    at = names.fresh("at", placed)
    lookup = table(df.sparkSession, shards, slots, weights).toDF(at, shard_col)
    return placed.join(F.broadcast(lookup), F.col(slot_col) == F.col(at)).drop(at)


def write(placed: DataFrame, path: str, shard_col: str = "shard", files_per_shard: int = 1) -> None:
    """One folder a shard, of a few files each."""
    salt = F.floor(F.rand(0) * files_per_shard)
    placed.repartition(F.col(shard_col), salt).write.partitionBy(shard_col).mode("overwrite").parquet(path)
