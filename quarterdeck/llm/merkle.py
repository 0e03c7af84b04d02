"""A Merkle manifest of a dataset: leaf, subroot, root and proof of every row, by exchange of subtrees.

A row's leaf is the hash of its fields. Per source, leaves ascend by id and every 16
consecutive nodes become their hash until one is left, the source's subroot;
subroots become the root likewise. Trees are cut into superblocks of
``16 ** LEVELS`` consecutive nodes. A first pass reduces each superblock to one node;
those nodes are few and form trees of their own, cut the same way, whose paths
come back as the *outer* nodes of each superblock. Then leaves and outer nodes are
cogrouped by superblock, and one function finishes the local levels, joins the
proofs and folds the leaves that are to be verified up to the root.

Positions are global ranks by range partitions with offsets of partition counts,
so a source that holds most rows is spread like any other and no group has more
than a superblock's rows.

Null fields are ``-``; empty and very long texts are hashed like any other. A null
source is a source, the first; null ids come first in it and aren't tampered
with. Rows that share an id are ordered by their leaf, and repeated rows are leaves
of their own. A single source's subroot is the root; a single row's leaf is its
subroot; a proof without siblings is the hash of nothing. An empty table gives an
empty result. Other columns don't matter, whatever their names.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm import scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
LEVELS = 3
_PATH = "array<struct<l:string,r:string>>"


def leaf_hash(values: list[Column]) -> Column:
    """Hash of a row's fields: ``-`` for null, else the byte count, a colon and the value."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def numbered(df: DataFrame, group: str, *order: str) -> DataFrame:
    """``df`` with ``pos``, each row's rank from 0 in its group by ``order``, and ``n``, the group's size: ranges of rows, and offsets from their counts."""
    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.array([last, *batch.column(group).to_pylist()], object)
            begins = np.flatnonzero(np.append(values[1:] != values[:-1], True))
            idx = np.arange(batch.num_rows) + held
            for a, b in zip(begins, begins[1:]):
                idx[a:b] = np.arange(b - a)
            last, held = values[-1], int(idx[-1]) + 1
            arrays = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int64)), pa.array(idx, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "_part", "_idx"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    placed = scratch.written(ranged.mapInArrow(counted, f"{fields}, _part long, _idx long"))
    # A row for each group and partition: a window over a group's partitions, not its rows.
    counts = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_at")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_group").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_group", "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy("_group")).alias("n"))
    same = (F.col("_part") == F.col("_at")) & F.col(group).eqNullSafe(F.col("_group"))
    return placed.join(offsets, same).withColumn("pos", F.col("_idx") + F.col("_before")).drop("_part", "_idx", "_group", "_at", "_before")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], n: int, levels: int) -> list[list[str]]:
    """The nodes of each level of a superblock, first those given; at most ``levels`` more, and none above the single node of a tree of ``n``."""
    out = [nodes]
    while n > 1 and len(out) <= levels:
        last = out[-1]
        out.append([_hash("".join(last[k : k + ARITY])) for k in range(0, len(last), ARITY)])
        n = -(-n // ARITY)
    return out


def _sides(nodes: list[str], k: int) -> tuple[str, str]:
    """What stands left and right of node ``k`` in its run, joined."""
    at = k - k % ARITY
    return "".join(nodes[at:k]), "".join(nodes[k + 1 : at + ARITY])


def _outer(nodes: DataFrame, levels: int) -> DataFrame:
    """(key, block, outer, root) of each superblock of trees of ``nodes`` (key, pos, h, n): the path from its own top to its tree's root."""
    size = ARITY**levels

    def reduced(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        key, n = rows["key"].iloc[0], int(rows["n"].iloc[0])
        return pd.DataFrame({"key": [key], "block": [int(rows["pos"].iloc[0]) // size], "n": [n], "h": _levels(rows["h"].tolist(), n, levels)[-1]})

    block = F.expr(f"pos div {size}").alias("block")
    tops = scratch.written(nodes.select("key", block, "pos", "n", "h").groupBy("key", "block").applyInPandas(reduced, "key long, block long, n long, h string"))
    none = tops.select("key", "block", F.array().cast(_PATH).alias("outer"), F.col("h").alias("root"))
    if tops.filter(F.col("n") > size).isEmpty():
        return none
    above = tops.filter(F.col("n") > size).select("key", F.col("block").alias("pos"), "h", F.ceil(F.col("n") / size).alias("n"))
    paths = _paths(above, levels).select("key", F.col("pos").alias("block"), F.col("path").alias("outer"), "root")
    return scratch.written(none.join(above.select("key").distinct(), "key", "left_anti").unionByName(paths))


def _paths(nodes: DataFrame, levels: int) -> DataFrame:
    """(key, pos, path, root) of each node of trees of ``nodes`` (key, pos, h, n): (left, right) siblings of each level, and the tree's root."""
    size = ARITY**levels

    def finished(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        local = _levels(rows["h"].tolist(), int(rows["n"].iloc[0]), levels)
        rest = [dict(x) if isinstance(x, dict) else x.asDict() for x in outer["outer"].iloc[0]]
        paths = [[dict(zip("lr", _sides(nodes, k // ARITY**level))) for level, nodes in enumerate(local[:-1])] + rest for k in range(len(rows))]
        return pd.DataFrame({"key": rows["key"], "pos": rows["pos"], "path": paths, "root": outer["root"].iloc[0]})

    cut = nodes.select("key", F.expr(f"pos div {size}").alias("block"), "pos", "n", "h")
    return cut.groupBy("key", "block").cogroup(_outer(nodes, levels).groupBy("key", "block")).applyInPandas(finished, f"key long, pos long, path {_PATH}, root string")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source", given: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    ``given`` replaces fields by what is presented for verification (a column of
    ``docs``); the fold of each row starts from the leaf of those fields.
    """
    size = ARITY**levels
    shown = [(given or {}).get(c, F.col(c)) for c in fields]
    leaves = scratch.written(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), leaf_hash([F.col(c) for c in fields]).alias("h"), leaf_hash(shown).alias("shown")))
    placed = numbered(leaves, "source", "id", "h", "shown")
    # Sources are leaves of the top tree, in their order: its positions serve as their keys.
    sources = leaves.select("source").distinct().withColumn("all", F.lit(0))
    keys = scratch.written(numbered(sources, "all", "source").select(F.col("source").alias("_source"), F.col("pos").alias("key"), F.col("n").alias("sources")))
    nodes = scratch.written(placed.join(keys, F.col("source").eqNullSafe(F.col("_source"))).select(F.col("id").cast("string").alias("id"), "key", "pos", "n", "h", "shown"))
    blocks = _outer(nodes, levels)
    subroots = blocks.filter("block = 0").select(F.col("key").alias("pos"), F.col("root").alias("h")).join(keys.select(F.col("key").alias("pos"), F.col("sources").alias("n")), "pos")
    top = _paths(subroots.withColumn("key", F.lit(0).cast("long")), levels).select(F.col("pos").alias("key"), "path", F.col("root").alias("top"))
    outer = blocks.join(top, "key").select("key", "block", F.concat("outer", "path").alias("outer"), F.col("root").alias("subroot"), F.col("top").alias("root"))

    def folded(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        local = _levels(rows["h"].tolist(), int(rows["n"].iloc[0]), levels)
        rest = [(x["l"], x["r"]) for x in outer["outer"].iloc[0]]
        tail = "".join(a + b for a, b in rest)
        sides = [[_sides(nodes, k) for k in range(len(nodes))] for nodes in local[:-1]]
        proofs, roots = [], []
        for k, h in enumerate(rows["shown"]):
            path = [s[k // ARITY**level] for level, s in enumerate(sides)]
            proofs.append(_hash("".join(a + b for a, b in path) + tail))
            for a, b in [*path, *rest]:
                h = _hash(a + h + b)
            roots.append(h)
        subroot, root = outer["subroot"].iloc[0], outer["root"].iloc[0]
        return pd.DataFrame({"id": rows["id"], "leaf": rows["h"], "subroot": subroot, "root": root, "proof_sha256": proofs, "folded_root": roots, "verified": [h == root for h in roots]})

    cut = nodes.withColumn("block", F.expr(f"pos div {size}"))
    shape = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    out = cut.groupBy("key", "block").cogroup(outer.groupBy("key", "block")).applyInPandas(folded, shape)
    return out.withColumn("id", F.col("id").cast("long")).withColumnRenamed("id", id_col)


def lowered(column: str = "text", id_col: str = "doc_id", every: int = 5) -> dict[str, Column]:
    """The tampering that the manifest must find: A-Z in lower case where the id's crc32 is divisible by ``every``."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0
    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return {column: F.when(hit, F.translate(column, capitals, capitals.lower())).otherwise(F.col(column))}
