"""Upkeep of the fact by change sets: what restated rows can reach is computed again, and nothing else.

Beside the fact lies a table of the source rows' hashes. A full outer join of keys and
hashes finds rows that are new, restated or gone; a changed quarter reaches the
quarters whose frames look back on it, ``reach`` of them. Affected entities are
computed from the quarters that those frames need, the affected rows are merged by
key, and what no longer has a source row is dropped. The result equals a rebuild, as
long as what else the build reads (a registry, bounds of bands) is the same; when
that changes, start a new path.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.columns import quarter_index
from quarterdeck.sources import versioned
from quarterdeck.sources.writers import materialized

#: Quarters that the longest frame of the fact looks back.
REACH = 12


def hashed(source: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """(keys, _hash) of each source row; nulls and values are told apart."""
    rest = [c for c in source.columns if c not in keys]
    return source.select(*keys, F.xxhash64(*rest, *[F.col(c).isNull() for c in rest]).alias("_hash"))


def changed(now: DataFrame, held: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """(keys, _gone): rows of ``now`` (keys, _hash) that ``held`` lacks or has otherwise, and rows that only ``held`` has."""
    both = now.alias("now").join(held.alias("held"), [F.col(f"now.{k}") == F.col(f"held.{k}") for k in keys], "full_outer")
    other = both.filter(~F.col("now._hash").eqNullSafe(F.col("held._hash")))
    return other.select(*[F.coalesce(f"now.{k}", f"held.{k}").alias(k) for k in keys], F.col("now._hash").isNull().alias("_gone"))


def affected(source: DataFrame, changes: DataFrame, keys: tuple[str, str], reach: int = REACH) -> DataFrame:
    """Keys of the source rows whose frames hold a changed row."""
    entity, date = keys
    reached = changes.select(entity, F.explode(F.sequence(quarter_index(date), quarter_index(date) + reach)).alias("_q")).distinct()
    return source.select(*keys, quarter_index(date).alias("_q")).join(reached, [entity, "_q"], "left_semi").select(*keys)


def needed(source: DataFrame, rows: DataFrame, keys: tuple[str, str], reach: int = REACH) -> DataFrame:
    """The source rows that frames of ``rows`` (keys) look at: those of the same entity up to ``reach`` quarters before."""
    entity, date = keys
    looked = rows.select(entity, F.explode(F.sequence(quarter_index(date) - reach, quarter_index(date))).alias("_q")).distinct()
    return source.withColumn("_q", quarter_index(date)).join(looked, [entity, "_q"], "left_semi").select(source.columns)


def maintain(source: DataFrame, path: str, build: Callable[[DataFrame], DataFrame], keys: tuple[str, str] = ("cert", "report_date"), reach: int = REACH, buckets: int = versioned.BUCKETS) -> dict[str, int]:
    """Bring the fact at ``path``/fact up to date with ``source``; ``build`` makes a fact of source rows, each from quarters up to ``reach`` before it.

    ``source`` is read for hashes, changes, keys and rows, so it should be a written table.
    Returns how many source rows changed, went, were read by ``build`` and were
    written. If a run breaks off between its two commits, the next one repeats it: hashes
    are committed after the fact.
    """
    spark = source.sparkSession
    now = hashed(source, keys)
    held = versioned.read(spark, f"{path}/hashes")
    if held is None or versioned.read(spark, f"{path}/fact") is None:
        n = versioned.upsert(build(source), f"{path}/fact", list(keys), buckets)
        rows = versioned.upsert(now, f"{path}/hashes", list(keys), buckets)
        return {"changed": rows, "gone": 0, "read": rows, "written": n}
    changes = materialized(changed(now, held, keys))
    sums = changes.agg(F.count_if(~F.col("_gone")).alias("changed"), F.count_if(F.col("_gone")).alias("gone")).first()
    if not sums.changed + sums.gone:
        return {"changed": 0, "gone": 0, "read": 0, "written": 0}
    todo = materialized(affected(source, changes, keys, reach))
    part = materialized(needed(source, todo, keys, reach))
    rows = build(part).join(todo, list(keys), "left_semi")
    gone = changes.filter("_gone").select(*keys)
    written = versioned.upsert(rows, f"{path}/fact", list(keys), buckets, gone=gone)
    versioned.upsert(now.join(changes.filter("NOT _gone"), list(keys), "left_semi"), f"{path}/hashes", list(keys), buckets, gone=gone)
    return {"changed": sums.changed, "gone": sums.gone, "read": part.count(), "written": written}
