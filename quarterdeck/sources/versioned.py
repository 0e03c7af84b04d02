"""A keyed table in versions: bucketed, sorted, and committed by a pointer.

A table is a folder. Each version is a bucketed and sorted Parquet table in a
subfolder, and ``_commits`` holds one small file for each commit, named by its
number; the highest number is the table. A commit is the creation of a file that
must not exist, so it happens or it doesn't, and of two writers at once one fails.
Whatever breaks before that leaves the version in force as it was.

``upsert`` merges by a full outer join on the keys. The held version is bucketed by
them, so its rows are read where they lie and only the batch is shuffled. The
batch's own faults, null and repeated keys, are counted by observations while the
new version is written: the batch is read once, and a faulty one is never committed.
"""

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarterdeck.sources.readers import conform, enforce_schema
from quarterdeck.sources.writers import delete

BUCKETS = 64
#: Versions that stay readable after a commit, the new one included.
KEPT = 2


class CommitConflict(RuntimeError):
    """Another writer committed meanwhile; nothing was changed."""


def _hadoop(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def _commits(spark: SparkSession, path: str) -> dict[int, str]:
    fs, folder = _hadoop(spark, f"{path}/_commits")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return {int(n): f"{path}/_commits/{n}" for n in names if n.isdigit()}


def _commit(spark: SparkSession, path: str, number: int, entry: dict) -> None:
    fs, file = _hadoop(spark, f"{path}/_commits/{number:012d}")
    try:
        out = fs.create(file, False)
    except Exception as e:
        raise CommitConflict(f"commit {number} of {path} is there already") from e
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()


def latest_entry(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """Number and entry of the version in force, if there is one. A commit that was created but not written isn't."""
    commits = _commits(spark, path)
    for number in sorted(commits, reverse=True):
        fs, file = _hadoop(spark, commits[number])
        if fs.getFileStatus(file).getLen():
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(fs.open(file), "UTF-8")
            return number, json.loads(text)
    return None


def _table(spark: SparkSession, path: str, entry: dict) -> DataFrame:
    name = f"versioned_{entry['version']}"
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(entry["schema"]))
        keys = ", ".join(f"`{k}`" for k in entry["keys"])
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {entry['buckets']} BUCKETS LOCATION '{path}/{entry['version']}'")
    return spark.table(name)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The version in force; none if nothing was ever committed."""
    found = latest_entry(spark, path)
    return found and _table(spark, path, found[1])


def ensure(spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The table at ``path``, made empty with these types if there is none."""
    if latest_entry(spark, path) is None:
        _write(spark, path, spark.createDataFrame([], schema), keys, buckets, None)
    return read(spark, path)


def _write(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], buckets: int, before: int | None, check=None) -> None:
    """Writes a version, asks ``check``, and commits; without a commit the version's folder goes."""
    version = f"v{uuid.uuid4().hex}"
    entry = {"version": version, "keys": keys, "buckets": buckets, "schema": rows.schema.jsonValue()}
    try:
        rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{path}/{version}").saveAsTable(f"versioned_{version}")
        if check:
            check()
        _commit(spark, path, 0 if before is None else before + 1, entry)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS versioned_{version}")
        delete(spark, f"{path}/{version}")
        raise
    commits = _commits(spark, path)
    for number in sorted(commits)[:-KEPT]:
        fs, file = _hadoop(spark, commits[number])
        old = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(fs.open(file), "UTF-8") or "{}")
        if old:
            spark.sql(f"DROP TABLE IF EXISTS versioned_{old['version']}")
            delete(spark, f"{path}/{old['version']}")
        delete(spark, commits[number])


def merged(held: DataFrame, batch: DataFrame, keys: list[str], gone: bool = False) -> DataFrame:
    """``held`` with the rows of ``batch`` (unique keys) in place of its own; with ``gone`` those whose ``_gone`` is true are left out.

    One full outer join: where ``held`` is bucketed by the keys, it isn't shuffled.
    """
    new = batch.withColumn("_new", F.lit(True)).alias("new")
    same = [F.col(f"old.`{k}`") == F.col(f"new.`{k}`") for k in keys]
    both = held.alias("old").join(new, same, "full_outer")
    both = both.filter("NOT coalesce(new._gone, false)") if gone else both
    return both.select(*[F.when(F.col("new._new"), F.col(f"new.`{c}`")).otherwise(F.col(f"old.`{c}`")).alias(c) for c in held.columns])


def upsert(batch: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS, gone: DataFrame | None = None) -> int:
    """Merge a batch by key into the versioned table at ``path``, made if there is none; returns the rows of the batch.

    ``gone`` names keys to drop, none of them in the batch. A batch without a key
    column, with null keys or with a key twice is an error and commits nothing; an
    empty one without ``gone`` commits nothing either.
    """
    spark = batch.sparkSession
    if missing := set(keys) - set(batch.columns):
        raise ValueError(f"key columns missing: {sorted(missing)}")
    found = latest_entry(spark, path)
    held = _table(spark, path, found[1]) if found else None
    buckets = found[1]["buckets"] if found else buckets
    given = enforce_schema(batch, held.schema if found else None)
    seen = Observation()
    null = " OR ".join(f"`{k}` IS NULL" for k in keys)
    # A key's rows meet here where the join needs them, so repeats are counted without another shuffle.
    once = given.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in given.columns if c not in keys])
    once = once.observe(seen, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(F.col("_n") > 1).alias("repeated"), F.coalesce(F.sum(F.when(F.expr(null), F.col("_n"))), F.lit(0)).alias("null"))
    rows = once.select(*given.columns)
    if gone is not None:
        rows = rows.withColumn("_gone", F.lit(False)).unionByName(conform(gone.select(*keys).distinct(), given.schema).withColumn("_gone", F.lit(True)))
    out = merged(held, rows, keys, gone is not None) if found else rows.select(*given.columns)

    counts = {}

    def check() -> None:
        try:
            counts.update(seen.get)
        except Py4JJavaError:  # a batch that Spark finds empty while it plans is not observed
            if given.take(1):
                raise
            counts.update(rows=0, repeated=0, null=0)
        faults = [f"{counts[k]} {name}" for k, name in (("null", "null key"), ("repeated", "duplicate key")) if counts[k]]
        if faults:
            raise ValueError("; ".join(faults))
        if not counts["rows"] and gone is None:
            raise _Nothing

    try:
        _write(spark, path, out, list(keys), buckets, found[0] if found else None, check)
    except _Nothing:
        return 0
    return counts["rows"]


class _Nothing(Exception):
    """An empty batch."""
