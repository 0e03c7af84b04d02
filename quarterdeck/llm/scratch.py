"""Tables written in the folder that all executors share."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.sources import writers

_made: list[set[str]] = []


def folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``."""
    path = writers.shared_folder(spark)
    for held in _made:
        held.add(path)
    return path


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: the lineage is cut and lost executors lose nothing."""
    path = path or folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table that ``written`` made and nothing reads any more."""
    writers.delete(df.sparkSession, df.scratch_path)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[set[str]]:
    """Deletes the scratch folders made inside, but for those that are taken out of the set."""
    _made.append(set())
    try:
        yield _made[-1]
    finally:
        for path in _made.pop():
            writers.delete(spark, path)
