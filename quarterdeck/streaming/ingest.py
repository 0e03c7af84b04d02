"""Upsert of newly landed files as a stream that ends when it has caught up."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarterdeck.sources.writers import keyed_upsert


def latest_by_key(batch: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest row of each key in a batch."""
    order = Window.partitionBy(*keys).orderBy(F.col(version).desc_nulls_last())
    return batch.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def upsert_stream(spark: SparkSession, landed: str, schema: StructType, target: str, keys: list[str], checkpoint: str, version: str | None = None) -> StreamingQuery:
    """Merge files that have landed since the last run; running it again changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        keyed_upsert(latest_by_key(batch, keys, version) if version else batch, target, keys)

    stream = spark.readStream.schema(schema).parquet(landed)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
