"""Sources: landed pages, declared schemas, calendars, sharded scans, and the guards around them."""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructType

from quarterdeck import schemas


class IncompletePages(ValueError):
    """Pages of an endpoint do not add up to the total that it stated."""


def read_landed_pages(spark: SparkSession, path: str, fields: StructType, check: bool = True) -> DataFrame:
    """Rows of landed API responses; each endpoint must have as many as its pages state."""
    pages = spark.read.schema(schemas.ENVELOPE.format(fields=fields.simpleString())).json(path, multiLine=True)
    if check and (short := incomplete_endpoints(pages).take(5)):
        raise IncompletePages(str(short))
    return pages.select(F.inline("response.data")).select("data.*")


def incomplete_endpoints(pages: DataFrame) -> DataFrame:
    """Endpoints whose rows do not add up, or with an empty page before the total is reached."""
    rows = F.coalesce(F.size("response.data"), F.lit(0))
    sums = pages.groupBy(F.col("request.endpoint").alias("endpoint")).agg(F.sum(rows).alias("rows"), F.max("response.meta.total").alias("total"))
    return sums.filter(~F.col("rows").eqNullSafe(F.col("total")))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared fields in order; missing ones are null, others are dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def scope_filter(df: DataFrame, column: str = "ASSET", least: float = 1_000_000) -> DataFrame:
    """Rows at or above a size, per period: an entity may have gaps."""
    return df.filter(F.col(column).cast("double") >= least)


def quarter_calendar(spark: SparkSession, start: date, today: date) -> DataFrame:
    """(quarter_end, tag): quarter ends from ``start`` to ``today``, the tag as yyyyMMdd."""
    steps = F.sequence(F.trunc(F.lit(start), "quarter"), F.lit(today), F.expr("interval 3 months"))
    ends = spark.range(1).select(F.explode(steps).alias("d")).select(F.last_day(F.add_months("d", 2)).alias("quarter_end"))
    return ends.filter(F.col("quarter_end").between(F.lit(start), F.lit(today))).withColumn("tag", F.date_format("quarter_end", "yyyyMMdd"))


def enforce_schema(batch: DataFrame, target: StructType | None) -> DataFrame:
    """An existing target's types win and unknown columns are errors; in a first load all-null columns become strings."""
    if target is None:
        return batch.select(*[F.col(f.name).cast(StringType()) if isinstance(f.dataType, NullType) else F.col(f.name) for f in batch.schema])
    if unknown := set(batch.columns) - set(target.names):
        raise ValueError(f"columns that the target lacks: {sorted(unknown)}")
    return conform(batch, target)


def ensure_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table with types, for a source that has no data yet."""
    return spark.createDataFrame([], schema)


def row_count(df: DataFrame) -> int:
    return df.count()


def max_value(df: DataFrame, column: str):
    return df.agg(F.max(column)).first()[0]


def new_period_available(published: DataFrame, held: DataFrame, column: str, fmt: str = "yyyyMMdd", force: bool = False) -> bool:
    """Whether the source's latest period is later than the one held."""
    parsed = lambda df: df.agg(F.max(F.to_date(F.col(column).cast("string"), fmt))).first()[0]
    new, old = parsed(published), parsed(held)
    return force or (new is not None and (old is None or new > old))


def catalog_mismatches(series: DataFrame, catalog: DataFrame, key: str = "series_id", title: str = "series_title") -> DataFrame:
    """Series that are served but not listed, listed but not served, or titled otherwise; empty means valid."""
    served = series.select(key, F.col(title).alias("served_title")).distinct()
    joined = served.join(catalog.select(key, F.col(title).alias("listed_title")), key, "full_outer")
    return joined.filter(~F.col("served_title").eqNullSafe(F.col("listed_title")))


def validate_series_catalog(series: DataFrame, catalog: DataFrame, **columns) -> DataFrame:
    if bad := catalog_mismatches(series, catalog, **columns).take(5):
        raise ValueError(f"series differ from the catalog: {bad}")
    return series


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def sharded_scan(df: DataFrame, start: str, end: str, shard: str = "event_date") -> DataFrame:
    """Daily shards between two bounds; on a table partitioned by ``shard`` other folders are not listed.

    The bounds take the column's type, so that a metastore can prune too.
    """
    kind = df.schema[shard].dataType
    return df.filter(F.col(shard).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def switched(spark: SparkSession, config: dict[str, str], name: str, schema: StructType | None = None) -> DataFrame | None:
    """The source that a configuration names; none if it is not enabled."""
    path = config.get(name)
    return read_table(spark, path, schema) if path else None


def read_export_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Quoted CSV with a header; a byte order mark is dropped from the first name."""
    df = spark.read.csv(path, header=True, encoding="UTF-8", schema=schema)
    return df.toDF(*[c.lstrip("﻿").strip('"') for c in df.columns])


def frozen(tables: dict[str, DataFrame], as_of: date, periods: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """Each table without rows after ``as_of``; ``periods`` names the period column and its format, other tables stay whole."""

    def until(column: str, fmt: str) -> Column:
        return F.try_to_timestamp(F.col(column).cast("string"), F.lit(fmt)).cast("date") <= F.lit(as_of)

    return {name: df.filter(until(*periods[name])) if name in periods else df for name, df in tables.items()}
