"""Ranks over whole tables and dense numbers, without a task that sees all rows.

Rows are counted by distinct value first, so ties meet in the aggregate. Values are
then dealt to ranges between cuts that a bounded sketch gives: the range is a
function of the value, so ties never lie across its bounds and reruns agree. Inside
a range a window counts; what lies below it is a running sum over the ranges' own
counts, a few hundred rows for each group.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.sources.writers import materialized

RANGES = 256


def _range_of(value: Column, cuts: Column) -> Column:
    """Number of cuts at or below a value."""
    return F.size(F.filter(cuts, lambda c: c <= value))


def cuts_of(rows: DataFrame, value: str, ranges: int = RANGES) -> DataFrame:
    """One row: ``_cuts``, values that split the rows into about equal ranges."""
    sketch = F.percentile_approx(value, F.array(*[F.lit(k / ranges) for k in range(1, ranges)]), F.lit(4 * ranges))
    return rows.agg(F.array_distinct(F.coalesce(sketch, F.array().cast("array<double>"))).alias("_cuts"))


def counted_ranks(rows: DataFrame, value: str, by: list[str], cuts: DataFrame | None = None) -> DataFrame:
    """(by, value, n, below, above, size): of each distinct value that isn't null, how many rows of its group have it, less, more, and any."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    # One row of cuts, whatever the table's size.
    dealt = counts.crossJoin(F.broadcast(cuts_of(rows, value) if cuts is None else cuts)).withColumn("_range", _range_of(F.col("_value"), F.col("_cuts"))).drop("_cuts")
    group = [F.col(k) for k in by] or [F.lit(0)]
    own = Window.partitionBy("_range", *by).orderBy("_value")
    placed = dealt.withColumns({"_before": F.coalesce(F.sum("_n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_sum": F.sum("_n").over(Window.partitionBy("_range", *by))})
    sums = placed.groupBy("_range", *by).agg(F.first("_sum").alias("_sum"))
    order = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_range").alias("_of"), *[F.col(k).alias(f"_by_{k}") for k in by], F.coalesce(F.sum("_sum").over(order), F.lit(0)).alias("_under"), F.sum("_sum").over(Window.partitionBy(*group)).alias("size"))
    same = F.col("_range") == F.col("_of")
    for k in by:
        same &= F.col(k).eqNullSafe(F.col(f"_by_{k}"))
    below = F.col("_under") + F.col("_before")
    return placed.join(sums, same).select(*by, F.col("_value").alias(value), F.col("_n").alias("n"), below.alias("below"), (F.col("size") - below - F.col("_n")).alias("above"), "size")


def with_ranks(rows: DataFrame, value: str, groups: dict[str, list[str]], ranges: int = RANGES) -> DataFrame:
    """``rows`` with, for each named grouping, name_rank (the largest value is first), name_size and name_percentile (percent rank; the smallest is 0).

    Rows without a value have none of them. ``rows`` is read for the cuts and each
    grouping, so it should be a written table.
    """
    cuts, out = materialized(cuts_of(rows, value, ranges)), rows
    for name, by in groups.items():
        found = counted_ranks(rows, value, by, cuts).select(
            *[F.col(k).alias(f"_of_{k}") for k in by],
            F.col(value).alias("_of_value"),
            (F.col("above") + 1).cast("int").alias(f"{name}_rank"),
            F.col("size").alias(f"{name}_size"),
            F.when(F.col("size") > 1, F.col("below") / (F.col("size") - 1)).otherwise(0.0).alias(f"{name}_percentile"),
        )
        same = F.col(value) == F.col("_of_value")
        for k in by:
            same &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        out = out.join(found, same, "left").drop("_of_value", *[f"_of_{k}" for k in by])
    return out


def dense_numbers(rows: DataFrame, key: str, into: str, buckets: int = RANGES) -> DataFrame:
    """(key, into): the distinct keys that aren't null, numbered from 0 without gaps; the same numbers whenever the keys are the same."""
    keys = rows.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    sums = keys.groupBy(F.col("_bucket").alias("_of")).agg(F.count("*").alias("_n"))
    under = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # as many rows as buckets
    return keys.withColumn("_own", own).join(sums.select("_of", under.alias("_under")), F.col("_bucket") == F.col("_of")).select(key, (F.col("_own") + F.col("_under")).alias(into))
