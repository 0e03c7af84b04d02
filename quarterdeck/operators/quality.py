"""Data checks: each returns the rows that fail, so an empty result passes."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.operators.parity import LEVELS, unequal_rows


def not_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n")).filter("n > 1")


def nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key the parent lacks; null keys don't count."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def unaccepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))


def freshness(df: DataFrame, date: str, warn_days: int, error_days: int, today: Column | None = None) -> DataFrame:
    """(latest, age_days, status) of a table."""
    age = F.datediff(F.current_date() if today is None else today, F.col("latest"))
    status = F.when(F.col("latest").isNull() | (F.col("age_days") > error_days), "error").when(F.col("age_days") > warn_days, "warn").otherwise("pass")
    return df.agg(F.max(date).alias("latest")).withColumn("age_days", age).withColumn("status", status)


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def unbanded(df: DataFrame, size: str, least: float, band: str = "peer_band") -> DataFrame:
    """Rows in scope that have no size band."""
    return df.filter((F.col(size) >= least) & F.col(band).isNull())


def unclamped(scored: DataFrame, clamp: float = 5.0) -> DataFrame:
    """Rows whose z is not the clamped form of the unclamped one."""
    expected = F.greatest(F.lit(-clamp), F.least(F.lit(clamp), F.col("robust_z_unclamped")))
    return scored.filter(F.col("robust_z").isNotNull() & (F.abs(F.col("robust_z") - expected) > 1e-9))


def assistance_marked_failed(failures: DataFrame, dim: DataFrame) -> DataFrame:
    """Entities with assistance only that are marked as failed."""
    only = failures.filter("cert IS NOT NULL").groupBy("cert").agg(F.count_if(F.col("resolution_type") == "FAILURE").alias("n")).filter("n = 0")
    return dim.filter("is_failed").join(only, "cert", "left_semi")


def funnel_not_monotone(f: DataFrame) -> DataFrame:
    return f.filter("sessions_with_view > sessions OR sessions_with_cart > sessions_with_view OR sessions_with_purchase > sessions_with_cart")


def retention_unbounded(r: DataFrame) -> DataFrame:
    return r.filter("retention_pct < 0 OR retention_pct > 1 OR (week_number = 0 AND retention_pct <> 1)")


def attribution_not_conserved(a: DataFrame, within: float = 0.01) -> DataFrame:
    """Totals if the two sides differ."""
    sums = a.agg(*[F.sum(c).alias(c) for c in a.columns if c != "channel"])
    return sums.filter((F.col("first_touch_purchases") != F.col("last_touch_purchases")) | (F.abs(F.col("first_touch_revenue_usd") - F.col("last_touch_revenue_usd")) > within))


#: Checks that fail, and that ask for a look, where they aren't 0.
MUST_BE_ZERO, TO_REVIEW = ("duplicate keys", "null keys"), ("orphan entities", "orphan rows")


def quality_status(fact: DataFrame, dim: DataFrame, raw: DataFrame, registry: DataFrame, failures: DataFrame, weekly: DataFrame, key: tuple[str, str] = ("cert", "report_date")) -> DataFrame:
    """(check_name, value, status): the last two periods and their rows, active entities of the last, the last weekly value, duplicate and null keys, what is left out and why.

    Each input is aggregated once; a check without a value has no line.
    """
    entity, date = key
    active = dim.select(entity, "is_active")
    # Counts by key serve duplicates, periods and entities; keys are the grain, so repeats meet here.
    keyed = fact.join(active, entity, "left").groupBy(entity, date).agg(F.count("*").alias("n"), F.count_if("is_active").alias("active"), F.count_if(F.col("peer_band").isNull()).alias("unbanded"))
    by_period = keyed.groupBy(date).agg(F.sum("n").alias("n"), F.sum("active").alias("active"), F.sum("unbanded").alias("unbanded"), F.count_if(F.col("n") > 1).alias("twice"))
    # As many entries as periods, the last one first.
    periods = F.reverse(F.array_sort(F.collect_list(F.struct(F.col(date).alias("period"), "n", "active"))))
    facts = by_period.agg(periods.alias("p"), F.sum("n").alias("fact_rows"), F.sum("unbanded").alias("unbanded"), F.sum("twice").alias("fact_twice"))
    entities = keyed.select(entity).distinct().agg(F.count("*").alias("fact_entities"))
    listed = registry.select(F.col(entity).alias("_listed")).distinct()
    landed = raw.groupBy(entity, date).agg(F.count("*").alias("n")).join(listed, F.col(entity) == F.col("_listed"), "left")
    orphan = F.col("_listed").isNull() & F.col(entity).isNotNull()
    raws = landed.agg(
        F.count_if(F.col("n") > 1).alias("raw_twice"),
        F.sum(F.when(F.col(entity).isNull() | F.col(date).isNull(), F.col("n")).otherwise(0)).alias("null_keys"),
        F.countDistinct(F.when(orphan, F.col(entity))).alias("orphan_entities"),
        F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("orphan_rows"),
    )
    fails = failures.agg(F.count_if(F.col("resolution_type") == "ASSISTANCE").alias("assistance"), F.count_if(F.col(entity).isNull()).alias("keyless"))
    weeks = weekly.agg(F.max("obs_date").alias("last_week"))
    one = reduce(DataFrame.crossJoin, [facts, entities, raws, fails, weeks])  # a row each
    latest, prior = F.get("p", F.lit(0)), F.coalesce(F.get("p", F.lit(1)), F.get("p", F.lit(0)))
    lines = {
        "latest period": latest["period"], "prior period": prior["period"],
        "rows of the latest period": latest["n"], "rows of the prior period": prior["n"], "active entities of the latest period": latest["active"],
        "latest weekly observation": F.col("last_week"),
        "fact rows": F.col("fact_rows"), "fact entities": F.col("fact_entities"), "rows without a band": F.col("unbanded"),
        "duplicate keys": F.col("raw_twice") + F.coalesce("fact_twice", F.lit(0)), "null keys": F.coalesce("null_keys", F.lit(0)),
        "orphan entities": F.col("orphan_entities"), "orphan rows": F.coalesce("orphan_rows", F.lit(0)),
        "assistance records": F.col("assistance"), "failures without a key": F.col("keyless"),
    }
    long = one.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check_name"), v.cast("string").alias("value")) for name, v in lines.items()]))).filter("value IS NOT NULL")
    name, some = F.col("check_name"), F.col("value") != "0"
    return long.withColumn("status", F.when(name.isin(*MUST_BE_ZERO) & some, "fail").when(name.isin(*TO_REVIEW) & some, "review").otherwise("pass"))


def build_meta(fact: DataFrame, dim: DataFrame, flags: DataFrame) -> DataFrame:
    """One row about a build: when it was made, its last quarter, and how much it holds."""
    out = fact.agg(F.current_timestamp().alias("built_at"), F.max("report_date").alias("latest_quarter"), F.count("*").alias("fact_rows"), F.countDistinct("report_date").alias("quarters"))
    out = out.crossJoin(dim.agg(F.count("*").alias("entities"), F.count_if("is_active").alias("active_entities"), F.count_if("is_failed").alias("failed_entities")))
    return out.crossJoin(flags.agg(F.count("composite_score").alias("scored_rows")))


def orphan_filers(raw: DataFrame, registry: DataFrame, key: str = "cert") -> DataFrame:
    """(entity, rows) of entities that the registry lacks."""
    return orphans(raw, registry, key).groupBy(key).agg(F.count("*").alias("rows"))


def slice_parity(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    """Slices whose row counts differ; slices of ``a`` past the last one of ``b`` are tolerated."""
    last = b.agg(F.max(by).alias("_last"))
    counts = a.groupBy(by).agg(F.count("*").alias("rows_a")).join(b.groupBy(by).agg(F.count("*").alias("rows_b")), by, "full_outer")
    return counts.join(F.broadcast(last)).filter(~F.col("rows_a").eqNullSafe(F.col("rows_b")) & (F.col(by) <= F.col("_last"))).drop("_last")


def table_parity(a: DataFrame, b: DataFrame, keys: list[str], tol: float = 1e-9, levels: int = LEVELS, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(keys, difference): keys that one side lacks, and columns that differ by more than a tolerance; nulls agree with nulls, in keys too, and NaNs with NaNs.

    Digests of buckets are compared first, and only rows of buckets that differ are
    joined: equal tables without a join at all. Each table is read for its digests,
    unless ``trees`` has them, and once more if the tables differ.
    """
    values = [c for c in a.columns if c not in keys and c in b.columns]
    kinds, others = dict(a.dtypes), dict(b.dtypes)
    unequal = [c for c in [*keys, *values] if kinds[c] != others[c]]
    # Hashes depend on the type; of columns whose types differ all rows are joined.
    found = (a, b) if unequal else unequal_rows(a, b, keys, values, levels, trees)
    if found is None:
        return a.select(*keys, F.lit(None).cast("string").alias("difference")).limit(0)
    a, b = found
    view = lambda df, x: df.select(F.struct(*keys).alias(f"k{x}"), F.struct(*values).alias(f"v{x}"), F.lit(True).alias(f"in_{x}"))
    both = view(a, "a").join(view(b, "b"), reduce(lambda p, q: p & q, [F.col(f"ka.{k}").eqNullSafe(F.col(f"kb.{k}")) for k in keys]), "full_outer")

    def differs(c: str) -> Column:
        x, y = F.col(f"va.{c}"), F.col(f"vb.{c}")
        far = (F.abs(x - y) > tol) & (x != y) if kinds[c] in ("double", "float") else x != y
        return F.when((x.isNull() != y.isNull()) | F.coalesce(far, F.lit(False)), F.lit(c))

    columns = F.concat_ws(",", *map(differs, values))
    what = F.when(F.col("in_b").isNull(), "only in first").when(F.col("in_a").isNull(), "only in second").otherwise(columns)
    key = [F.when(F.col("in_a"), F.col(f"ka.{k}")).otherwise(F.col(f"kb.{k}")).alias(k) for k in keys]
    return both.select(*key, what.alias("difference")).filter("difference <> ''")


def reconcile_external(panel: DataFrame, export: DataFrame, key: list[str], column: str, within: float = 0.0) -> DataFrame:
    """Values of an external export that the panel lacks or has otherwise."""
    theirs = export.select(*key, F.col(column).cast("double").alias("external_value"))
    joined = theirs.join(panel.select(*key, F.col(column).alias("panel_value")), key, "left")
    return joined.filter(F.col("panel_value").isNull() | (F.abs(F.col("panel_value") - F.col("external_value")) > within))
