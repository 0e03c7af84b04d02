"""Robust peer statistics, the signed composite and its parts."""

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.columns import pair_corr
from quarterdeck.operators.orderstats import IN_MEMORY, largest_group, medians

CLAMP, SCALE = 5.0, 1.4826
#: Metrics scored within size bands, and within business models.
BAND_METRICS = [
    "equity_to_assets",
    "loans_to_deposits",
    "securities_to_assets",
    "brokered_deposit_share",
    "uninsured_deposit_share",
    "asset_growth_qoq",
    "asset_growth_yoy",
    "asset_growth_3y_cagr",
    "deposit_growth_yoy",
    "nim_trend_4q",
    "net_interest_margin_pct",
    "roa_pct",
    "efficiency_ratio_pct",
    "cost_of_funds_pct",
]
MODEL_METRICS = ["equity_to_assets", "loans_to_deposits", "asset_growth_yoy", "deposit_growth_yoy", "nim_trend_4q", "net_interest_margin_pct", "roa_pct", "efficiency_ratio_pct", "uninsured_deposit_share", "cost_of_funds_pct"]
#: Sign with which each screened metric counts as risk, and the column of its part.
SIGNS = {
    "uninsured_deposit_share": (1, "z_uninsured_share"),
    "brokered_deposit_share": (1, "z_brokered_share"),
    "securities_to_assets": (1, "z_securities_share"),
    "asset_growth_3y_cagr": (1, "z_asset_growth_3y"),
    "nim_trend_4q": (-1, "z_nim_trend"),
    "equity_to_assets": (-1, "z_equity_ratio"),
}
PARTS = [column for _, column in SIGNS.values()]


def unpivot_metrics(fact: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """(ids, metric, value) without nulls, on which every median and count rests."""
    return fact.unpivot(ids, metrics, "metric", "value").filter(F.col("value").isNotNull())


def group_median(long: DataFrame, by: list[str], value: str = "value", into: str = "peer_median", in_memory: int = IN_MEMORY) -> DataFrame:
    """Exact median, interpolated, and number of values of each group."""
    return medians(long, by, {"x": F.col(value)}, in_memory).select(*by, F.col("x_median").alias(into), F.col("x_count").alias("peer_count"))


def group_mad(long: DataFrame, by: list[str], value: str = "value", in_memory: int = IN_MEMORY) -> DataFrame:
    """(by, peer_median, peer_count, peer_mad): median distance from the median."""
    return _longer(wide_stats(long, by, [value], in_memory), by, [value]).drop("metric")


def wide_stats(fact: DataFrame, by: list[str], metrics: list[str], in_memory: int = IN_MEMORY) -> DataFrame:
    """(by, one struct for each metric: peer_median, peer_count, peer_mad): two aggregates over wide rows, for all metrics at once."""
    rows = fact.select(*by, *metrics)
    largest = largest_group(rows, by)
    middle = medians(rows, by, {m: F.col(m) for m in metrics}, in_memory, largest)
    near = rows.join(middle, by)
    spread = medians(near, by, {m: F.abs(F.col(m) - F.col(f"{m}_median")) for m in metrics}, in_memory, largest)
    kept = spread.select(*by, *[F.col(f"{m}_median").alias(f"{m}_mad") for m in metrics])
    stats = [F.struct(F.col(f"{m}_median").alias("peer_median"), F.col(f"{m}_count").alias("peer_count"), F.col(f"{m}_mad").alias("peer_mad")).alias(m) for m in metrics]
    return middle.join(kept, by).select(*by, *stats)


def group_stats(fact: DataFrame, by: list[str], metrics: list[str], in_memory: int = IN_MEMORY) -> DataFrame:
    """(by, metric, peer_median, peer_count, peer_mad) of metrics that a group has values of."""
    return _longer(wide_stats(fact, by, metrics, in_memory), by, metrics)


def _longer(wide: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """(ids, metric, the struct's fields): a row for each metric whose count isn't zero, made where the wide row is."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), *[F.col(m)[f].alias(f) for f in wide.schema[m].dataType.names]) for m in metrics])
    return wide.select(*ids, F.inline(F.filter(rows, lambda r: r["peer_count"] > 0)))


def robust_z(value: str | Column = "value", clamp: float | None = CLAMP, scale: float = SCALE, median: str | Column = "peer_median", mad: str | Column = "peer_mad") -> Column:
    """Distance from the median in scaled MADs, clamped; null where there is no value or the MAD is zero."""
    value, median, mad = (F.col(x) if isinstance(x, str) else x for x in (value, median, mad))
    z = (value - median) / (scale * mad)
    if clamp is not None:
        z = F.greatest(F.lit(-clamp), F.least(F.lit(clamp), z))
    return F.when((mad > 0) & value.isNotNull(), z)  # the bounds would stand in for a null


def wide_scores(fact: DataFrame, metrics: list[str], group: str, clamp: float = CLAMP, scale: float = SCALE, date: str = "report_date", in_memory: int = IN_MEMORY) -> DataFrame:
    """Rows that have a group, with a struct of each metric in ``_m``: value, its group's median, count and MAD, and its z-score, clamped and not."""
    by = [date, group]
    rows = fact.filter(F.col(group).isNotNull() & F.col(date).isNotNull())
    stats = wide_stats(rows, by, metrics, in_memory).select(*by, F.struct(*metrics).alias("_stats"))

    def scored(m: str) -> Column:
        value, s = F.col(m).cast("double"), F.col("_stats")[m]
        z = lambda c: robust_z(value, c, scale, s["peer_median"], s["peer_mad"])
        return F.struct(value.alias("value"), *[s[f].alias(f) for f in ("peer_median", "peer_count", "peer_mad")], z(clamp).alias("robust_z"), z(None).alias("robust_z_unclamped"))

    return rows.join(stats, by).withColumn("_m", F.struct(*[scored(m).alias(m) for m in metrics])).drop("_stats")


def peer_stats(fact: DataFrame, ids: list[str], metrics: list[str], group: str, clamp: float = CLAMP, scale: float = SCALE, unclamped: bool = True, date: str = "report_date", in_memory: int = IN_MEMORY) -> DataFrame:
    """One row per entity, period and metric, with its group's median and MAD and its z-score. Rows without a group are dropped.

    Groups are joined to wide rows, which become long only after that. ``fact`` is
    read for each aggregate, so it should be a written table.
    """
    wide = wide_scores(fact, metrics, group, clamp, scale, date, in_memory)
    fields = ["value", "peer_median", "peer_count", "peer_mad", "robust_z", *(["robust_z_unclamped"] if unclamped else [])]
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), *[F.col("_m")[m][f].alias(f) for f in fields]) for m in metrics])
    return wide.select(*dict.fromkeys([*ids, date, group]), F.inline(F.filter(rows, lambda r: r["value"].isNotNull())))


def peer_percentiles(fact: DataFrame) -> DataFrame:
    return peer_stats(fact, ["cert", "report_date", "peer_band"], BAND_METRICS, "peer_band")


def model_percentiles(fact: DataFrame) -> DataFrame:
    return peer_stats(fact, ["cert", "report_date", "business_model"], MODEL_METRICS, "business_model", unclamped=False)


def risk_signed(scored: DataFrame, signs: dict[str, tuple[int, str]] = SIGNS) -> DataFrame:
    """Rows of the screened metrics with the sign of risk."""
    sign = F.lit(None).cast("double")
    for metric, (s, _) in signs.items():
        sign = F.when(F.col("metric") == metric, float(s)).otherwise(sign)
    return scored.filter(F.col("metric").isin(*signs)).withColumn("risk_signed_z", F.col("robust_z") * sign)


def composite(scored: DataFrame, ids: tuple[str, ...] = ("cert", "report_date", "peer_band"), signs: dict[str, tuple[int, str]] = SIGNS) -> DataFrame:
    """Mean of the signed z-scores there are, their number, and one column for each; null if none can be told."""
    part = [F.max(F.when(F.col("metric") == m, F.col("risk_signed_z"))).alias(c) for m, (_, c) in signs.items()]
    return risk_signed(scored, signs).groupBy(*ids).agg(F.avg("risk_signed_z").alias("composite_score"), F.count("risk_signed_z").alias("n_screen_metrics"), *part)


def screen_flags(fact: DataFrame, ids: tuple[str, ...] = ("cert", "report_date", "peer_band"), signs: dict[str, tuple[int, str]] = SIGNS, group: str = "peer_band", clamp: float = CLAMP, in_memory: int = IN_MEMORY) -> DataFrame:
    """The composite of a fact with one row per entity and period, from the wide row: what ``composite`` makes of its scores, without a shuffle of rows."""
    wide = wide_scores(fact, list(signs), group, clamp, in_memory=in_memory)
    parts = {c: F.col("_m")[m]["robust_z"] * float(sign) for m, (sign, c) in signs.items()}
    held = wide.filter(F.coalesce(*[F.col("_m")[m]["value"] for m in signs]).isNotNull()).withColumns(parts)
    total = sum((F.coalesce(c, F.lit(0.0)) for c in list(parts)), F.lit(0.0))
    n = sum((F.col(c).isNotNull().cast("bigint") for c in parts), F.lit(0).cast("bigint"))
    return held.select(*ids, F.try_divide(total, n).alias("composite_score"), n.alias("n_screen_metrics"), *parts)


def comoments(flags: DataFrame, parts: list[str] = PARTS, by: list[str] = ["report_date"]) -> DataFrame:  # noqa: B006
    """(by, metric_x, metric_y, n, mean_x, mean_y, sxx, syy, sxy, and least and largest values): what a correlation over any span needs of each slice.

    Each pair counts the scored rows that have both values. One aggregate makes all
    pairs; the table has one row for each slice and pair, and is worth writing.
    """
    pairs = list(combinations(parts, 2))

    def moments(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(both, F.col(c)) for c in (a, b))
        n = F.count(x)
        ends = [f(v).alias(f"{name}_{k}") for k, v in (("x", x), ("y", y)) for name, f in (("least", F.min), ("most", F.max))]
        return F.struct(n.alias("n"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"), (F.var_pop(x) * n).alias("sxx"), (F.var_pop(y) * n).alias("syy"), (F.covar_pop(x, y) * n).alias("sxy"), *ends)

    wide = flags.filter("composite_score IS NOT NULL").groupBy(*by).agg(*[moments(a, b).alias(f"{a}|{b}") for a, b in pairs])
    fields = wide.schema[f"{pairs[0][0]}|{pairs[0][1]}"].dataType.names
    rows = F.array(*[F.struct(F.lit(a).alias("metric_x"), F.lit(b).alias("metric_y"), *[F.col(f"{a}|{b}")[f].alias(f) for f in fields]) for a, b in pairs])
    return wide.select(*by, F.inline(F.filter(rows, lambda r: r["n"] > 0)))


def merged_comoments(moments: DataFrame, by: list[str]) -> DataFrame:
    """Co-moments of wider slices from those of narrower ones: deviations are moved to the common mean, so nothing cancels."""
    pair = [*by, "metric_x", "metric_y"]
    over = Window.partitionBy(*pair)  # as many rows as slices
    mean = lambda k: F.sum(F.col("n") * F.col(f"mean_{k}")).over(over) / F.sum("n").over(over)
    moved = moments.withColumns({"_x": mean("x"), "_y": mean("y")})
    dx, dy = F.col("mean_x") - F.col("_x"), F.col("mean_y") - F.col("_y")
    about = lambda s, a, b: F.sum(F.col(s) + F.col("n") * a * b).alias(s)
    ends = [f(f"{name}_{k}").alias(f"{name}_{k}") for k in "xy" for name, f in (("least", F.min), ("most", F.max))]
    return moved.groupBy(*pair).agg(F.sum("n").alias("n"), F.first("_x").alias("mean_x"), F.first("_y").alias("mean_y"), about("sxx", dx, dx), about("syy", dy, dy), about("sxy", dx, dy), *ends)


def correlation_of(moments: DataFrame, by: list[str] = [], digits: int = 2) -> DataFrame:  # noqa: B006
    """(by, metric_x, metric_y, correlation) in both orders from co-moments; null where a metric is constant."""
    whole = merged_comoments(moments, by)
    varies = (F.col("least_x") < F.col("most_x")) & (F.col("least_y") < F.col("most_y"))
    r = F.round(F.when(varies, F.try_divide("sxy", F.sqrt("sxx") * F.sqrt("syy"))), digits)
    sides = F.array(*[F.struct(F.col(a).alias("metric_x"), F.col(b).alias("metric_y"), r.alias("correlation")) for a, b in (("metric_x", "metric_y"), ("metric_y", "metric_x"))])
    return whole.select(*by, F.inline(sides))


def metric_correlation(flags: DataFrame, parts: list[str] = PARTS, digits: int = 2) -> DataFrame:
    """(metric_x, metric_y, correlation) in both orders, from one aggregate of all pairs. Pairs without a common row have a null."""
    pairs = list(combinations(parts, 2))
    wide = flags.filter("composite_score IS NOT NULL").agg(*[pair_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = [F.struct(F.lit(x).alias("metric_x"), F.lit(y).alias("metric_y"), F.round(F.col(f"{a}|{b}"), digits).alias("correlation")) for a, b in pairs for x, y in ((a, b), (b, a))]
    return wide.select(F.inline(F.array(*rows)))
