"""Profile, peer-explorer, sector and extract views over the marts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.columns import quarter_tag
from quarterdeck.operators.ranks import with_ranks
from quarterdeck.operators.screen import latest
from quarterdeck.sources.writers import materialized


def pick_list(df: DataFrame, column: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Distinct values with a label."""
    label = F.col(column)
    for value, text in (labels or {}).items():
        label = F.when(F.col(column) == value, text).otherwise(label)
    return df.select(F.col(column).alias("value"), label.alias("label")).distinct().filter("value IS NOT NULL")


def peer_selection(scored: DataFrame, dim: DataFrame, group: str, value: str, metric: str) -> DataFrame:
    """Active entities of one peer group with one metric, in the last quarter."""
    rows = latest(scored).filter((F.col(group) == value) & (F.col("metric") == metric))
    return rows.join(dim.filter("is_active").select("cert", "bank_name"), "cert")


def markers(selection: DataFrame) -> DataFrame:
    """Percentiles of a selection, and where its outliers begin on either side."""
    p = lambda q: F.percentile("value", q)
    return selection.agg(
        p(0.1).alias("p10"),
        F.median("value").alias("median"),
        p(0.9).alias("p90"),
        F.min(F.when(F.col("robust_z") >= 2, F.col("value"))).alias("high_from"),
        F.max(F.when(F.col("robust_z") <= -2, F.col("value"))).alias("low_to"),
    )


def highlight(selection: DataFrame, entity: int) -> DataFrame:
    return selection.filter(F.col("cert") == entity).limit(1)


def deciles(selection: DataFrame) -> DataFrame:
    """The top and bottom tenth of a selection."""
    rank = with_ranks(materialized(selection), "value", {"value": ["report_date", "metric"]}).withColumnRenamed("value_percentile", "percentile")
    side = F.when(F.col("percentile") >= 0.9, "top").when(F.col("percentile") <= 0.1, "bottom")
    return rank.drop("value_rank", "value_size").withColumn("decile", side).filter("decile IS NOT NULL")


def availability(scored: DataFrame, group: str, value: str) -> DataFrame:
    """How many entities of a group have each metric in the last quarter."""
    return latest(scored).filter(F.col(group) == value).groupBy("metric").agg(F.count("*").alias("available"))


def entity_history(fact: DataFrame, entity: int, columns: list[str], scale: int = 1, digits: int | None = None) -> DataFrame:
    """One entity's quarters; ``scale`` divides every column. With ``digits`` (up to eight) values are divided and rounded as decimals, so that a tie doesn't hang on the last bit of a double."""

    def scaled(c: str) -> Column:
        if digits is None:
            return F.col(c) / scale
        return F.round(F.col(c).cast("decimal(28,8)") / F.lit(scale).cast("decimal(9,0)"), digits).cast("double")

    return fact.filter(F.col("cert") == entity).select("report_date", *[scaled(c).alias(c) for c in columns])


def profile_header(fact: DataFrame, entities: list[int] | None = None) -> DataFrame:
    """Last quarter, number of quarters, and latest model and band of each entity."""
    rows = fact.filter(F.col("cert").isin(entities)) if entities else fact
    return rows.groupBy("cert").agg(
        F.max("report_date").alias("latest_quarter"),
        F.count("*").alias("quarters"),
        F.max_by("business_model", "report_date").alias("business_model"),
        F.max_by("peer_band", "report_date").alias("peer_band"),
    )


def screen_history(flags: DataFrame, entity: int) -> DataFrame:
    return flags.filter(F.col("cert") == entity).select("report_date", "composite_score", "n_screen_metrics")


def screen_now(flags: DataFrame, scored: DataFrame, entity: int, metrics: dict[str, str]) -> DataFrame:
    """One line for each screened metric of an entity's last quarter, with text forms; strongest first."""
    row = latest(flags.filter(F.col("cert") == entity)).select("cert", "report_date", *metrics.values())
    lines = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).alias("z")) for m, c in metrics.items()])
    long = row.select("cert", "report_date", F.inline(lines))
    values = scored.filter(F.col("cert") == entity).select("cert", "report_date", "metric", "value", "peer_median")
    out = long.join(values, ["cert", "report_date", "metric"], "left")
    text = lambda c: F.when(F.col(c).isNotNull(), F.format_string("%.2f", F.col(c)))
    return out.withColumn("z_text", text("z")).withColumn("value_text", text("value")).orderBy(F.abs("z").desc_nulls_last(), "metric")


def entity_labels(dim: DataFrame) -> DataFrame:
    return dim.select("cert", F.concat("bank_name", F.lit(" — "), "city", F.lit(", "), "state_code").alias("label"))


def sector_kpis(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Last and prior quarter's counts, sums and medians side by side."""
    dates = fact.select("report_date").distinct().orderBy(F.desc("report_date")).limit(2)
    rows = fact.join(F.broadcast(dates), "report_date", "left_semi").join(dim.select("cert", "is_active"), "cert", "left")
    measures = {
        "banks": F.count("*"),
        "active_banks": F.count_if("is_active"),
        "assets": F.sum("total_assets"),
        "median_nim": F.median("net_interest_margin_pct"),
        "median_roa": F.median("roa_pct"),
    }
    per = rows.groupBy("report_date").agg(*[c.alias(n) for n, c in measures.items()])
    return per.agg(F.max("report_date").alias("latest"), *[f(n, "report_date").alias(p + n) for n in measures for p, f in (("", F.max_by), ("prior_", F.min_by))])


def report_kpis(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """The last quarter in one row."""
    rows = latest(fact).join(dim.select("cert", "is_active"), "cert", "left")
    return rows.agg(
        F.max("report_date").alias("quarter"),
        F.count("*").alias("banks"),
        F.count_if("is_active").alias("active_banks"),
        F.sum("total_assets").alias("assets"),
        F.median("net_interest_margin_pct").alias("median_nim"),
        F.median("roa_pct").alias("median_roa"),
        F.median("equity_to_assets").alias("median_equity_ratio"),
    )


def sector_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("report_date").agg(F.count("*").alias("banks"), F.sum("total_assets").alias("assets"), F.median("net_interest_margin_pct").alias("median_nim"))


def band_trend(fact: DataFrame) -> DataFrame:
    return fact.filter("peer_band IS NOT NULL").groupBy("report_date", "peer_band").agg(F.count("*").alias("banks"), F.sum("total_assets").alias("assets"))


def funding_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("report_date").agg(F.median("brokered_deposit_share").alias("brokered"), F.median("uninsured_deposit_share").alias("uninsured"), F.median("loans_to_deposits").alias("loans_to_deposits"))


def weekly_indexed(series: DataFrame, since) -> DataFrame:
    """Each series as a percentage of its first value since a date."""
    rows = series.filter(F.col("obs_date") >= F.lit(since))
    first = F.first("value").over(Window.partitionBy("series_id").orderBy("obs_date"))
    return rows.withColumn("index_value", F.try_divide(F.col("value"), first) * 100)


def recent_weeks(series: DataFrame, weeks: int = 12) -> DataFrame:
    """The last weeks up to the last date of all series."""
    last = series.agg(F.max("obs_date").alias("_last"))
    return series.join(F.broadcast(last), F.col("obs_date") > F.date_sub("_last", 7 * weeks)).drop("_last")


def wide_weeks(series: DataFrame, ids: list[str]) -> DataFrame:
    return series.groupBy("obs_date").pivot("series_id", ids).agg(F.first("value"))


def forecast_fan(actuals: DataFrame, path: DataFrame, days: int = 180) -> DataFrame:
    """Recent actual values and the published path in one shape."""
    last = actuals.agg(F.max("obs_date").alias("_last"))
    recent = actuals.join(F.broadcast(last), F.col("obs_date") >= F.date_sub("_last", days)).select("series_id", "obs_date", F.col("value").alias("actual"))
    return recent.unionByName(path, allowMissingColumns=True)


def forecast_scoreboard(scores: DataFrame, digits: int = 3) -> DataFrame:
    status = F.when(F.col("published"), "published").otherwise("not used")
    return scores.select("series_id", "method", F.round("mape", digits).alias("mape"), F.round("smape", digits).alias("smape"), status.alias("status"))


def extract_peer_latest(scored: DataFrame, digits: int = 4) -> DataFrame:
    rows = latest(scored)
    return rows.select("cert", "report_date", "peer_band", "metric", *[F.round(c, digits).alias(c) for c in ("value", "peer_median", "robust_z")])


def extract_trends(fact: DataFrame, columns: list[str], n: int = 12) -> DataFrame:
    """The last ``n`` distinct quarters; of a mart that is partitioned by quarter, only these are read."""
    first = fact.select("report_date").distinct().orderBy(F.desc("report_date")).limit(n).agg(F.min("report_date"))
    return fact.filter(F.col("report_date") >= first.scalar()).select("cert", "report_date", quarter_tag("report_date").alias("quarter"), *columns)


def beyond_sigma(scored: DataFrame, bound: float = 2.0) -> DataFrame:
    return scored.filter(F.abs("robust_z") >= bound)


def bi_measures(fact: DataFrame) -> DataFrame:
    """Sums by quarter with growth on the quarter present before, and on the same quarter a year before."""
    sums = fact.groupBy("report_date").agg(F.sum("total_assets").alias("assets"))
    by_date = Window.orderBy("report_date")  # as many rows as quarters
    months = sums.withColumn("_m", F.year("report_date") * 12 + F.month("report_date"))
    year_back = F.first("assets").over(Window.orderBy("_m").rangeBetween(-12, -12))
    return months.select("report_date", "assets", (F.col("assets") / F.nullif(F.lag("assets").over(by_date), F.lit(0)) - 1).alias("qoq"), (F.col("assets") / F.nullif(year_back, F.lit(0)) - 1).alias("yoy"))


def delta_to_median(scored: DataFrame) -> DataFrame:
    return scored.select("cert", "report_date", "metric", (F.col("value") - F.col("peer_median")).alias("delta"))


def entities(df: DataFrame, columns: list[str], key: str = "cert") -> DataFrame:
    """One row for each entity: its latest by period."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("report_date")))
    return df.withColumn("_n", last).filter("_n = 1").select(key, *columns)


def populations(dim: DataFrame, fact: DataFrame, flags: DataFrame) -> DataFrame:
    """Labelled counts of entities."""
    count = lambda df, label: df.agg(F.countDistinct("cert").alias("entities")).select(F.lit(label).alias("population"), "entities")
    return count(dim, "in the registry and in scope").unionByName(count(latest(fact), "filed last quarter")).unionByName(count(latest(flags).filter("composite_score IS NOT NULL"), "scored last quarter"))


def merger_stats(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_if("likely_merger_quarter").alias("flagged_rows"), F.countDistinct(F.when(F.col("likely_merger_quarter"), F.col("cert"))).alias("flagged_banks"))


def report_pages(fact: DataFrame, by: list[str]) -> DataFrame:
    return fact.groupBy(*by).agg(F.sum("total_assets").alias("assets"), F.avg("roa_pct").alias("avg_roa"), F.count("*").alias("rows"))
