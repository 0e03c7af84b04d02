"""Metrics of an entity-by-quarter panel, safe across gaps."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.columns import quarter_index, ratio

#: Derived ratios: numerator and denominator.
RATIOS = {
    "equity_to_assets": ("equity", "total_assets"),
    "loans_to_deposits": ("net_loans_leases", "total_deposits"),
    "securities_to_assets": ("securities", "total_assets"),
    "brokered_deposit_share": ("brokered_deposits", "total_deposits"),
    "uninsured_deposit_share": ("uninsured_deposits_est", "total_deposits"),
}
#: Lower bound of each size band, largest first.
BANDS = ((100e6, ">$100B"), (10e6, "$10B-$100B"), (1e6, "$1B-$10B"))
#: First rule that holds names the business model: ratio, sign, bound, name.
MODELS = (("loans", "<", 0.20, "fee_custody"), ("brokered", ">", 0.25, "wholesale_funded"), ("securities", ">", 0.50, "securities_focused"))
OTHER_MODEL = "traditional_lender"
MERGER_GROWTH = 0.25


def with_quarter_index(panel: DataFrame, date: str = "report_date") -> DataFrame:
    return panel.withColumn("quarter_index", quarter_index(date))


def with_ratios(panel: DataFrame, ratios: dict[str, tuple[str, str]] = RATIOS) -> DataFrame:
    return panel.withColumns({name: ratio(a, b) for name, (a, b) in ratios.items()})


def _back(column: str, k: int, entity: str, index: str) -> Column:
    """The value exactly ``k`` quarters back: a frame of the one index, so a gap gives null. (entity, index) must be unique."""
    return F.first(column).over(Window.partitionBy(entity).orderBy(index).rangeBetween(-k, -k))


def growth_vs(column: str, k: int, entity: str = "cert", index: str = "quarter_index") -> Column:
    return ratio(F.col(column), _back(column, k, entity, index)) - 1


def growth_cagr(column: str, k: int = 12, entity: str = "cert", index: str = "quarter_index") -> Column:
    return F.pow(ratio(F.col(column), _back(column, k, entity, index)), F.lit(4.0 / k)) - 1


def trailing_slope(column: str, n: int = 4, entity: str = "cert", index: str = "quarter_index") -> Column:
    """Slope per quarter over the last ``n`` quarters; null unless all have a value."""
    frame = Window.partitionBy(entity).orderBy(index).rangeBetween(1 - n, 0)
    return F.when(F.count(column).over(frame) == n, F.regr_slope(F.col(column), F.col(index)).over(frame))


def peer_band(column: str = "total_assets", bands=BANDS) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for least, name in bands:
        out = out.when(F.col(column) >= least, name)
    return out


def business_model(loans: Column, brokered: Column, securities: Column, rules=MODELS, other: str = OTHER_MODEL) -> Column:
    """First rule that holds; a null ratio falls through."""
    of = {"loans": loans, "brokered": brokered, "securities": securities}
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, sign, bound, model in rules:
        out = out.when(of[name] < bound if sign == "<" else of[name] > bound, model)
    return out.otherwise(other)


def panel_metrics(panel: DataFrame, bands=BANDS) -> DataFrame:
    """Ratios, growth, trend, band and model of each row; one shuffle by entity serves all frames."""
    out = with_ratios(with_quarter_index(panel))
    return out.withColumns(
        {
            "asset_growth_qoq": growth_vs("total_assets", 1),
            "asset_growth_yoy": growth_vs("total_assets", 4),
            "asset_growth_3y_cagr": growth_cagr("total_assets", 12),
            "deposit_growth_yoy": growth_vs("total_deposits", 4),
            "nim_trend_4q": trailing_slope("net_interest_margin_pct", 4),
            "peer_band": peer_band(bands=bands),
            "business_model": business_model(ratio("net_loans_leases", "total_assets"), F.col("brokered_deposit_share"), F.col("securities_to_assets")),
        }
    )


def surrogate_key(entity: str = "cert", date: str = "report_date") -> Column:
    return F.concat_ws("_", F.col(entity).cast("string"), F.date_format(date, "yyyyMMdd"))


def merger_flag(growth: str = "asset_growth_qoq", bound: float = MERGER_GROWTH) -> Column:
    """Null where growth cannot be told."""
    return F.col(growth) > bound


def build_fact(panel: DataFrame, registry: DataFrame, bands=BANDS, entity: str = "cert") -> DataFrame:
    """Metrics of the entities that the registry has. Bands and models are functions of the row, so nothing is joined back."""
    out = panel_metrics(panel, bands).withColumn("bank_quarter_key", surrogate_key(entity)).withColumn("likely_merger_quarter", merger_flag())
    return out.join(registry.select(entity), entity, "left_semi")


def dim_entities(registry: DataFrame, panel: DataFrame, failures: DataFrame, entity: str = "cert") -> DataFrame:
    """Registered entities that the panel has, with their latest failure; assistance is no failure."""
    latest = Window.partitionBy(entity).orderBy(F.col("failure_date").desc_nulls_last(), F.col("assets_at_failure").desc_nulls_last())
    failed = failures.filter(F.col(entity).isNotNull() & (F.col("resolution_type") == "FAILURE"))
    failed = failed.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").select(entity, "failure_date", "resolution_type", "assets_at_failure", F.lit(True).alias("_failed"))
    out = registry.join(panel.select(entity), entity, "left_semi").join(failed, entity, "left")
    return out.withColumn("is_failed", F.coalesce("_failed", F.lit(False))).drop("_failed")
