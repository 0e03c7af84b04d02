"""Registered queries of the operators over the test tables, each with an independent SQL twin for DuckDB."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from quarterdeck import schemas
from quarterdeck.functions import columns as c
from quarterdeck.operators import experiment as x
from quarterdeck.operators import forecast as fc
from quarterdeck.operators import forecast_states as states
from quarterdeck.operators import panel as p
from quarterdeck.operators import changes, parity, peers, product, quality, screen, staging, user_sets, views
from quarterdeck.plans import backtest, oracle
from quarterdeck.plans import bindings as b
from quarterdeck.sources import readers, versioned, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, doubles: str = ""):
    """Register a query under its function's name; doubles are rounded to six digits on both sides."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: c.rounded(f(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = oracle.statement(sql, doubles.split())
        return f

    return register


# Sources and sinks


@query("SELECT CAST(cert AS VARCHAR) AS CERT, strftime(report_date, '%Y%m%d') AS REPDTE FROM panel")
def s01_landed_pages(spark, d):
    """The panel landed as one response a page, of at most 1,000 rows, and read back."""
    rows = b.panel(spark, d).select(F.struct(F.col("cert").cast("string").alias("CERT"), F.date_format("report_date", "yyyyMMdd").alias("REPDTE")).alias("data"), "report_date", "cert")
    totals = rows.groupBy("report_date").agg(F.count("*").alias("total"))
    pages = rows.groupBy("report_date", F.floor(F.col("cert") / 1000).alias("page")).agg(F.collect_list(F.struct("data")).alias("data")).join(totals, "report_date")
    page = pages.select(
        F.struct(F.date_format("report_date", "yyyyMMdd").alias("endpoint"), F.create_map(F.lit("page"), F.col("page").cast("string")).alias("params")).alias("request"),
        F.struct(F.struct("total").alias("meta"), "data").alias("response"),
    )
    path = writers.shared_folder(spark)
    page.write.option("maxRecordsPerFile", 1).json(path)
    return readers.read_landed_pages(spark, path, schemas.texts("CERT REPDTE"))


@query("SELECT CAST(cert AS BIGINT) AS cert, CAST(strftime(report_date, '%Y-%m-%d') AS VARCHAR) AS report_date, CAST(NULL AS DOUBLE) AS total_assets FROM panel")
def s07_enforce_schema(spark, d):
    """A batch with a whole-number key, a date and no sizes, in the types of a table that has them."""
    batch = b.panel(spark, d).select(F.col("cert").cast("int").alias("cert"), "report_date")
    return readers.enforce_schema(batch, schemas.struct(cert=schemas.NUMBER, report_date=schemas.TEXT, total_assets=schemas.REAL))


@query("SELECT cert, bank_name FROM registry")
def s14_switched(spark, d):
    """Of two sources one is enabled."""
    path = writers.shared_folder(spark)
    b.registry(spark, d).select("cert", "bank_name").write.parquet(path)
    assert readers.switched(spark, {"registry": path}, "events") is None
    return readers.switched(spark, {"registry": path}, "registry")


@query("SELECT cert, report_date, total_assets FROM panel WHERE report_date >= DATE '2001-01-01'", "total_assets")
def s15_truncate_load(spark, d):
    """Two loads of one table: the second replaces the first."""
    path, rows = writers.shared_folder(spark), b.panel(spark, d).select("cert", "report_date", "total_assets")
    writers.truncate_load(rows.filter("report_date < DATE'2001-01-01'"), path)
    writers.truncate_load(rows.filter("report_date >= DATE'2001-01-01'"), path)
    return staging.except_columns(readers.read_table(spark, path), "generated_at")


@query("SELECT cert, report_date, total_assets, equity_to_assets FROM fact", "total_assets equity_to_assets")
def s16_merge_fact(spark, d):
    """An old half of the fact, other in its sizes, and then the whole: as a rebuild would give."""
    fact = b.fact(spark, d).select("cert", "report_date", "total_assets", "equity_to_assets")
    path = writers.shared_folder(spark)
    writers.merge_fact(fact.filter("report_date < DATE'2001-01-01'").withColumn("total_assets", F.col("total_assets") + 1), path, ["cert", "report_date"], "report_date")
    writers.merge_fact(fact, path, ["cert", "report_date"], "report_date")
    return readers.read_table(spark, path).select(fact.columns)


@query("SELECT cert, report_date, total_assets, asset_growth_yoy, asset_growth_3y_cagr, nim_trend_4q FROM fact", "total_assets asset_growth_yoy asset_growth_3y_cagr nim_trend_4q")
def s16_change_sets(spark, d):
    """The fact from a panel with some quarters otherwise, one too many and some missing, then brought up to date by change sets."""
    source, registry = writers.materialized(b.panel(spark, d)), b.registry(spark, d)
    build = lambda rows: p.build_fact(rows, registry, b.BANDS)
    picked = F.pmod(F.xxhash64("cert", "report_date"), F.lit(40))
    other = source.filter(picked != 0).withColumn("total_assets", F.when(picked == 1, F.col("total_assets") * 2).otherwise(F.col("total_assets")))
    extra = source.filter(picked == 2).withColumn("report_date", F.last_day(F.add_months("report_date", -600)))
    path = writers.shared_folder(spark)
    changes.maintain(other.unionByName(extra), path, build, buckets=8)
    changes.maintain(source, path, build, buckets=8)
    return versioned.read(spark, f"{path}/fact").select("cert", "report_date", "total_assets", "asset_growth_yoy", "asset_growth_3y_cagr", "nim_trend_4q")


@query("SELECT cert, report_date, CASE WHEN report_date >= DATE '2001-01-01' THEN total_assets + 1 ELSE total_assets END AS total_assets FROM panel", "total_assets")
def s05_versioned_upsert(spark, d):
    """The same by versions: written, merged and read back."""
    held = b.panel(spark, d).select("cert", "report_date", "total_assets")
    path = writers.shared_folder(spark)
    versioned.upsert(held.filter(F.col("report_date") < F.lit(date(2001, 7, 1))), path, ["cert", "report_date"], buckets=8)
    versioned.upsert(held.filter(F.col("report_date") >= F.lit(date(2001, 1, 1))).withColumn("total_assets", F.col("total_assets") + 1), path, ["cert", "report_date"])
    return versioned.read(spark, path)


@query("SELECT cert, report_date, total_assets FROM panel", "total_assets")
def s08_ensure_table(spark, d):
    """A typed table for a source that has no data yet: made empty, filled, and found again as it is."""
    rows = b.panel(spark, d).select("cert", "report_date", "total_assets")
    path, schema = writers.shared_folder(spark), rows.schema
    assert versioned.ensure(spark, path, schema, ["cert", "report_date"], buckets=4).isEmpty()
    versioned.upsert(rows, path, ["cert", "report_date"])
    return versioned.ensure(spark, path, schema, ["cert", "report_date"])


@query("SELECT CAST(cert AS VARCHAR) AS cert, bank_name, CASE WHEN is_active THEN 'true' ELSE 'false' END AS is_active FROM dim")
def s17_exhibit(spark, d):
    path = writers.shared_folder(spark)
    writers.write_exhibit(b.dim(spark, d).select("cert", "bank_name", "is_active"), path)
    return spark.read.csv(path, header=True)


@query("SELECT strftime(report_date, '%Y%m%d') AS RISDATE, CAST(count(*) AS VARCHAR) AS ASSET FROM panel GROUP BY 1")
def s19_export_csv(spark, d):
    """A quoted export whose first name begins with a byte order mark."""
    path = writers.shared_folder(spark)
    rows = b.panel(spark, d).groupBy("report_date").count().select(F.date_format("report_date", "yyyyMMdd"), "count").toDF("\ufeffRISDATE", "ASSET")
    rows.write.csv(path, header=True, quoteAll=True)
    return readers.read_export_csv(spark, path)


@query("SELECT cert, report_date, total_assets FROM panel WHERE total_assets >= 1000000", "total_assets")
def s03_scope_filter(spark, d):
    return readers.scope_filter(b.panel(spark, d), "total_assets").select("cert", "report_date", "total_assets")


@query("SELECT cert, report_date, total_assets, CAST(NULL AS VARCHAR) AS website FROM panel", "total_assets")
def s02_conform(spark, d):
    return readers.conform(b.panel(spark, d), schemas.struct(cert=schemas.NUMBER, report_date=schemas.DATE, total_assets=schemas.REAL, website=schemas.TEXT))


@query("SELECT DISTINCT quarter_end, strftime(quarter_end, '%Y%m%d') AS tag FROM (SELECT CAST(date_trunc('quarter', q) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end FROM (SELECT unnest(generate_series((SELECT min(report_date) FROM panel)::TIMESTAMP, (SELECT max(report_date) FROM panel)::TIMESTAMP, INTERVAL 1 DAY)) AS q)) WHERE quarter_end <= (SELECT max(report_date) FROM panel)")
def s04_quarter_calendar(spark, d):
    first, last = b.panel(spark, d).agg(F.min("report_date"), F.max("report_date")).first()
    return readers.quarter_calendar(spark, first, last)


@query("SELECT cert, report_date, CASE WHEN report_date >= DATE '2001-01-01' THEN total_assets + 1 ELSE total_assets END AS total_assets FROM panel", "total_assets")
def s05_keyed_merge(spark, d):
    """A restated batch (the last quarters, one unit larger) merged into the older ones and themselves."""
    held = b.panel(spark, d).select("cert", "report_date", "total_assets").filter(F.col("report_date") < F.lit(date(2001, 7, 1)))
    batch = b.panel(spark, d).filter(F.col("report_date") >= F.lit(date(2001, 1, 1))).select("cert", "report_date", (F.col("total_assets") + 1).alias("total_assets"))
    return writers.merged(held, batch, ["cert", "report_date"])


@query("SELECT 'duplicate key' AS fault, count(*) AS n FROM (SELECT k FROM (SELECT nullif(o_custkey % 100, 0) AS k FROM orders) GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'null key', count(*) FROM orders WHERE o_custkey % 100 = 0")
def s06_validate_batch(spark, d):
    return writers.batch_faults(b.table(spark, d, "orders").select(F.nullif(F.col("o_custkey") % 100, F.lit(0)).alias("k")), ["k"])


@query("SELECT count(*) AS row_count, max(report_date) AS max_value FROM panel")
def s09_probes(spark, d):
    panel = b.panel(spark, d)
    return spark.createDataFrame([(readers.row_count(panel), readers.max_value(panel, "report_date"))], "row_count bigint, max_value date")


@query("SELECT CAST(max(strftime(report_date, '%Y%m%d')) AS VARCHAR) AS published, max(report_date) > (SELECT max(report_date) FROM panel WHERE report_date < DATE '2001-01-01') AS available FROM panel")
def s10_new_period(spark, d):
    raw = b.raw_financials(spark, d)
    new = readers.new_period_available(raw, raw.filter("REPDTE < '20010101'"), "REPDTE")
    return raw.agg(F.max("REPDTE").alias("published")).withColumn("available", F.lit(new))


@query("SELECT series_id, 'orders ' || series_id AS served_title, CAST(NULL AS VARCHAR) AS listed_title FROM (SELECT DISTINCT series_id FROM weekly) WHERE series_id LIKE '1%'")
def s11_catalog_mismatches(spark, d):
    titled = b.weekly(spark, d).withColumn("series_title", F.concat(F.lit("orders "), "series_id"))
    catalog = titled.filter("series_id NOT LIKE '1%'").select("series_id", "series_title").distinct()
    return readers.catalog_mismatches(titled, catalog)


@query("SELECT strftime(ts, '%Y%m%d') AS event_date, event_name, 'u' || user_id AS user_pseudo_id, CAST(event_id AS VARCHAR) AS transaction_id FROM ev WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'")
def s13_sharded_scan(spark, d):
    """Events in one folder a day; the scan lists the days asked for."""
    path = writers.shared_folder(spark)
    b.raw_events(spark, d).select("event_date", "event_name", "user_pseudo_id", F.col("ecommerce.transaction_id").alias("transaction_id")).write.partitionBy("event_date").parquet(path)
    return readers.sharded_scan(readers.read_table(spark, path).withColumn("event_date", F.col("event_date").cast("string")), "20240110", "20240115")


@query("SELECT cert, report_date, total_assets FROM panel WHERE report_date <= DATE '1999-06-30'", "total_assets")
def s18_frozen(spark, d):
    cut = readers.frozen({"financials": b.panel(spark, d)}, b.AS_OF, {"financials": ("report_date", "yyyy-MM-dd")})
    return cut["financials"].select("cert", "report_date", "total_assets")


@query("SELECT CAST(cert AS VARCHAR) AS cert, strftime(report_date, '%Y-%m-%d') AS report_date, coalesce(peer_band, '') AS peer_band FROM fact")
def s20_extract(spark, d):
    return writers.flat(b.fact(spark, d).select("cert", "report_date", "peer_band"))


# Staging


@query("SELECT cert, report_date, total_assets, total_deposits, net_interest_margin_pct FROM panel WHERE report_date <= DATE '1999-06-30'", "total_assets total_deposits net_interest_margin_pct")
def p01_stage_financials(spark, d):
    raw = readers.conform(b.raw_financials(spark, d), schemas.FINANCIALS)
    return staging.stage_financials(raw, b.AS_OF).select("cert", "report_date", "total_assets", "total_deposits", "net_interest_margin_pct")


@query("SELECT s_suppkey * 2 + turn AS failure_id, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey END AS cert, CAST(DATE '2000-01-01' + CAST(s_suppkey % 1000 - 400 * turn AS INTEGER) AS DATE) AS failure_date, CASE WHEN s_suppkey % 3 = 0 THEN 'ASSISTANCE' ELSE 'FAILURE' END AS resolution_type FROM supplier, (VALUES (0), (1)) t(turn) WHERE s_acctbal < 0 AND (turn = 0 OR s_suppkey % 4 = 0)")
def p02_stage_failures(spark, d):
    return b.failures(spark, d).select("failure_id", "cert", "failure_date", "resolution_type")


@query("SELECT cert, bank_name, is_active, CAST(DATE '1950-01-01' + CAST(cert % 9000 AS INTEGER) AS DATE) AS established_date FROM registry")
def p04_stage_institutions(spark, d):
    raw = readers.conform(b.raw_institutions(spark, d), schemas.INSTITUTIONS)
    return staging.stage_institutions(raw).select("cert", "bank_name", "is_active", "established_date")


@query("SELECT CAST(ts AS DATE) AS event_date, event_name, 'u' || user_id AS user_pseudo_id, session AS ga_session_id, day AS ga_session_number, 'u' || user_id || '-' || session AS session_key, 'https://site.example/p' || k AS page_location, engaged AS session_engaged, source AS event_source, medium AS event_medium, device, country, ft_source, ft_medium, revenue FROM ev", "revenue")
def p08_normalize_events(spark, d):
    e = product.normalize_events(b.raw_events(spark, d))
    return e.select("event_date", "event_name", "user_pseudo_id", "ga_session_id", "ga_session_number", "session_key", "page_location", "session_engaged", "event_source", "event_medium", F.col("device_category").alias("device"), "country", F.col("first_touch_source").alias("ft_source"), F.col("first_touch_medium").alias("ft_medium"), F.col("purchase_revenue_usd").alias("revenue"))


@query("SELECT 'u' || user_id || '-' || session AS session_key, count(*) AS events FROM ev WHERE session IS NOT NULL GROUP BY 1")
def p10_session_events(spark, d):
    e = product.normalize_events(b.raw_events(spark, d)).filter("ga_session_id IS NOT NULL")
    return e.groupBy("session_key").agg(F.count("*").alias("events"))


@query("SELECT series_id, obs_date, value FROM weekly WHERE month(obs_date) <> 7", "value")
def p03_stage_weekly(spark, d):
    """Values as text, a dot in each July."""
    raw = b.weekly(spark, d).select("series_id", F.lit("t").alias("series_title"), F.col("obs_date").cast("string").alias("obs_date"), F.when(F.month("obs_date") == 7, ".").otherwise(F.col("value").cast("string")).alias("value"))
    return staging.stage_weekly(raw).drop("series_title")


@query("SELECT * EXCLUDE (city, is_active) FROM registry")
def p11_except_columns(spark, d):
    return staging.except_columns(b.registry(spark, d), "city", "is_active", "state_name")


# Panel


@query("SELECT cert, report_date, quarter_index, equity_to_assets, loans_to_deposits, securities_to_assets, brokered_deposit_share, uninsured_deposit_share FROM metrics", "equity_to_assets loans_to_deposits securities_to_assets brokered_deposit_share uninsured_deposit_share")
def m02_ratios(spark, d):
    return p.with_ratios(p.with_quarter_index(b.panel(spark, d))).select("cert", "report_date", "quarter_index", *p.RATIOS)


@query("SELECT a.cert, a.report_date, a.quarter_index, a.total_assets / q.total_assets - 1 AS growth_1, a.total_assets / y.total_assets - 1 AS growth_4, pow(a.total_assets / t.total_assets, 1e0 / 3) - 1 AS cagr_12 FROM sparse a LEFT JOIN sparse q ON q.cert = a.cert AND q.quarter_index = a.quarter_index - 1 LEFT JOIN sparse y ON y.cert = a.cert AND y.quarter_index = a.quarter_index - 4 LEFT JOIN sparse t ON t.cert = a.cert AND t.quarter_index = a.quarter_index - 12", "growth_1 growth_4 cagr_12")
def m03_growth(spark, d):
    s = b.sparse_panel(spark, d)
    return s.select("cert", "report_date", "quarter_index", p.growth_vs("total_assets", 1).alias("growth_1"), p.growth_vs("total_assets", 4).alias("growth_4"), p.growth_cagr("total_assets", 12).alias("cagr_12"))


@query("SELECT a.cert, a.quarter_index, CASE WHEN count(x.quarter_index) = 4 THEN covar_pop(x.total_assets, CAST(x.quarter_index AS DOUBLE)) / var_pop(CAST(x.quarter_index AS DOUBLE)) END AS slope FROM sparse a JOIN sparse x ON x.cert = a.cert AND x.quarter_index BETWEEN a.quarter_index - 3 AND a.quarter_index GROUP BY a.cert, a.quarter_index", "slope")
def m05_trailing_slope(spark, d):
    return b.sparse_panel(spark, d).select("cert", "quarter_index", p.trailing_slope("total_assets").alias("slope"))


@query("SELECT bank_quarter_key, cert, report_date, peer_band, business_model, likely_merger_quarter, asset_growth_qoq, asset_growth_yoy, asset_growth_3y_cagr, deposit_growth_yoy, nim_trend_4q FROM fact", "asset_growth_qoq asset_growth_yoy asset_growth_3y_cagr deposit_growth_yoy nim_trend_4q")
def m10_fact(spark, d):
    return b.fact(spark, d).select("bank_quarter_key", "cert", "report_date", "peer_band", "business_model", "likely_merger_quarter", "asset_growth_qoq", "asset_growth_yoy", "asset_growth_3y_cagr", "deposit_growth_yoy", "nim_trend_4q")


@query("SELECT cert, bank_name, city, state_code, is_active, is_failed, failure_date, assets_at_failure FROM dim", "assets_at_failure")
def m11_dim_entities(spark, d):
    return b.dim(spark, d).select("cert", "bank_name", "city", "state_code", "is_active", "is_failed", "failure_date", "assets_at_failure")


# Peers


@query("SELECT cert, report_date, metric, value FROM long WHERE peer_band IS NOT NULL", "value")
def r01_unpivot_metrics(spark, d):
    return peers.unpivot_metrics(b.fact(spark, d).filter("peer_band IS NOT NULL"), ["cert", "report_date"], peers.BAND_METRICS)


@query("SELECT metric, report_date, peer_band, peer_median, peer_count, peer_mad FROM stats", "peer_median peer_mad")
def r03_group_mad(spark, d):
    """All metrics at once, from wide rows."""
    return peers.group_stats(b.fact(spark, d).filter("peer_band IS NOT NULL"), ["report_date", "peer_band"], peers.BAND_METRICS)


@query("SELECT cert, report_date, peer_band, metric, value, peer_median, peer_count, robust_z, robust_z_unclamped FROM scored", "value peer_median robust_z robust_z_unclamped")
def r04_robust_z(spark, d):
    return b.scored(spark, d).select("cert", "report_date", "peer_band", "metric", "value", "peer_median", "peer_count", "robust_z", "robust_z_unclamped")


@query("SELECT cert, report_date, business_model, metric, value, peer_median, robust_z FROM model_scored", "value peer_median robust_z")
def r06_model_percentiles(spark, d):
    return peers.model_percentiles(b.fact(spark, d)).select("cert", "report_date", "business_model", "metric", "value", "peer_median", "robust_z")


@query("SELECT * FROM flags", "composite_score z_uninsured_share z_brokered_share z_securities_share z_asset_growth_3y z_nim_trend z_equity_ratio")
def r08_composite(spark, d):
    """From the long scores; the screen takes the same from wide rows."""
    return peers.composite(peers.peer_stats(b.fact(spark, d), ["cert", "report_date", "peer_band"], list(peers.SIGNS), "peer_band", unclamped=False))


@query("SELECT * FROM flags", "composite_score z_uninsured_share z_brokered_share z_securities_share z_asset_growth_3y z_nim_trend z_equity_ratio")
def r08_screen_flags(spark, d):
    """From wide rows, with ranges refined in the larger groups."""
    return peers.screen_flags(b.fact(spark, d), in_memory=16)


@query(oracle.CORRELATION, "correlation")
def r10_metric_correlation(spark, d):
    return peers.metric_correlation(b.flags(spark, d), digits=6)


@query(oracle.SPAN_CORRELATION, "correlation")
def r10_span_correlation(spark, d):
    """Each year, and all quarters, from the co-moments of quarters, which are computed once."""
    moments = writers.materialized(peers.comoments(b.flags(spark, d)))
    years = peers.correlation_of(moments.withColumn("span", F.year("report_date").cast("string")), ["span"], 6)
    return years.unionByName(peers.correlation_of(moments.withColumn("span", F.lit("all")), ["span"], 6))


# Screen


def _ranked(spark, d):
    fact = b.fact(spark, d)
    return screen.rank_screen(b.flags(spark, d, fact), b.dim(spark, d), fact)


RANK_COLUMNS = ["cert", "report_date", "peer_band", "composite_score", "band_rank", "band_size", "band_percentile", "overall_rank", "overall_size", "overall_percentile", "bank_name", "is_failed", "total_assets"]
RANK_DOUBLES = "composite_score band_percentile overall_percentile total_assets"


@query(f"SELECT {', '.join(RANK_COLUMNS)} FROM ranked", RANK_DOUBLES)
def b01_rank_screen(spark, d):
    return _ranked(spark, d).select(*RANK_COLUMNS)


@query("SELECT cert, CASE WHEN cert IN (1, 2, 3) THEN 'watched' ELSE 'control' END AS label_group, band_rank FROM ranked WHERE cert IN (1, 2, 3, 10, 11)")
def b02_labeled_subset(spark, d):
    return screen.labeled_subset(_ranked(spark, d), {"watched": [1, 2, 3], "control": [10, 11]}).select("cert", "label_group", "band_rank")


@query("SELECT cert, composite_score FROM ranked WHERE band_percentile >= 0.9 AND cert NOT IN (1, 2, 3) ORDER BY composite_score DESC, cert LIMIT 12", "composite_score")
def b03_false_positive_sample(spark, d):
    return screen.false_positive_sample(_ranked(spark, d), [1, 2, 3]).select("cert", "composite_score")


@query("SELECT cert, report_date, composite_score FROM flags WHERE report_date = DATE '1999-06-30'", "composite_score")
def b04_frozen_build(spark, d):
    """The screen from data truncated at a date: its scores must be those of the full build, which the SQL gives."""
    cut = b.panel(spark, d).filter(F.col("report_date") <= F.lit(b.AS_OF))
    return b.flags(spark, d, b.fact(spark, d, cut)).filter(F.col("report_date") == F.lit(b.AS_OF)).select("cert", "report_date", "composite_score")


@query("SELECT cert, report_date, CASE WHEN cert % 10 = 1 THEN 'second' ELSE side END AS only_in FROM flags, (VALUES ('first'), ('second')) s(side) WHERE report_date = DATE '1999-06-30' AND (cert % 10 = 2 AND composite_score IS NOT NULL OR cert % 10 = 1 AND side = 'second')")
def b04_prove_equivalence(spark, d):
    """A frozen build that lacks some entities and has other scores for some: just these may differ from the full build."""
    cut = b.panel(spark, d).filter(F.col("report_date") <= F.lit(b.AS_OF))
    at = lambda df: df.filter(F.col("report_date") == F.lit(b.AS_OF))
    frozen = at(b.flags(spark, d, b.fact(spark, d, cut))).filter("cert % 10 <> 1").withColumn("composite_score", F.col("composite_score") + F.when(F.col("cert") % 10 == 2, 1.0).otherwise(0.0))
    return screen.prove_equivalence(frozen, at(b.flags(spark, d)), ["cert", "report_date"]).select("cert", "report_date", "only_in")


@query("SELECT cert, CAST(band_rank + (cert % 2) AS INTEGER) AS expected_band_rank, CAST(band_rank AS INTEGER) AS got_band_rank FROM ranked WHERE cert % 2 = 1 UNION ALL SELECT -1, 1, NULL")
def b05_rank_differences(spark, d):
    """Pins that are off by one for odd entities, and one for an entity that isn't there."""
    ranked = _ranked(spark, d)
    pins = ranked.select("cert", (F.col("band_rank") + (F.col("cert") % 2).cast("int")).alias("band_rank")).unionByName(spark.createDataFrame([(-1, 1)], "cert bigint, band_rank int"))
    return screen.rank_differences(ranked, pins)


@query("SELECT CAST(f.cert AS BIGINT) AS cert, f.peer_band, f.composite_score, 1 + (SELECT count(*) FROM flags g WHERE g.report_date = f.report_date AND g.composite_score > f.composite_score) AS overall_rank, dim.bank_name FROM flags f JOIN dim USING (cert) WHERE f.report_date = DATE '1999-06-30' AND f.composite_score IS NOT NULL", "composite_score")
def b06_run_backtest(spark, d):
    """The whole backtest, which proves the frozen build against the full one, and its exhibit of all ranks."""
    # Both builds and their dimensions read the panel, so it is made once, as a landed table would be.
    tables = {"financials": writers.materialized(b.panel(spark, d)), "registry": b.registry(spark, d), "failures": b.failures(spark, d)}
    found = backtest.run_backtest(spark, tables, b.AS_OF, writers.shared_folder(spark), {"watched": [1, 2]}, b.BANDS)
    return found["ranked_full"].select("cert", "peer_band", "composite_score", F.col("overall_rank").cast("bigint").alias("overall_rank"), "bank_name")


@query("SELECT cert, band_rank, composite_score FROM ranked WHERE peer_band = 'small' AND is_active ORDER BY composite_score DESC, cert LIMIT 50", "composite_score")
def b07_screen_view(spark, d):
    return screen.screen_view(_ranked(spark, d), "small").select("cert", "band_rank", "composite_score")


@query("SELECT peer_band, quantile_cont(composite_score, 0.9) AS top_decile_score FROM ranked GROUP BY 1", "top_decile_score")
def b08_top_decile_line(spark, d):
    return screen.top_decile_line(_ranked(spark, d))


@query("SELECT cert, peer_band, composite_score, prior_score, score_change, main_driver FROM moved", "composite_score prior_score score_change")
def b09_movers(spark, d):
    return screen.movers(b.flags(spark, d)).select("cert", "peer_band", "composite_score", "prior_score", "score_change", "main_driver")


@query("SELECT m.cert, CAST(r.band_rank AS VARCHAR) || ' of ' || r.band_size AS rank_label FROM moved m JOIN ranked r ON m.cert = r.cert WHERE m.peer_band = 'small' ORDER BY score_change DESC, m.cert LIMIT 12")
def b09_movers_in_band(spark, d):
    fact = b.fact(spark, d)
    flags = b.flags(spark, d, fact)
    return screen.movers_in_band(screen.movers(flags), screen.rank_screen(flags, b.dim(spark, d), fact), "small").select("cert", "rank_label")


@query("SELECT cert, round(composite_score, 2) AS composite_score, round(prior_score, 2) AS prior_score, round(score_change, 2) AS score_change, main_driver FROM moved", "composite_score prior_score score_change")
def b10_movers_rounded(spark, d):
    return screen.movers(b.flags(spark, d), digits=2).select("cert", "composite_score", "prior_score", "score_change", "main_driver")


@query("SELECT peer_band, side, place, cert FROM (SELECT peer_band, cert, 'riser' AS side, row_number() OVER (PARTITION BY peer_band ORDER BY score_change DESC, cert) AS place FROM moved UNION ALL SELECT peer_band, cert, 'faller', row_number() OVER (PARTITION BY peer_band ORDER BY score_change, cert) FROM moved) WHERE place <= 15")
def b11_top_n_per_side(spark, d):
    return screen.top_n_per_side(screen.movers(b.flags(spark, d))).select("peer_band", "side", "place", "cert")


@query("SELECT peer_band, count(*) AS entities, avg(composite_score) AS avg_score, avg(score_change) AS avg_change, max(score_change) AS max_change, arg_max(cert, score_change) AS top_mover FROM moved GROUP BY 1", "avg_score avg_change max_change")
def b12_band_summary(spark, d):
    return screen.band_summary(screen.movers(b.flags(spark, d)))


@query("SELECT cert, peer_band, band_rank FROM ranked WHERE band_rank <= 10")
def b13_top_of_bands(spark, d):
    return screen.top_of_bands(_ranked(spark, d)).select("cert", "peer_band", "band_rank")


@query("SELECT r.cert, r.bank_name, peer_band, composite_score, band_rank || ' of ' || band_size AS band_rank_label, band_percentile, CASE r.cert WHEN 5 THEN 'Liquidated' ELSE strftime(dim.failure_date, 'Failed %b %Y') END AS outcome FROM ranked r JOIN dim ON dim.cert = r.cert WHERE (dim.is_failed AND year(dim.failure_date) = 2000) OR r.cert = 5", "composite_score band_percentile")
def b13_outcomes(spark, d):
    return screen.outcomes(_ranked(spark, d), b.dim(spark, d), 2000, {5: "Liquidated"})


@query(f"SELECT r.cert, c.component, CASE c.component {' '.join(f"WHEN '{x}' THEN r.{x}" for x in peers.PARTS)} END AS z FROM ranked r, (VALUES {', '.join(f"('{x}')" for x in peers.PARTS)}) c(component)", "z")
def b13_components_long(spark, d):
    return screen.components_long(_ranked(spark, d))


@query("SELECT cert, report_date, equity_to_assets FROM fact WHERE cert IN (1, 2, 3) AND report_date <= DATE '1999-06-30'", "equity_to_assets")
def b13_input_trends(spark, d):
    return screen.input_trends(b.fact(spark, d), [1, 2, 3], b.AS_OF, ["equity_to_assets"])


# Views


@query("SELECT DISTINCT business_model AS value, CASE business_model WHEN 'fee_custody' THEN 'Fee and custody' ELSE business_model END AS label FROM fact")
def v01_pick_list(spark, d):
    return views.pick_list(b.fact(spark, d), "business_model", {"fee_custody": "Fee and custody"})


@query("SELECT DISTINCT peer_band AS value, upper(peer_band) AS label FROM fact WHERE peer_band IS NOT NULL AND report_date = (SELECT max(report_date) FROM fact)")
def v01_pick_list_latest(spark, d):
    """Bands that the last quarter has."""
    return views.pick_list(screen.latest(b.fact_by_quarter(spark, d)), "peer_band", {"small": "SMALL", "middle": "MIDDLE", "large": "LARGE"})


SELECTION = "SELECT s.* FROM scored s JOIN dim ON dim.cert = s.cert AND dim.is_active WHERE s.peer_band = 'small' AND s.metric = 'roa_pct' AND s.report_date = (SELECT max(report_date) FROM scored)"


def _selection(spark, d):
    return views.peer_selection(b.scored(spark, d), b.dim(spark, d), "peer_band", "small", "roa_pct")


@query(f"SELECT quantile_cont(value, 0.1) AS p10, median(value) AS median, quantile_cont(value, 0.9) AS p90, min(value) FILTER (robust_z >= 2) AS high_from, max(value) FILTER (robust_z <= -2) AS low_to FROM ({SELECTION})", "p10 median p90 high_from low_to")
def v03_markers(spark, d):
    return views.markers(_selection(spark, d))


@query(f"SELECT cert, value, robust_z FROM ({SELECTION}) WHERE cert = 5", "value robust_z")
def v04_highlight(spark, d):
    return views.highlight(_selection(spark, d), 5).select("cert", "value", "robust_z")


@query(f"SELECT cert, percentile, CASE WHEN percentile >= 0.9 THEN 'top' ELSE 'bottom' END AS decile FROM (SELECT cert, percent_rank() OVER (ORDER BY value) AS percentile FROM ({SELECTION})) WHERE percentile >= 0.9 OR percentile <= 0.1", "percentile")
def v05_deciles(spark, d):
    return views.deciles(_selection(spark, d)).select("cert", "percentile", "decile")


@query("SELECT metric, count(*) AS available FROM model_scored WHERE business_model = 'traditional_lender' AND report_date = (SELECT max(report_date) FROM model_scored) GROUP BY 1")
def v06_availability(spark, d):
    return views.availability(peers.model_percentiles(b.fact(spark, d)), "business_model", "traditional_lender")


#: Thousands as decimals of six digits.
THOUSANDS = "CAST(CAST(CAST({0} AS DECIMAL(24,4)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(28,6)) AS DOUBLE) AS {0}"


@query(f"SELECT report_date, {THOUSANDS.format('total_assets')}, {THOUSANDS.format('equity')} FROM panel WHERE cert = 1", "total_assets equity")
def v07_entity_history(spark, d):
    return views.entity_history(b.panel(spark, d), 1, ["total_assets", "equity"], 1000, 6)


@query("SELECT cert, max(report_date) AS latest_quarter, count(*) AS quarters, arg_max(business_model, report_date) AS business_model, arg_max(peer_band, report_date) AS peer_band FROM fact GROUP BY 1")
def v08_profile_header(spark, d):
    return views.profile_header(b.fact(spark, d))


@query("SELECT report_date, composite_score, n_screen_metrics FROM flags WHERE cert = 1", "composite_score")
def v09_screen_history(spark, d):
    return views.screen_history(b.flags(spark, d), 1)


@query("SELECT metric, z, value, peer_median, printf('%.2f', z) AS z_text, printf('%.2f', value) AS value_text, CAST(row_number() OVER (ORDER BY abs(z) DESC NULLS LAST, metric) AS INTEGER) AS line FROM (SELECT s.metric, value, peer_median, CASE WHEN s.metric IN ('nim_trend_4q', 'equity_to_assets') THEN -s.robust_z ELSE s.robust_z END AS z FROM scored s WHERE s.cert = 1 AND s.metric IN ('uninsured_deposit_share', 'brokered_deposit_share', 'securities_to_assets', 'asset_growth_3y_cagr', 'nim_trend_4q', 'equity_to_assets') AND s.report_date = (SELECT max(report_date) FROM flags WHERE cert = 1)) WHERE z IS NOT NULL", "z value peer_median")
def v09_screen_now(spark, d):
    """In the order of the view, which the line number shows."""
    now = views.screen_now(b.flags(spark, d), b.scored(spark, d), 1, {m: col for m, (_, col) in peers.SIGNS.items()})
    rows = now.select("metric", "z", "value", "peer_median", "z_text", "value_text").collect()  # one entity's screened metrics
    kept = [(*r, k + 1) for k, r in enumerate(rows) if r.z is not None]
    return spark.createDataFrame(kept, "metric string, z double, value double, peer_median double, z_text string, value_text string, line int")


@query("SELECT cert, bank_name || ' — ' || city || ', ' || state_code AS label FROM registry")
def v10_entity_labels(spark, d):
    return views.entity_labels(b.registry(spark, d))


@query("WITH q AS (SELECT f.report_date, count(*) AS banks, count(*) FILTER (dim.is_active) AS active_banks, sum(total_assets) AS assets, median(net_interest_margin_pct) AS median_nim, median(roa_pct) AS median_roa FROM fact f LEFT JOIN dim ON dim.cert = f.cert WHERE f.report_date IN (SELECT DISTINCT report_date FROM fact ORDER BY 1 DESC LIMIT 2) GROUP BY 1) SELECT max(report_date) AS latest, arg_max(banks, report_date) AS banks, arg_max(active_banks, report_date) AS active_banks, arg_max(assets, report_date) AS assets, arg_max(median_nim, report_date) AS median_nim, arg_max(median_roa, report_date) AS median_roa, arg_min(banks, report_date) AS prior_banks, arg_min(active_banks, report_date) AS prior_active_banks, arg_min(assets, report_date) AS prior_assets, arg_min(median_nim, report_date) AS prior_median_nim, arg_min(median_roa, report_date) AS prior_median_roa FROM q", "assets median_nim median_roa prior_assets prior_median_nim prior_median_roa")
def v11_sector_kpis(spark, d):
    return views.sector_kpis(b.fact(spark, d), b.dim(spark, d))


@query("SELECT max(f.report_date) AS quarter, count(*) AS banks, count(*) FILTER (dim.is_active) AS active_banks, sum(total_assets) AS assets, median(net_interest_margin_pct) AS median_nim, median(roa_pct) AS median_roa, median(equity_to_assets) AS median_equity_ratio FROM fact f LEFT JOIN dim ON dim.cert = f.cert WHERE f.report_date = (SELECT max(report_date) FROM fact)", "assets median_nim median_roa median_equity_ratio")
def v12_report_kpis(spark, d):
    return views.report_kpis(b.fact(spark, d), b.dim(spark, d))


@query("SELECT report_date, count(*) AS banks, sum(total_assets) AS assets, median(net_interest_margin_pct) AS median_nim FROM fact GROUP BY 1", "assets median_nim")
def v13_sector_trend(spark, d):
    return views.sector_trend(b.fact(spark, d))


@query("SELECT report_date, peer_band, count(*) AS banks, sum(total_assets) AS assets FROM fact WHERE peer_band IS NOT NULL GROUP BY 1, 2", "assets")
def v13_band_trend(spark, d):
    return views.band_trend(b.fact(spark, d))


@query("SELECT report_date, median(brokered_deposit_share) AS brokered, median(uninsured_deposit_share) AS uninsured, median(loans_to_deposits) AS loans_to_deposits FROM fact GROUP BY 1", "brokered uninsured loans_to_deposits")
def v13_funding_trend(spark, d):
    return views.funding_trend(b.fact(spark, d))


@query("SELECT series_id, obs_date, value / nullif(first_value(value) OVER (PARTITION BY series_id ORDER BY obs_date), 0) * 100 AS index_value FROM weekly WHERE obs_date >= DATE '1999-01-01'", "index_value")
def v14_weekly_indexed(spark, d):
    return views.weekly_indexed(b.weekly(spark, d), date(1999, 1, 1)).select("series_id", "obs_date", "index_value")


@query("""SELECT obs_date, max(value) FILTER (series_id = '1-URGENT') AS "1-URGENT", max(value) FILTER (series_id = '5-LOW') AS "5-LOW" FROM weekly WHERE obs_date > (SELECT max(obs_date) FROM weekly) - INTERVAL 84 DAY GROUP BY 1""", "1-URGENT 5-LOW")
def v15_recent_weeks_wide(spark, d):
    return views.wide_weeks(views.recent_weeks(b.weekly(spark, d)), ["1-URGENT", "5-LOW"])


@query("SELECT series_id, obs_date, value AS actual, CAST(NULL AS DOUBLE) AS point FROM weekly WHERE obs_date >= (SELECT max(obs_date) FROM weekly) - INTERVAL 180 DAY UNION ALL SELECT series_id, CAST(last + CAST((53 - r) * 7 AS INTEGER) AS DATE), NULL, value FROM (SELECT *, max(obs_date) OVER (PARTITION BY series_id) AS last, row_number() OVER (PARTITION BY series_id ORDER BY obs_date DESC) AS r FROM weekly) WHERE r BETWEEN 41 AND 52", "actual point")
def v16_forecast_fan(spark, d):
    w = b.weekly(spark, d)
    ends = w.groupBy("series_id").agg(F.max("obs_date").alias("end"))
    path = fc.seasonal_naive(w).join(ends, "series_id").select("series_id", F.expr("date_add(end, 7 * k)").alias("obs_date"), "point")
    return views.forecast_fan(w, path)


@query(f"SELECT cert, metric, value, robust_z FROM scored WHERE report_date = (SELECT max(report_date) FROM scored)", "value robust_z")
def v18_extract_peer_latest(spark, d):
    return views.extract_peer_latest(peers.peer_percentiles(b.fact_by_quarter(spark, d)), 6).select("cert", "metric", "value", "robust_z")


@query("SELECT cert, report_date, year(report_date) || 'Q' || quarter(report_date) AS quarter, total_assets FROM fact WHERE report_date IN (SELECT DISTINCT report_date FROM fact ORDER BY 1 DESC LIMIT 12)", "total_assets")
def v19_extract_trends(spark, d):
    return views.extract_trends(b.fact_by_quarter(spark, d), ["total_assets"])


@query("SELECT cert, report_date, metric, robust_z FROM scored WHERE abs(robust_z) >= 2", "robust_z")
def v20_beyond_sigma(spark, d):
    return views.beyond_sigma(b.scored(spark, d)).select("cert", "report_date", "metric", "robust_z")


@query("WITH q AS (SELECT report_date, sum(total_assets) AS assets FROM fact GROUP BY 1) SELECT q.report_date, q.assets, q.assets / lag(q.assets) OVER (ORDER BY q.report_date) - 1 AS qoq, q.assets / y.assets - 1 AS yoy FROM q LEFT JOIN q y ON y.report_date = CAST(last_day(q.report_date - INTERVAL 12 MONTH) AS DATE)", "assets qoq yoy")
def v21_bi_measures(spark, d):
    return views.bi_measures(b.fact(spark, d))


@query("SELECT cert, report_date, metric, value - peer_median AS delta FROM scored", "delta")
def v21_delta_to_median(spark, d):
    return views.delta_to_median(b.scored(spark, d))


@query("SELECT cert, arg_max(peer_band, report_date) AS peer_band FROM (SELECT cert, report_date, peer_band FROM fact) GROUP BY 1")
def v22_entities(spark, d):
    return views.entities(b.fact(spark, d), ["peer_band"])


@query("SELECT 'in the registry and in scope' AS population, count(DISTINCT cert) AS entities FROM dim UNION ALL SELECT 'filed last quarter', count(DISTINCT cert) FROM fact WHERE report_date = (SELECT max(report_date) FROM fact) UNION ALL SELECT 'scored last quarter', count(DISTINCT cert) FROM flags WHERE composite_score IS NOT NULL AND report_date = (SELECT max(report_date) FROM flags)")
def v24_populations(spark, d):
    fact = b.fact(spark, d)
    return views.populations(b.dim(spark, d), fact, b.flags(spark, d, fact))


@query("SELECT count(*) FILTER (likely_merger_quarter) AS flagged_rows, count(DISTINCT cert) FILTER (likely_merger_quarter) AS flagged_banks FROM fact")
def v25_merger_stats(spark, d):
    return views.merger_stats(b.fact(spark, d))


@query("SELECT report_date, business_model, sum(total_assets) AS assets, avg(roa_pct) AS avg_roa, count(*) AS rows FROM fact GROUP BY 1, 2", "assets avg_roa")
def v26_report_pages(spark, d):
    return views.report_pages(b.fact(spark, d), ["report_date", "business_model"])


# Events


@query("SELECT * FROM sessions", "revenue_usd")
def g01_sessions(spark, d):
    return b.sessions(spark, d).drop("session_start_ts")


@query(oracle.DAILY, "revenue_usd purchase_cvr")
def g04_daily(spark, d):
    return product.daily(b.sessions(spark, d))


@query(oracle.FUNNEL, "view_rate cart_rate_of_views purchase_rate_of_carts overall_cvr")
def g05_closed_funnel(spark, d):
    return product.closed_funnel(b.sessions(spark, d))


@query(oracle.RETENTION, "retention_pct")
def g06_retention(spark, d):
    return product.retention(b.sessions(spark, d))


@query(f"SELECT cohort_week, cohort_size, {', '.join(f'max(retention_pct) FILTER (week_number = {k}) AS w{k}' for k in range(13))} FROM ({oracle.RETENTION}) GROUP BY 1, 2", " ".join(f"w{k}" for k in range(13)))
def g07_retention_grid(spark, d):
    return product.retention_grid(product.retention(b.sessions(spark, d)))


@query(oracle.CHANNELS, "revenue_usd purchase_cvr session_share")
def g08_channels(spark, d):
    return product.channels(b.sessions(spark, d))


@query(oracle.ATTRIBUTION, "first_touch_revenue_usd last_touch_revenue_usd")
def g09_attribution(spark, d):
    return product.attribution(b.sessions(spark, d))


@query(f"SELECT CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(users) AS BIGINT) AS user_days, CAST(sum(purchases) AS BIGINT) AS purchases, sum(revenue_usd) AS revenue_usd, sum(purchase_cvr * sessions) / sum(sessions) AS purchase_cvr FROM ({oracle.DAILY})", "revenue_usd purchase_cvr")
def g10_window_totals(spark, d):
    return product.window_totals(product.daily(b.sessions(spark, d)))


@query("SELECT d.date AS last, count(DISTINCT user_pseudo_id) AS users, count(*) AS sessions FROM (SELECT DISTINCT session_date AS date FROM sessions) d JOIN sessions s ON s.session_date BETWEEN d.date - 6 AND d.date GROUP BY 1")
def g10_window_users(spark, d):
    """Distinct users of every seven days, from sets of days."""
    s = writers.materialized(b.session_days(spark, d).select("session_date", "user_pseudo_id"))
    sets = writers.materialized(user_sets.user_sets(s, user_sets.user_numbers(s), {"date": F.col("session_date")}))
    spans = sets.select(F.col("date").alias("span")).distinct().select("span", F.date_sub("span", 6).alias("first"), F.col("span").alias("last"))
    days = spans.select("span", F.explode(F.sequence("first", "last")).alias("session_date"))
    sessions = days.join(s.groupBy("session_date").count(), "session_date").groupBy("span").agg(F.sum("count").alias("sessions"))
    return user_sets.users_of_spans(sets, spans).join(sessions, "span").select(F.col("span").alias("last"), "users", "sessions")


@query("SELECT session_channel AS channel, CAST(date_trunc('week', session_date) AS DATE) AS week, count(DISTINCT user_pseudo_id) AS users FROM sessions GROUP BY 1, 2 UNION ALL SELECT 'all', CAST(date_trunc('week', session_date) AS DATE), count(DISTINCT user_pseudo_id) FROM sessions GROUP BY 2")
def g08_channel_users(spark, d):
    """Users of channels by week and of all channels, from one table of sets by channel and day."""
    s = writers.materialized(b.sessions(spark, d).select("session_date", "session_channel", "user_pseudo_id"))
    sets = user_sets.user_sets(s, user_sets.user_numbers(s), {"channel": F.col("session_channel"), "date": F.col("session_date")})
    weekly = writers.materialized(user_sets.merged_sets(sets.withColumn("week", c.week_of("date")), ["channel", "week"]))
    return user_sets.distinct_users(weekly, ["channel", "week"]).unionByName(user_sets.distinct_users(weekly, ["week"]).withColumn("channel", F.lit("all")))


@query(f"UNPIVOT (SELECT week, sessions, sessions_with_view, sessions_with_cart, sessions_with_purchase FROM ({oracle.FUNNEL})) ON sessions, sessions_with_view, sessions_with_cart, sessions_with_purchase INTO NAME stage VALUE sessions_at_stage")
def g11_funnel_long(spark, d):
    return product.funnel_long(product.closed_funnel(b.sessions(spark, d)))


@query(f"SELECT channel, touch, purchases FROM (UNPIVOT (SELECT channel, first_touch_purchases, last_touch_purchases FROM ({oracle.ATTRIBUTION}) WHERE first_touch_purchases + last_touch_purchases > 0) ON first_touch_purchases, last_touch_purchases INTO NAME touch VALUE purchases)")
def g11_attribution_long(spark, d):
    return product.attribution_long(product.attribution(b.sessions(spark, d)))


@query(f"SELECT *, last_touch_purchases - first_touch_purchases AS purchase_shift, last_touch_revenue_usd - first_touch_revenue_usd AS revenue_shift FROM ({oracle.ATTRIBUTION})", "first_touch_revenue_usd last_touch_revenue_usd revenue_shift")
def g11_attribution_table(spark, d):
    return product.attribution_table(product.attribution(b.sessions(spark, d)))


@query("SELECT event_name, count(*) AS events, count(DISTINCT user_id) AS users FROM ev WHERE event_name IN ('add_to_cart', 'begin_checkout') GROUP BY 1")
def g12_event_counts(spark, d):
    return product.event_counts(product.normalize_events(b.raw_events(spark, d)), ["add_to_cart", "begin_checkout"])


# Experiment


@query("SELECT unit, arm, converted FROM outcomes")
def e01_assign_arm(spark, d):
    return b.outcomes(spark, d).select("unit", "arm", "converted")


ARMS = "SELECT count(*) FILTER (arm = 'control') AS n_control, count(*) FILTER (arm = 'control' AND converted) AS conversions_control, count(*) FILTER (arm = 'treatment') AS n_treatment, count(*) FILTER (arm = 'treatment' AND converted) AS conversions_treatment FROM outcomes"


@query(ARMS)
def e02_arm_counts(spark, d):
    return x.arm_counts(b.outcomes(spark, d))


@query(f"SELECT pow(n_control - n / 2, 2) / (n / 2) + pow(n_treatment - n / 2, 2) / (n / 2) AS chi2, (conversions_treatment / n_treatment - conversions_control / n_control) / sqrt(q * (1 - q) * (1 / n_control + 1 / n_treatment)) AS z FROM (SELECT *, n_control + n_treatment AS n, (conversions_control + conversions_treatment) / (n_control + n_treatment) AS q FROM ({ARMS}))", "chi2 z")
def e04_tests(spark, d):
    return x.arm_counts(b.outcomes(spark, d)).select(x.srm_chi2().alias("chi2"), x.two_proportion_z().alias("z"))


#: Two-sided 5 % and power of 80 %, and one in a thousand for a sample-ratio mismatch, as quantiles of the normal and chi-square distributions.
NEEDED = "CAST(ceil(pow(1.959963984540054e0 * sqrt(2 * ({p} * 1.1e0) * (1 - {p} * 1.1e0)) + 0.8416212335729143e0 * sqrt({p} * (1 - {p}) + {p} * 1.2e0 * (1 - {p} * 1.2e0)), 2) / pow({p} * 0.2e0, 2)) AS BIGINT)"


@query(f"SELECT event_type, baseline, {NEEDED.format(p='baseline')} AS required_n FROM (SELECT event_type, count(DISTINCT user_id || '@' || strftime(ts, '%Y-%m-%d')) / (SELECT count(*) FROM outcomes) AS baseline FROM events GROUP BY 1)", "baseline")
def e05_required_n(spark, d):
    """Users needed per arm for lifts on each event type's share of users' days."""
    days = b.table(spark, d, "events").select("event_type", "user_id", F.to_date("ts").alias("day"))
    total = days.agg(F.countDistinct("user_id", "day").alias("n"))
    share = days.groupBy("event_type").agg(F.countDistinct("user_id", "day").alias("u")).join(F.broadcast(total)).select("event_type", (F.col("u") / F.col("n")).alias("baseline"))
    return share.select("event_type", "baseline", x.required_n_per_arm("baseline").alias("required_n"))


LIFTED = "converted OR (arm = 'treatment' AND ('0x' || substr(md5(unit || ':20260705'), 1, 8))::BIGINT / 4294967296e0 < share)"


@query(f"SELECT unit, arm, {LIFTED} AS converted FROM outcomes, (SELECT count(*) FILTER (converted) * 0.2e0 / count(*) FILTER (NOT converted) AS share FROM outcomes WHERE arm = 'treatment')")
def e06_inject_lift(spark, d):
    return x.inject_lift(b.outcomes(spark, d), 0.2, 20260705, "unit").select("unit", "arm", "converted")


_SHOWN = "n_control conversions_control n_treatment conversions_treatment srm_chi2 z rate_pooled lift srm_mismatch required_n powered significant lifted_conversions lifted_z"


@query(f"""WITH u AS (SELECT event_type, user_id || '@' || strftime(ts, '%Y-%m-%d') AS unit, bool_or(value > 150) AS converted FROM events GROUP BY 1, 2),
r AS (SELECT *, CASE WHEN ('0x' || substr(md5(unit), 1, 8))::BIGINT % 2 = 1 THEN 'treatment' ELSE 'control' END AS arm FROM u),
s AS (SELECT event_type, count(*) FILTER (converted) * 0.2e0 / count(*) FILTER (NOT converted) AS share FROM r WHERE arm = 'treatment' GROUP BY 1),
t AS (SELECT event_type, count(*) FILTER (arm = 'control') AS n_control, count(*) FILTER (arm = 'control' AND converted) AS conversions_control, count(*) FILTER (arm = 'treatment') AS n_treatment, count(*) FILTER (arm = 'treatment' AND converted) AS conversions_treatment, count(*) FILTER (arm = 'treatment' AND ({LIFTED})) AS lifted_conversions FROM r JOIN s USING (event_type) GROUP BY 1),
v AS (SELECT *, (conversions_control + conversions_treatment) / (n_control + n_treatment) AS rate_pooled, (conversions_control + lifted_conversions) / (n_control + n_treatment) AS q, pow(n_control - n_treatment, 2) / (n_control + n_treatment) AS srm_chi2, sqrt(1 / n_control + 1 / n_treatment) AS w, conversions_control / n_control AS rc FROM t),
y AS (SELECT *, (conversions_treatment / n_treatment - rc) / (w * sqrt(rate_pooled * (1 - rate_pooled))) AS z, {NEEDED.format(p='rate_pooled')} AS required_n FROM v)
SELECT event_type, n_control, conversions_control, n_treatment, conversions_treatment, srm_chi2, z, rate_pooled, conversions_treatment / n_treatment / rc - 1 AS lift, srm_chi2 > 10.827566170662733e0 AS srm_mismatch, required_n, least(n_control, n_treatment) >= required_n AS powered, abs(z) > 1.959963984540054e0 AS significant, lifted_conversions, (lifted_conversions / n_treatment - rc) / (w * sqrt(q * (1 - q))) AS lifted_z FROM y""", "srm_chi2 z rate_pooled lift lifted_z")
def e07_experiment_readout(spark, d):
    """One experiment for each event type: users' days that had it, split by arm, with a lift of a fifth injected."""
    units = b.outcomes(spark, d, F.col("value") > 150, ["event_type"])
    return x.experiment_readout(units, ["event_type"], injected=0.2, seed=20260705, user="unit").select("event_type", *_SHOWN.split())


# Forecast


@query("SELECT series_id, obs_date, previous_date FROM (SELECT *, lag(obs_date) OVER (PARTITION BY series_id ORDER BY obs_date) AS previous_date FROM weekly WHERE month(obs_date) <> 7) WHERE obs_date - previous_date <> 7")
def f01_grid_gaps(spark, d):
    """Series that stop each July."""
    return fc.grid_gaps(b.weekly(spark, d).filter(F.month("obs_date") != 7)).select("series_id", "obs_date", "previous_date")


@query("SELECT series_id, CAST(53 - r AS INTEGER) AS k, value AS point FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY obs_date DESC) AS r FROM weekly) WHERE r BETWEEN 41 AND 52", "point")
def f02_seasonal_naive(spark, d):
    return fc.seasonal_naive(b.weekly(spark, d))


@query(oracle.NAIVE_BACKTEST, "actual point")
def f03_naive_backtest(spark, d):
    return fc.naive_backtest(b.weekly(spark, d))


@query(f"SELECT series_id, avg(abs(point - actual) / nullif(abs(actual), 0)) * 100 AS mape, avg(coalesce(2 * abs(point - actual) / nullif(abs(point) + abs(actual), 0), 0)) * 100 AS smape, count(*) AS n_errors, count(DISTINCT origin) AS n_origins FROM ({oracle.NAIVE_BACKTEST}) GROUP BY 1", "mape smape")
def f04_accuracy(spark, d):
    return fc.accuracy(fc.naive_backtest(b.weekly(spark, d)), ("series_id",))


@query(f"WITH t AS ({oracle.NAIVE_BACKTEST}), s AS (SELECT series_id, 'seasonal_naive' AS method, avg(coalesce(2 * abs(point - actual) / nullif(abs(point) + abs(actual), 0), 0)) * 100 AS smape FROM t GROUP BY 1 UNION ALL SELECT series_id, 'copy', avg(coalesce(2 * abs(point - actual) / nullif(abs(point) + abs(actual), 0), 0)) * 100 FROM t GROUP BY 1 UNION ALL SELECT series_id, 'double', avg(coalesce(2 * abs(2 * point - actual) / nullif(abs(2 * point) + abs(actual), 0), 0)) * 100 FROM t GROUP BY 1) SELECT series_id, method, smape, method = CASE WHEN (SELECT min(smape) FROM s o WHERE o.series_id = s.series_id AND method = 'double') < (SELECT min(smape) FROM s o WHERE o.series_id = s.series_id AND method = 'seasonal_naive') THEN 'double' ELSE 'seasonal_naive' END AS published FROM s", "smape")
def f05_select_method(spark, d):
    """A candidate that ties with the baseline and one that doubles it: only a strictly better one may win."""
    t = fc.naive_backtest(b.weekly(spark, d))
    point = {"seasonal_naive": F.col("point"), "copy": F.col("point"), "double": F.col("point") * 2}
    each = t.select("series_id", "actual", F.inline(F.array(*[F.struct(F.lit(m).alias("method"), v.alias("point")) for m, v in point.items()])))
    return fc.select_method(fc.accuracy(each)).select("series_id", "method", "smape", "published")


@query(oracle.NAIVE_INTERVALS, "point lower upper")
def f06_naive_intervals(spark, d):
    return fc.naive_intervals(b.weekly(spark, d))


def _in_millions(forecasts, columns):
    return forecasts.withColumns({c: F.col(c) / 1e6 for c in columns})


@query(f"SELECT series_id, origin, k, point / 1e6 AS point, sigma / 1e6 AS sigma FROM ({oracle.ETS})", "point sigma")
def f07_ets_damped(spark, d):
    return _in_millions(fc.ets_damped(b.weekly(spark, d)), ["point", "sigma"])


@query(f"SELECT series_id, origin, k, point / 1e6 AS point, sigma / 1e6 AS sigma FROM ({oracle.ARIMA})", "point sigma")
def f08_arima_drift(spark, d):
    return _in_millions(fc.arima_drift(b.weekly(spark, d)), ["point", "sigma"])


@query(oracle.EVALUATE, "mape smape")
def f09_evaluate(spark, d):
    return fc.evaluate(b.weekly(spark, d))


PATHS = f"""SELECT p.series_id, 'orders ' || p.series_id AS series_title, p.method, CAST(e.last + 7 * p.k AS DATE) AS obs_date, p.k AS horizon_weeks, point / 1e6 AS point, lower / 1e6 AS lower, upper / 1e6 AS upper, e.last AS trained_through FROM (
  SELECT series_id, 'seasonal_naive' AS method, k, point, lower, upper FROM ({oracle.NAIVE_INTERVALS}) UNION ALL
  SELECT series_id, method, k, point, point - 1.96e0 * sigma, point + 1.96e0 * sigma FROM (SELECT *, 'ets_damped' AS method FROM ({oracle.ETS}) UNION ALL SELECT *, 'arima_drift' FROM ({oracle.ARIMA})) t WHERE origin = (SELECT count(*) FROM weekly w WHERE w.series_id = t.series_id)
) p JOIN (SELECT series_id, max(obs_date) AS last FROM weekly GROUP BY 1) e ON e.series_id = p.series_id JOIN ({oracle.EVALUATE}) v ON v.series_id = p.series_id AND v.method = p.method AND v.published"""


@query(PATHS, "point lower upper")
def f09_publish(spark, d):
    w = b.weekly(spark, d).withColumn("series_title", F.concat(F.lit("orders "), "series_id"))
    return _in_millions(fc.publish(w, fc.evaluate(w)), ["point", "lower", "upper"])


def _kept(spark, d) -> str:
    """Forecasts kept of all weeks but the last 30, to which these are then added."""
    w, path = writers.materialized(b.weekly(spark, d)), writers.shared_folder(spark)
    cut = w.agg(F.date_sub(F.max("obs_date"), 210).alias("_cut"))
    early = F.col("obs_date") <= F.col("_cut")
    for part in (early, ~early):
        states.refresh(writers.materialized(w.crossJoin(F.broadcast(cut)).filter(part).drop("_cut")), path)
    return path


@query(oracle.EVALUATE, "mape smape")
def f09_kept_scores(spark, d):
    return states.kept_scores(spark, _kept(spark, d))


@query(f"SELECT series_id, method, obs_date, horizon_weeks, point, lower, upper, trained_through FROM ({PATHS})", "point lower upper")
def f09_kept_publish(spark, d):
    path = _kept(spark, d)
    return _in_millions(states.kept_publish(spark, path, states.kept_scores(spark, path)), ["point", "lower", "upper"])


@query(f"SELECT series_id, count(*) AS weeks, min(horizon_weeks) AS first, max(horizon_weeks) AS last, max(trained_through) AS trained_through, 1 AS stamps FROM ({PATHS}) GROUP BY 1")
def f09_load(spark, d):
    """Scores and paths loaded as a pair, and what the pair has in common."""
    scores, paths = fc.load(writers.materialized(b.weekly(spark, d)), writers.shared_folder(spark))
    stamps = paths.select("series_id", "generated_at").union(scores.select("series_id", "generated_at")).groupBy("series_id").agg(F.countDistinct("generated_at").cast("int").alias("stamps"))
    sums = paths.groupBy("series_id").agg(F.count("*").alias("weeks"), F.min("horizon_weeks").alias("first"), F.max("horizon_weeks").alias("last"), F.max("trained_through").alias("trained_through"))
    return sums.join(stamps, "series_id")


@query(f"SELECT series_id, method, round(mape, 3) AS mape, round(smape, 3) AS smape, CASE WHEN published THEN 'published' ELSE 'not used' END AS status FROM ({oracle.EVALUATE})", "mape smape")
def v17_forecast_scoreboard(spark, d):
    return views.forecast_scoreboard(fc.evaluate(b.weekly(spark, d)))


# Data quality


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def q01_not_unique(spark, d):
    return quality.not_unique(b.table(spark, d, "orders"), ["o_custkey"])


@query("SELECT cert, report_date FROM fact WHERE asset_growth_yoy IS NULL OR nim_trend_4q IS NULL")
def q02_nulls(spark, d):
    return quality.nulls(b.fact(spark, d), ["asset_growth_yoy", "nim_trend_4q"]).select("cert", "report_date")


@query("SELECT p.cert, p.report_date FROM panel p WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.cert = p.cert)")
def q03_orphans(spark, d):
    return quality.orphans(b.panel(spark, d), b.registry(spark, d), "cert").select("cert", "report_date")


@query("SELECT cert, report_date, business_model FROM fact WHERE business_model NOT IN ('traditional_lender', 'wholesale_funded')")
def q04_unaccepted(spark, d):
    return quality.unaccepted(b.fact(spark, d), "business_model", ["traditional_lender", "wholesale_funded"]).select("cert", "report_date", "business_model")


@query("SELECT max(report_date) AS latest, CAST(DATE '2002-06-30' - max(report_date) AS INTEGER) AS age_days, CASE WHEN DATE '2002-06-30' - max(report_date) > 200 THEN 'error' WHEN DATE '2002-06-30' - max(report_date) > 130 THEN 'warn' ELSE 'pass' END AS status FROM panel")
def q05_freshness(spark, d):
    return quality.freshness(b.panel(spark, d), "report_date", 130, 200, F.lit(date(2002, 6, 30)))


@query("SELECT cert, report_date FROM fact WHERE equity_to_assets < 0.03 OR equity_to_assets > 0.05")
def q06_out_of_range(spark, d):
    return quality.out_of_range(b.fact(spark, d), "equity_to_assets", 0.03, 0.05).select("cert", "report_date")


@query("SELECT cert, report_date FROM fact WHERE total_assets >= 0 AND total_assets < 900000")
def q07_unbanded(spark, d):
    """Without a band for the small ones, so that rows fail."""
    banded = b.fact(spark, d).withColumn("peer_band", F.when(F.col("total_assets") >= 0.9e6, F.col("peer_band")))
    return quality.unbanded(banded, "total_assets", 0.0).select("cert", "report_date")


@query("SELECT cert, report_date, metric FROM scored WHERE robust_z IS NOT NULL AND abs(robust_z - greatest(-2, least(2, robust_z_unclamped))) > 1e-9")
def q08_unclamped(spark, d):
    """Held against a tighter clamp than the one applied, so that rows fail."""
    return quality.unclamped(b.scored(spark, d), 2.0).select("cert", "report_date", "metric")


@query("SELECT dim.cert FROM dim WHERE cert IN (SELECT cert FROM failures WHERE cert IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (resolution_type = 'FAILURE') = 0)")
def q09_assistance(spark, d):
    """Every entity marked as failed, so that rows fail."""
    return quality.assistance_marked_failed(b.failures(spark, d), b.dim(spark, d).withColumn("is_failed", F.lit(True))).select("cert")


@query("SELECT week FROM (" + oracle.FUNNEL + ") WHERE sessions_with_view > sessions OR sessions_with_cart > sessions_with_view OR 2 * sessions_with_purchase > sessions_with_cart")
def q10_funnel(spark, d):
    """Purchases counted twice, so that rows fail."""
    funnel = product.closed_funnel(b.sessions(spark, d)).withColumn("sessions_with_purchase", F.col("sessions_with_purchase") * 2)
    return quality.funnel_not_monotone(funnel).select("week")


@query(f"SELECT cohort_week, week_number FROM ({oracle.RETENTION}) WHERE week_number = 0 OR retention_pct + week_number % 2 NOT BETWEEN 0 AND 1")
def q11_retention(spark, d):
    """Rates that are too high in odd weeks and too low in the first, so that rows fail."""
    rates = product.retention(b.sessions(spark, d)).withColumn("retention_pct", F.when(F.col("week_number") == 0, 0.99).otherwise(F.col("retention_pct") + F.col("week_number") % 2))
    return quality.retention_unbounded(rates).select("cohort_week", "week_number")


@query(f"SELECT 1 AS failed, CAST(sum(first_touch_purchases) AS BIGINT) AS first_touch, CAST(sum(last_touch_purchases + 1) AS BIGINT) AS last_touch FROM ({oracle.ATTRIBUTION}) HAVING sum(first_touch_purchases) <> sum(last_touch_purchases + 1)")
def q12_attribution(spark, d):
    """One purchase too many in each channel, so that the check fails."""
    shares = product.attribution(b.sessions(spark, d)).withColumn("last_touch_purchases", F.col("last_touch_purchases") + 1)
    return quality.attribution_not_conserved(shares).select(F.lit(1).alias("failed"), F.col("first_touch_purchases").cast("bigint").alias("first_touch"), F.col("last_touch_purchases").cast("bigint").alias("last_touch"))


@query(oracle.STATUS)
def q13_quality_status(spark, d):
    return quality.quality_status(b.fact(spark, d), b.dim(spark, d), b.panel(spark, d), b.registry(spark, d), b.failures(spark, d), b.weekly(spark, d))


@query("SELECT (SELECT max(report_date) FROM fact) AS latest_quarter, (SELECT count(*) FROM fact) AS fact_rows, (SELECT count(DISTINCT report_date) FROM fact) AS quarters, (SELECT count(*) FROM dim) AS entities, (SELECT count(*) FROM dim WHERE is_active) AS active_entities, true AS stamped, (SELECT count(*) FROM dim WHERE is_failed) AS failed_entities, (SELECT count(composite_score) FROM flags) AS scored_rows")
def q14_build_meta(spark, d):
    fact = b.fact(spark, d)
    meta = quality.build_meta(fact, b.dim(spark, d), b.flags(spark, d, fact))
    return staging.except_columns(meta.withColumn("stamped", F.col("built_at").between(F.current_timestamp() - F.expr("INTERVAL 1 DAY"), F.current_timestamp())), "built_at")


@query("SELECT cert, count(*) AS rows FROM panel WHERE cert NOT IN (SELECT cert FROM registry) GROUP BY 1")
def q15_orphan_filers(spark, d):
    return quality.orphan_filers(b.panel(spark, d), b.registry(spark, d))


@query("SELECT report_date, count(*) AS rows_a, count(*) FILTER (total_assets < 1400000) AS rows_b FROM panel WHERE report_date < DATE '2001-01-01' GROUP BY 1 HAVING count(*) <> count(*) FILTER (total_assets < 1400000)")
def q16_slice_parity(spark, d):
    whole = b.panel(spark, d)
    return quality.slice_parity(whole, whole.filter("report_date < DATE'2001-01-01' AND total_assets < 1400000"), "report_date")


@query("SELECT cert, report_date, CASE WHEN cert % 10 = 1 THEN 'only in first' ELSE 'equity' END AS difference FROM panel WHERE cert % 10 IN (1, 2)")
def q17_table_parity(spark, d):
    a = b.panel(spark, d).select("cert", "report_date", "total_assets", "equity")
    other = a.filter("cert % 10 <> 1").withColumn("equity", F.when(F.col("cert") % 10 == 2, F.col("equity") + 1).otherwise(F.col("equity")))
    return quality.table_parity(a, other, ["cert", "report_date"])


@query("SELECT 'reordered' AS build, 0 AS differences UNION ALL SELECT 'restated', count(*) FROM panel WHERE cert % 100 = 2")
def q17_kept_digests(spark, d):
    """Two later builds against the digests kept of the first: one in another order, one with some rows restated."""
    keys, values = ["cert", "report_date"], ["equity", "total_assets"]
    first = writers.materialized(b.panel(spark, d).select(*keys, *values))
    restated = first.withColumn("equity", F.col("equity") + F.when(F.col("cert") % 100 == 2, 1.0).otherwise(0.0))
    kept, out = writers.materialized(parity.digest_tree(first, keys, values)), []
    for name, later in (("reordered", first.orderBy(F.desc("total_assets"))), ("restated", restated)):
        found = quality.table_parity(first, later, keys, trees=(kept, writers.materialized(parity.digest_tree(later, keys, values))))
        out.append(found.agg(F.count("*").alias("differences")).select(F.lit(name).alias("build"), "differences"))
    return out[0].unionByName(out[1])


@query("SELECT cert, report_date, total_assets + 5 AS external_value, total_assets AS panel_value FROM panel WHERE cert = 3", "external_value panel_value")
def q18_reconcile_external(spark, d):
    whole = b.panel(spark, d).select("cert", "report_date", "total_assets")
    export = whole.filter("cert <= 3").withColumn("ASSET", F.col("total_assets") + F.when(F.col("cert") == 3, 5.0).otherwise(0.0))
    return quality.reconcile_external(whole.withColumnRenamed("total_assets", "ASSET"), export, ["cert", "report_date"], "ASSET")
