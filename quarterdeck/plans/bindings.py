"""The test tables in the shapes that the operators work on.

Sums of prices are taken as decimals, or as whole numbers of their last digit, so
they are the same under any partitioning and in any engine.
"""

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.columns import quarter_end, week_of
from quarterdeck.operators import panel as p
from quarterdeck.operators import peers
from quarterdeck.sources.writers import mart, materialized

#: Size bands that split suppliers' quarters, and the nation whose suppliers the registry lacks.
BANDS = ((1.4e6, "large"), (0.9e6, "middle"), (0.0, "small"))
UNREGISTERED_NATION = 7
AS_OF = date(1999, 6, 30)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def _hundredths(column: str, kind: str) -> Column:
    """A column in a decimal type of two digits as a whole number of hundredths."""
    return (F.col(column).cast(kind) * 100).cast("bigint")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier by quarter of shipping, in the staged names of a bank panel.

    Sums are of whole cents and hundredths of cents: a group in a task's memory is then
    a dozen numbers, where wide decimals take more than twice that. One past 63 bits is an error.
    """
    cents, less, tax, pieces = (_hundredths(c, kind) for c, kind in (("l_extendedprice", "decimal(12,2)"), ("l_discount", "decimal(4,2)"), ("l_tax", "decimal(4,2)"), ("l_quantity", "decimal(12,2)")))
    total = lambda c, unit="0.01": (F.sum(c).cast("decimal(20,0)") * F.lit(Decimal(unit))).cast("double")
    mean = lambda c: total(c) / F.count("*")
    where = lambda c, v: F.when(F.col(c) == v, cents).otherwise(F.lit(0).cast("bigint"))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("cert"), quarter_end(F.to_date("l_shipdate")).alias("report_date")).agg(
        total(cents).alias("total_assets"),
        total(cents * (100 - less), "0.0001").alias("total_deposits"),
        total(cents * tax, "0.0001").alias("equity"),
        total(where("l_returnflag", "N")).alias("net_loans_leases"),
        total(where("l_returnflag", "R")).alias("securities"),
        total(where("l_returnflag", "A")).alias("brokered_deposits"),
        total(where("l_linestatus", "O")).alias("uninsured_deposits_est"),
        (mean(less) * 100).alias("net_interest_margin_pct"),
        (mean(tax) * 100).alias("roa_pct"),
        mean(pieces).alias("efficiency_ratio_pct"),
        (mean(less + tax) * 100).alias("cost_of_funds_pct"),
    )


def sparse_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer by quarter of ordering, with real gaps."""
    orders = table(spark, sf_dir, "orders")
    total = F.sum(_money("o_totalprice")).cast("double").alias("total_assets")
    out = orders.groupBy(F.col("o_custkey").alias("cert"), quarter_end(F.to_date("o_orderdate")).alias("report_date")).agg(total)
    return p.with_quarter_index(out)


def raw_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a landed table: codes and text."""
    codes = {"ASSET": "total_assets", "DEP": "total_deposits", "EQ": "equity", "LNLSNET": "net_loans_leases", "SC": "securities", "BRO": "brokered_deposits", "DEPUNINS": "uninsured_deposits_est", "NIMY": "net_interest_margin_pct"}
    text = [F.col(n).cast("decimal(24,6)").cast("string").alias(c) for c, n in codes.items()]
    return panel(spark, sf_dir).select(F.col("cert").cast("string").alias("CERT"), F.date_format("report_date", "yyyyMMdd").alias("REPDTE"), *text)


def raw_institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with nation and region, dates in text with one- and two-digit parts."""
    s, n, r = (table(spark, sf_dir, x) for x in ("supplier", "nation", "region"))
    rows = s.filter(F.col("s_nationkey") != UNREGISTERED_NATION).join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    opened = F.date_add(F.lit(date(1950, 1, 1)), F.col("s_suppkey").cast("int") % 9000)
    return rows.select(
        F.col("s_suppkey").cast("string").alias("CERT"),
        F.col("s_name").alias("NAME"),
        F.col("n_name").alias("CITY"),
        F.substring("r_name", 1, 2).alias("STALP"),
        F.col("r_name").alias("STNAME"),
        F.when(F.col("s_acctbal") >= 0, "1").otherwise("0").alias("ACTIVE"),
        F.date_format(opened, "M/d/yyyy").alias("ESTYMD"),
        F.col("s_acctbal").cast("string").alias("ASSET"),
    )


def raw_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in debt: failures and assistance, some without a usable key, some twice."""
    s = table(spark, sf_dir, "supplier").filter("s_acctbal < 0")
    k = F.col("s_suppkey").cast("int")
    twice = s.withColumn("turn", F.explode(F.when(k % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    failed = F.date_add(F.lit(date(2000, 1, 1)), k % 1000 - 400 * F.col("turn"))
    return twice.select(
        (k * 2 + F.col("turn")).cast("string").alias("ID"),
        F.when(k % 5 == 0, "n/a").otherwise(k.cast("string")).alias("CERT"),
        F.col("s_name").alias("NAME"),
        F.date_format(failed, "M/d/yyyy").alias("FAILDATE"),
        F.when(k % 3 == 0, "ASSISTANCE").otherwise("FAILURE").alias("RESTYPE"),
        (-F.col("s_acctbal")).cast("string").alias("QBFASSET"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, x) for x in ("supplier", "nation", "region"))
    rows = s.filter(F.col("s_nationkey") != UNREGISTERED_NATION).join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(F.col("s_suppkey").alias("cert"), F.col("s_name").alias("bank_name"), F.col("n_name").alias("city"), F.substring("r_name", 1, 2).alias("state_code"), F.col("r_name").alias("state_name"), (F.col("s_acctbal") >= 0).alias("is_active"))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterdeck.operators.staging import stage_failures

    return stage_failures(raw_failures(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """The fact mart, written once: medians, deviations and scores each read it."""
    return materialized(p.build_fact(panel(spark, sf_dir) if rows is None else rows, registry(spark, sf_dir), BANDS))


def fact_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact mart with a folder for each quarter, for queries of the last ones."""
    return mart(p.build_fact(panel(spark, sf_dir), registry(spark, sf_dir), BANDS), "report_date")


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.dim_entities(registry(spark, sf_dir), panel(spark, sf_dir), failures(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peers.peer_percentiles(fact(spark, sf_dir))


def flags(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Composite scores of a fact."""
    return peers.screen_flags(fact(spark, sf_dir) if of is None else of)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the nested shape of a daily export."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn("u", F.col("user_id").cast("int"))
    no_text, no_int = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def param(key: str, text=no_text, number=no_int):
        value = F.struct(text.alias("string_value"), number.alias("int_value"), F.lit(None).cast("double").alias("float_value"), F.lit(None).cast("double").alias("double_value"))
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    def given(condition, p):
        return F.when(condition, F.array(p)).otherwise(F.array())

    k, session = F.col("k"), F.datediff(F.to_date("ts"), F.lit(date(1970, 1, 1))).cast("bigint")
    params = F.concat(
        given((k != 0) & (k % 10 != 3), param("ga_session_id", number=session)),
        given((k != 0) & (k % 10 == 3), param("ga_session_id", text=session.cast("string"))),
        F.array(param("ga_session_number", number=F.dayofmonth("ts").cast("bigint"))),
        given(k % 3 == 0, param("session_engaged", text=F.lit("1"))),
        given(k % 3 == 2, param("session_engaged", number=F.lit(0).cast("bigint"))),
        given(k % 4 != 2, param("source", text=F.when(k % 4 == 0, "google").when(k % 4 == 1, "mail").otherwise("ads"))),
        given(k % 5 < 2, param("medium", text=F.when(k % 5 == 0, "organic").otherwise("email"))),
        F.array(param("page_location", text=F.concat(F.lit("https://site.example/p"), k.cast("string")))),
        F.array(param("engagement_time_msec", number=(k * 10).cast("bigint"))),
    )
    name = F.create_map(*map(F.lit, ("view", "view_item", "click", "add_to_cart", "signup", "begin_checkout", "error", "page_view", "purchase", "purchase")))
    text = lambda c: c.cast("string")
    return e.select(
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        name[F.col("event_type")].alias("event_name"),
        F.concat(F.lit("u"), text(F.col("u"))).alias("user_pseudo_id"),
        no_int.alias("user_first_touch_timestamp"),
        F.lit("WEB").alias("platform"),
        params.alias("event_params"),
        F.struct(F.when(k % 2 == 0, "mobile").otherwise("desktop").alias("category"), no_text.alias("operating_system"), F.struct(no_text.alias("browser")).alias("web_info")).alias("device"),
        F.struct(F.concat(F.lit("C"), text(F.col("u") % 7)).alias("country"), no_text.alias("region"), no_text.alias("city")).alias("geo"),
        F.struct(F.when(F.col("u") % 3 == 0, "google").when(F.col("u") % 3 == 2, "ads").alias("source"), F.when(F.col("u") % 2 == 0, "cpc").alias("medium"), no_text.alias("name")).alias("traffic_source"),
        F.struct(F.when((F.col("event_type") == "purchase") & (k % 11 != 0), F.col("value")).alias("purchase_revenue_in_usd"), text(F.col("event_id")).alias("transaction_id")).alias("ecommerce"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterdeck.operators.product import normalize_events
    from quarterdeck.operators.product import sessions as of

    return of(normalize_events(raw_events(spark, sf_dir)))


def session_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterdeck.operators.product import normalize_events
    from quarterdeck.operators.product import session_days as of

    return of(normalize_events(raw_events(spark, sf_dir)))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority and Monday's week; 0 where a week has none."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series_id"), week_of(F.to_date("o_orderdate")).alias("obs_date"), _money("o_totalprice").alias("price"))
    span = o.agg(F.min("obs_date").alias("first"), F.max("obs_date").alias("last"))
    weeks = o.select("series_id").distinct().join(F.broadcast(span)).select("series_id", F.explode(F.sequence("first", "last", F.expr("INTERVAL 7 DAYS"))).alias("obs_date"))
    sums = o.groupBy("series_id", "obs_date").agg(F.sum("price").cast("double").alias("value"))
    return weeks.join(sums, ["series_id", "obs_date"], "left").select("series_id", "obs_date", F.coalesce("value", F.lit(0.0)).alias("value"))


def outcomes(spark: SparkSession, sf_dir: str, converted: Column | None = None, by: list[str] | None = None) -> DataFrame:
    """Days of users with their arm and whether something was bought on that day."""
    from quarterdeck.operators.experiment import assign_arm, user_outcomes

    events = table(spark, sf_dir, "events").withColumn("unit", F.concat_ws("@", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")))
    units = user_outcomes(events, "unit", F.col("event_type") == "purchase" if converted is None else converted, by)
    return units.withColumn("arm", assign_arm(F.col("unit")))
