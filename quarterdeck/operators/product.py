"""Event normalisation, sessions and the product marts built from them."""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.columns import param_int, param_repeated, param_str, week_of
from quarterdeck.sources.writers import materialized

#: Funnel events and the session column that counts each.
COUNTED = {"page_view": "pageviews", "view_item": "items_viewed", "add_to_cart": "carts", "begin_checkout": "checkouts", "purchase": "purchases"}
#: Texts of which a session has the first that is known, and how many pairs of event name and value a broadcast dictionary may have.
FIRST_KNOWN = ["device_category", "country", "event_source", "event_medium", "first_touch_source", "first_touch_medium"]
CODES = 1 << 17
WEEKS = 12
#: Weeks are counted from here.
MONDAY = date(1970, 1, 5)


def normalize_events(raw: DataFrame) -> DataFrame:
    """Nested export rows as flat columns."""
    p = F.col("event_params")
    return raw.select(
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_ts"),
        "event_name",
        "user_pseudo_id",
        param_int(p, "ga_session_id").alias("ga_session_id"),
        param_int(p, "ga_session_number").alias("ga_session_number"),
        F.concat("user_pseudo_id", F.lit("-"), param_int(p, "ga_session_id").cast("string")).alias("session_key"),
        param_str(p, "page_location").alias("page_location"),
        param_str(p, "page_title").alias("page_title"),
        param_str(p, "page_referrer").alias("page_referrer"),
        param_int(p, "session_engaged").alias("session_engaged"),
        param_int(p, "engagement_time_msec").alias("engagement_time_msec"),
        F.col("device.category").alias("device_category"),
        F.col("device.operating_system").alias("operating_system"),
        F.col("device.web_info.browser").alias("browser"),
        F.col("geo.country").alias("country"),
        F.col("geo.region").alias("region"),
        F.col("geo.city").alias("city"),
        "platform",
        F.col("traffic_source.source").alias("first_touch_source"),
        F.col("traffic_source.medium").alias("first_touch_medium"),
        F.col("traffic_source.name").alias("first_touch_name"),
        param_str(p, "source").alias("event_source"),
        param_str(p, "medium").alias("event_medium"),
        param_str(p, "campaign").alias("event_campaign"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_usd"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.timestamp_micros("user_first_touch_timestamp").alias("user_first_touch_ts"),
    )


def repeated_params(raw: DataFrame, keys: list[str]) -> DataFrame:
    """(key, rows): parameters that occur more than once in an event; only the first is read."""
    counts = raw.agg(*[F.count_if(param_repeated(F.col("event_params"), k)).alias(k) for k in keys])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("rows")) for k in keys]))).filter("rows > 0")


def value_codes(events: DataFrame, columns: list[str] = FIRST_KNOWN) -> DataFrame:
    """(event_name, value, least_us, most_us): the pairs of a name and a known value in any of ``columns``, with their first and last time."""
    pairs = F.array(*[F.struct("event_name", F.col(c).alias("value")) for c in columns])
    us = F.unix_micros(F.col("event_ts").cast("timestamp"))
    return events.select(us.alias("_us"), F.inline(pairs)).filter("value IS NOT NULL").groupBy("event_name", "value").agg(F.min("_us").alias("least_us"), F.max("_us").alias("most_us"))


def _with_first_codes(events: DataFrame, pairs: DataFrame, n: int) -> tuple[DataFrame, dict[str, Column], DataFrame]:
    """``events`` with each column's time and code in one number, the aggregates that find the first, and the dictionary: (_name, _value, _code)."""
    # As many rows as codes, which are bounded; their order is that of ties in time.
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("event_name", "value")) - 1
    codes = materialized(pairs.select(F.col("event_name").alias("_name"), F.col("value").alias("_value"), place.cast("long").alias("_code")))
    least, most = pairs.agg(F.min("least_us"), F.max("most_us")).first()
    least, most = least or 0, most or 0
    # A long holds some nine years of microseconds with 32,768 codes; beyond that it is a decimal.
    kind = "bigint" if (most - least + 2) * n < 1 << 63 else "decimal(38,0)"
    at = F.coalesce(F.unix_micros(F.col("event_ts").cast("timestamp")).cast(kind) - F.lit(least - 1).cast(kind), F.lit(0).cast(kind))
    out = events
    for c in FIRST_KNOWN:
        mine = F.broadcast(codes.toDF("_name", "_value", f"_c_{c}"))
        out = out.join(mine, F.col("event_name").eqNullSafe(F.col("_name")) & (F.col(c) == F.col("_value")), "left").drop("_name", "_value")
    found = {c: F.min(at * F.lit(n).cast(kind) + F.col(f"_c_{c}").cast(kind)) for c in FIRST_KNOWN}
    return out, found, codes


def sessions(events: DataFrame, counted: dict[str, str] = COUNTED, max_codes: int = CODES) -> DataFrame:
    """One row per session; events without a session id are dropped. Ties in time go by name and value, so reruns agree.

    Texts whose first known value is wanted become codes of a dictionary, and time
    and code one number, so a session is a hash aggregate of numbers: ``events`` is
    read once, and what sessions need of it is written for the dictionary and that. With more than ``max_codes``
    pairs of names and values the dictionary isn't broadcast, and rows are sorted.
    """
    # Filtered only once written: a filter on raw rows repeats what makes the id, parsing included, for each mention.
    needed = ["session_key", "user_pseudo_id", "ga_session_id", "ga_session_number", "session_engaged", "event_date", "event_ts", "event_name", "purchase_revenue_usd", *FIRST_KNOWN]
    held = materialized(events.select(*needed)).filter("ga_session_id IS NOT NULL")
    pairs = materialized(value_codes(held))
    n = pairs.count()
    if coded := n <= max_codes:
        held, first, codes = _with_first_codes(held, pairs, max(n, 1))
    else:
        first = {c: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("event_ts", "event_name", F.col(c)))) for c in FIRST_KNOWN}
    out = held.groupBy("session_key", "user_pseudo_id", "ga_session_id").agg(
        F.max("ga_session_number").alias("ga_session_number"),
        F.min("event_date").alias("session_date"),
        F.min("event_ts").alias("session_start_ts"),
        (F.max("ga_session_number") == 1).alias("is_first_session"),
        (F.max("session_engaged") == 1).alias("engaged"),
        *[F.count_if(F.col("event_name") == e).alias(c) for e, c in counted.items()],
        F.sum("purchase_revenue_usd").alias("revenue_usd"),
        *[f.alias(f"_f_{c}") for c, f in first.items()],
    )
    for c in FIRST_KNOWN if coded else []:
        mine = F.broadcast(codes.select("_code", F.col("_value").alias(f"_v_{c}")))
        out = out.join(mine, (F.col(f"_f_{c}") % max(n, 1)).cast("long") == F.col("_code"), "left").drop("_code", f"_f_{c}").withColumnRenamed(f"_v_{c}", f"_f_{c}")
    channel = lambda a, b: F.concat(F.coalesce(f"_f_{a}", F.lit("(direct)")), F.lit(" / "), F.coalesce(f"_f_{b}", F.lit("(none)")))
    return out.select(
        *["session_key", "user_pseudo_id", "ga_session_id", "ga_session_number", "session_date", "session_start_ts", "is_first_session", "engaged"],
        *[F.col(f"_f_{c}").alias(c) for c in ("device_category", "country")],
        *counted.values(),
        "revenue_usd",
        channel("event_source", "event_medium").alias("session_channel"),
        channel("first_touch_source", "first_touch_medium").alias("first_touch_channel"),
    )


def session_days(events: DataFrame) -> DataFrame:
    """(user_pseudo_id, ga_session_id, session_date): what ``sessions`` has of these, one row for each of its rows, without its other columns.

    A session's key is made of its user and id, so these two are the group.
    """
    days = events.groupBy("user_pseudo_id", "ga_session_id").agg(F.min("event_date").alias("session_date"), F.max("ga_session_id").alias("_known"))
    # By an aggregate: a filter of the key would move to raw rows and repeat what makes the id.
    return days.filter("_known IS NOT NULL").drop("_known")


def daily(s: DataFrame) -> DataFrame:
    return s.groupBy(F.col("session_date").alias("date")).agg(
        F.count("*").alias("sessions"),
        F.count_if("engaged").alias("engaged_sessions"),
        F.countDistinct("user_pseudo_id").alias("users"),
        F.countDistinct(F.when(F.col("is_first_session"), F.col("user_pseudo_id"))).alias("new_users"),
        F.sum("pageviews").alias("pageviews"),
        F.sum("purchases").alias("purchases"),
        F.coalesce(F.sum("revenue_usd"), F.lit(0.0)).alias("revenue_usd"),
        F.try_divide(F.count_if(F.col("purchases") > 0), F.count("*")).alias("purchase_cvr"),
    )


def closed_funnel(s: DataFrame) -> DataFrame:
    """Weekly funnel in which a deeper stage implies the ones before it."""
    purchase = F.col("purchases") > 0
    cart = (F.col("carts") > 0) | (F.col("checkouts") > 0) | purchase
    view = (F.col("items_viewed") > 0) | cart
    n, v, c, p = F.count("*"), F.count_if(view), F.count_if(cart), F.count_if(purchase)
    return s.groupBy(week_of("session_date").alias("week")).agg(
        n.alias("sessions"),
        v.alias("sessions_with_view"),
        c.alias("sessions_with_cart"),
        p.alias("sessions_with_purchase"),
        F.try_divide(v, n).alias("view_rate"),
        F.try_divide(c, v).alias("cart_rate_of_views"),
        F.try_divide(p, c).alias("purchase_rate_of_carts"),
        F.try_divide(p, n).alias("overall_cvr"),
    )


def week_masks(s: DataFrame, weeks: int = WEEKS) -> DataFrame:
    """(user, cohort_index, mask): each user's first active week, counted in weeks since a Monday, and a bit for each of the ``weeks`` after it that is active too.

    Weeks are bits of spans that overlap by ``weeks``, so the span in which a user
    begins holds all that counts, however long the history.
    """
    if not 0 < weeks <= 30:
        raise ValueError("a mask holds up to 30 weeks")
    span = 62 - weeks
    index = F.floor(F.datediff("session_date", F.lit(MONDAY)) / 7).cast("long")
    at = F.pmod(index, F.lit(span))
    place = lambda back: F.struct((F.floor((index - at) / span).cast("long") - back).alias("span"), (at + back * span).cast("int").alias("bit"))
    held = s.select("user_pseudo_id", F.explode(F.when(at < weeks, F.array(place(0), place(1))).otherwise(F.array(place(0)))).alias("_p"))
    masks = held.groupBy("user_pseudo_id", F.col("_p.span").alias("span")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_p.bit"))).alias("mask"))
    begins = F.col("mask").bitwiseAND(F.lit((1 << span) - 1)) != 0
    first = masks.filter(begins).groupBy("user_pseudo_id").agg(F.min("span").alias("span"), F.min_by("mask", "span").alias("mask"))
    low = F.bit_count(F.col("mask").bitwiseAND(-F.col("mask")) - 1).cast("int")
    return first.select("user_pseudo_id", (F.col("span") * span + low).alias("cohort_index"), F.call_function("shiftright", F.col("mask"), low).bitwiseAND(F.lit((1 << weeks + 1) - 1)).alias("mask"))


def retention(s: DataFrame, weeks: int = WEEKS) -> DataFrame:
    """Share of each cohort active in each later week; the cohort is the user's first week. A user is one mask of weeks, a cohort one row of sums."""
    bit = lambda k: F.call_function("shiftright", F.col("mask"), F.lit(k)).bitwiseAND(F.lit(1).cast("long"))
    sums = week_masks(s, weeks).groupBy("cohort_index").agg(F.count("*").alias("cohort_size"), *[F.sum(bit(k)).alias(f"_{k}") for k in range(weeks + 1)])
    rows = F.array(*[F.struct(F.lit(k).cast("long").alias("week_number"), F.col(f"_{k}").alias("active_users")) for k in range(weeks + 1)])
    cohort = F.date_add(F.lit(MONDAY), (F.col("cohort_index") * 7).cast("int")).alias("cohort_week")
    long = sums.select(cohort, "cohort_size", F.inline(F.filter(rows, lambda r: r["active_users"] > 0)))
    return long.withColumn("retention_pct", F.try_divide("active_users", "cohort_size"))


def retention_grid(r: DataFrame, weeks: int = WEEKS) -> DataFrame:
    """Weeks as columns; blank where a cohort has no row."""
    wide = r.groupBy("cohort_week", "cohort_size").pivot("week_number", list(range(weeks + 1))).agg(F.max("retention_pct"))
    return wide.toDF("cohort_week", "cohort_size", *[f"w{k}" for k in range(weeks + 1)])


def channels(s: DataFrame) -> DataFrame:
    out = s.groupBy(F.col("session_channel").alias("channel")).agg(
        F.count("*").alias("sessions"),
        F.countDistinct("user_pseudo_id").alias("users"),
        F.sum("purchases").alias("purchases"),
        F.coalesce(F.sum("revenue_usd"), F.lit(0.0)).alias("revenue_usd"),
        F.try_divide(F.count_if(F.col("purchases") > 0), F.count("*")).alias("purchase_cvr"),
    )
    # After the aggregate: one row for each channel.
    return out.withColumn("session_share", F.col("sessions") / F.sum("sessions").over(Window.partitionBy()))


def attribution(s: DataFrame) -> DataFrame:
    """Purchases and revenue by first touch beside those by the session's channel."""
    bought = s.filter("purchases > 0")

    def by(channel: str, touch: str) -> DataFrame:
        return bought.groupBy(F.col(channel).alias("channel")).agg(F.sum("purchases").alias(f"{touch}_touch_purchases"), F.sum("revenue_usd").alias(f"{touch}_touch_revenue_usd"))

    both = by("first_touch_channel", "first").join(by("session_channel", "last"), "channel", "full_outer")
    zero = {c: F.coalesce(c, F.lit(0.0 if "revenue" in c else 0)) for c in both.columns if c != "channel"}
    return both.withColumns(zero)


def window_totals(d: DataFrame) -> DataFrame:
    """Totals over days, the rate weighted by sessions."""
    return d.agg(F.sum("sessions").alias("sessions"), F.sum("users").alias("user_days"), F.sum("purchases").alias("purchases"), F.sum("revenue_usd").alias("revenue_usd"), F.try_divide(F.sum(F.col("purchase_cvr") * F.col("sessions")), F.sum("sessions")).alias("purchase_cvr"))


def funnel_long(f: DataFrame) -> DataFrame:
    return f.unpivot(["week"], ["sessions", "sessions_with_view", "sessions_with_cart", "sessions_with_purchase"], "stage", "sessions_at_stage")


def attribution_long(a: DataFrame) -> DataFrame:
    """(channel, touch, purchases) without channels that have none at all."""
    long = a.unpivot(["channel"], ["first_touch_purchases", "last_touch_purchases"], "touch", "purchases")
    return long.withColumn("_total", F.sum("purchases").over(Window.partitionBy("channel"))).filter("_total > 0").drop("_total")


def attribution_table(a: DataFrame) -> DataFrame:
    return a.withColumn("purchase_shift", F.col("last_touch_purchases") - F.col("first_touch_purchases")).withColumn("revenue_shift", F.col("last_touch_revenue_usd") - F.col("first_touch_revenue_usd")).orderBy(F.desc("last_touch_purchases"), "channel")


def event_counts(events: DataFrame, names: list[str]) -> DataFrame:
    """Occurrences and users of listed custom events."""
    return events.filter(F.col("event_name").isin(names)).groupBy("event_name").agg(F.count("*").alias("events"), F.countDistinct("user_pseudo_id").alias("users"))
