"""SQL for DuckDB that computes the operators' results by other means: self-joins, grouped percentiles, correlated look-ups."""

from quarterdeck.operators.forecast import ARIMA_GRID, ETS_GRID

METRICS = [
    "equity_to_assets", "loans_to_deposits", "securities_to_assets", "brokered_deposit_share", "uninsured_deposit_share", "asset_growth_qoq", "asset_growth_yoy",
    "asset_growth_3y_cagr", "deposit_growth_yoy", "nim_trend_4q", "net_interest_margin_pct", "roa_pct", "efficiency_ratio_pct", "cost_of_funds_pct",
]
OF_MODELS = "'equity_to_assets', 'loans_to_deposits', 'asset_growth_yoy', 'deposit_growth_yoy', 'nim_trend_4q', 'net_interest_margin_pct', 'roa_pct', 'efficiency_ratio_pct', 'uninsured_deposit_share', 'cost_of_funds_pct'"
Z = {
    "uninsured_deposit_share": "z_uninsured_share",
    "brokered_deposit_share": "z_brokered_share",
    "securities_to_assets": "z_securities_share",
    "asset_growth_3y_cagr": "z_asset_growth_3y",
    "nim_trend_4q": "z_nim_trend",
    "equity_to_assets": "z_equity_ratio",
}
_QUARTER_END = "CAST(date_trunc('quarter', {0}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"
_RISE = {c: f"coalesce(n.{c} - o.{c}, -99)" for c in Z.values()}
_MOST = f"greatest({', '.join(_RISE.values())})"

CTES = {
    "panel": f"""
  SELECT l_suppkey AS cert, {_QUARTER_END.format('l_shipdate')} AS report_date,
    CAST(sum(p) AS DOUBLE) AS total_assets, CAST(sum(p * (1 - d)) AS DOUBLE) AS total_deposits, CAST(sum(p * t) AS DOUBLE) AS equity,
    CAST(sum(CASE WHEN l_returnflag = 'N' THEN p ELSE 0 END) AS DOUBLE) AS net_loans_leases,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN p ELSE 0 END) AS DOUBLE) AS securities,
    CAST(sum(CASE WHEN l_returnflag = 'A' THEN p ELSE 0 END) AS DOUBLE) AS brokered_deposits,
    CAST(sum(CASE WHEN l_linestatus = 'O' THEN p ELSE 0 END) AS DOUBLE) AS uninsured_deposits_est,
    CAST(sum(d) AS DOUBLE) / count(*) * 100 AS net_interest_margin_pct, CAST(sum(t) AS DOUBLE) / count(*) * 100 AS roa_pct,
    CAST(sum(q) AS DOUBLE) / count(*) AS efficiency_ratio_pct, CAST(sum(d + t) AS DOUBLE) / count(*) * 100 AS cost_of_funds_pct
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(l_tax AS DECIMAL(4,2)) AS t, CAST(l_quantity AS DECIMAL(12,2)) AS q FROM lineitem)
  GROUP BY 1, 2""",
    "sparse": f"""
  SELECT o_custkey AS cert, {_QUARTER_END.format('o_orderdate')} AS report_date, year(o_orderdate) * 4 + quarter(o_orderdate) AS quarter_index,
    CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_assets
  FROM orders GROUP BY 1, 2, 3""",
    "registry": """
  SELECT s_suppkey AS cert, s_name AS bank_name, n_name AS city, substr(r_name, 1, 2) AS state_code, s_acctbal >= 0 AS is_active
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_nationkey <> 7""",
    "failures": """
  SELECT CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey END AS cert, CAST(DATE '2000-01-01' + CAST(s_suppkey % 1000 - 400 * turn AS INTEGER) AS DATE) AS failure_date,
    CASE WHEN s_suppkey % 3 = 0 THEN 'ASSISTANCE' ELSE 'FAILURE' END AS resolution_type, -s_acctbal AS assets_at_failure
  FROM supplier, (VALUES (0), (1)) t(turn) WHERE s_acctbal < 0 AND (turn = 0 OR s_suppkey % 4 = 0)""",
    "indexed": "SELECT *, year(report_date) * 4 + quarter(report_date) AS quarter_index FROM panel",
    "slopes": """
  SELECT a.cert, a.quarter_index, CASE WHEN count(x.net_interest_margin_pct) = 4 THEN covar_pop(x.net_interest_margin_pct, CAST(x.quarter_index AS DOUBLE)) / var_pop(CAST(x.quarter_index AS DOUBLE)) END AS nim_trend_4q
  FROM indexed a JOIN indexed x ON x.cert = a.cert AND x.quarter_index BETWEEN a.quarter_index - 3 AND a.quarter_index GROUP BY 1, 2""",
    "metrics": """
  SELECT a.*, a.equity / nullif(a.total_assets, 0) AS equity_to_assets, a.net_loans_leases / nullif(a.total_deposits, 0) AS loans_to_deposits,
    a.securities / nullif(a.total_assets, 0) AS securities_to_assets, a.brokered_deposits / nullif(a.total_deposits, 0) AS brokered_deposit_share,
    a.uninsured_deposits_est / nullif(a.total_deposits, 0) AS uninsured_deposit_share,
    a.total_assets / nullif(q.total_assets, 0) - 1 AS asset_growth_qoq, a.total_assets / nullif(y.total_assets, 0) - 1 AS asset_growth_yoy,
    pow(a.total_assets / nullif(t.total_assets, 0), 1e0 / 3) - 1 AS asset_growth_3y_cagr, a.total_deposits / nullif(y.total_deposits, 0) - 1 AS deposit_growth_yoy,
    s.nim_trend_4q
  FROM indexed a JOIN slopes s ON s.cert = a.cert AND s.quarter_index = a.quarter_index
  LEFT JOIN indexed q ON q.cert = a.cert AND q.quarter_index = a.quarter_index - 1
  LEFT JOIN indexed y ON y.cert = a.cert AND y.quarter_index = a.quarter_index - 4
  LEFT JOIN indexed t ON t.cert = a.cert AND t.quarter_index = a.quarter_index - 12""",
    "fact": """
  SELECT *, cert || '_' || strftime(report_date, '%Y%m%d') AS bank_quarter_key, asset_growth_qoq > 0.25 AS likely_merger_quarter,
    CASE WHEN total_assets >= 1400000 THEN 'large' WHEN total_assets >= 900000 THEN 'middle' WHEN total_assets >= 0 THEN 'small' END AS peer_band,
    CASE WHEN net_loans_leases / nullif(total_assets, 0) < 0.2 THEN 'fee_custody' WHEN brokered_deposit_share > 0.25 THEN 'wholesale_funded'
         WHEN securities_to_assets > 0.5 THEN 'securities_focused' ELSE 'traditional_lender' END AS business_model
  FROM metrics WHERE cert IN (SELECT cert FROM registry)""",
    "dim": """
  SELECT r.*, f.cert IS NOT NULL AS is_failed, f.failure_date, f.assets_at_failure
  FROM registry r LEFT JOIN (SELECT cert, max(failure_date) AS failure_date, arg_max(assets_at_failure, failure_date) AS assets_at_failure FROM failures WHERE resolution_type = 'FAILURE' AND cert IS NOT NULL GROUP BY 1) f ON f.cert = r.cert
  WHERE r.cert IN (SELECT cert FROM panel)""",
    "long": f"SELECT cert, report_date, peer_band, business_model, metric, value FROM (UNPIVOT (SELECT cert, report_date, peer_band, business_model, {', '.join(METRICS)} FROM fact) ON {', '.join(METRICS)} INTO NAME metric VALUE value)",
    "medians": "SELECT metric, report_date, peer_band, quantile_cont(value, 0.5) AS peer_median, count(*) AS peer_count FROM long WHERE peer_band IS NOT NULL GROUP BY 1, 2, 3",
    "stats": "SELECT metric, report_date, peer_band, peer_median, peer_count, quantile_cont(abs(value - peer_median), 0.5) AS peer_mad FROM long JOIN medians USING (metric, report_date, peer_band) GROUP BY 1, 2, 3, 4, 5",
    "scored": """
  SELECT *, CASE WHEN peer_mad > 0 THEN greatest(-5, least(5, (value - peer_median) / (1.4826 * peer_mad))) END AS robust_z,
    CASE WHEN peer_mad > 0 THEN (value - peer_median) / (1.4826 * peer_mad) END AS robust_z_unclamped
  FROM long JOIN stats USING (metric, report_date, peer_band)""",
    "model_medians": f"SELECT metric, report_date, business_model, quantile_cont(value, 0.5) AS peer_median FROM long WHERE metric IN ({OF_MODELS}) GROUP BY 1, 2, 3",
    "model_mads": "SELECT metric, report_date, business_model, peer_median, quantile_cont(abs(value - peer_median), 0.5) AS peer_mad FROM long JOIN model_medians USING (metric, report_date, business_model) GROUP BY 1, 2, 3, 4",
    "model_scored": "SELECT *, CASE WHEN peer_mad > 0 THEN greatest(-5, least(5, (value - peer_median) / (1.4826 * peer_mad))) END AS robust_z FROM long JOIN model_mads USING (metric, report_date, business_model)",
    "signed": f"SELECT cert, report_date, peer_band, metric, CASE WHEN metric IN ('nim_trend_4q', 'equity_to_assets') THEN -robust_z ELSE robust_z END AS z FROM scored WHERE metric IN ({', '.join(repr(m) for m in Z)})",
    "flags": "SELECT cert, report_date, peer_band, avg(z) AS composite_score, count(z) AS n_screen_metrics, " + ", ".join(f"max(z) FILTER (metric = '{m}') AS {c}" for m, c in Z.items()) + " FROM signed GROUP BY 1, 2, 3",
    "ranked": """
  SELECT f.*, d.bank_name, d.is_active, d.is_failed, x.total_assets,
    1 + (SELECT count(*) FROM flags g WHERE g.report_date = f.report_date AND g.peer_band = f.peer_band AND g.composite_score > f.composite_score) AS band_rank,
    count(*) OVER (PARTITION BY f.peer_band) AS band_size, percent_rank() OVER (PARTITION BY f.peer_band ORDER BY f.composite_score) AS band_percentile,
    1 + (SELECT count(*) FROM flags g WHERE g.report_date = f.report_date AND g.composite_score > f.composite_score) AS overall_rank,
    count(*) OVER () AS overall_size, percent_rank() OVER (ORDER BY f.composite_score) AS overall_percentile
  FROM flags f JOIN dim d ON d.cert = f.cert LEFT JOIN fact x ON x.cert = f.cert AND x.report_date = f.report_date
  WHERE f.composite_score IS NOT NULL AND f.report_date = (SELECT max(report_date) FROM flags)""",
    "dates": "SELECT max(report_date) AS now, max(report_date) FILTER (report_date < (SELECT max(report_date) FROM flags)) AS before FROM flags",
    "moved": f"""
  SELECT n.cert, n.peer_band, n.composite_score, o.composite_score AS prior_score, n.composite_score - o.composite_score AS score_change,
    CASE {_MOST} WHEN -99 THEN NULL {' '.join(f"WHEN {r} THEN '{c}'" for c, r in _RISE.items())} END AS main_driver
  FROM flags n JOIN flags o ON n.cert = o.cert, dates WHERE n.report_date = now AND o.report_date = before AND n.composite_score IS NOT NULL AND o.composite_score IS NOT NULL""",
    "ev": """
  SELECT *, CASE WHEN k <> 0 THEN CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) END AS session, CAST(day(ts) AS BIGINT) AS day,
    CASE event_type WHEN 'view' THEN 'view_item' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'begin_checkout' WHEN 'error' THEN 'page_view' ELSE event_type END AS event_name,
    CASE k % 3 WHEN 0 THEN 1 WHEN 2 THEN 0 END AS engaged, CASE k % 4 WHEN 0 THEN 'google' WHEN 1 THEN 'mail' WHEN 3 THEN 'ads' END AS source,
    CASE k % 5 WHEN 0 THEN 'organic' WHEN 1 THEN 'email' END AS medium, CASE WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device, 'C' || user_id % 7 AS country,
    CASE user_id % 3 WHEN 0 THEN 'google' WHEN 2 THEN 'ads' END AS ft_source, CASE WHEN user_id % 2 = 0 THEN 'cpc' END AS ft_medium,
    CASE WHEN event_type = 'purchase' AND k % 11 <> 0 THEN value END AS revenue
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "sessions": """
  SELECT 'u' || user_id || '-' || session AS session_key, 'u' || user_id AS user_pseudo_id, session AS ga_session_id, max(day) AS ga_session_number,
    min(CAST(ts AS DATE)) AS session_date, max(day) = 1 AS is_first_session, max(engaged) = 1 AS engaged, arg_min(device, ts) AS device_category, min(country) AS country,
    count(*) FILTER (event_name = 'page_view') AS pageviews, count(*) FILTER (event_name = 'view_item') AS items_viewed, count(*) FILTER (event_name = 'add_to_cart') AS carts,
    count(*) FILTER (event_name = 'begin_checkout') AS checkouts, count(*) FILTER (event_name = 'purchase') AS purchases, sum(revenue) AS revenue_usd,
    coalesce(arg_min(source, ts) FILTER (source IS NOT NULL), '(direct)') || ' / ' || coalesce(arg_min(medium, ts) FILTER (medium IS NOT NULL), '(none)') AS session_channel,
    coalesce(min(ft_source), '(direct)') || ' / ' || coalesce(min(ft_medium), '(none)') AS first_touch_channel
  FROM ev WHERE session IS NOT NULL GROUP BY user_id, session""",
    "weekly": """
  SELECT series_id, CAST(w AS DATE) AS obs_date, coalesce((SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) FROM orders WHERE o_orderpriority = series_id AND date_trunc('week', o_orderdate) = w), 0) AS value
  FROM (SELECT DISTINCT o_orderpriority AS series_id FROM orders), (SELECT unnest(generate_series(date_trunc('week', min(o_orderdate))::TIMESTAMP, date_trunc('week', max(o_orderdate))::TIMESTAMP, INTERVAL 7 DAY)) AS w FROM orders)""",
    "outcomes": """
  SELECT unit, CASE WHEN ('0x' || substr(md5(unit), 1, 8))::BIGINT % 2 = 1 THEN 'treatment' ELSE 'control' END AS arm, bool_or(event_type = 'purchase') AS converted
  FROM (SELECT *, user_id || '@' || strftime(ts, '%Y-%m-%d') AS unit FROM events) GROUP BY 1""",
}

DAILY = "SELECT session_date AS date, count(*) AS sessions, count(*) FILTER (engaged) AS engaged_sessions, count(DISTINCT user_pseudo_id) AS users, count(DISTINCT CASE WHEN is_first_session THEN user_pseudo_id END) AS new_users, CAST(sum(pageviews) AS BIGINT) AS pageviews, CAST(sum(purchases) AS BIGINT) AS purchases, coalesce(sum(revenue_usd), 0) AS revenue_usd, count(*) FILTER (purchases > 0) / count(*) AS purchase_cvr FROM sessions GROUP BY 1"
FUNNEL = "SELECT week, count(*) AS sessions, count(*) FILTER (d >= 1) AS sessions_with_view, count(*) FILTER (d >= 2) AS sessions_with_cart, count(*) FILTER (d >= 3) AS sessions_with_purchase, count(*) FILTER (d >= 1) / count(*) AS view_rate, count(*) FILTER (d >= 2) / nullif(count(*) FILTER (d >= 1), 0) AS cart_rate_of_views, count(*) FILTER (d >= 3) / nullif(count(*) FILTER (d >= 2), 0) AS purchase_rate_of_carts, count(*) FILTER (d >= 3) / count(*) AS overall_cvr FROM (SELECT CAST(date_trunc('week', session_date) AS DATE) AS week, CASE WHEN purchases > 0 THEN 3 WHEN carts + checkouts > 0 THEN 2 WHEN items_viewed > 0 THEN 1 ELSE 0 END AS d FROM sessions) GROUP BY 1"
RETENTION = "WITH a AS (SELECT DISTINCT user_pseudo_id, CAST(date_trunc('week', session_date) AS DATE) AS week FROM sessions), f AS (SELECT user_pseudo_id, min(week) AS cohort_week FROM a GROUP BY 1), n AS (SELECT cohort_week, count(*) AS cohort_size FROM f GROUP BY 1) SELECT f.cohort_week, (a.week - f.cohort_week) // 7 AS week_number, n.cohort_size, count(*) AS active_users, count(*) / n.cohort_size AS retention_pct FROM a JOIN f USING (user_pseudo_id) JOIN n ON n.cohort_week = f.cohort_week WHERE (a.week - f.cohort_week) // 7 <= 12 GROUP BY 1, 2, 3"
CHANNELS = "SELECT session_channel AS channel, count(*) AS sessions, count(DISTINCT user_pseudo_id) AS users, CAST(sum(purchases) AS BIGINT) AS purchases, coalesce(sum(revenue_usd), 0) AS revenue_usd, count(*) FILTER (purchases > 0) / count(*) AS purchase_cvr, count(*) / (SELECT count(*) FROM sessions) AS session_share FROM sessions GROUP BY 1"
ATTRIBUTION = "SELECT channel, CAST(coalesce(sum(p) FILTER (side = 1), 0) AS BIGINT) AS first_touch_purchases, CAST(coalesce(sum(p) FILTER (side = 2), 0) AS BIGINT) AS last_touch_purchases, coalesce(sum(r) FILTER (side = 1), 0) AS first_touch_revenue_usd, coalesce(sum(r) FILTER (side = 2), 0) AS last_touch_revenue_usd FROM (SELECT first_touch_channel AS channel, 1 AS side, purchases AS p, revenue_usd AS r FROM sessions WHERE purchases > 0 UNION ALL SELECT session_channel, 2, purchases, revenue_usd FROM sessions WHERE purchases > 0) GROUP BY 1"
NAIVE_BACKTEST = "WITH n AS (SELECT *, CAST(row_number() OVER (PARTITION BY series_id ORDER BY obs_date) - 1 AS INTEGER) AS i, CAST(count(*) OVER (PARTITION BY series_id) AS INTEGER) AS n FROM weekly) SELECT a.series_id, CAST(o AS INTEGER) AS origin, CAST(a.i - o + 1 AS INTEGER) AS k, a.value AS actual, b.value AS point FROM n a JOIN (SELECT unnest(range(104, 10000, 4)) AS o) g ON a.i BETWEEN o AND o + 11 AND o <= a.n - 12 JOIN n b ON b.series_id = a.series_id AND b.i = a.i - 52"
NAIVE_INTERVALS = "WITH i AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY obs_date) AS i, row_number() OVER (PARTITION BY series_id ORDER BY obs_date DESC) AS r FROM weekly), d AS (SELECT a.series_id, quantile_cont(a.value - b.value, 0.025) AS lo, quantile_cont(a.value - b.value, 0.975) AS hi FROM i a JOIN i b ON a.series_id = b.series_id AND b.i = a.i - 52 GROUP BY 1) SELECT series_id, CAST(53 - r AS INTEGER) AS k, value AS point, value + lo AS lower, value + hi AS upper FROM i JOIN d USING (series_id) WHERE r BETWEEN 41 AND 52"
_NAIVE_ERRORS = f"SELECT series_id, 'seasonal_naive' AS method, origin, k, actual, point FROM ({NAIVE_BACKTEST})"
_LINES = "n AS (SELECT series_id, value AS v, CAST(row_number() OVER (PARTITION BY series_id ORDER BY obs_date) AS INTEGER) AS i, CAST(count(*) OVER (PARTITION BY series_id) AS INTEGER) AS n FROM weekly)"
_AT_ORIGINS = "i = n OR (i BETWEEN 104 AND n - 12 AND (i - 104) % 4 = 0)"
_values = lambda x: ", ".join(f"(CAST({v} AS DOUBLE))" for v in x)
#: One row for each series, parameter choice and week, by recursion; then the choice with the least error at each origin.
ETS = f"""WITH RECURSIVE {_LINES},
g AS (SELECT alpha, beta, phi FROM (VALUES {_values(ETS_GRID[0])}) a(alpha), (VALUES {_values(ETS_GRID[1])}) b(beta), (VALUES {_values(ETS_GRID[2])}) c(phi)),
run AS (
  SELECT f.series_id, f.n, g.*, 0 AS i, f.v AS l, (t.v - f.v) / 103 AS b, 0e0 AS e FROM n f JOIN n t ON t.series_id = f.series_id AND t.i = 104, g WHERE f.i = 1
  UNION ALL
  SELECT r.series_id, r.n, alpha, beta, phi, r.i + 1, l + phi * b + alpha * (v - (l + phi * b)), phi * b + beta * (v - (l + phi * b)), e + (v - (l + phi * b)) * (v - (l + phi * b)) FROM run r JOIN n ON n.series_id = r.series_id AND n.i = r.i + 1
), best AS (SELECT * FROM run WHERE {_AT_ORIGINS} QUALIFY row_number() OVER (PARTITION BY series_id, i ORDER BY e, alpha, beta, phi) = 1)
SELECT series_id, i AS origin, CAST(k AS INTEGER) AS k, l + phi * (1 - pow(phi, k)) / (1 - phi) * b AS point,
  sqrt(e / i * list_sum(list_transform(range(0, k), lambda j: CASE WHEN j = 0 THEN 1e0 ELSE pow(alpha + beta * phi * (1 - pow(phi, j)) / (1 - phi), 2) END))) AS sigma
FROM best, (SELECT unnest(range(1, 13)) AS k)"""
ARIMA = f"""WITH RECURSIVE {_LINES},
g AS (SELECT phi, theta FROM (VALUES {_values(ARIMA_GRID[0])}) a(phi), (VALUES {_values(ARIMA_GRID[1])}) b(theta)),
run AS (
  SELECT f.series_id, f.n, g.*, 1 AS i, f.v AS y, 0e0 AS d, 0e0 AS a, 0e0 AS e, (t.v - f.v) / 103 AS m FROM n f JOIN n t ON t.series_id = f.series_id AND t.i = 104, g WHERE f.i = 1
  UNION ALL
  SELECT r.series_id, r.n, phi, theta, r.i + 1, v, v - y - m, v - y - m - phi * d - theta * a, e + pow(v - y - m - phi * d - theta * a, 2), m FROM run r JOIN n ON n.series_id = r.series_id AND n.i = r.i + 1
), best AS (SELECT * FROM run WHERE {_AT_ORIGINS} QUALIFY row_number() OVER (PARTITION BY series_id, i ORDER BY e, phi, theta) = 1)
SELECT series_id, i AS origin, CAST(k AS INTEGER) AS k, y + k * m + (phi * d + theta * a) * list_sum(list_transform(range(0, k), lambda j: pow(phi, j))) AS point,
  sqrt(e / i * list_sum(list_transform(range(0, k), lambda j: CASE WHEN j = 0 THEN 1e0 ELSE pow(1 + (phi + theta) * list_sum(list_transform(range(0, j), lambda x: pow(phi, x))), 2) END))) AS sigma
FROM best, (SELECT unnest(range(1, 13)) AS k)"""
_TESTS = _NAIVE_ERRORS + "".join(f" UNION ALL SELECT t.series_id, '{name}', t.origin, t.k, t.actual, m.point FROM ({NAIVE_BACKTEST}) t JOIN ({sql}) m ON m.series_id = t.series_id AND m.origin = t.origin AND m.k = t.k" for name, sql in (("ets_damped", ETS), ("arima_drift", ARIMA)))
_ERRORS = f"SELECT series_id, method, avg(abs(point - actual) / nullif(abs(actual), 0)) * 100 AS mape, avg(coalesce(2 * abs(point - actual) / nullif(abs(point) + abs(actual), 0), 0)) * 100 AS smape, count(*) AS n_errors, count(DISTINCT origin) AS n_origins FROM ({_TESTS}) GROUP BY 1, 2"
EVALUATE = f"SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY smape, method <> 'seasonal_naive', method) = 1 AS published FROM ({_ERRORS})"
CORRELATION = " UNION ALL ".join(f"SELECT '{x}' AS metric_x, '{y}' AS metric_y, CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END AS correlation FROM flags WHERE composite_score IS NOT NULL" for x in Z.values() for y in Z.values() if x != y)
#: Pairs without a common row in a year have no line.
SPAN_CORRELATION = " UNION ALL ".join(
    f"SELECT {span} AS span, '{x}' AS metric_x, '{y}' AS metric_y, CASE WHEN min({x}) = max({x}) OR min({y}) = max({y}) OR isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END AS correlation FROM flags WHERE composite_score IS NOT NULL AND {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1"
    for span in ("CAST(year(report_date) AS VARCHAR)", "'all'") for x in Z.values() for y in Z.values() if x != y
)
_LAST = "(SELECT max(report_date) FROM fact)"
_PRIOR = f"coalesce((SELECT max(report_date) FROM fact WHERE report_date < {_LAST}), {_LAST})"
_CHECKS = {
    "latest period": f"SELECT CAST({_LAST} AS VARCHAR)",
    "prior period": f"SELECT CAST({_PRIOR} AS VARCHAR)",
    "rows of the latest period": f"SELECT CAST(count(*) AS VARCHAR) FROM fact WHERE report_date = {_LAST}",
    "rows of the prior period": f"SELECT CAST(count(*) AS VARCHAR) FROM fact WHERE report_date = {_PRIOR}",
    "active entities of the latest period": f"SELECT CAST(count(*) AS VARCHAR) FROM fact JOIN dim USING (cert) WHERE is_active AND report_date = {_LAST}",
    "latest weekly observation": "SELECT CAST(max(obs_date) AS VARCHAR) FROM weekly",
    "fact rows": "SELECT CAST(count(*) AS VARCHAR) FROM fact",
    "fact entities": "SELECT CAST(count(DISTINCT cert) AS VARCHAR) FROM fact",
    "rows without a band": "SELECT CAST(count(*) AS VARCHAR) FROM fact WHERE peer_band IS NULL",
    "duplicate keys": "SELECT CAST((SELECT count(*) FROM (SELECT 1 FROM fact GROUP BY cert, report_date HAVING count(*) > 1)) + (SELECT count(*) FROM (SELECT 1 FROM panel GROUP BY cert, report_date HAVING count(*) > 1)) AS VARCHAR)",
    "null keys": "SELECT CAST(count(*) AS VARCHAR) FROM panel WHERE cert IS NULL OR report_date IS NULL",
    "orphan entities": "SELECT CAST(count(DISTINCT cert) AS VARCHAR) FROM panel WHERE cert NOT IN (SELECT cert FROM registry)",
    "orphan rows": "SELECT CAST(count(*) AS VARCHAR) FROM panel WHERE cert NOT IN (SELECT cert FROM registry)",
    "assistance records": "SELECT CAST(count(*) AS VARCHAR) FROM failures WHERE resolution_type = 'ASSISTANCE'",
    "failures without a key": "SELECT CAST(count(*) AS VARCHAR) FROM failures WHERE cert IS NULL",
}
STATUS = (
    "SELECT *, CASE WHEN check_name IN ('duplicate keys', 'null keys') AND value <> '0' THEN 'fail' WHEN check_name LIKE 'orphan%' AND value <> '0' THEN 'review' ELSE 'pass' END AS status FROM ("
    + " UNION ALL ".join(f"SELECT '{name}' AS check_name, ({sql}) AS value" for name, sql in _CHECKS.items())
    + ")"
)


def statement(sql: str, doubles: list[str]) -> str:
    """A query over the shared tables, with its doubles rounded as the Spark side rounds them."""
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items())
    rounded = ", ".join(f'CASE WHEN round("{c}", 6) = 0 THEN 0e0 ELSE round("{c}", 6) END AS "{c}"' for c in doubles)
    return f"WITH RECURSIVE {ctes}\nSELECT *{f' REPLACE ({rounded})' if doubles else ''} FROM ({sql})"
