from datetime import date

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions import columns as c
from quarterdeck.operators import panel as p
from quarterdeck.operators import peers, screen

Q = [date(2020, 3, 31), date(2020, 6, 30), date(2020, 9, 30), date(2020, 12, 31), date(2021, 3, 31), date(2021, 9, 30)]


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(1, d, 100.0 * (k + 1), float(k)) for k, d in enumerate(Q)]
    return p.with_quarter_index(spark.createDataFrame(rows, "cert bigint, report_date date, total_assets double, nim double"))


def test_growth_is_null_across_a_gap(panel):
    rows = panel.select("report_date", p.growth_vs("total_assets", 1).alias("g"), p.growth_vs("total_assets", 4).alias("y")).orderBy("report_date").collect()
    assert [r.g for r in rows][:3] == [None, 1.0, 0.5]
    assert rows[-1].g is None  # June 2021 is missing
    assert rows[4].y == 4.0


def test_slope_needs_all_quarters(panel):
    rows = panel.select("report_date", p.trailing_slope("nim").alias("s")).orderBy("report_date").collect()
    assert [r.s for r in rows] == [None, None, None, 1.0, 1.0, None]


def test_cagr(spark):
    df = p.with_quarter_index(spark.createDataFrame([(1, date(2018, 3, 31), 1.0), (1, date(2021, 3, 31), 8.0)], "cert bigint, report_date date, total_assets double"))
    assert df.select(p.growth_cagr("total_assets").alias("g")).orderBy(F.desc_nulls_last("g")).first().g == pytest.approx(1.0)


def test_zero_denominator_and_bands(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert df.select(c.ratio("a", "b").alias("r")).first().r is None
    sizes = spark.createDataFrame([(5e5,), (1e6,), (10e6,), (2e8,), (None,)], "total_assets double")
    assert [r.b for r in sizes.select(p.peer_band().alias("b")).collect()] == [None, "$1B-$10B", "$10B-$100B", ">$100B", None]


def test_business_model_falls_through_nulls(spark):
    df = spark.createDataFrame([(0.1, 0.9, 0.9), (None, 0.3, 0.9), (0.5, None, 0.6), (None, None, None)], "l double, b double, s double")
    found = [r.m for r in df.select(p.business_model(F.col("l"), F.col("b"), F.col("s")).alias("m")).collect()]
    assert found == ["fee_custody", "wholesale_funded", "securities_focused", "traditional_lender"]


def test_merger_flag_stays_null(spark):
    df = spark.createDataFrame([(0.3,), (0.1,), (None,)], "asset_growth_qoq double")
    assert [r.f for r in df.select(p.merger_flag().alias("f")).collect()] == [True, False, None]


def test_assistance_is_no_failure(spark):
    registry = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "cert bigint, bank_name string")
    panel = spark.createDataFrame([(1,), (2,)], "cert bigint")
    failures = spark.createDataFrame([(1, date(2020, 1, 1), "ASSISTANCE", 1.0), (2, date(2019, 1, 1), "FAILURE", 1.0), (2, date(2020, 1, 1), "FAILURE", 2.0), (None, date(2020, 1, 1), "FAILURE", 2.0)], "cert bigint, failure_date date, resolution_type string, assets_at_failure double")
    found = {r.cert: (r.is_failed, r.failure_date) for r in p.dim_entities(registry, panel, failures).collect()}
    assert found == {1: (False, None), 2: (True, date(2020, 1, 1))}


@pytest.fixture(scope="module")
def scored(spark):
    metrics = ["equity_to_assets", "nim_trend_4q"]
    rows = [(k, Q[0], "x", float(v), 1.0 if k < 4 else None) for k, v in enumerate([1, 2, 3, 4, 1000])]
    fact = spark.createDataFrame(rows, "cert bigint, report_date date, peer_band string, equity_to_assets double, nim_trend_4q double")
    return peers.peer_stats(fact, ["cert", "report_date", "peer_band"], metrics, "peer_band")


def test_robust_z_is_clamped_and_null_without_spread(scored):
    z = {(r.cert, r.metric): (r.robust_z, r.robust_z_unclamped) for r in scored.collect()}
    assert z[4, "equity_to_assets"][0] == 5.0 and z[4, "equity_to_assets"][1] > 600
    assert z[0, "nim_trend_4q"] == (None, None)
    assert (4, "nim_trend_4q") not in z
    assert z[2, "equity_to_assets"][0] == 0.0


def test_composite_keeps_rows_without_a_score(scored):
    only = peers.composite(scored.filter("metric = 'nim_trend_4q'"))
    assert {(r.composite_score, r.n_screen_metrics) for r in only.collect()} == {(None, 0)}
    both = {r.cert: r for r in peers.composite(scored).collect()}
    assert both[4].composite_score == -5.0 and both[4].n_screen_metrics == 1


def test_correlation_of_a_constant_is_null(spark):
    rows = [(1.0, float(k), float(-k), 1.0) for k in range(5)]
    df = spark.createDataFrame(rows, "composite_score double, a double, b double, c double")
    found = {(r.metric_x, r.metric_y): r.correlation for r in peers.metric_correlation(df, ["a", "b", "c"]).collect()}
    assert len(found) == 6 and found["a", "b"] == found["b", "a"] == -1.0 and found["a", "c"] is None


def test_equivalence_and_pins(spark):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "cert bigint, composite_score double")
    b = spark.createDataFrame([(1, 0.1 + 1e-12), (2, 0.3)], "cert bigint, composite_score double")
    assert screen.prove_equivalence(a, a, ["cert"]).count() == 0
    assert {(r.cert, r.only_in) for r in screen.prove_equivalence(a, b, ["cert"]).collect()} == {(2, "first"), (2, "second")}


def test_movers_name_the_largest_rise(spark):
    parts = ["p", "q"]
    rows = [(1, Q[0], "x", 1.0, 0.0, None), (1, Q[1], "x", 2.0, 0.5, 3.0), (2, Q[1], "x", 2.0, 0.5, 3.0), (3, Q[0], "x", 1.0, None, None), (3, Q[1], "x", 1.5, None, None)]
    df = spark.createDataFrame(rows, "cert bigint, report_date date, peer_band string, composite_score double, p double, q double")
    found = {r.cert: (r.score_change, r.main_driver) for r in screen.movers(df, parts=parts).collect()}
    assert found == {1: (1.0, "p"), 3: (0.5, None)}


def test_backtest_finds_no_leak(spark, tmp_path):
    from quarterdeck.plans import backtest, bindings

    data = "/root/testdata/sf0.001"
    tables = {"financials": bindings.panel(spark, data), "registry": bindings.registry(spark, data), "failures": bindings.failures(spark, data)}
    out = backtest.run_backtest(spark, tables, bindings.AS_OF, str(tmp_path), {"watched": [1, 2]}, bindings.BANDS)
    assert out["ranked_full"].count() > 0 and {r.label_group for r in out["labeled"].collect()} <= {"watched"}
    pins = out["ranked_full"].select("cert", (F.col("band_rank") + 1).cast("int").alias("band_rank")).limit(1)
    with pytest.raises(backtest.LeakError):
        backtest.run_backtest(spark, tables, bindings.AS_OF, str(tmp_path / "again"), {}, bindings.BANDS, expected=pins)
