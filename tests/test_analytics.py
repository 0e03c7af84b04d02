import hashlib
import math
import random
from datetime import date, timedelta
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from quarterdeck import schemas
from quarterdeck.functions import columns as c
from quarterdeck.operators import experiment as x
from quarterdeck.operators import forecast as fc
from quarterdeck.operators import product, quality


def event(name, ts, params, user="u1", source=None, revenue=None):
    values = [(k, (v if isinstance(v, str) else None, v if isinstance(v, int) else None, None, None)) for k, v in params]
    return ("20240102", ts, name, user, None, "WEB", values, ("mobile", None, (None,)), ("C", None, None), (source, None, None), (revenue, None))


def test_params(spark):
    rows = [event("a", 1, [("n", "7"), ("s", "x"), ("n", 9)]), event("b", 2, [("n", "1.0")]), event("c", 3, [])]
    df = spark.createDataFrame(rows, schemas.EVENTS)
    p = F.col("event_params")
    found = df.select("event_name", c.param_int(p, "n").alias("n"), c.param_str(p, "s").alias("s")).orderBy("event_name").collect()
    assert [(r.n, r.s) for r in found] == [(7, "x"), (None, None), (None, None)]
    assert [tuple(r) for r in product.repeated_params(df, ["n", "s"]).collect()] == [("n", 1)]


def test_sessions_take_the_first_known_channel(spark):
    rows = [
        event("page_view", 1, [("ga_session_id", 5), ("ga_session_number", 1)]),
        event("view_item", 2, [("ga_session_id", "5"), ("source", "mail")]),
        event("purchase", 3, [("ga_session_id", 5), ("source", "ads"), ("medium", "cpc")], revenue=3.0),
        event("purchase", 4, []),
    ]
    out = product.sessions(product.normalize_events(spark.createDataFrame(rows, schemas.EVENTS))).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.session_key, r.session_channel, r.first_touch_channel, r.purchases, r.revenue_usd, r.engaged, r.is_first_session) == ("u1-5", "mail / cpc", "(direct) / (none)", 1, 3.0, None, True)


@pytest.fixture(scope="module")
def sessions(spark):
    day = lambda k: date(2024, 1, 1) + timedelta(days=k)
    rows = [("a", day(0), 1, 1, 0, 1, 5.0, "x", "y"), ("a", day(8), 0, 0, 0, 0, None, "x", "y"), ("b", day(1), 1, 0, 0, 0, None, "y", "y"), ("c", day(9), 0, 0, 1, 1, 2.0, "z", "x")]
    cols = "user_pseudo_id string, session_date date, items_viewed bigint, carts bigint, checkouts bigint, purchases bigint, revenue_usd double, session_channel string, first_touch_channel string"
    return spark.createDataFrame(rows, cols)


def test_retention(sessions):
    found = {(r.cohort_week.day, r.week_number): (r.cohort_size, r.active_users, r.retention_pct) for r in product.retention(sessions).collect()}
    assert found == {(1, 0): (2, 2, 1.0), (1, 1): (2, 1, 0.5), (8, 0): (1, 1, 1.0)}
    grid = product.retention_grid(product.retention(sessions)).orderBy("cohort_week").collect()
    assert grid[0].w1 == 0.5 and grid[1].w1 is None


def test_funnel_is_closed(sessions):
    rows = product.closed_funnel(sessions).orderBy("week").collect()
    assert [(r.sessions, r.sessions_with_view, r.sessions_with_cart, r.sessions_with_purchase) for r in rows] == [(2, 2, 1, 1), (2, 1, 1, 1)]
    assert quality.funnel_not_monotone(product.closed_funnel(sessions)).count() == 0


def test_attribution_conserves(sessions):
    a = product.attribution(sessions)
    assert quality.attribution_not_conserved(a).count() == 0
    assert quality.attribution_not_conserved(a.withColumn("last_touch_purchases", F.col("last_touch_purchases") + 1)).count() == 1
    assert {r.channel: (r.first_touch_purchases, r.last_touch_purchases) for r in a.collect()} == {"x": (1, 1), "y": (1, 0), "z": (0, 1)}


NORMAL = NormalDist()


def needed(p, mde, alpha, power):
    q, mean = p * (1 + mde), p * (1 + mde / 2)
    root = NORMAL.inv_cdf(1 - alpha / 2) * math.sqrt(2 * mean * (1 - mean)) + NORMAL.inv_cdf(power) * math.sqrt(p * (1 - p) + q * (1 - q))
    return math.ceil((root / (p * mde)) ** 2)


def test_required_n(spark):
    rates = [0.001, 0.016357, 0.05, 0.1, 0.37, 0.6]
    df = spark.createDataFrame([(p,) for p in rates], "p double").coalesce(1)
    for mde, alpha, power in ((0.2, 0.05, 0.8), (0.5, 0.01, 0.9), (-0.3, 0.1, 0.5)):
        found = {r.p: r.n for r in df.select("p", x.required_n_per_arm("p", mde, alpha, power).alias("n")).collect()}
        assert found == {p: needed(p, mde, alpha, power) for p in rates}
    published = {r.p: r.n for r in df.select("p", x.required_n_per_arm("p").alias("n")).collect()}
    assert (published[0.1], published[0.016357]) == (3841, 25916)


@pytest.mark.parametrize("p", [-0.2, 0.0, 0.84, 1.0])
def test_required_n_needs_rates(spark, p):
    with pytest.raises(Exception, match="between 0 and 1"):
        spark.createDataFrame([(p,)], "p double").select(x.required_n_per_arm("p")).collect()


ARMS = "n_control bigint, conversions_control bigint, n_treatment bigint, conversions_treatment bigint"


def test_z_is_the_root_of_pearsons_chi_square(spark):
    rng = random.Random(11)
    rows = [(n, rng.randint(1, n - 1), m, rng.randint(1, m - 1)) for n, m in ((rng.randint(2, 900), rng.randint(2, 900)) for _ in range(60))]
    rows += [(40, 10, 80, 20), (0, 0, 5, 1), (5, 0, 5, 0)]
    out = spark.createDataFrame(rows, ARMS).withColumn("z", x.two_proportion_z()).withColumn("p", x.two_sided_p("z")).collect()
    for r in out[:-2]:
        table = [[r.conversions_control, r.n_control - r.conversions_control], [r.conversions_treatment, r.n_treatment - r.conversions_treatment]]
        total = r.n_control + r.n_treatment
        chi = sum((table[i][j] - (e := sum(table[i]) * (table[0][j] + table[1][j]) / total)) ** 2 / e for i in range(2) for j in range(2))
        assert r.z**2 == pytest.approx(chi, abs=1e-9)
        assert math.copysign(1, r.z) == math.copysign(1, r.conversions_treatment / r.n_treatment - r.conversions_control / r.n_control) or abs(r.z) < 1e-12
        assert r.p == pytest.approx(2 * NORMAL.cdf(-abs(r.z)), abs=1e-12)
    assert [(r.z, r.p) for r in out[-2:]] == [(None, None), (None, None)]


@pytest.mark.parametrize("share", [0.5, 0.7])
def test_sample_ratio(spark, share):
    rows = [(int(1000 * share) + k, 0, 1000 - int(1000 * share) - k, 0) for k in (-60, -7, 0, 7, 60)]
    found = spark.createDataFrame(rows, ARMS).coalesce(1).withColumn("c", x.srm_chi2(share=share)).withColumn("p", x.two_sided_p(F.sqrt("c"))).collect()
    for r, k in zip(found, (-60, -7, 0, 7, 60)):
        assert r.c == pytest.approx(k * k / (1000 * share * (1 - share)))
        assert r.p == pytest.approx(2 * NORMAL.cdf(-math.sqrt(r.c))) and (r.p < x.SRM_ALPHA) == (abs(k) == 60)


def drawn(user, seed):
    return int(hashlib.md5(f"{user}:{seed}".encode()).hexdigest()[:8], 16) / 2**32


def people(n, seed=0):
    rng = random.Random(seed)
    return [(f"p{k}", "treatment" if rng.random() < 0.6 else "control", rng.random() < 0.15, "ab"[k % 2]) for k in range(n)]


USERS = "user_id string, arm string, converted boolean, test string"


@pytest.mark.parametrize("by", [[], ["test"]])
def test_injected_lift_is_the_hash_rule(spark, by):
    rows = people(900)
    df = spark.createDataFrame(rows, USERS)
    for lift in (0.0, 0.35, 2.0):
        found = {r.user_id: r.converted for r in x.inject_lift(df.repartition(5), lift, 3, by=by).collect()}
        for group in ("a", "b"):
            mine = [r for r in rows if r[1] == "treatment" and (not by or r[3] == group)]
            c = sum(r[2] for r in mine)
            share = c * lift / (len(mine) - c)
            assert all(found[u] == (done or (arm == "treatment" and drawn(u, 3) < share)) for u, arm, done, g in rows if not by or g == group)


@pytest.mark.parametrize(("rate", "lift"), [(0.2, -0.1), (0.6, 0.9), (1.0, 0.1), (1.0, 0.0)])
def test_lifts_out_of_reach(spark, rate, lift):
    rows = [(str(k), "treatment", k < 50 * rate, "a") for k in range(50)]
    with pytest.raises(Exception, match="out of reach"):
        x.inject_lift(spark.createDataFrame(rows, USERS), lift, 1).collect()


def test_readout_by_hand(spark):
    rows = people(700, 5)
    found = {r.test: r for r in x.experiment_readout(spark.createDataFrame(rows, USERS), ["test"], injected=0.5, seed=9).collect()}
    for group in ("a", "b"):
        arm = {a: [r for r in rows if r[3] == group and r[1] == a] for a in ("control", "treatment")}
        n, c = ({a: f(v) for a, v in arm.items()} for f in (len, lambda v: sum(r[2] for r in v)))
        rate = sum(c.values()) / sum(n.values())
        share = c["treatment"] * 0.5 / (n["treatment"] - c["treatment"])
        lifted = sum(r[2] or drawn(r[0], 9) < share for r in arm["treatment"])

        def z(treated):
            q = (c["control"] + treated) / sum(n.values())
            return (treated / n["treatment"] - c["control"] / n["control"]) / math.sqrt(q * (1 - q) * (1 / n["control"] + 1 / n["treatment"]))

        r = found[group]
        assert (r.n_control, r.conversions_control, r.n_treatment, r.conversions_treatment, r.lifted_conversions) == (n["control"], c["control"], n["treatment"], c["treatment"], lifted)
        assert (r.rate_pooled, r.z, r.lifted_z) == pytest.approx((rate, z(c["treatment"]), z(lifted)))
        assert (r.p_value, r.lifted_p) == pytest.approx((2 * NORMAL.cdf(-abs(r.z)), 2 * NORMAL.cdf(-abs(r.lifted_z))))
        assert r.required_n == needed(rate, 0.2, 0.05, 0.8) and r.powered == (min(n.values()) >= r.required_n) and r.significant == (r.p_value < 0.05)
    whole = x.experiment_readout(spark.createDataFrame(rows, USERS)).collect()
    assert len(whole) == 1 and whole[0].n_control == sum(r[1] == "control" for r in rows) and "lifted_z" not in whole[0]


def series(spark, values, name="s", start=date(2011, 4, 4)):
    return spark.createDataFrame([(name, start + timedelta(days=7 * k), None if v is None else float(v)) for k, v in enumerate(values)], "series_id string, obs_date date, value double")


def noise(n, seed, trend=0.0, season=0.0):
    rng = random.Random(seed)
    return [50 + trend * k + season * math.sin(k * math.tau / 52) + rng.gauss(0, 1) for k in range(n)]


@pytest.mark.parametrize(("n", "horizon", "season"), [(6, 3, 6), (17, 5, 5), (17, 9, 4)])
def test_seasonal_naive_looks_one_season_back(spark, n, horizon, season):
    y = noise(n, n)
    found = {r.k: r.point for r in fc.seasonal_naive(series(spark, y), horizon, season).collect()}
    assert found == {k: y[n - season + k - 1] for k in range(1, min(horizon, season) + 1)}
    with pytest.raises(ValueError, match="shorter than a season"):
        fc.seasonal_naive(series(spark, y[: season - 1]), horizon, season)


def test_errors_by_hand(spark):
    rng = random.Random(2)
    pairs = [(rng.choice([0.0, rng.uniform(-9, 9)]), rng.choice([0.0, rng.uniform(-9, 9)])) for _ in range(40)]
    df = spark.createDataFrame([("s", "m", k // 8, a, p) for k, (a, p) in enumerate(pairs)], "series_id string, method string, origin int, actual double, point double")
    r = fc.accuracy(df).first()
    relative = [abs(p - a) / abs(a) for a, p in pairs if a]
    assert r.mape == pytest.approx(100 * sum(relative) / len(relative))
    assert r.smape == pytest.approx(100 * sum(2 * abs(p - a) / (abs(p) + abs(a)) if a or p else 0.0 for a, p in pairs) / 40)
    assert (r.n_errors, r.n_origins) == (40, 5)


@pytest.mark.parametrize(("n", "horizon", "step", "min_train"), [(8, 3, 1, 5), (23, 3, 2, 5), (24, 4, 7, 9)])
def test_origins_by_hand(spark, n, horizon, step, min_train):
    y, windows = noise(n, 1), {"horizon": horizon, "step": step, "min_train": min_train}
    both = series(spark, y).unionByName(series(spark, y[1:] + [7.0, 7.0], "t"))
    found = {(r.series_id, r.origin, r.k): r.actual for r in fc.rolling_origins(both, **windows).collect()}
    assert found == {(name, o, k): v[o + k - 1] for name, v in (("s", y), ("t", y[1:] + [7.0, 7.0])) for o in range(min_train, len(v) - horizon + 1, step) for k in range(1, horizon + 1)}
    with pytest.raises(ValueError, match="no origin"):
        fc.rolling_origins(both.filter("value <> 7").unionByName(series(spark, y[: min_train + horizon - 1], "u")), **windows)


@pytest.mark.parametrize(
    ("errors", "winner"),
    [
        ({"seasonal_naive": 3.0, "a": 3.0, "b": 3.5}, "seasonal_naive"),
        ({"seasonal_naive": 3.0, "b": 2.9, "a": 2.9}, "a"),
        ({"seasonal_naive": 3.0, "a": None, "b": 4.0}, "seasonal_naive"),
        ({"seasonal_naive": 3.0, "a": math.nan}, "seasonal_naive"),
        ({"seasonal_naive": None, "a": None}, "seasonal_naive"),
    ],
)
def test_only_a_strictly_better_method_wins(spark, errors, winner):
    df = spark.createDataFrame([("s", m, v) for m, v in errors.items()], "series_id string, method string, smape double")
    assert [r.method for r in fc.select_method(df).filter("published").collect()] == [winner]


def test_guards(spark):
    y = noise(130, 4)
    good = series(spark, y)
    assert fc.guarded(good, ["s"]).count() == 130
    gap, twice = good.filter("obs_date <> DATE'2012-05-07'"), good.unionByName(good.limit(1))
    for bad, error in ((gap, fc.GridError), (twice, fc.GridError), (series(spark, [*y, None]), fc.GridError), (series(spark, [*y, math.nan]), fc.GridError), (good.unionByName(series(spark, y, "new")), ValueError), (good.withColumn("series_id", F.lit("new")), ValueError)):
        for call in (lambda df: fc.evaluate(df, {}, ["s"]), lambda df: fc.publish(df, None, {}, ["s"])):
            with pytest.raises(error):
                call(bad)


def smoothed(y, min_train, alpha, beta, phi):
    """Level, trend and squared error after each number of values."""
    level, trend, e = y[0], (y[min_train - 1] - y[0]) / (min_train - 1), 0.0
    out = [(level, trend, e)]
    for v in y:
        guess = level + phi * trend
        level, trend, e = guess + alpha * (v - guess), phi * trend + beta * (v - guess), e + (v - guess) ** 2
        out.append((level, trend, e))
    return out


def differenced(y, min_train, phi, theta):
    """Last difference, last shock and squared error after each number of values from 1 on."""
    m, d, a, e = (y[min_train - 1] - y[0]) / (min_train - 1), 0.0, 0.0, 0.0
    out = [None, (d, a, e)]
    for before, v in zip(y, y[1:]):
        now = v - before - m
        d, a = now, now - phi * d - theta * a
        e += a * a
        out.append((d, a, e))
    return out


WINDOWS = {"horizon": 3, "step": 2, "min_train": 6}


def test_ets_by_brute_force(spark):
    y, grid = noise(15, 8, 0.7), [(a, b, p) for a in (0.2, 0.6) for b in (0.05, 0.3) for p in (0.8, 0.95)]
    found = {(r.origin, r.k): (r.point, r.sigma) for r in fc.ets_damped(series(spark, y), grid=grid, **WINDOWS).collect()}
    expected = {}
    for o in (6, 8, 10, 12, 15):
        (alpha, beta, phi), (level, trend, e) = min(((g, smoothed(y, 6, *g)[o]) for g in grid), key=lambda x: x[1][2])
        for k in (1, 2, 3):
            weights = 1 + sum((alpha + beta * sum(phi**i for i in range(1, j + 1))) ** 2 for j in range(1, k))
            expected[o, k] = pytest.approx((level + trend * sum(phi**i for i in range(1, k + 1)), math.sqrt(e / o * weights)))
    assert found == expected


def test_arima_by_brute_force(spark):
    y, grid = noise(15, 9, -0.4), [(p, t) for p in (-0.5, 0.0, 0.4) for t in (-0.3, 0.0, 0.5)]
    found = {(r.origin, r.k): (r.point, r.sigma) for r in fc.arima_drift(series(spark, y), grid=grid, **WINDOWS).collect()}
    expected, m = {}, (y[5] - y[0]) / 5
    for o in (6, 8, 10, 12, 15):
        (phi, theta), (d, a, e) = min(((g, differenced(y, 6, *g)[o]) for g in grid), key=lambda x: x[1][2])
        point, variance, step = y[o - 1], 0.0, phi * d + theta * a
        for k in (1, 2, 3):
            point, step = point + m + step, phi * step
            psi = 1 + sum((phi + theta) * phi**i for i in range(k - 1))
            variance += psi**2
            expected[o, k] = pytest.approx((point, math.sqrt(e / o * variance)))
    assert found == expected


def test_publishing(spark):
    ramp, wave = noise(140, 5, trend=3.0), [100 + 30 * math.sin(k * math.tau / 52) + k % 3 for k in range(156)]
    both = series(spark, ramp, "ramp").unionByName(series(spark, wave, "wave"))
    scores = fc.evaluate(both)
    told = {(r.series_id, r.method): r for r in scores.collect()}
    assert {m for (s, m), r in told.items() if r.published and s == "ramp"} <= {"ets_damped", "arima_drift"}
    assert {s: r.n_origins for (s, m), r in told.items()} == {"ramp": 7, "wave": 11}
    paths = fc.publish(both, scores, expected=["ramp", "wave"]).orderBy("series_id", "obs_date").collect()
    assert len(paths) == 24 and all(r.lower < r.upper for r in paths)
    assert [r.obs_date for r in paths[:12]] == [date(2011, 4, 4) + timedelta(days=7 * k) for k in range(140, 152)]
    assert paths[11].point == pytest.approx(50 + 3 * 151, abs=8)


def test_checks(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 2.0), (None, 0.1)], "k int, v double")
    assert [tuple(r) for r in quality.not_unique(df, ["k"]).collect()] == [(1, 2)]
    assert quality.nulls(df, ["k"]).count() == 1 and quality.out_of_range(df, "v", -0.5, 1).count() == 1
    assert quality.orphans(df, spark.createDataFrame([(2,)], "k int"), "k").count() == 2
    a = spark.createDataFrame([(1, 1.0, "x"), (2, None, "y"), (3, 3.0, "z")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.0 + 1e-12, "x"), (2, None, "other"), (4, 3.0, "z")], "k int, v double, s string")
    assert {r.k: r.difference for r in quality.table_parity(a, b, ["k"]).collect()} == {2: "s", 3: "only in first", 4: "only in second"}
