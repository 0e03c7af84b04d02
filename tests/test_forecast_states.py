"""Forecasts kept week by week against fits of whole series."""

import math
import random
from datetime import date, timedelta

import pytest

from quarterdeck.operators import forecast as fc
from quarterdeck.operators import forecast_states as states
from quarterdeck.sources import versioned

MONDAY = date(2010, 1, 4)
WINDOWS = {"step": 4, "min_train": 60, "horizon": 5}
GRIDS = {"ets_damped": [(0.3, 0.05, 0.9), (0.7, 0.1, 0.8), (0.1, 0.3, 0.98)], "arima_drift": [(-0.3, 0.3), (0.6, 0.0), (0.0, 0.0)]}


@pytest.fixture(autouse=True)
def small_grids(monkeypatch):
    for name, grid in GRIDS.items():
        small = states.METHODS[name]._replace(grid=grid)
        monkeypatch.setitem(states.METHODS, name, small)
    return {name: (lambda s, m=m, **w: fc._fitted(s, m, w["horizon"], w["step"], w["min_train"], None)) for name, m in states.METHODS.items()}


def weeks(spark, values, first=0):
    rows = [(s, MONDAY + timedelta(days=7 * (first + k)), float(v)) for s, ys in values.items() for k, v in enumerate(ys)]
    return spark.createDataFrame(rows, "series_id string, obs_date date, value double")


def values(n, seed):
    rng = random.Random(seed)
    return {"ramp": [3.0 * k + rng.gauss(0, 4) for k in range(n)], "wave": [50 + 9 * math.sin(k * math.tau / 52) + k % 3 for k in range(n)]}


def near(rows):
    return {tuple(v for v in r if not isinstance(v, float)): pytest.approx(tuple(v for v in r if isinstance(v, float)), rel=1e-9, abs=1e-9) for r in rows}


def exact(rows):
    return {tuple(v for v in r if not isinstance(v, float)): tuple(v for v in r if isinstance(v, float)) for r in rows}


def test_added_weeks_give_what_a_refit_gives(spark, tmp_path, small_grids):
    """In uneven batches, one of a single week, one given twice, with a series that begins to be long enough on the way."""
    path, ys = str(tmp_path), values(78, 4)
    cuts = [0, 61, 62, 71, 78]
    for a, b in zip(cuts, cuts[1:]):
        batch = weeks(spark, {s: y[a:b] for s, y in ys.items()}, a)
        assert states.refresh(batch, path, **WINDOWS) == 12
    assert states.refresh(batch, path, **WINDOWS) == 0  # given before
    late = {"late": [1.0 + k % 5 for k in range(70)]}
    assert states.refresh(weeks(spark, {"late": late["late"][:59]}, 8), path, **WINDOWS) == 0  # too short for states
    assert states.refresh(weeks(spark, {"late": late["late"][59:]}, 67), path, **WINDOWS) == 6
    whole = weeks(spark, ys).unionByName(weeks(spark, late, 8)).cache()
    scores = fc.evaluate(whole, small_grids, **WINDOWS)
    kept = states.kept_scores(spark, path, **WINDOWS).select(*scores.columns)
    assert exact(kept.collect()) == near(scores.collect())
    pinned = spark.createDataFrame([("ramp", "ets_damped", True), ("wave", "seasonal_naive", True), ("late", "arima_drift", True)], "series_id string, method string, published boolean")
    paths = fc.publish(whole, pinned, small_grids, **WINDOWS).drop("series_title")
    found = states.kept_publish(spark, path, pinned, WINDOWS["horizon"]).select(*paths.columns)
    assert exact(found.collect()) == near(paths.collect()) and found.count() == 15


def test_faulty_weeks_change_nothing(spark, tmp_path):
    path = str(tmp_path)
    states.refresh(weeks(spark, {"a": [1.0] * 61}), path, **WINDOWS)
    before = versioned.latest_entry(spark, f"{path}/weeks")
    for bad, error in ((weeks(spark, {"a": [1.0]}, 62), fc.GridError), (weeks(spark, {"a": [2.0]}, 60), ValueError), (weeks(spark, {"a": [float("nan")]}, 61), fc.GridError)):
        with pytest.raises(error):
            states.refresh(bad, path, **WINDOWS)
    assert versioned.latest_entry(spark, f"{path}/weeks") == before


def test_a_run_that_broke_is_repeated(spark, tmp_path, monkeypatch):
    """Weeks and paths are in, states aren't: the next run takes the same weeks up again."""
    path, ys = str(tmp_path), values(64, 9)
    states.refresh(weeks(spark, {s: y[:60] for s, y in ys.items()}), path, **WINDOWS)
    batch, upsert = weeks(spark, {s: y[60:] for s, y in ys.items()}, 60), versioned.upsert

    def breaks(rows, target, keys, buckets):
        if "states" in target:
            raise OSError("lost")
        return upsert(rows, target, keys, buckets)

    monkeypatch.setattr(versioned, "upsert", breaks)
    with pytest.raises(OSError):
        states.refresh(batch, path, **WINDOWS)
    monkeypatch.setattr(versioned, "upsert", upsert)
    assert states.refresh(batch, path, **WINDOWS) == 12
    whole = weeks(spark, ys)
    for name, method in states.METHODS.items():
        expected = {(r.series_id, r.choice): r.s for r in states.first_states(whole, method, WINDOWS["step"], WINDOWS["min_train"]).collect()}
        assert {(r.series_id, r.choice): r.s for r in versioned.read(spark, f"{path}/states_{name}").collect()} == expected
