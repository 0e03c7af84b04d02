"""Correlations of spans from the co-moments of their quarters."""

import random
from datetime import date

import numpy as np
import pytest

from quarterdeck.operators import peers

QUARTERS = [date(2020 + k // 4, 3 * (k % 4) + 3, 28) for k in range(7)]


def plain(rows, a, b):
    xy = [(r[a], r[b]) for r in rows if r[a] is not None and r[b] is not None]
    if not xy:
        return "none"
    x, y = np.array(xy).T
    return None if x.min() == x.max() or y.min() == y.max() else float(np.corrcoef(x, y)[0, 1])


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_any_span_from_slices(spark, shift):
    """Sparse pairs, constants, a quarter of one row, and values far from zero beside their spread."""
    rng = random.Random(3)
    rows = []
    for q, n in zip(QUARTERS, (40, 1, 25, 60, 2, 33, 0)):
        for _ in range(n):
            x = shift + rng.gauss(0, 1)
            rows.append((q, 1.0, x, None if rng.random() < 0.3 else shift - x / 3 + rng.gauss(0, 1), 0.1))
    rows.append((QUARTERS[6], 1.0, shift, None, 0.1))
    rows.append((QUARTERS[6], None, 1e9, 1e9, 5.0))  # not scored
    names = ["report_date", "composite_score", "a", "b", "c"]
    flags = spark.createDataFrame(rows, "report_date date, composite_score double, a double, b double, c double")
    moments = peers.comoments(flags, ["a", "b", "c"]).cache()
    scored = [dict(zip(names, r)) for r in rows if r[1] is not None]
    for first, last in [(0, 6), (0, 0), (1, 1), (1, 4), (4, 5), (6, 6)]:
        within = [r for r in scored if QUARTERS[first] <= r["report_date"] <= QUARTERS[last]]
        span = moments.filter((moments.report_date >= QUARTERS[first]) & (moments.report_date <= QUARTERS[last]))
        found = {(r.metric_x, r.metric_y): r.correlation for r in peers.correlation_of(span, digits=6).collect()}
        for x, y in (("a", "b"), ("b", "a"), ("a", "c"), ("c", "b")):
            assert found.get((x, y), "none") == pytest.approx(plain(within, x, y), abs=2e-6)


def test_merging_goes_in_any_order(spark):
    flags = spark.range(400).selectExpr("date_add(DATE'2024-01-01', cast(id % 8 AS int)) AS report_date", "1D AS composite_score", "sin(id) AS a", "cos(id * id) + sin(id) AS b")
    moments = peers.comoments(flags, ["a", "b"])
    halves = peers.merged_comoments(moments.selectExpr("*", "dayofmonth(report_date) % 2 AS half"), ["half"])
    at_once, in_steps = peers.correlation_of(moments, digits=9).collect(), peers.correlation_of(halves, digits=9).collect()
    assert sorted(at_once) == sorted(in_steps) and len(at_once) == 2


def test_nothing_scored(spark):
    empty = spark.createDataFrame([], "report_date date, composite_score double, a double, b double")
    assert peers.correlation_of(peers.comoments(empty, ["a", "b"])).collect() == []
