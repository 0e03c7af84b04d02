import random
from datetime import date, timedelta

import pytest

from quarterdeck.operators import product, user_sets


def visits(rng, n, users, days, start=date(2019, 12, 20)):
    return [(None if rng.random() < 0.02 else f"u{rng.randrange(users)}", start + timedelta(days=rng.randrange(days))) for _ in range(n)]


@pytest.mark.parametrize("users", [5, 700])
def test_users_of_any_span(spark, users):
    rng = random.Random(users)
    rows = visits(rng, 1500, users, 40)
    s = spark.createDataFrame(rows, "user_pseudo_id string, session_date date")
    sets = user_sets.user_sets(s, user_sets.user_numbers(s), {"date": s.session_date})
    spans = [(k, first, first + timedelta(days=rng.randrange(20))) for k in range(12) for first in [date(2019, 12, 15) + timedelta(days=rng.randrange(45))]]
    found = {r.span: r.users for r in user_sets.users_of_spans(sets, spark.createDataFrame(spans, "span long, first date, last date")).collect()}
    for k, first, last in spans:
        assert found.get(k, 0) == len({u for u, d in rows if u and first <= d <= last})


def test_sets_of_more_than_one_block(spark):
    s = spark.range(70_000).selectExpr("concat('u', id) AS user_pseudo_id", "date_add(DATE'2024-01-01', cast(id % 3 AS int)) AS session_date")
    sets = user_sets.user_sets(s, user_sets.user_numbers(s), {"date": s.session_date})
    assert sets.select("block").distinct().count() == 3
    assert user_sets.distinct_users(sets, []).first().users == 70_000
    assert {r.users for r in user_sets.distinct_users(sets, ["date"]).collect()} == {23_333, 23_334}


@pytest.mark.parametrize("days", [60, 1500])
def test_retention_is_that_of_plain_sets(spark, days):
    """Histories of any length, sparse and dense, before the first Monday too."""
    rng = random.Random(days)
    rows = [(u, d) for u, d in visits(rng, 900, 80, days, date(1969, 6, 1) if days > 100 else date(2024, 1, 3)) if u]
    monday = lambda d: d - timedelta(days=d.weekday())
    active = {(u, monday(d)) for u, d in rows}
    first = {u: min(w for v, w in active if v == u) for u, _ in rows}
    expected = {}
    for u, w in active:
        k = (w - first[u]).days // 7
        if k <= 12:
            expected[first[u], k] = expected.get((first[u], k), 0) + 1
    df = spark.createDataFrame(rows, "user_pseudo_id string, session_date date")
    out = product.retention(df)
    assert {(r.cohort_week, r.week_number): r.active_users for r in out.collect()} == expected
    assert all(r.cohort_size == expected[r.cohort_week, 0] for r in out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan
    with pytest.raises(ValueError):
        product.retention(df, 31)
