"""Sessions from codes against sorted rows and a plain computation."""

import random
from datetime import date, datetime, timedelta, timezone

import pytest

from quarterdeck.operators import product

TEXTS = product.FIRST_KNOWN
SCHEMA = "event_date date, event_ts timestamp, event_name string, user_pseudo_id string, ga_session_id long, ga_session_number long, session_key string, session_engaged long, purchase_revenue_usd double, " + ", ".join(f"{c} string" for c in TEXTS)


def events(rng, n, start, spread):
    out = []
    for _ in range(n):
        u, s = f"u{rng.randrange(5)}", rng.choice([None, 1, 2, 3])
        ts = None if rng.random() < 0.05 else start + timedelta(seconds=rng.randrange(12) * spread)
        texts = [None if rng.random() < 0.5 else rng.choice(["a", "b", "Z", "é", ""]) for _ in TEXTS]
        name = rng.choice([None, "page_view", "purchase", "scroll"])
        out.append((date(2024, 1, 1), ts, name, u, s, rng.choice([None, 1, 2]), f"{u}-{s}", rng.choice([None, 0, 1]), 2.0 if name == "purchase" else None, *texts))
    return out


def first_known(rows, c):
    at = 9 + TEXTS.index(c)
    known = [r for r in rows if r[at] is not None]
    low = datetime.min.replace(tzinfo=timezone.utc)
    order = lambda r: (r[1] is not None, r[1] or low, r[2] is not None, r[2] or "", r[at].encode())
    return min(known, key=order)[at] if known else None


@pytest.mark.parametrize("start,spread", [(2024, 1), (2, 86_400 * 365 * 800)])
def test_codes_find_what_sorting_finds(spark, start, spread):
    """Ties in time, names and times that are null, empty texts, and spans that only a decimal holds."""
    rows = events(random.Random(spread), 500, datetime(start, 1, 1, tzinfo=timezone.utc), spread if start > 2 else 86_400 * 300 * 800)
    df = spark.createDataFrame(rows, SCHEMA)
    coded, plain = product.sessions(df), product.sessions(df, max_codes=0)
    assert coded.dtypes == plain.dtypes
    assert sorted(map(repr, coded.drop("session_start_ts").collect())) == sorted(map(repr, plain.drop("session_start_ts").collect()))
    groups = {}
    for r in rows:
        if r[4] is not None:
            groups.setdefault(r[6], []).append(r)
    found = {r.session_key: r for r in coded.drop("session_start_ts").collect()}
    assert found.keys() == groups.keys()
    for k, mine in groups.items():
        f = {c: first_known(mine, c) for c in TEXTS}
        or_else = lambda c, text: text if f[c] is None else f[c]  # noqa: E731, B023
        assert (found[k].country, found[k].device_category) == (f["country"], f["device_category"])
        assert found[k].session_channel == or_else("event_source", "(direct)") + " / " + or_else("event_medium", "(none)")
        assert found[k].first_touch_channel == or_else("first_touch_source", "(direct)") + " / " + or_else("first_touch_medium", "(none)")


def test_sessions_are_hashed(spark):
    df = spark.createDataFrame(events(random.Random(1), 50, datetime(2024, 1, 1, tzinfo=timezone.utc), 60), SCHEMA)
    plan = product.sessions(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "SortMergeJoin" not in plan


def test_no_events_and_no_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert product.sessions(none).count() == 0
    bare = spark.createDataFrame([(date(2024, 1, 1), None, "scroll", "u", 1, None, "u-1", None, None, *[None] * len(TEXTS))], SCHEMA)
    assert product.sessions(bare).first().session_channel == "(direct) / (none)"
