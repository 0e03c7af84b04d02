"""Days of sessions against whole sessions, and what a query of users by day reads."""

import random
from datetime import datetime, timezone

from quarterdeck.operators import product
from quarterdeck.plans import queries
from tests.test_sessions import SCHEMA, events

DATA = "/root/testdata/sf0.001"


def test_days_are_those_of_sessions(spark):
    """Ids and users that are null, several days in a session."""
    rows = events(random.Random(3), 400, datetime(2024, 1, 1, tzinfo=timezone.utc), 60)
    rows = [(r[0].replace(day=1 + k % 28), *r[1:]) for k, r in enumerate(rows)]
    rows += [(*r[:3], None, *r[4:6], None, *r[7:]) for r in rows[:40]]
    df = spark.createDataFrame(rows, SCHEMA)
    columns = ["user_pseudo_id", "ga_session_id", "session_date"]
    found, whole = (sorted(map(repr, x.select(columns).collect())) for x in (product.session_days(df), product.sessions(df)))
    assert found and found == whole
    assert product.session_days(df.limit(0)).count() == 0


def test_window_users_make_no_codes(spark, monkeypatch):
    known = sorted(map(tuple, queries.QUERIES["g10_window_users"](spark, DATA).collect()))

    def fail(*_):
        raise AssertionError("texts of sessions are not needed")

    monkeypatch.setattr(product, "value_codes", fail)
    assert known and sorted(map(tuple, queries.QUERIES["g10_window_users"](spark, DATA).collect())) == known
