import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import changes
from quarterdeck.operators import panel as p
from quarterdeck.sources import versioned

SCHEMA = "id bigint, day date, v double, note string"


def rows(df):
    return sorted(map(tuple, df.collect()))


def batch(spark, keys, v, note="x"):
    return spark.createDataFrame([(k, date(2020, 1, 1 + k % 28), float(v), note) for k in keys], SCHEMA)


def test_upserts_equal_a_dictionary(spark, tmp_path):
    rng, path, held = random.Random(1), f"{tmp_path}/t", {}
    for turn in range(4):
        keys = rng.sample(range(60), 25)
        assert versioned.upsert(batch(spark, keys, turn), path, ["id", "day"], buckets=4) == 25
        held |= {(k, date(2020, 1, 1 + k % 28)): (k, date(2020, 1, 1 + k % 28), float(turn), "x") for k in keys}
        assert rows(versioned.read(spark, path)) == sorted(held.values())
    assert versioned.upsert(batch(spark, [], 9), path, ["id", "day"]) == 0 and rows(versioned.read(spark, path)) == sorted(held.values())
    # Only the versions that are kept are on disk.
    assert sum(n.startswith("v") for n in os.listdir(path)) == versioned.KEPT


def test_held_version_is_not_shuffled(spark, tmp_path):
    path = f"{tmp_path}/t"
    versioned.upsert(batch(spark, range(500), 1), path, ["id"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = versioned.read(spark, path)
        plan = versioned.merged(held, batch(spark, range(300, 700), 2), ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    above = plan[: plan.index("FileScan")]
    assert above.rfind("Exchange") < above.rfind("SortMergeJoin")  # the shuffle is the batch's


@pytest.mark.parametrize("keys", [[1, 2, 2], [None, 3]])
def test_faulty_batches_commit_nothing(spark, tmp_path, keys):
    path = f"{tmp_path}/t"
    versioned.upsert(batch(spark, [1, 5], 0), path, ["id"], buckets=2)
    before = rows(versioned.read(spark, path))
    bad = spark.createDataFrame([(k, None, 1.0, "y") for k in keys], SCHEMA)
    with pytest.raises(ValueError, match="1 (duplicate|null) key"):
        versioned.upsert(bad, path, ["id"])
    with pytest.raises(ValueError, match="missing"):
        versioned.upsert(bad.drop("id"), path, ["id"])
    assert rows(versioned.read(spark, path)) == before and sum(n.startswith("v") for n in os.listdir(path)) == 1


def test_a_failure_at_any_step_leaves_the_version_in_force(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    versioned.upsert(batch(spark, range(9), 0), path, ["id"], buckets=2)
    before = rows(versioned.read(spark, path))
    broken = batch(spark, range(5, 20), 1).withColumn("v", F.when(F.col("id") == 12, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):  # while it is written
        versioned.upsert(broken, path, ["id"])
    assert rows(versioned.read(spark, path)) == before
    with monkeypatch.context() as m:  # before the pointer moves
        m.setattr(versioned, "_commit", lambda *a: (_ for _ in ()).throw(OSError("no commit")))
        with pytest.raises(OSError):
            versioned.upsert(batch(spark, range(5, 20), 1), path, ["id"])
    assert rows(versioned.read(spark, path)) == before
    number = versioned.latest_entry(spark, path)[0]
    with monkeypatch.context() as m:  # another writer was faster
        original = versioned._commit
        m.setattr(versioned, "_commit", lambda s, f, n, e: (original(s, f, n, versioned.latest_entry(s, f)[1]), original(s, f, n, e)))
        with pytest.raises(versioned.CommitConflict):
            versioned.upsert(batch(spark, range(5, 20), 1), path, ["id"])
    assert versioned.latest_entry(spark, path)[0] == number + 1 and rows(versioned.read(spark, path)) == before
    open(f"{path}/_commits/{number + 2:012d}", "w").close()  # a writer that died in the act
    assert rows(versioned.read(spark, path)) == before


def test_batch_is_read_once(spark, tmp_path):
    path, seen = f"{tmp_path}/t", spark.sparkContext.accumulator(0)
    versioned.upsert(batch(spark, range(9), 0), path, ["id"], buckets=2)

    def tell(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    versioned.upsert(batch(spark, range(5, 45), 1).mapInArrow(tell, SCHEMA), path, ["id"])
    assert seen.value == 40


def test_ensure_makes_a_typed_table_once(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert versioned.read(spark, f"{tmp_path}/t") is None
    made = versioned.ensure(spark, f"{tmp_path}/t", schema, ["id"], 2)
    assert made.schema.simpleString() == schema.simpleString() and made.count() == 0
    versioned.upsert(batch(spark, [3], 1), f"{tmp_path}/t", ["id"])
    assert versioned.ensure(spark, f"{tmp_path}/t", schema, ["id"]).count() == 1


PANEL = "cert bigint, report_date date, total_assets double, total_deposits double, equity double, net_loans_leases double, securities double, brokered_deposits double, uninsured_deposits_est double, net_interest_margin_pct double"


def panel(rng, n=12, quarters=22):
    ends = [date(2010 + k // 4, (3, 6, 9, 12)[k % 4], (31, 30, 30, 31)[k % 4]) for k in range(quarters)]
    return {(c, d): (c, d, *[rng.choice([0.0, None, *[rng.uniform(1, 9) * 1e6] * 12]) for _ in range(8)]) for c in range(n) for d in ends if rng.random() < 0.85}


def test_change_sets_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(5)
    source = panel(rng)
    registry = spark.createDataFrame([(c,) for c in range(11)], "cert bigint")
    frame = lambda s: spark.createDataFrame(list(s.values()), PANEL)
    build = lambda df: p.build_fact(df, registry)
    view = lambda df: sorted(tuple(str(x) for x in r) for r in df.select(sorted(df.columns)).collect())
    first = changes.maintain(frame(source), str(tmp_path), build, buckets=2)
    assert first["changed"] == len(source)
    again = changes.maintain(frame(source), str(tmp_path), build, buckets=2)
    assert again == {"changed": 0, "gone": 0, "read": 0, "written": 0}
    for turn in range(2):
        fresh = panel(rng)
        picked = rng.sample(sorted(source), 4)
        for k in picked[:2]:
            source[k] = (*k, *[rng.uniform(1, 9) * 1e6 for _ in range(8)])
        del source[picked[2]], source[picked[3]]
        new = next(k for k in fresh if k not in source)
        source[new] = fresh[new]
        done = changes.maintain(frame(source), str(tmp_path), build, buckets=2)
        assert done["gone"] == 2 - (new in picked[2:]) and done["written"] < done["read"] < 0.8 * len(source)
        assert view(versioned.read(spark, f"{tmp_path}/fact")) == view(build(frame(source)))


def test_a_batch_found_empty_while_planning(spark, tmp_path):
    """A join that adaptive planning finds empty takes the observation with it."""
    path = str(tmp_path / "t")
    some = spark.range(4).selectExpr("id AS k", "id AS v")
    versioned.upsert(some, path, ["k"], 4)
    before = versioned.latest_entry(spark, path)
    other = spark.range(100, 104, 1, 2).selectExpr("id AS k").filter("rand(1) > 2")
    assert versioned.upsert(some.join(other.repartition(3), "k"), path, ["k"]) == 0
    assert versioned.latest_entry(spark, path) == before
