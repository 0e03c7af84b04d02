"""Bucket digests, and comparisons that join no more than they must."""

import random

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import parity, quality, screen

SCHEMA = "k long, g string, x double, s string, l array<int>"


def rows_of(rng, n):
    maybe = lambda v: None if rng.random() < 0.2 else v
    return [(k, maybe(rng.choice("ab")), maybe(rng.choice([0.5, 1.5, float("nan")])), maybe(rng.choice(["", "t", "tt"])), maybe([rng.randrange(3), None])) for k in range(n)]


def key(r):
    return tuple(map(repr, r))


@pytest.mark.parametrize("changed", [0, 1, 7])
@pytest.mark.parametrize("levels", [1, 3])
def test_differences_are_those_of_plain_rows(spark, changed, levels):
    rng = random.Random(10 * changed + levels)
    a = rows_of(rng, 400)
    b = list(a)
    for i in rng.sample(range(len(b)), changed):
        k, g, x, s, values = b[i]
        b[i] = rng.choice([(k, g, 9.0, s, values), (k, g, x, "new", values), (k + 1000, g, x, s, values), (k, g, x, s, [None, 7])])
    rng.shuffle(b)
    found = quality.table_parity(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA).repartition(3), ["k", "g"], levels=levels)
    left, right = {key(r[:2]): key(r[2:]) for r in a}, {key(r[:2]): key(r[2:]) for r in b}
    expected = {k for k in left.keys() | right.keys() if left.get(k) != right.get(k)}
    assert sorted(key((r.k, r.g)) for r in found.collect()) == sorted(expected)


def test_equal_tables_are_not_joined(spark):
    df = spark.createDataFrame(rows_of(random.Random(1), 300), SCHEMA)
    for out in (quality.table_parity(df, df.orderBy(F.desc("k")), ["k"]), screen.prove_equivalence(df.select("k", "x"), df.select("k", "x").repartition(5), ["k"], "x")):
        assert out.count() == 0 and "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_only_differing_buckets_are_kept(spark):
    a = spark.range(20_000).selectExpr("id AS k", "id * 2 AS v")
    b = a.withColumn("v", F.when(F.col("k").isin(5, 77), 0).otherwise(F.col("v")))
    left, right = parity.unequal_rows(a, b, ["k"], ["v"])
    assert 2 <= left.count() == right.count() < 60
    assert {r.k for r in quality.table_parity(a, b, ["k"]).collect()} == {5, 77}


def test_nulls_that_change_places_are_seen(spark):
    a = spark.createDataFrame([(1, "x", None)], "k long, p string, q string")
    b = spark.createDataFrame([(1, None, "x")], "k long, p string, q string")
    assert [r.difference for r in quality.table_parity(a, b, ["k"]).collect()] == ["p,q"]


def test_null_keys_meet(spark):
    a = spark.createDataFrame([(None, 1.0), (2, 2.0)], "k long, v double")
    b = spark.createDataFrame([(None, 1.0), (2, 3.0)], "k long, v double")
    assert [tuple(r) for r in quality.table_parity(a, b, ["k"], levels=1).collect()] == [(2, "v")]


def test_repeated_rows_count(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, 2.0)], "k long, v double")
    out = screen.prove_equivalence(a, a.distinct(), ["k"], "v").collect()
    assert [tuple(r) for r in out] == [(1, 1.0, "first")]


def test_empty_tables_and_other_types(spark):
    a = spark.createDataFrame([(1, 1.0)], "k long, v double")
    assert quality.table_parity(a.limit(0), a.limit(0), ["k"]).count() == 0
    assert [r.difference for r in quality.table_parity(a.limit(0), a, ["k"]).collect()] == ["only in second"]
    assert quality.table_parity(a, a.withColumn("v", F.col("v").cast("int")), ["k"]).count() == 0


def test_a_difference_within_the_tolerance_is_none(spark):
    a = spark.createDataFrame([(1, 1.0), (2, float("inf"))], "k long, v double")
    assert quality.table_parity(a, a.withColumn("v", F.col("v") + 1e-12), ["k"]).count() == 0


def test_levels_add_up(spark):
    tree = parity.digest_tree(spark.range(3000).selectExpr("id AS k", "id % 7 AS v"), ["k"], levels=2).collect()
    for level in (0, 1, 2):
        assert sum(r.rows for r in tree if r.level == level) == 3000
    with pytest.raises(ValueError):
        parity.unequal_rows(spark.range(1), spark.range(1), ["id"], [], levels=0)
