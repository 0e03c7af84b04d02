import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import orderstats, peers, ranks


def groups(seed, n=2500):
    """Groups of very different shapes: spread, nearly one value, ties around the middle, signs and sizes mixed, few, none."""
    rng = random.Random(seed)
    draw = {
        "spread": lambda: rng.gauss(0, 1e6),
        "tied": lambda: rng.choice([0.0] * 9 + [rng.random()]),
        "halves": lambda: float(rng.randrange(2)),
        "scales": lambda: rng.choice([-1, 1]) * 10.0 ** rng.uniform(-250, 250),
        "steps": lambda: float(rng.randrange(7)),
        None: lambda: rng.random(),
    }
    rows = [(g, draw[g]() if rng.random() < 0.95 else None, rng.expovariate(1)) for g in draw for _ in range(rng.randrange(n - 1, n + 2))]
    return rows + [("one", 3.5, None), ("none", None, None), ("two", 1.0, 2.0), ("two", 4.0, 2.0)]


def plain(rows):
    out = {}
    for g in {r[0] for r in rows}:
        for k, name in ((1, "x"), (2, "y")):
            v = [r[k] for r in rows if r[0] == g and r[k] is not None]
            out[g, name] = (float(np.median(v)) if v else None, len(v))
    return out


@pytest.mark.parametrize("in_memory", [1, 1000, 10**6])
def test_medians_are_exact_however_few_values_are_held(spark, in_memory):
    rows = groups(in_memory)
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(6)
    found = orderstats.medians(df, ["g"], {"x": F.col("x"), "y": F.col("y")}, in_memory).collect()
    got = {(r.g, n): (r[f"{n}_median"], r[f"{n}_count"]) for r in found for n in "xy"}
    expected = plain(rows)
    assert got.keys() == expected.keys()
    for k, (m, n) in expected.items():
        assert got[k][1] == n and (got[k][0] is None if m is None else got[k][0] == pytest.approx(m, rel=1e-15, abs=0)), k


def test_what_is_gathered_stays_within_the_bound(spark):
    """A group of 300,000 distinct values, of which at most 1,000 are ever in one array."""
    df = spark.range(300_000).select(F.lit("a").alias("g"), ((F.col("id") * 7919) % 300_007).cast("double").alias("x"))
    sizes, original = [], F.array_sort
    try:
        F.array_sort = lambda c: (sizes.append(1), original(F.when(F.size(c) > 1000, F.raise_error(F.lit("too many"))).otherwise(c)))[1]
        (row,) = orderstats.medians(df, ["g"], {"x": F.col("x")}, in_memory=1000).collect()
    finally:
        F.array_sort = original
    assert sizes and row.x_median == float(np.median([(k * 7919) % 300_007 for k in range(300_000)]))


def test_peer_scores_refined_and_direct_agree(spark):
    rng = random.Random(2)
    rows = [(k, q, rng.choice(["s", "l", None]), *[rng.gauss(0, 1) if rng.random() < 0.9 else None for _ in range(6)]) for q in ("2020-03-31", "2020-06-30") for k in range(150)]
    df = spark.createDataFrame(rows, "cert bigint, report_date string, peer_band string, " + ", ".join(f"{m} double" for m in peers.SIGNS)).withColumn("report_date", F.to_date("report_date"))
    view = lambda d: sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in d.collect())
    direct, refined = (view(peers.screen_flags(df, in_memory=n)) for n in (10**6, 5))
    long = peers.composite(peers.peer_stats(df, ["cert", "report_date", "peer_band"], list(peers.SIGNS), "peer_band", unclamped=False))
    assert direct == refined == view(long)


def test_no_exchange_of_unpivoted_rows(spark, tmp_path):
    """Only aggregates are shuffled, and wide rows are read where they lie."""
    rows = [(k, "2020-03-31", "s", *[float(k % 7 + m) for m in range(6)]) for k in range(50)]
    spark.createDataFrame(rows, "cert bigint, report_date string, peer_band string, " + ", ".join(f"{m} double" for m in peers.SIGNS)).write.parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    plan = peers.peer_stats(fact, ["cert", "report_date", "peer_band"], list(peers.SIGNS), "peer_band")._jdf.queryExecution().executedPlan().toString()
    generate = plan.index("Generate")
    assert plan.count("Generate") == 1 and "Exchange" not in plan[:generate]


def test_ranks_across_ranges_with_ties(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice("ab"), rng.choice([float(rng.randrange(5)), 0.25, rng.random() * 5, None])) for k in range(700)]
    df = spark.createDataFrame(rows, "id long, band string, v double").repartition(5)
    for n in (2, 16, 300):
        found = {r.id: r for r in ranks.with_ranks(df, "v", {"band": ["band"], "overall": []}, ranges=n).collect()}
        assert len(found) == len(rows)
        for k, band, v in rows:
            for name, mine in (("band", [x for _, b, x in rows if b == band and x is not None]), ("overall", [x for *_, x in rows if x is not None])):
                got = tuple(found[k][f"{name}_{c}"] for c in ("rank", "size", "percentile"))
                assert got == ((None,) * 3 if v is None else (1 + sum(x > v for x in mine), len(mine), pytest.approx(sum(x < v for x in mine) / (len(mine) - 1))))


def test_ranks_of_one_row_and_none(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, band string, v double")
    (r,) = ranks.with_ranks(df, "v", {"x": ["band"]}).collect()
    assert (r.x_rank, r.x_size, r.x_percentile) == (1, 1, 0.0)
    assert ranks.with_ranks(df.limit(0), "v", {"x": []}).collect() == []


def test_no_window_over_a_whole_quarter(spark):
    df = spark.range(100).select(F.col("id"), F.col("id").cast("double").alias("v"))
    plan = ranks.with_ranks(df, "v", {"overall": []})._jdf.queryExecution().executedPlan().toString()
    # Rows are windowed by range; only a few sums of ranges meet in one place.
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_range#" in line or "_sum#" in line for line in windows)


def test_dense_numbers_have_no_gaps_and_do_not_move(spark):
    df = spark.createDataFrame([(f"u{k % 90}",) for k in range(300)] + [(None,)], "u string")
    once, again = ({r.u: r.n for r in ranks.dense_numbers(x, "u", "n", buckets=7).collect()} for x in (df, df.repartition(9)))
    assert once == again and sorted(once.values()) == list(range(90))
