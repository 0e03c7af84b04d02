import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every):
    """All products, as whole numbers."""
    v = {}
    for i, x, label in rows:
        if i is not None and label is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            v.setdefault((i, label, tuple(math.floor(256 * float(np.float32(c))) for c in x)), []).append(i)
    all_rows = [(k, n) for k, ids in v.items() for n in range(len(ids))]
    out = []
    for i, label, q in v:
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, p)), j, m != label) for (j, m, p), _ in all_rows if j != i)
        for s, j, _ in [x for x in scores if not x[2]][:5]:
            fit = [(t, k) for t, k, other in scores if other and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k) in enumerate(fit)]
    return sorted(out)


def found(df, every=10, **options):
    return sorted(map(tuple, negatives.hard_negatives(negatives.prepared(df), F.col("id") % every == 0, **options).collect()))


def vectors(rng, n, dims, groups, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    of = [rng.randrange(groups) for _ in range(n)]
    return [(k, [x + rng.gauss(0, spread) for x in centres[g]], g % 4 if rng.random() < 0.7 else rng.randrange(4)) for k, g in enumerate(of)]


@pytest.mark.parametrize(("dims", "groups", "spread", "codewords", "chunk"), [(8, 6, 0.2, 8, None), (5, 3, 1.0, 4, 7), (2, 9, 0.05, 16, 3)])
def test_same_as_all_products(spark, monkeypatch, dims, groups, spread, codewords, chunk):
    monkeypatch.setattr(negatives, "FIRST_ROWS", 20)
    rows = vectors(random.Random(dims), 240, dims, groups, spread)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, codewords=codewords, chunk_rows=chunk) == plain(rows, 10)


def test_heap_visits_all_cells_by_bound_and_bounds_hold():
    rng = np.random.default_rng(1)
    points = np.floor(256 * rng.normal(size=(600, 6)))
    books = [negatives.codebook(points[:, :3], 9), negatives.codebook(points[:, 3:], 9)]
    (i, a), (j, b) = negatives.nearest(points[:, :3], books[0]), negatives.nearest(points[:, 3:], books[1])
    radii = [np.array([max(x[k == c], default=0) for c in range(9)]) for k, x in ((i, a), (j, b))]
    counts = np.zeros((9, 9), np.int64)
    np.add.at(counts, (i, j), 1)
    index = negatives.Index(6, tuple(books), tuple(radii), counts, counts)
    for q in points[:20]:
        seen = list(index.visits(q))
        assert {c for c, *_ in seen} == set(np.flatnonzero(counts.ravel())) and len(seen) == len({c for c, *_ in seen})
        uppers = [u for _, u, _ in seen]
        assert uppers == sorted(uppers, reverse=True)
        scores = points @ q
        for cell, upper, lower in seen:
            held = scores[i * 9 + j == cell]
            assert lower <= held.min() and held.max() <= upper


def test_certified_windows_leave_cells_out(spark, monkeypatch):
    """Clear groups: most cells are never asked for, and nothing is lost."""
    monkeypatch.setattr(negatives, "FIRST_ROWS", 20)
    rows = vectors(random.Random(2), 900, 8, 12, 0.05)
    df = spark.createDataFrame(rows, SCHEMA)
    asked = []
    original = negatives._asked
    monkeypatch.setattr(negatives, "_asked", lambda *a: asked.append(original(*a).cache()) or asked[-1])
    assert found(df, every=30, codewords=12) == plain(rows, 30)
    index = negatives.index(negatives.prepared(df), 12)
    cells, anchors = int((index.counts > 0).sum()), 30
    assert all(a.select("id", "cell").distinct().count() < 0.6 * cells * anchors for a in asked)


def test_common_vector_and_ties(spark):
    rng = random.Random(6)
    rows = vectors(rng, 80, 4, 3, 0.3) + [(k, [0.5, 0.25, -0.125, 1.0], k % 3) for k in range(80, 200)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, chunk_rows=16) == plain(rows, 10)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 1.9], 1), (1, [1.0, 1.9], 1), (2, [1.0, 1.8], 2), (2, [1.0, 1.8], 2), (3, None, 1), (4, [1.0, None], 2), (5, [nan, 1.0], 2), (6, [1.0, inf], 2), (7, [1.0, 1.7], None), (None, [1.0, 1.0], 2), (8, [], 2), (9, [1.0], 2), (10, [-1.0, -1.0], 3), (20, [0.0, 0.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    own = df.withColumns({c: F.lit("own") for c in ("id", "q", "cell", "chunk", "anchor", "windows", "rank", "a.b")})
    assert found(own) == plain(rows, 10) != []
    assert found(df.limit(0)) == []
    far = [(k, [1e18 if k % 2 else 2.0, 1.0], k % 2) for k in range(4)]
    assert all(abs(v) <= 2**63 for r in found(spark.createDataFrame(far, SCHEMA), every=1) for v in r)


def test_small_cells_share_chunks_and_large_ones_have_their_own():
    counts = np.random.default_rng(4).integers(0, 90, (9, 9))
    counts[2, 3], counts[8, 8] = 1000, 101
    first, parts = negatives.chunks(counts, 100)
    held, alone = {}, counts.ravel() > 100
    for n, at, k in zip(counts.ravel(), first, parts):
        assert k == max(1, -(-n // 100)) if n > 100 else k == 1
        for c in range(at, at + k):
            held.setdefault(c, []).append(n / k)
    assert sorted(held) == list(range(len(held))) and len(held) < 45 + 12
    assert all(sum(x) < 200 for x in held.values())
    assert all(len(held[c]) == 1 for at, k in zip(first[alone], parts[alone]) for c in range(at, at + k))


@pytest.mark.parametrize(("groups", "spread", "most"), [(1, 1.0, 1.0), (16, 0.02, 0.6)])
def test_an_anchor_goes_to_a_chunk_once_and_no_task_asks_for_all(spark, monkeypatch, groups, spread, most):
    """Asks grow with chunks, not with cells; they name the cells, and what is left out stays out."""
    for name, value in (("FIRST_ROWS", 100), ("BLOCK_ANCHORS", 9), ("TASK_ANCHORS", 5), ("BATCH_ASKS", 3), ("_SCORES", 500)):
        monkeypatch.setattr(negatives, name, value, raising=False)
    rows, anchors = vectors(random.Random(8), 4200, 6, groups, spread), 42
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    cells = int((negatives.index(negatives.prepared(df)).counts > 0).sum())
    assert cells >= 10
    asked = []
    original = negatives._asked
    monkeypatch.setattr(negatives, "_asked", lambda *a: asked.append(original(*a).cache()) or asked[-1])
    assert found(df, every=100, chunk_rows=1000) == plain(rows, 100)
    assert len(asked) == 4
    for a in asked:
        assert a.count() == a.select("anchor", "chunk").distinct().count() <= anchors * (4200 // 1000 + 1)
        assert all(r["count"] <= 5 * 5 for r in a.groupBy(F.spark_partition_id()).count().collect())
    both = [a.select("id", F.explode("cell")).distinct().count() for a in asked]
    assert all(n <= most * cells * anchors for n in both)


def test_firsts_of_rows_are_those_of_a_sort():
    rng = np.random.default_rng(9)
    s = rng.integers(-4, 4, (30, 40))
    for k, share in ((5, 0.9), (5, 0.05), (60, 0.5)):
        i, j = np.nonzero(rng.random(s.shape) < share)
        cut, fit = negatives.firsts(s.shape, i, j, s[i, j], k)
        for r in range(len(s)):
            order = sorted((-int(s[r, c]), c) for c in j[i == r])[:k]
            got = sorted((-int(s[r, c]), c) for c in j[fit & (i == r)])
            assert got[: len(order)] == order and len(got) < 2 * k
            assert int(cut[r]) == (-order[-1][0] if len(order) == k else -(2**63))


def test_rows_of_one_id_are_dealt_to_chunks(spark):
    rows = vectors(random.Random(3), 80, 4, 3, 0.3) + [(81, [0.5, 0.25, -0.125, 1.0], k % 3) for k in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    assert found(df, chunk_rows=50) == plain(rows, 10)
    held = negatives.index(negatives.prepared(df)).rows.filter("id = 81").groupBy(F.pmod(F.xxhash64("id", "place"), F.lit(8)).alias("chunk")).count().collect()
    assert len(held) == 8 and max(r["count"] for r in held) < 150
