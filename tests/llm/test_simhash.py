import random

import numpy as np
import pytest
import xxhash

from quarterdeck.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(rows):
    """Smallest id reachable over pairs of fingerprints at four bits or fewer."""
    prints = [plain_fingerprint(t) for _, t in rows]
    low = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (prints[a] ^ prints[b]).bit_count() <= 4 and low[b] < low[a]:
                    low[a], changed = low[b], True
    return {(i, f"{p:016x}", k) for (i, _), p, k in zip(rows, prints, low)}


def texts(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.5:
            base = rng.choice(out).split(" ")
            if len(base) > 1 and rng.random() < 0.7:
                base[rng.randrange(len(base))] = rng.choice(words)
            out.append(" ".join(base))
        else:
            out.append(" ".join(rng.choices(words, k=rng.choice([0, 1, 3, 5, 60, 200, 400]))))
    return out


@pytest.mark.parametrize(("leaf", "blocks"), [(4096, 3), (8, 3), (8, 1), (16, 2), (8, 5)])
def test_groups_are_those_of_all_pairs(spark, leaf, blocks):
    rows = list(enumerate(texts(150)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {tuple(r) for r in simhash.near_duplicates(df, leaf_size=leaf, n_blocks=blocks).collect()}
    assert found == plain_groups(rows)


def test_dense_chain_of_fingerprints(spark):
    """A chain of fingerprints two bits apart: one component, through many links."""
    rng = np.random.default_rng(3)
    x, fps = rng.integers(0, 2**63, dtype=np.uint64), []
    for k in range(400):
        x ^= np.uint64(3) << np.uint64(2 * (k % 31))
        fps.append(int(np.int64(x)))
    rows = [(k, fp) for k, fp in enumerate(dict.fromkeys(fps))]
    points = spark.createDataFrame(rows, "node long, fp long")
    for leaf in (16, 4096):
        found = simhash.components(simhash.links(points, leaf_size=leaf)).collect()
        assert {r.component for r in found} == {0} and len(found) == len(rows) - 1


def test_fingerprints_that_agree_on_a_block(monkeypatch):
    """All pairs of fingerprints with one block in common, by few comparisons."""
    rng = np.random.default_rng(7)
    masks = [np.uint64(((1 << min(22, 64 - 22 * k)) - 1) << (22 * k)) for k in range(3)]
    base = rng.integers(0, 1 << 64, 3000, np.uint64)
    near = base[rng.integers(0, 3000, 3000)]
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(22, 64, 3000).astype(np.uint64)
    fps = np.unique(np.concatenate([base, near]) & ~masks[0] | np.uint64(12345))
    compared, count = [0], np.bitwise_count
    every = np.arange(len(fps))
    expected = {(a, b) for a in every.tolist() for b in np.flatnonzero(count(fps ^ fps[a]) <= 4).tolist()}
    monkeypatch.setattr(np, "bitwise_count", lambda x: (compared.__setitem__(0, compared[0] + (x.size if x.ndim == 2 else 0)), count(x))[1])
    found = {(int(a), int(b)) for q, h in simhash._matches(fps, masks, 0, every, every, 1, 4) for a, b in zip(q, h)}
    assert found == expected and len(expected) > 2 * len(fps)
    assert compared[0] < 0.7 * len(fps) ** 2


def test_defined_cases(spark):
    long = "very long text " * 30_000
    rows = [(5, None, "x"), (2, "", "x"), (9, " \t\n", "x"), (1, "One two", None), (7, "ONE  two", "y"), (7, "ONE  two", "y"), (None, "one two", "z"), (None, "nothing like it", "z"), (20, long, "q"), (21, long, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = simhash.near_duplicates(df)
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == len(rows)
    got = sorted(((r.doc_id, r.component_id) for r in out.collect()), key=str)
    assert got == sorted([(5, 2), (2, 2), (9, 2), (1, 1), (7, 1), (7, 1), (None, 1), (None, None), (20, 20), (21, 20)], key=str)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 1, 20, None, None], key=str)
    empty = df.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(3, "a b c d e f"), (3, "a b c d e f"), (4, "x y z u v w q")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == [3, 4]


def test_one_id_with_different_texts_loses_none(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    keep = lambda rows, **o: sorted(((r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), **o).collect()), key=str)
    assert keep([(3, a), (5, a), (5, b)]) == [(3, a), (5, b)]
    assert keep([(5, a), (5, b)]) == [(5, a), (5, b)]
    assert keep([(0, a), (0, b), (0, c), (0, a), (1, b)]) == [(0, a), (0, b), (0, c)]


def test_null_id_copies_leave_one(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    df = spark.createDataFrame([(None, a), (None, a), (7, b), (None, b)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(df, null_ids=True).filter("doc_id IS NOT NULL").collect()) == [(7, b)]
    assert [r.text for r in simhash.keep_one(df, null_ids=True).filter("doc_id IS NULL").collect()] == [a]
    assert simhash.keep_one(df).filter("doc_id IS NULL").count() == 3


def test_survivors_do_not_depend_on_partitions(spark):
    rows = [(k % 4, t, k) for k, t in enumerate(texts(80, 5))]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    once, again = (sorted(map(tuple, simhash.keep_one(df.repartition(n, c)).collect())) for n, c in ((3, "n"), (7, "text")))
    of = {i: k for i, _, k in plain_groups([(k, t) for _, t, k in rows])}
    assert once == again and sorted(of[n] for _, _, n in once) == sorted(set(of.values()))
