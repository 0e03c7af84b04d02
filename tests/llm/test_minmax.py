import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import minmax


def plain_set(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    return {b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()


def plain(rows):
    """(id, size, smallest id reachable) over all pairs."""
    sets, low = [plain_set(t) for _, t in rows], [i for i, _ in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(len(rows)) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            if low[b] < low[a]:
                low[a], changed = low[b], True
    return sorted((i, len(s), k, i == k) for (i, _), s, k in zip(rows, sets, low))


def family(rng, n, size, most):
    """``n`` edits of one text of ``size`` words, each with up to ``most`` words replaced."""
    base = [f"w{rng.randrange(500)}" for _ in range(size)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(size)] = f"x{rng.randrange(10_000)}"
        yield " ".join(words)


def found(df, **options):
    return sorted(map(tuple, minmax.near_duplicates(df, **options).collect()))


def test_components_are_those_of_all_pairs(spark):
    rng = random.Random(3)
    texts = [t for size, most in ((40, 4), (100, 8), (200, 14), (9, 2), (5, 1), (3, 1)) for t in family(rng, 25, size, most)]
    rows = list(enumerate(rng.sample(texts, len(texts))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = plain(rows)
    assert len({k for *_, k, _ in expected}) < 0.8 * len(rows)
    assert found(df) == expected


@pytest.mark.parametrize("nodes", [1, 3, 16])
def test_large_groups_are_cut_into_blocks(spark, monkeypatch, nodes):
    """Links between texts none of which is near the lead, whatever the blocks."""
    monkeypatch.setattr(minmax, "STAR_NODES", nodes)
    monkeypatch.setattr(minmax, "BLOCK_NODES", nodes)
    rows = list(enumerate(family(random.Random(9), 60, 80, 10)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == plain(rows)


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(5)
    pool = [f"w{k}" for k in range(4000)]
    rates = {"low": [], "high": []}
    for k in range(120):
        words = [pool[i] for i in rng.integers(0, 4000, 150)]
        other = words[:120] + [pool[i] for i in rng.integers(0, 4000, 30)]
        sets, starts = minmax.shingle_sets(pa.array([" ".join(words), " ".join(other)]), 4)
        a, b = set(sets[: starts[1]].tolist()), set(sets[starts[1] :].tolist())
        low, high = minmax.signatures(sets, starts)
        exact = len(a & b) / len(a | b)
        for name, x in (("low", low), ("high", high)):
            rates[name].append((x[:, 0] == x[:, 1]).mean() - exact)
    assert abs(np.mean(rates["low"])) < 0.015 and abs(np.mean(rates["high"])) < 0.015  # unbiased, either half
    both = (np.array(rates["low"]) + np.array(rates["high"])) / 2
    assert both.var() < 0.75 * np.mean([np.var(rates["low"]), np.var(rates["high"])])  # and steadier together


def test_links_at_the_very_bound(spark):
    """Eight of ten shingles link, seven of nine and a bit fewer don't; order and letter case count as they should."""
    words = [f"a{k}" for k in range(12)]
    rows = [(1, " ".join(words[:11])), (2, " ".join([*words[:11], "b", "c"])), (3, " ".join(["z1", *words[:11], "b", "c"])), (4, "one two three"), (5, "ONE\ttwo  Three"), (6, "one two three four"), (7, "three two one")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_defined_cases(spark):
    long = " ".join(f"v{k % 5000}" for k in range(60_000))
    rows = [(5, None), (2, ""), (9, " \t"), (1, "One two"), (7, "ONE  two"), (7, "ONE  two"), (None, "one two"), (None, "nothing else"), (20, long), (21, long + " end"), (22, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("node", "n", "id", "h", "k1", "lead", "component_id", "class", "a.b")})
    out = minmax.near_duplicates(df)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()), key=str)
    expected = [(5, 0, 5, True), (2, 0, 2, True), (9, 0, 9, True), (1, 1, 1, True), (7, 1, 1, False), (7, 1, 1, False), (None, 1, 1, False), (None, 1, None, False)]
    n = len(plain_set(long))
    assert got == sorted([*expected, (20, n, 20, True), (22, n, 20, False), (21, n + 1, 20, False)], key=str)
    assert minmax.near_duplicates(df.limit(0)).count() == 0


def test_no_task_gets_the_pairs_of_a_group(spark):
    """What the confirming rounds deal out follows the group, not its square."""
    dealt = []
    for n in (60, 120):
        rows = list(enumerate(family(random.Random(4), n, 120, 3)))
        df = spark.createDataFrame(rows, "doc_id long, text string")
        nodes = minmax._nodes(minmax.sketches(df)).cache()
        members = minmax._members(nodes)
        dealt.append((nodes.count(), members.filter("node != lead").select("lead", "node").distinct().count()))
    (n1, p1), (n2, p2) = dealt
    assert p1 <= 12 * n1 and p2 <= 2.6 * p1
