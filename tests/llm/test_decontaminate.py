import random
import re

import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(window, len(b))
        grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if b else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found |= {item} - {None}
    return len(w), hit, sorted(found)


@pytest.mark.parametrize("seed", range(6))
def test_scan_is_brute_force(seed):
    rng = random.Random(seed)
    sep = [" ", ", ", "\n", "-", "_"]
    make = lambda n, a: "".join(rng.choice(a) + rng.choice(sep) for _ in range(n))
    for _ in range(40):
        docs = [make(rng.randint(0, 60), ["a", "B", "c", "é", "7"]) for _ in range(6)]
        docs.append(docs[0])
        items = [(f"i{k}", make(rng.randint(0, 7), ["A", "b", "c", "é", "x"])) for k in range(5)]
        phrases = dc.Phrases(items, 4)
        for text, n, spans, found in zip(docs, *dc.scan(docs, phrases)):
            expected = plain(text, items, 4)
            assert (n, {p for b, e in spans for p in range(b, e)}, found) == expected
            assert all(b > a for (_, a), (b, _) in zip(spans, spans[1:]))  # merged


def test_blocks_of_one_shard_and_pruning_are_brute_force():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(12)]
    draw = lambda n: " ".join(rng.choices(vocabulary, k=n))
    for _ in range(30):
        items = [(f"i{k}", draw(rng.choice([0, 1, 2, 5, 9]))) for k in range(6)]
        docs = [" ".join([draw(rng.randint(0, 9)), rng.choice(items)[1], draw(rng.randint(0, 9))]) for _ in range(12)]
        blocks = [dc.Phrases(items[k : k + 2], 5) for k in (0, 2, 4)]
        for text, n, spans, found in zip(docs, *dc.scan(docs, *blocks)):
            assert (n, {p for b, e in spans for p in range(b, e)}, found) == plain(text, items, 5)
            assert all(b > a for (_, a), (b, _) in zip(spans, spans[1:]))
    # Neighbours across two items are no pair, and a window goes when the shard lacks one of its pairs.
    phrases = dc.Phrases([("a", "x y z"), ("b", "q x"), ("c", "y")], 2)
    assert len(phrases.pairs) == 3
    w = {k.decode(): v for k, v in phrases.words.items()}
    only = phrases.possible(phrases.ids[phrases.ids > 0], [phrases.pairs.tolist().index(w["y"] * 5 + w["z"])])
    assert sorted(phrases.ids[b : b + n].tolist() for b, n in zip(phrases.begins[only], phrases.lengths[only])) == sorted([[w["y"], w["z"]], [w["y"]]])


def test_index_finds_every_position():
    import numpy as np

    rng = np.random.default_rng(5)
    runs = [[0, *rng.integers(1, 4, rng.integers(3, 30))] for _ in range(50)]
    text = np.array([x for r in runs for x in r] + [0])
    index = dc.FMIndex(text, 3)
    phrases = dc.Phrases([("a", "1 2 3"), ("b", "2 1"), ("c", "3 3 3"), ("d", "2 1")], 3)
    assert len(index.position) == index.sampled.ones < index.n
    assert phrases.words == {b"1": 1, b"2": 2, b"3": 3} and len(phrases.begins) == 3
    low, high = index.search(phrases)
    for begin, n, a, b in zip(phrases.begins, phrases.lengths, low, high):
        p = phrases.ids[begin : begin + n]
        expected = [i for i in range(len(text) - n + 1) if (text[i : i + n] == p).all()]
        assert expected and sorted(index.locate(np.arange(a, b)).tolist()) == expected


def test_windows_are_distinct_and_know_their_items():
    rng = random.Random(9)
    items = [(None if k == 7 else f"i{k}", " ".join(rng.choices("abc", k=rng.randint(0, 9)))) for k in range(40)]
    phrases = dc.Phrases(items, 3)
    back = {v: k.decode() for k, v in phrases.words.items()}
    found = {}
    for k, (begin, n) in enumerate(zip(phrases.begins, phrases.lengths)):
        window = tuple(back[i] for i in phrases.ids[begin : begin + n].tolist())
        assert window not in found
        found[window] = sorted({phrases.items[o] for o in phrases.owner[phrases.owned[k] : phrases.owned[k + 1]]}, key=str)
    expected = {}
    for item, text in items:
        w = text.split()
        for i in range(max(1, len(w) - 2) if w else 0):
            expected.setdefault(tuple(w[i : i + 3]), set()).add(item)
    assert found == {w: sorted(x, key=str) for w, x in expected.items()}


def test_blocks_and_shards_agree(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([0, 2, 20])))) for k in range(20)]
    docs = [(k, " ".join([*rng.choices(vocabulary, k=30), rng.choice(items)[1]])) for k in range(40)]
    docs += [docs[0], (None, None), (50, ""), (60, "w1 w2 " * 40_000)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_hit", F.lit("clash"))
    b = spark.createDataFrame([*items, (99, None), (None, "w1 w2")], "item_id long, text string")
    whole = dc.contamination(d, b)
    split = dc.contamination(d, b, block_bytes=200, shard_bytes=300)
    key = lambda df: sorted((str(r) for r in df.collect()))
    assert key(whole) == key(split) and whole.columns == [*d.columns, "contamination"]
    for r in whole.collect():
        n, hit, found = plain(r.text, [*((str(i), t) for i, t in items), (None, "w1 w2")], 13)
        assert (r.contamination.n_words, r.contamination.n_hit, r.contamination["items"]) == (n, len(hit), found)
    clean = dc.decontaminate(d, b)
    expected = [(i, t) for i, t in docs if not (lambda n, hit, _: hit and 20 * len(hit) >= n)(*plain(t, [*((str(k), x) for k, x in items), (None, "w1 w2")], 13))]
    assert clean.columns == d.columns and sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(expected, key=str)


def test_empty_tables(spark):
    d, b = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert dc.decontaminate(d, b).count() == 1 and dc.decontaminate(d.limit(0), b).count() == 0
