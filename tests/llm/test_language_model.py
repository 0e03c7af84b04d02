import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import language_model as lm


def plain(docs, corpus, alpha=0.4):
    one, two = Counter(), Counter()
    for t in corpus:
        w = (t or "").split()
        one.update(w)
        two.update(zip(w, w[1:]))
    n = sum(one.values())
    alone = lambda w: max(one[w], 1) / max(n, 1)
    out = []
    for t in docs:
        w = (t or "").split()
        s = math.log(alone(w[0])) if w else 0.0
        for a, b in zip(w, w[1:]):
            s += math.log(two[a, b] / one[a]) if two[a, b] else math.log(alpha * alone(b))
        out.append((len(w), s))
    return out


def make(n, words, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choices(words, k=rng.choice([0, 1, 2, 3, 30]))) for _ in range(n)]


def check(spark, docs, corpus, **options):
    frame = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = lm.score(frame(docs), None if corpus is None else frame(corpus), orders=2, held_out=False, **options)
    found = {r.doc_id: r for r in out.collect()}
    for k, (n, s) in enumerate(plain(docs, docs if corpus is None else corpus)):
        assert (found[k].n_words, found[k].log_score) == (n, pytest.approx(s, abs=1e-6)), docs[k]
    assert len(found) == len(docs)


@pytest.mark.parametrize("bucket", [16 << 20, 200])
@pytest.mark.parametrize("words", [["a", "b", "c"], [f"w{k}" for k in range(400)]])
def test_own_corpus(spark, words, bucket):
    check(spark, [*make(120, words, 1), None, "a b a b a b"], None, bucket_bytes=bucket, chunk_bytes=1 << 23 if bucket > 200 else 500)


def test_backs_off_outside_the_corpus(spark):
    words = [f"w{k}" for k in range(30)]
    check(spark, [*make(40, [*words, "new", "newer"], 2), "new", "new newer", "w1 new w2"], make(80, words, 3), bucket_bytes=300)


def test_defined_cases(spark):
    df = spark.createDataFrame([(1, "a b", 0), (1, "a b", 0), (2, None, 0), (None, "a", 0)], "doc_id long, text string, chunk int").withColumn("n_words", F.lit("x")).withColumn("id", F.lit("y"))
    out = sorted(((r.doc_id, r.n_words, round(r.log_score, 6)) for r in lm.score(df, orders=2, held_out=False).collect()), key=str)
    c = {"a": 3, "b": 2}
    ab = math.log(c["a"] / 5) + math.log(2 / 3)
    assert out == sorted([(1, 2, round(ab, 6)), (1, 2, round(ab, 6)), (2, 0, 0.0), (None, 1, round(math.log(3 / 5), 6))], key=str)
    assert lm.score(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    docs = ["a b c " * 60_000, "a b c", "x " * 30]
    found = {r.doc_id: (r.n_words, r.log_score) for r in lm.score(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1), chunk_bytes=1000, bucket_bytes=5000).collect()}
    for k, (n, s) in enumerate(plain_held_out(docs, 3)):
        assert found[k] == (n, pytest.approx(s, rel=1e-9)), k


def test_empty_corpus(spark):
    check(spark, ["a b", "a", ""], [])


def plain_held_out(docs, orders, alpha=0.4):
    """Counts over all other texts, and back-off from the longest n-gram down."""
    split = [(t or "").split() for t in docs]
    grams = lambda w: Counter(tuple(w[i : i + m]) for m in range(1, orders + 1) for i in range(len(w) - m + 1))
    every = sum((grams(w) for w in split), Counter())
    out = []
    for w in split:
        c, n, s = every - grams(w), sum(map(len, split)) - len(w), 0.0
        for i in range(len(w)):
            g, factor = tuple(w[max(0, i - orders + 1) : i + 1]), 1.0
            while len(g) > 1 and not c[g]:
                g, factor = g[1:], factor * alpha
            s += math.log(factor * (c[g] / c[g[:-1]] if len(g) > 1 else max(c[g], 1) / max(n, 1)))
        out.append((len(w), s))
    return out


@pytest.mark.parametrize(("orders", "sizes"), [(3, {}), (4, {"chunk_bytes": 300, "bucket_bytes": 200}), (1, {"chunk_bytes": 300})])
def test_held_out_is_brute_force(spark, orders, sizes):
    docs = [*make(80, [f"w{k}" for k in range(12)], 4), *make(20, [f"x{k}" for k in range(500)], 5), None, "", "w1 w1 w1 w1", "only here", "w1 w2 w3", "w1 w2 w3"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_words, r.log_score) for r in lm.score(df, orders=orders, **sizes).collect()}
    assert len(found) == len(docs)
    for k, (n, s) in enumerate(plain_held_out(docs, orders)):
        assert found[k] == (n, pytest.approx(s, abs=1e-6)), docs[k]
    assert lm.score(df.limit(0)).count() == 0


def test_held_out_puts_junk_below_prose(spark):
    prose = ["the cat sat on the mat", "the dog sat on the mat", "a cat sat on the rug", "the dog lay on the rug"]
    df = spark.createDataFrame([*enumerate(prose), (9, "qzx vkw jjp wwq zzk bbv")], "doc_id long, text string")
    a_word = {r.doc_id: r.log_score / r.n_words for r in lm.score(df).collect()}
    assert a_word.pop(9) < min(a_word.values())


def test_both_groupings_read_one_shuffle(spark):
    df = spark.createDataFrame([(k, f"w{k} a b") for k in range(50)], "doc_id long, text string").repartition(4)
    out = lm.score(df, chunk_bytes=60, bucket_bytes=100)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_lookup_and_packing():
    rng = np.random.default_rng(3)
    for n in (1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        asked = rng.choice(keys, 3 * n)
        assert (keys[lm._places(keys, asked)] == asked).all()
    for x in ([], [0, 0], [3, 255], [256], [1 << 20, 1], [1 << 40]):
        assert lm._restored(lm._squeezed(np.array(x, np.int64)), len(x)).tolist() == x


@pytest.mark.parametrize("name", ["op2_stupid_backoff", "op2_stupid_backoff_own_corpus"])
def test_queries_match_sql(spark, name):
    import duckdb

    from quarterdeck.llm import queries

    duckdb.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    expected = {r[0]: tuple(pytest.approx(x, abs=2e-5) for x in r[1:]) for r in duckdb.execute(queries.ORACLES[name]).fetchall()}
    assert {r[0]: tuple(r[1:]) for r in queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()} == expected
