import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import fingerprints as fp


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def test_collision_rate_is_the_similarity():
    rng = random.Random(1)
    words = [f"w{k}" for k in range(60)]
    pairs = []
    for _ in range(150):
        a = rng.choices(words[:30], k=40)
        b = a[: rng.randrange(41)] + rng.choices(words, k=rng.randrange(40))
        pairs.append((" ".join(a), " ".join(b or ["x"])))
    s = fp.signatures([t for p in pairs for t in p], samples=512)
    got = fp.likeness(s[::2], s[1::2])
    true = np.array([jaccard(a, b) for a, b in pairs])
    assert np.abs(got - true).mean() < 0.03 and abs((got - true).mean()) < 0.01


def test_signatures_do_not_depend_on_the_batch():
    texts = ["one two two", "", "two ONE two", None, "other"]
    whole = fp.signatures(texts)
    assert all((fp.signatures([t])[0] == s).all() for t, s in zip(texts, whole))
    assert (whole[0] == whole[2]).all() and (whole[1] == whole[3]).all() and (whole[1] == 65535).all()
    assert fp.likeness(whole[:1], whole[1:2])[0] == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_rows_and_neighbours(spark, parts):
    rng = random.Random(parts)
    rows = [(i, "".join(rng.choice("ab é🙂") for _ in range(rng.randrange(30)))) for i in rng.sample(range(-500, 5000), 120)]
    rows += [(6000, None), (None, "first"), (7000, "a b c " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [t or "" for _, t in order]
    found = {r.doc_id: r for r in fp.fingerprints(df).collect()}
    assert len(found) == len(rows)
    s = fp.signatures(texts)
    for k, (i, _) in enumerate(order):
        t, nxt = texts[k], texts[(k + 1) % len(texts)]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        r, e = found[i], fp.signatures([edited])[0]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fp.text_of(s[k]), fp.text_of(e))
        assert r.near_next == pytest.approx((s[k] == s[(k + 1) % len(texts)]).mean()) and r.near_edited == pytest.approx((s[k] == e).mean())


def test_small_and_repeated(spark):
    one = spark.createDataFrame([(1, "ab cd")], "doc_id long, text string")
    r = fp.fingerprints(one).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    twice = spark.createDataFrame([(1, "x y"), (1, "x y"), (2, "z")], "doc_id long, text string")
    assert sorted(r.doc_id for r in fp.fingerprints(twice).collect()) == [1, 1, 2]
    same = spark.createDataFrame([(k, "same text here") for k in range(50)], "doc_id long, text string")
    assert {(r.near_next, r.near_edited > 0) for r in fp.fingerprints(same).collect()} == {(1.0, True)}
    assert fp.fingerprints(one.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [7, None])
def test_an_id_of_most_rows_is_split_by_hash(spark, hot):
    df = spark.createDataFrame([(hot if k % 5 else k, f"words {k} {k % 7}") for k in range(400)], "doc_id long, text string").repartition(4)
    ordered = df.withColumn("h", F.xxhash64("text")).orderBy(F.col("doc_id").asc_nulls_first(), "h").collect()
    placed = fp.with_next(df).filter("tail = 0").collect()
    share = Counter(r.bucket for r in placed if r.id == hot)
    assert len(placed) == 400 and len(share) > 5 and max(share.values()) < 100
    found = sorted((str(r.doc_id), r.fingerprint, round(r.near_next, 9)) for r in fp.fingerprints(df).collect())
    s = fp.signatures([r.text for r in ordered])
    assert found == sorted((str(r.doc_id), fp.text_of(s[k]), round(float((s[k] == s[(k + 1) % 400]).mean()), 9)) for k, r in enumerate(ordered))
