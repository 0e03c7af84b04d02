"""Learned operators: held-out accuracy and defined cases."""

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import langid, quality, queries, sampling, toxicity

DATA = "/root/testdata/sf0.1"


def auc(scores, labels):
    s, y = np.array(scores), np.array(labels)
    return (s[y == 1][:, None] > s[y == 0][None]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None]).mean()


@pytest.mark.parametrize(("name", "label"), [("op8_quality_fm", "quality"), ("op6_toxicity_lexicon", "toxic")])
def test_held_out_scores(spark, name, label):
    out = queries.QUERIES[name](spark, DATA)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert out.count() == queries.table(spark, DATA, "documents").count()
    rows = out.filter("held_out").join(queries.table(spark, DATA, "labels"), "doc_id").collect()
    assert auc([r.score for r in rows], [r[label] for r in rows]) > 0.95
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r[label] for r in rows]) > 0.95


def test_held_out_languages(spark):
    out = queries.QUERIES["op3_naive_bayes_language"](spark, DATA)
    rows = out.filter("held_out").join(queries.table(spark, DATA, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_folds_are_crc32(spark):
    import zlib

    rows = spark.range(50).select("id", sampling.remainder(F.col("id"), 5).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_machine_is_the_pairwise_sum():
    rng = np.random.default_rng(1)
    m = quality.FactorisationMachine(20, 3)
    m.w, m.bias = rng.normal(size=20).astype(np.float32), 0.3
    ids, values = np.array([1, 5, 7, 2]), np.array([0.5, 1.0, -2.0, 3.0], np.float32)
    expected = 0.3 + sum(m.w[i] * x for i, x in zip(ids[:3], values)) + sum(float(m.v[ids[a]] @ m.v[ids[b]]) * values[a] * values[b] for a in range(3) for b in range(a + 1, 3))
    z, _ = m._forward(ids, values, np.array([0, 3, 3, 4]))
    assert z[0] == pytest.approx(expected, rel=1e-4) and z[1] == pytest.approx(0.3) and z[2] == pytest.approx(0.3 + 3 * m.w[2], rel=1e-5)


def test_features_do_not_depend_on_neighbours():
    texts = ["One two two", "", None, "ÀB | c" * 50]
    whole = quality.features(pa.array(texts), [pa.array([1, None, 0, 7])])
    for k, t in enumerate(texts):
        ids, values, _ = quality.features(pa.array([t], pa.string()), [pa.array([[1, None, 0, 7][k]], pa.int64())])
        a, b = whole[2][k], whole[2][k + 1]
        assert sorted(zip(ids, values)) == sorted(zip(whole[0][a:b], whole[1][a:b]))


LONG = "many words in here " * 40_000
ROWS = [(1, None, None), (2, "", 0), (3, "12 34 !!", 8), (4, "Fine text here", 14), (4, "Fine text here", 14), (None, LONG, len(LONG))]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, n_chars long").withColumns({"score": F.lit("clash"), "label": F.lit(1), "lang": F.lit("xx")})


def test_quality_defined_cases(spark, odd):
    labels = spark.createDataFrame([(4, 1), (3, 0), (None, 1), (2, None)], "doc_id long, quality int")
    out = quality.scored(odd, labels, F.lit(True), into="quality_score").collect()
    assert len(out) == len(ROWS) and all(0 <= r.quality_score <= 1 for r in out)
    one_kind = quality.scored(odd, labels.filter("quality = 1"), F.lit(True), into="q")
    scores = [r.q for r in one_kind.collect()]
    assert len(scores) == len(ROWS) and all(0 <= q <= 1 for q in scores) and quality.scored(odd.limit(0), labels, F.lit(True), into="q").count() == 0


def test_language_defined_cases(spark, odd):
    train = spark.createDataFrame([("de", "der die das und"), ("en", "the and of"), (None, "x"), ("fr", None)], "lang string, text string")
    out = {(r.doc_id, r.text): tuple(r.language) for r in langid.identify(odd, train).collect()}
    assert out[1, None] == out[2, ""] == out[3, "12 34 !!"] == ("und", 0.0)
    assert out[4, "Fine text here"][0] in ("de", "en") and out[None, LONG][0] in ("de", "en")
    assert {r.language.lang for r in langid.identify(odd, train.limit(0)).collect()} == {"und"}
    assert langid.identify(odd.limit(0), train).count() == 0


def test_naive_bayes_by_hand():
    texts = ["aab", "ba"]
    grams, bounds, some = langid.buckets(texts, 15)
    model = langid.Model(["x", "y"], np.random.default_rng(0).integers(1, 50, (2, 1 << 15)).astype(float), np.log([0.75, 0.25]))
    names, best, total = model.predict(texts)
    scores = np.exp(best - total)
    for k in range(2):
        log = [np.log(p) + sum(float(model.log_p[l, g[i]]) for g in grams for i in range(bounds[k], bounds[k + 1])) for l, p in enumerate((0.75, 0.25))]
        assert names[k] == "xy"[int(np.argmax(log))]
        assert scores[k] == pytest.approx(1 / (1 + np.exp(min(log) - max(log))), rel=1e-4)


def plain_buckets(text, bits=15):
    """Buckets of the n-grams of a text, one by one."""
    symbols = [ord(c) if c.isalpha() else 32 for c in text.lower()]
    letter = [c.isalpha() for c in text.lower()]
    out = []
    for n in (1, 2, 3):
        for i in range(len(symbols) - n + 1):
            if (letter[i], letter[i] or letter[min(i + 1, len(letter) - 1)], letter[min(i + 1, len(letter) - 1)])[n - 1]:
                h = 0
                for s in symbols[i : i + n]:
                    h = (h * 0x100000001B3 + s) % 2**64
                out.append((h + n - 1) * 0x9E3779B97F4A7C15 % 2**64 >> 64 - bits)
    return out


@pytest.mark.parametrize("block", [1, 2, 256])
def test_naive_bayes_counts_by_hand(spark, block):
    train = [("de", "der Löwe und, die 7 Bäume"), ("de", "und so"), ("en", "the lion and the trees!"), ("fr", "à l'été"), ("xx", "123"), ("en", ""), (None, "lost"), ("fr", None)]
    docs = ["Die Bäume", "the tree", "été", "z", "", None, "7", "und the l'été " * 500]
    seen, counts = Counter(), {}
    for lang, text in train:
        if lang is not None and text is not None:
            seen[lang] += 1
            counts.setdefault(lang, Counter()).update(plain_buckets(text))
    frame = spark.createDataFrame(train, "lang string, text string")
    for model in langid.fit(frame, block_languages=block):
        for row, lang in zip(model.log_p, model.languages):
            expected = np.full(1 << 15, 0.5)
            for b, n in counts[lang].items():
                expected[b] += n
            assert np.allclose(row[:-1], np.log(expected / expected.sum()), atol=1e-5)
    out = {r.text: r.language for r in langid.identify(spark.createDataFrame([(t,) for t in docs], "text string"), frame, block_languages=block).collect()}
    for t in docs:
        grams = plain_buckets(t or "")
        if not grams:
            assert tuple(out[t]) == ("und", 0.0)
            continue
        log = {x: np.log(seen[x] / sum(seen.values())) + sum(np.log((counts[x][g] + 0.5) / (sum(counts[x].values()) + 0.5 * (1 << 15))) for g in grams) for x in seen}
        best = max(sorted(log), key=log.get)
        assert out[t].lang == best
        assert out[t].score == pytest.approx(1 / sum(np.exp(v - log[best]) for v in log.values()), rel=1e-3)


def plain_hits(found, weights, exceptions):
    """Every entry against every word, and every exception at every place."""
    spared = set()
    for phrase in exceptions:
        p = phrase.split()
        for i in range(len(found) - len(p) + 1):
            if found[i : i + len(p)] == p:
                spared.update(range(i, i + len(p)))
    return sorted((e, w) for i, word in enumerate(found) if i not in spared for e, w in weights.items() if (word == e[:-1] if e.endswith("$") else word.startswith(e)))


@pytest.mark.parametrize("seed", range(5))
def test_matcher_is_brute_force(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abc", k=rng.randint(1, 5)))
    weights = {word() + rng.choice(["", "$"]): rng.random() for _ in range(12)}
    exceptions = [" ".join(word() for _ in range(rng.randint(1, 3))) for _ in range(8)]
    lexicon = toxicity.Lexicon(weights, exceptions)
    automaton = lexicon.automaton()
    for n in (0, 1, 2, 7, 300):
        found = [word() for _ in range(n)]
        assert sorted(lexicon.hits(automaton, found)) == plain_hits(found, weights, exceptions)


def test_exceptions_take_linear_time():
    lexicon = toxicity.Lexicon({"trash": 1.0}, ["trash can"])
    automaton, found = lexicon.automaton(), ["trash", "can"] * 100_000
    began = time.time()
    assert lexicon.hits(automaton, [*found, "trash"]) == [("trash", 1.0)] and time.time() - began < 5


def test_fold():
    assert toxicity.words("Ѕtupid 1D10T st​upid") == ["stupid", "idiot", "stupid"]
    assert toxicity.words("2005 été $100 p@thetic ｉｄｉｏｔ 𝓲𝓭𝓲𝓸𝓽 ïdìöt ⓘⓓⓘⓞⓣ") == ["ete", "pathetic", "idiot", "idiot", "idiot", "idiot"]


def test_exceptions_are_mined_from_clean_texts(spark):
    rows = [(k, "you total clown" if k % 2 else "calm day" if k % 10 else f"a clown fish swims by {k}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")), F.lit(True), exceptions=())
    shown = lambda t: lexicon.hits(lexicon.automaton(), toxicity.words(t))
    assert "clown fish" in lexicon.exceptions and "total clown" not in lexicon.exceptions
    assert shown("you total clown") and not any(e.startswith("clown") for e, _ in shown("a clown fish"))


def test_planted_exceptions_are_found_and_noise_is_not(spark):
    rng = random.Random(4)
    common = ["calm", "day", "river", "green", "house", "walk", "music", "light"]
    noise = lambda n: rng.choices(common, k=n)
    spared = ["clown fish", "dirty snow", "the rat", "garbage truck"]
    rows = []
    for k in range(1200):
        if k % 2:
            text = [*noise(4), rng.choice(["clown", "dirty", "rat", "garbage"]), *noise(4)]
        elif k % 16 == 0:
            text = [*noise(3), rng.choice(spared), *noise(3)]
        else:
            text = noise(9)
        rows.append((k, " ".join(text)))
    # Some marked the wrong way round, and one clean text with an insult in five copies.
    rows += [(1201 + 2 * k, "light clown fish day") for k in range(2)] + [(2000 + 2 * k, "music odd garbage walk") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")), F.lit(True))
    assert lexicon.exceptions == tuple(sorted(spared))
    automaton = lexicon.automaton()
    score = lambda t: lexicon.score(np.array([lexicon.density(automaton, toxicity.words(t))]))[0]
    for phrase in spared:
        alone = next(w for w in phrase.split() if w in ("clown", "dirty", "rat", "garbage"))
        assert score(f"a green {phrase} here") < 0.3 < 0.7 < score(f"a green {alone} here")


def test_pairs_of_hits_are_brute_force():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("ab", k=rng.randint(1, 3)))
    for _ in range(50):
        weights = {word() + rng.choice(["", "$"]): 1.0 for _ in range(4)}
        lexicon, found = toxicity.Lexicon(weights), [word() for _ in range(rng.randint(0, 12))]
        held = [{e for e in weights if (w == e[:-1] if e.endswith("$") else w.startswith(e))} for w in found]
        expected = {(e, f"{found[j]} {found[j + 1]}") for j in range(len(found) - 1) for e in held[j] | held[j + 1]}
        assert lexicon.pairs(lexicon.automaton(), found) == expected


def test_exceptions_and_word_bounds():
    lexicon = toxicity.Lexicon({"trash$": 2.0, "vequ": 3.0}, ["trash can"], 1.0, 0.0)
    found = lexicon.automaton()
    hits = lexicon.hits(found, toxicity.words("trash. Trash can! trashy vequelle avequ"))
    assert sorted(hits) == [("trash$", 2.0), ("vequ", 3.0)]
    assert lexicon.hits(found, []) == [] and toxicity.Lexicon({}, []).hits(toxicity.Lexicon({}, []).automaton(), ["a"]) == []


def test_toxicity_defined_cases(spark, odd):
    rows = [(k, f"plain words {k}" + (" awfulword awfulword" if k % 2 else "")) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    lexicon = toxicity.fit(docs, labels, F.lit(True))
    assert lexicon.weights == {"awfulword$": pytest.approx(np.log((200.5 / 101) / (0.5 / 101)))}
    out = {r.text: r.toxicity for r in toxicity.scored(odd.unionByName(spark.createDataFrame([(9, "An AWFULW0RD here")], "doc_id long, text string"), allowMissingColumns=True), lexicon).collect()}
    assert out["An AWFULW0RD here"].score > 0.7 and out["An AWFULW0RD here"].entries == ["awfulword$"]
    assert out[None].score < 0.3 and out[""].score < 0.3 and out[LONG].score < 0.3
    assert toxicity.scored(odd.limit(0), lexicon).count() == 0
    none = toxicity.fit(docs, labels.filter("toxic = 1"), F.lit(True))
    assert none.weights == {} and {round(r.toxicity.score, 3) for r in toxicity.scored(docs, none).collect()} == {0.0}


def test_the_sample_is_the_smallest_hashes(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("y")).unionByName(docs.select("doc_id", F.lit(0).alias("y")))
    every = [r.doc_id for r in docs.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    for bound in (10, 700, 800, 5000):
        found = sampling.labelled(docs, labels, "y", F.lit(True), bound, into="got").collect()
        assert {r.doc_id for r in found} == set(every[:bound]) and all(r.got == r.doc_id % 2 for r in found)
