"""Every operator and stage on a table that holds the names the operators use themselves, nulls, repeats and a long text."""

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import decontaminate, fingerprints, langid, language_model, merkle, minmax, mixing, quality, sharding, simhash, token_store, toxicity

NAMES = (
    "id row class slot k n words size source_size target num den unit shift rank before copies s c g shard at _slot found new label _label score _score _found "
    "contamination contamination_0 toxicity language doc fp _id _row id_ row_ kept first best component node leaf home bucket tail h p part matrix doc_ids lengths "
    "chunk data asks hashes counts n_words log_score entry times pair item begin end "
    "k1 k2 b0 key lead last outside blocks n_shingles component_id shown pos path outer root leaf_hash block _part _idx _group"
).split() + ["a.b", "a`b"]
KEPT = ["doc_id", "text", "lang", "source", "n_chars", *NAMES]
ROWS = [(1, "fine words in a row here", "en", "a"), (1, "fine words in a row here", "en", "a"), (2, None, None, None), (None, "no id but text", "en", "b"), (3, "", "de", "a"), (4, "lang " * 50_000, "de", "a"), (5, "w1 w2 w3 and more of them", None, "b")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, len(t or "")) for i, t, lang, s in ROWS]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in NAMES])


def same(df, docs, but=()):
    """All columns of ``docs`` with their values, but for those that the operator says it replaces."""
    kept = [c for c in docs.columns if c not in but]
    view = lambda d: sorted((tuple(r[c] for c in kept) for r in d.collect()), key=str)
    assert view(df) == view(docs)


def test_operators(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "w1 w2 w3", "own")], "item_id long, text string, item string")
    same(sharding.place(docs, ["x", "y"], slots=13), docs, ("slot", "shard"))
    same(quality.scored(docs, labels, F.lit(True)), docs, ("score",))
    same(toxicity.scored(docs, toxicity.fit(docs, labels, F.lit(True))), docs, ("toxicity",))
    same(langid.identify(docs, docs), docs, ("language",))
    same(langid.identify(docs, docs, block_languages=1), docs, ("language",))
    same(decontaminate.contamination(docs, bench), docs, ("contamination",))
    same(decontaminate.decontaminate(docs, bench), docs.filter("doc_id IS NULL OR doc_id <> 5"))
    assert language_model.score(docs).count() == fingerprints.fingerprints(docs).count() == simhash.near_duplicates(docs).count() == mixing.copies(docs).count() == len(ROWS)
    assert minmax.near_duplicates(docs).count() == merkle.manifest(docs, given=merkle.lowered()).count() == len(ROWS)
    assert {(r.doc_id, r.component_id) for r in minmax.near_duplicates(docs).collect() if r.doc_id} == {(i, i) for i in (1, 2, 3, 4, 5)}
    assert all(r.verified for r in merkle.manifest(docs).collect())
    assert token_store.encode_and_read(docs, public_tokenizers.path("byte_bpe_50k.json")).count() == len(ROWS)
    same(simhash.keep_one(docs, null_ids=True), docs.dropDuplicates(["doc_id", "text"]).filter("doc_id IS NULL OR doc_id <> 3"))  # the null text and the empty one are copies
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {r[0] for r in ROWS}


@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, docs, tmp_path, empty):
    spark.createDataFrame([(1, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = docs.limit(0) if empty else docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, given, str(tmp_path))
        rows = out.collect()
        assert empty is False or rows == []
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == KEPT and all(r[c] == f"own {c}" for r in rows for c in NAMES)


def test_run_leaves_only_its_result_and_shards(spark, docs, tmp_path):
    import os

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    top = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(top))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert len(set(os.listdir(top)) - before) == 2
