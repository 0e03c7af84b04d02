"""Each stage of the pipeline against a plain version, on the smallest tables."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarterdeck.llm import mixing, quality, scratch
from tests.llm.test_decontaminate import plain as plain_contamination
from tests.llm.test_simhash import plain_groups

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs if not outs else outs[-1], DATA)
        outs.append(scratch.written(out))
    good, single, clean, mixed, tokens = outs
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    assert all(df.columns == docs.columns for df in outs[:-1])

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {i for i, _ in rows(good)}
    assert all((i in kept) == bool(q) for i, q in labels.items())

    assert sorted(i for i, _ in rows(single)) == sorted({k for _, _, k in plain_groups(rows(good))})

    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = {i for i, t in rows(single) if (lambda n, hit, _: hit and 20 * len(hit) >= n)(*plain_contamination(t, items, 13))}
    assert bad and {i for i, _ in rows(clean)} == {i for i, _ in rows(single)} - bad

    drawn = {r.id: r.copies for r in mixing.copies(clean).collect()}
    assert Counter(i for i, _ in rows(mixed)) == Counter({i: n for i, n in drawn.items() if n})

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, expected = 0, []
    for i, text in sorted(rows(mixed)):
        ids = [*t.encode(text, add_special_tokens=False).ids, 0]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in tokens.collect()) == expected


def test_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)


def test_quality_without_labels_of_both_kinds_rejects_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    known = spark.read.parquet(f"{DATA}/labels.parquet")
    nulls = known.withColumn("quality", F.lit(None).cast(known.schema["quality"].dataType))
    for k, labels in enumerate((known.limit(0), known.filter("quality = 1"), known.filter("quality = 0"), nulls)):
        labels.write.parquet(str(tmp_path / str(k) / "labels.parquet"))
        assert corpus_pipeline.keep_quality(spark, docs, str(tmp_path / str(k))).count() == docs.count()
        assert {r.score for r in quality.scored(docs, labels, F.lit(True)).select("score").distinct().collect()} == {0.5}
