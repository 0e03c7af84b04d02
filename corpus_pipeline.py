"""A training corpus from ``documents`` in five stages, each written and read again.

Every stage works on all documents that its predecessor kept. Columns keep their
names and values whatever they are called: helper columns get names that the
table lacks. Each stage is defined on empty tables, null texts and ids, very long
texts and repeated rows, as its operator says; token shards stay in the shared
folder, all other tables of a run are deleted when they have been read.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm import decontaminate, mixing, names, quality, scratch, simhash, token_store


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject; all of them if the labels teach it nothing."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, F.lit(True))
    if not model.fitted:
        return docs
    score = names.fresh("score", docs)
    return quality.applied(docs, model, into=score).filter(F.col(score) >= quality.THRESHOLD).select(names.columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, null_ids=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows hit less than one word in twenty."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix draws it."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, and where each document lies in them."""
    return token_store.encode_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("token output", write_tokens),
]

#: A learned classifier and hashes that SQL lacks: held against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch.cleared(spark) as made:
            docs = scratch.written(stage(spark, docs, sf_dir))
            # The last stage's shards are what the pipeline is for.
            made.discard(docs.scratch_path) if name != STAGES[-1][0] else made.clear()
        if before:
            scratch.discard(before)
        before = docs
    return docs
