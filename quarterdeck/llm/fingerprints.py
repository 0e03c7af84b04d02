"""Document fingerprints by improved consistent weighted sampling.

A text's terms are its words (ASCII letters in lower case), weighted by their
counts. For each term and each of ``SAMPLES`` samples, r and c are
Gamma(2, 1) and b is uniform, all drawn from the term's hash; with
t = floor(ln w / r + b), the sample is the term and t with the least
ln c - r (t - b + 1). Two texts share a sample with a probability equal to the
generalised Jaccard similarity of their weights. A fingerprint holds a 16-bit
code of each sample as hex digits.

A null text is empty; all empty texts share the one fingerprint of no terms.
Rows go by ascending id, null ids first, equal ids by a hash of the text; the
row after the last is the first, so a lone row is its own next one. Repeated rows
are each fingerprinted; an empty table gives an empty result; very long texts are
taken whole. Other columns are not read, whatever their names.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import text as bytes_of

SAMPLES = 64
SLICE_BYTES = 1 << 20
_tables: tuple[np.ndarray, np.ndarray] | None = None


def _gamma() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1) at 65,536 even steps, and their logarithms."""
    global _tables
    if _tables is None:
        p = (np.arange(65536) + 0.5) / 65536
        x = np.sqrt(2 * p) + p  # the distribution is 1 - (1 + x) exp(-x); Newton's method
        for _ in range(60):
            x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / np.maximum(x * np.exp(-x), 1e-12), 1e-9)
        _tables = x.astype(np.float32), np.log(x).astype(np.float32)
    return _tables


def signatures(texts: list[str | None], samples: int = SAMPLES) -> np.ndarray:
    """One row of 16-bit codes for each text; 65535 throughout if it has no words."""
    data, bounds = bytes_of.raw(pa.array(texts, pa.large_string()))
    out = np.full((len(texts), samples), 65535, np.uint16)
    begins, ends, firsts = bytes_of.words(data, bounds)
    if not len(begins):
        return out
    # (row, 40 bits of the hash) in one sortable number.
    hashed = bytes_of.hashes(bytes_of.LOWER[data], begins, ends) >> np.uint64(24)
    row = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(firsts))
    keys = np.sort(row << np.uint64(40) | hashed)
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    weight = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    terms, inverse = np.unique(keys & np.uint64((1 << 40) - 1), return_inverse=True)

    gamma, log_gamma = _gamma()
    seeds = bytes_of.mix(np.arange(1, samples + 1, dtype=np.uint64)) | np.uint64(1)
    x = terms[:, None] * seeds
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    part = x.view(np.uint16).reshape(*x.shape, 4)
    r, log_c = gamma[part[..., 0]], log_gamma[part[..., 1]]
    b = part[..., 2].astype(np.float32) / np.float32(65536)
    once = log_c - r * (1 - b)  # a weight of one: t is 0
    value = once[inverse]
    many = np.flatnonzero(weight > 1)
    k = inverse[many]
    t = np.floor(np.log(weight[many]).astype(np.float32)[:, None] / r[k] + b[k])
    value[many] = log_c[k] - r[k] * (t - b[k] + 1)
    row = (keys >> np.uint64(40)).astype(np.int64)
    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    least = np.minimum.reduceat(value, begin, axis=0)
    # Equal samples have equal values, so a value's bits stand for its sample.
    code = bytes_of.mix(least.view(np.uint32).astype(np.uint64)) % np.uint64(65535)
    out[row[begin]] = code.astype(np.uint16)
    return out


def text_of(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row: an estimate of the generalised Jaccard similarity."""
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by as many of the next text's first ones."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets_per_part: int = 4) -> DataFrame:
    """(bucket, tail, id, text): each bucket's rows in order, then the first row of the bucket after it (tail = 1).

    Buckets are ranges of ids from approximate quantiles, and of hashes inside an id
    that many rows share; the text is shuffled once.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = parts * buckets_per_part
    keyed = rows.select(F.coalesce("id", F.lit(-(1 << 63))).alias("id"))
    # A value that stands here m times has about m buckets' worth of rows.
    splits = np.sort(np.array(keyed.approxQuantile("id", [k / n for k in range(1, n)], 0.1 / n), np.int64)) if n > 1 else np.zeros(0, np.int64)

    @F.arrow_udf("int")
    def bucket(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        ids = np.array(ids.fill_null(-(1 << 63)), np.int64)
        low, high = (np.searchsorted(splits, ids, side=side) for side in ("left", "right"))
        share = np.array(hashes, np.int64).astype(np.float64) / 2.0**64 + 0.5
        within = np.minimum((share * (high - low)).astype(np.int64), high - low - 1)
        return pa.array(np.where(high > low, low + 1 + within, low).astype(np.int32))

    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("bucket", bucket("id", "h"))
    # One row for each bucket, and there are as many as the splits allow.
    firsts = sorted((r.bucket, r.first.id, r.first.h) for r in rows.groupBy("bucket").agg(F.min(F.struct("id", "h")).alias("first")).collect())
    firsts = [(firsts[k - 1][0], i, h) for k, (_, i, h) in enumerate(firsts)]
    heads = spark.createDataFrame(firsts, "before int, head_id long, head_h long")
    # A head's repeats go along too; the reader takes the first.
    placed = rows.join(F.broadcast(heads), F.expr("id <=> head_id AND h = head_h"), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("tail"))
    tail = F.struct(F.col("before").alias("bucket"), F.lit(1).alias("tail"))
    placed = placed.select(F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, tail))).alias("p"), "id", "h", "text")
    placed = placed.select("p.bucket", "p.tail", "id", "h", "text").repartition(parts, "bucket")
    return placed.sortWithinPartitions("bucket", "tail", F.col("id").asc_nulls_first(), "h").drop("h")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like they are to each other and to the next text's."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of one bucket, the last of which only serves as a next one.
        run: list[tuple[int | None, str]] = []
        held, current, closed = 0, None, False

        def out(run) -> pa.RecordBatch:
            ids, texts = [r[0] for r in run[:-1]], [r[1] for r in run]
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
            codes = signatures(texts + changed, samples)
            own, other, made = codes[: len(ids)], codes[1 : len(texts)], codes[len(texts) :]
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed], pa.string()),
                pa.array([text_of(s) for s in own], pa.string()),
                pa.array([text_of(s) for s in made], pa.string()),
                pa.array(likeness(own, made)),
                pa.array(likeness(own, other)),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            for bucket, tail, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != current:
                    run, held, current, closed = [], 0, bucket, False
                if closed:
                    continue
                run.append((key, text))
                held += len(text)
                closed = tail == 1
                if len(run) > 1 and (closed or held > SLICE_BYTES):
                    yield out(run)
                    run, held = run[-1:], len(text)

    return with_next(docs, id_col, text_col).mapInArrow(signed, SCHEMA)
