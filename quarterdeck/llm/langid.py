"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and everything but letters becomes a space. Its 1- to
3-grams are hashed into buckets; log-probabilities of buckets by language are a
matrix, of which each block of at most ``BLOCK_LANGUAGES`` languages has a fixed
size and is broadcast; beyond one block, each has a pass over the rows of its
own, and the best language and the sum of probabilities are carried along.
Counts are summed in Spark over all training rows.

Null texts and texts without a letter are ``und`` with score 0. Rows with a null
language don't train. With nothing to learn from, every text is ``und``. Equal
scores go to the language that sorts first. Repeated rows score alike; an empty
table gives an empty result; very long texts are taken whole, one at a time. A
column that has the result's name (``into``) is replaced; other columns stay,
whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import names, scratch

BITS = 15
ORDERS = 3
BLOCK_LANGUAGES = 256
SLICE_CHARS = 1 << 20
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _letters


def _parts(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    part, held, begin = [], 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t or "") > SLICE_CHARS:
            yield begin, part
            part, held, begin = [], 0, i
        part.append((t or "").lower())
        held += len(part[-1])
    if part:
        yield begin, part


def buckets(texts: list[str], bits: int = BITS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per order the bucket of the n-gram at each character (``1 << bits``: none), each text's bounds, and whether it has letters."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.cumsum([0, *map(len, texts)])
    letter = _is_letter()[code]
    symbol = np.where(letter, code, 32).astype(np.uint64)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(code))  # characters up to the text's end
    out, h, ok = [], symbol, letter
    for k in range(ORDERS):
        if k:
            h = h[:-1] * np.uint64(0x100000001B3) + symbol[k:]
            # Of a pair one is a letter, of a triple the middle one.
            ok = (letter[:-1] | letter[1:] if k == 1 else letter[k - 1 : len(letter) - 1])[: len(h)]
        gram = ((h + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int32)
        full = np.full(len(code), 1 << bits, np.int32)
        full[: len(h)] = np.where(ok & (left[: len(h)] > k), gram, 1 << bits)
        out.append(full)
        if len(h) < 2:
            break
    some = np.add.reduceat(np.append(letter, False), bounds[:-1]) > 0 if len(texts) else np.zeros(0, bool)
    return out, bounds, some & (np.diff(bounds) > 0)


class Model:
    """Log-probabilities (language, bucket) of some languages, and priors."""

    def __init__(self, languages: list[str], counts: np.ndarray, prior: np.ndarray, alpha: float = 0.5):
        self.languages, self.prior = languages, prior
        smooth = counts + alpha
        self.log_p = np.zeros((len(languages), counts.shape[1] + 1), np.float32)
        self.log_p[:, :-1] = np.log(smooth / smooth.sum(1, keepdims=True))

    def predict(self, texts: list[str | None]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Of each text the best language (none without a letter), its log-probability, and the log of the sum over the languages."""
        langs, best, total_of = [], [], []
        for _, part in _parts(texts):
            grams, bounds, some = buckets(part, (self.log_p.shape[1] - 1).bit_length() - 1)
            firsts = bounds[:-1][some]
            total = np.tile(self.prior[:, None], (1, len(firsts)))
            if len(firsts):
                for language, log_p in enumerate(self.log_p):
                    for gram in grams:
                        total[language] += np.add.reduceat(log_p[gram], firsts, dtype=np.float64)
            top, which = total.max(0), total.argmax(0)
            summed = top + np.log(np.exp(total - top).sum(0))
            where = iter(range(len(firsts)))
            for known in some.tolist():
                k = next(where) if known else -1
                langs.append(self.languages[which[k]] if known else None)
                best.append(top[k] if known else -np.inf)
                total_of.append(summed[k] if known else -np.inf)
        return langs, np.array(best), np.array(total_of)


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", bits: int = BITS, block_languages: int = BLOCK_LANGUAGES) -> Iterator[Model]:
    """Models of blocks of languages, from counts over all rows of ``docs`` that have a language and a text."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            for begin, part in _parts(texts):
                grams, bounds, _ = buckets(part, bits)
                names = sorted(set(langs[begin : begin + len(part)]))
                of = np.array([names.index(x) for x in langs[begin : begin + len(part)]])
                of_char = np.repeat(of, np.diff(bounds)) * ((1 << bits) + 1)
                n = sum(np.bincount(g + of_char, minlength=len(names) * ((1 << bits) + 1)) for g in grams).reshape(len(names), -1)
                for name, c, d in zip(names, n, np.bincount(of, minlength=len(names))):
                    sums[name] = sums.get(name, 0) + c[:-1]
                    seen[name] = seen.get(name, 0) + int(d)
        for name, c in sums.items():
            at = np.flatnonzero(c)
            # Bucket -1 counts the documents.
            yield pa.RecordBatch.from_arrays([pa.array([name] * (len(at) + 1)), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(c[at], seen[name]).astype(np.int64))], ["lang", "bucket", "n"])

    sums = scratch.written(rows.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))

    def vector(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        counts = np.zeros(1 << bits, np.int64)
        counts[np.asarray(table["bucket"])] = np.asarray(table["n"])
        return pa.table({"lang": [key[0].as_py()], "counts": pa.array([counts.tobytes()], pa.binary())})

    vectors = sums.filter("bucket >= 0").groupBy("lang").applyInArrow(vector, "lang string, counts binary")
    # One row for each language; a language whose texts have no letters has no n-grams.
    seen = {r.lang: r.n for r in sums.filter("bucket < 0").orderBy("lang").toLocalIterator()}
    known = sorted(seen)
    for at in range(0, len(known), block_languages):
        block = known[at : at + block_languages]
        found = {r.lang: np.frombuffer(r.counts, np.int64) for r in vectors.filter(F.col("lang").between(block[0], block[-1])).toLocalIterator()}
        counts = np.stack([found.get(x, np.zeros(1 << bits, np.int64)) for x in block])
        yield Model(block, counts, np.log(np.array([seen[x] for x in block]) / sum(seen.values())))


def identify(docs: DataFrame, training: DataFrame, lang_col: str = "lang", text_col: str = "text", into: str = "language", bits: int = BITS, block_languages: int = BLOCK_LANGUAGES) -> DataFrame:
    """``docs`` with a struct column ``into``: lang and score."""

    def predicted(model):
        @F.arrow_udf("struct<lang:string,best:double,total:double>")
        def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                langs, best, total = model.value.predict(texts.to_pylist())
                yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(best), pa.array(total)], ["lang", "best", "total"])

        return of.asNondeterministic()(F.col(text_col))

    found, new = names.fresh("found", docs), names.fresh("new", docs)
    out, held = docs.withColumn(found, F.lit(None).cast("struct<lang:string,best:double,total:double>")), None
    for k, model in enumerate(fit(training, lang_col, text_col, bits, block_languages)):
        if k:  # one block at a time in the workers' memory
            out = scratch.written(out)
            held.destroy()
        held = docs.sparkSession.sparkContext.broadcast(model)
        out = out.withColumn(new, predicted(held))
        if k:
            a, b = F.col(found), F.col(new)
            high = F.greatest(a["total"], b["total"])
            total = F.when(high == float("-inf"), high).otherwise(high + F.log(F.exp(a["total"] - high) + F.exp(b["total"] - high)))
            # Blocks go in the order of names, so the first stays on a tie.
            better = b["best"] > a["best"]
            both = F.struct(F.when(better, b["lang"]).otherwise(a["lang"]).alias("lang"), F.greatest(a["best"], b["best"]).alias("best"), total.alias("total"))
            out = out.withColumn(found, both).drop(new)
        else:
            out = out.drop(found).withColumnRenamed(new, found)
    lang = F.col(found)["lang"]
    result = F.struct(F.coalesce(lang, F.lit(UNKNOWN)).alias("lang"), F.when(lang.isNull(), 0.0).otherwise(F.exp(F.col(found)["best"] - F.col(found)["total"])).alias("score"))
    return out.withColumn(into, result).drop(found)


def language(column: str = "language") -> Column:
    return F.col(f"{column}.lang")
