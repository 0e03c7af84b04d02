"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters to Latin ones, digits
inside words to the letters that they stand for, invisible characters dropped.
Entries are whole words or beginnings of words; each hit adds the entry's
weight unless it lies in an exception phrase. The sum a hundred words (of the
text and ``EXTRA_WORDS`` more, so that one hit is not all of a short text) goes
through a fitted logistic curve.

The lexicon and curve are learned from a bounded sample of labelled rows: word
beginnings and words that many toxic and hardly any clean texts hold, weighted
by their log-odds. Exception phrases are pairs of neighbouring words with a hit in
them that pass the same test the other way round: among the texts that hold the entry,
far more clean ones hold the pair than the entry's own share of clean texts would give.
The sample is folded and split once. Null and empty texts have no
hits and score as clean; with no labels to learn from every score is 0. Repeated
rows score alike; an empty table gives an empty result; very long texts are
matched whole, in linear time. A column that has the result's name (``into``) is
replaced; other columns stay, whatever their names.
"""

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import names, sampling, scratch

BOUND = 8_000
#: Sampled rows that a task folds and counts.
ROWS = 500
THRESHOLD = 0.7
LEAST_TEXTS = 4
LEAST_ODDS = 4.0
LEAST_SURPRISE = 5.0
SHORTEST, LONGEST = 3, 10
EXTRA_WORDS = 20

#: Letters that look like a Latin one: Cyrillic, Greek, Armenian, Latin ones of their own.
LOOK_ALIKES = str.maketrans("авеёкмнорстухіїјѕһԁԛԝӏαβεικνορτυχωγηօսհոցıɑɡʟøđł", "abeekmhopctyxiijshdqwlabeiknoptuxwynouhngiaglodl")
#: Digits and signs that stand for letters.
DIGITS = str.maketrans("0134578@$", "oieastbas")
#: Accents and invisible characters.
_DROPPED = re.compile("[\u0300-\u036f\u200b-\u200f\u2060\ufeff\u00ad]")
_MIXED = re.compile(r"(?:[^\W\d_][\w@$]*[\d@$]|[\d@$]+[^\W\d_])[\w@$]*")
_SIGN = re.compile("[0-9@$]")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        # Compatibility forms (wide, bold, circled) become plain letters, and accents go.
        text = _DROPPED.sub("", unicodedata.normalize("NFKD", text)).lower()
        text = text.translate(LOOK_ALIKES)
    if _SIGN.search(text):
        text = _MIXED.sub(lambda m: m[0].translate(DIGITS), text)
    return text


def words(text: str | None) -> list[str]:
    return _WORD.findall(fold(text)) if text else []


def _features(found: list[str]) -> Counter[str]:
    """Occurrences of beginnings of words, and of whole words closed by ``$``."""
    out: Counter[str] = Counter()
    for w, n in Counter(found).items():
        for k in range(SHORTEST, min(LONGEST, len(w)) + 1):
            out[w[:k]] += n
        out[w + "$"] += n
    return out


def per_hundred(weight: np.ndarray | float, n_words: np.ndarray | int) -> np.ndarray | float:
    return 100 * weight / (n_words + EXTRA_WORDS)


class Lexicon:
    """Entries with weights; ``$`` at an entry's end closes the word."""

    def __init__(self, weights: dict[str, float], exceptions=(), slope: float = 0.0, offset: float = -20.0):
        self.weights, self.exceptions, self.slope, self.offset = weights, tuple(exceptions), slope, offset

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(" " + entry, (len(entry), weight, entry))
        for phrase in self.exceptions:
            key = " " + "$ ".join(words(phrase)) + "$"
            found.add_word(key, (len(key) - 1, None, phrase))
        if len(found):
            found.make_automaton()
        return found

    def places(self, automaton: ahocorasick.Automaton, found: list[str]) -> list[tuple[int, int, float, str]]:
        """Begin, end, weight and entry of what occurs outside exception phrases; each word has a sign before it and one after it."""
        if not found or not len(automaton):
            return []
        hits, spared = [], []
        for end, (size, weight, entry) in automaton.iter(" " + "$ ".join(found) + "$"):
            (spared if weight is None else hits).append((end - size, end, weight, entry))
        if spared:
            # How far the phrases reach that have begun by each place.
            spared.sort()
            begins, reach = [x for x, *_ in spared], list(accumulate((y for _, y, *_ in spared), max))
            hits = [h for h in hits if not (k := bisect_right(begins, h[0])) or reach[k - 1] < h[1]]
        return hits

    def hits(self, automaton: ahocorasick.Automaton, found: list[str]) -> list[tuple[str, float]]:
        return [(e, w) for _, _, w, e in self.places(automaton, found)]

    def pairs(self, automaton: ahocorasick.Automaton, found: list[str]) -> set[tuple[str, str]]:
        """Each entry that occurs with the pairs of neighbours that the word is in."""
        places = self.places(automaton, found)
        begins = list(accumulate((len(w) + 2 for w in found), initial=0)) if places else []
        at = {(entry, bisect_right(begins, begin) - 1) for begin, _, _, entry in places}
        return {(entry, f"{found[j]} {found[j + 1]}") for entry, i in at for j in (i - 1, i) if 0 <= j < len(found) - 1}

    def density(self, automaton: ahocorasick.Automaton, found: list[str]) -> float:
        return float(per_hundred(sum(w for _, w in self.hits(automaton, found)), len(found)))

    def score(self, density: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * density + self.offset, -30, 30)))


def _tells(n: int, m: int, ours: int, others: int, least: float = 0.0) -> tuple[float, float] | None:
    """How many of our texts hold something above the number expected, and its odds, if both are telling.

    ``n`` of ``ours`` and ``m`` of ``others`` hold it; no less than ``least`` are expected.
    """
    expected = max((n + m) * ours / (ours + others), least)
    odds = ((n + 0.5) / (ours + 1)) / ((m + 0.5) / (others + 1))
    if odds >= LEAST_ODDS and (n - expected) / expected**0.5 >= LEAST_SURPRISE:
        return n - expected, odds
    return None


def _chosen(bad: dict[str, tuple[int, int]], good: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Weights of the entries that tell most, from (texts, occurrences) of each entry.

    Of entries that begin alike, the one stays whose toxic texts above the
    number expected, times the log-odds, are the most. An entry weighs the
    log-odds of its occurrences.
    """
    worth = {}
    for entry, (n, times) in bad.items():
        m, others = good.get(entry, (0, 0))
        if told := _tells(n, m, toxic, clean):
            worth[entry] = told[0] * np.log(told[1]), float(np.log(((times + 0.5) / (toxic + 1)) / ((others + 0.5) / (clean + 1))))
    kept: dict[str, float] = {}
    begun: set[str] = set()
    for entry in sorted(worth, key=lambda e: (-worth[e][0], -len(e), e)):
        stems = {entry[:k] for k in range(1, len(entry) + 1)}
        if entry not in begun and not any(s in kept for s in stems):
            kept[entry] = worth[entry][1]
            begun |= stems
    return kept


def _spared(sample: DataFrame, lexicon, bad: dict[str, tuple[int, int]], good: dict[str, tuple[int, int]]) -> tuple[str, ...]:
    """Pairs of neighbours that are told to be clean among the texts that hold the entry in them; of two entries, by both."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.value.automaton()
        for batch in batches:
            counts = Counter()
            for text, label in zip(*(c.to_pylist() for c in batch.columns)):
                counts.update((*pair, label) for pair in lexicon.value.pairs(automaton, text.split()))
            entry, pair, label = zip(*counts) if counts else ((), (), ())
            columns = [pa.array(entry, pa.string()), pa.array(pair, pa.string()), pa.array(label, pa.int32()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["entry", "pair", "label", "n"])

    n = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    counts = sample.select("folded", "label").mapInArrow(counted, "entry string, pair string, label int, n long").groupBy("entry", "pair").agg(n(0).alias("clean"), n(1).alias("toxic"))
    kept, not_kept = set(), set()
    # A pair that passes for one entry may fail for another one with few clean texts, so all with enough of them are looked at.
    for r in counts.filter(F.col("clean") >= LEAST_TEXTS).toLocalIterator():
        told = _tells(r.clean, r.toxic, good.get(r.entry, (0, 0))[0], bad[r.entry][0], least=1.0)
        (kept if told else not_kept).add(r.pair)
    return tuple(sorted(kept - not_kept))


def fit(docs: DataFrame, labels: DataFrame, fold_: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", bound: int = BOUND, exceptions=()) -> Lexicon:
    """A lexicon from at most ``bound`` labelled rows of the fold."""
    label = names.fresh("label", docs)
    rows = sampling.labelled(docs, labels, label_col, fold_, bound, id_col, label).select(F.col(text_col).alias("text"), F.col(label).cast("int").alias("label"))
    spark = docs.sparkSession

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([" ".join(words(t)) for t in batch.column(0).to_pylist()], pa.string()), batch.column(1)], ["folded", "label"])

    sample = scratch.written(rows.repartition(max(1, bound // ROWS)).mapInArrow(folded, "folded string, label int"))

    def counted(entries):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts, times = Counter(), Counter()
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    found = _features(text.split())
                    if entries is not None:
                        found = Counter({e: found[e] for e in found.keys() & entries.value})
                    times.update(found)
                    texts.update(found.keys())
            columns = [pa.array(list(texts), pa.string()), *[pa.array([c[e] for e in texts], pa.int64()) for c in (texts, times)]]
            yield pa.RecordBatch.from_arrays(columns, ["entry", "n", "times"])

        return of

    def counts(label: int, entries=None) -> DataFrame:
        rows = sample.filter(F.col("label") == label).select("folded")
        return rows.mapInArrow(counted(entries), "entry string, n long, times long").groupBy("entry").agg(F.sum("n").alias("n"), F.sum("times").alias("times"))

    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, exceptions)
    # At most as many entries as the sampled texts can hold.
    bad = {r.entry: (r.n, r.times) for r in counts(1).filter(F.col("n") >= LEAST_TEXTS).toLocalIterator()}
    good = {r.entry: (r.n, r.times) for r in counts(0, spark.sparkContext.broadcast(set(bad))).toLocalIterator()}
    lexicon = Lexicon(_chosen(bad, good, toxic, clean), exceptions)
    lexicon.exceptions += _spared(sample, spark.sparkContext.broadcast(lexicon), bad, good)
    shared = spark.sparkContext.broadcast(lexicon)

    def densities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([shared.value.density(automaton, t.split()) for t in batch.column(0).to_pylist()], pa.float64())], ["label", "density"])

    table = sample.select("folded", "label").mapInArrow(densities, "label int, density double").toPandas().sort_values(["density", "label"])
    x, y = table["density"].to_numpy(), table["label"].to_numpy(np.float64)
    design, w = np.stack([x, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(30):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(hessian, design.T @ (p - y) + 1e-2 * w)
    lexicon.slope, lexicon.offset = float(w[0]), float(w[1])
    return lexicon


RESULT = "struct<score:double,weight:double,n_words:long,entries:array<string>>"


def scored(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``into``: score, weight of the hits, n_words, and the entries hit."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf(RESULT)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = shared.value
        automaton = lexicon.automaton()
        for texts in batches:
            weight, n, entries = [], [], []
            for text in texts.to_pylist():
                found = words(text)
                hits = lexicon.hits(automaton, found)
                weight.append(sum(w for _, w in hits))
                n.append(len(found))
                entries.append(sorted({e for e, _ in hits}))
            score = lexicon.score(per_hundred(np.array(weight, np.float64), np.array(n, np.float64)))
            yield pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array(weight, pa.float64()), pa.array(n, pa.int64()), pa.array(entries, pa.list_(pa.string()))], ["score", "weight", "n_words", "entries"])

    return docs.withColumn(into, of.asNondeterministic()(F.col(text_col)))
