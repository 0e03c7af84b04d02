"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Each document has one-hot features: its distinct words hashed into buckets
(weighted to length one), the bins of statistics of its bytes, and the bins of
numeric metadata columns. Pairwise interactions have rank ``RANK`` and are
scored in linear time: half of the square of sums less the sum of squares. The
model is fitted with numpy on a bounded sample of labelled rows (``bound``),
broadcast (its size is fixed by the parameters) and applied to every text.

Null and empty texts have no words and zero statistics, and get a score from
those; null metadata has a bin of its own; without labelled rows of both kinds
nothing is learned: ``fitted`` is false and every score is 0.5. Repeated rows
score alike; an empty table gives an empty result; very long texts are taken
whole, one at a time. A column that has the result's name (``into``) is replaced;
other columns stay, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import names, sampling, text

BITS = 15
RANK = 8
BINS = 24
BOUND = 6000
THRESHOLD = 0.7

_UPPER = np.array([65 <= b < 91 for b in range(256)])
_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])
_DIGIT = np.array([48 <= b < 58 for b in range(256)])
_MARK = ~(_LETTER | _DIGIT | text.SPACE)
_STOP = np.array([chr(b) in ".,;:" for b in range(256)])
_LINE = np.array([b == 10 for b in range(256)])
N_STATS = 11


def statistics(data: np.ndarray, bounds: np.ndarray, begins: np.ndarray, ends: np.ndarray, firsts: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Statistics of each row's structure in 0..1, and its distinct words: (row, hash, count)."""
    n_rows = len(bounds) - 1
    size = np.maximum(np.diff(bounds), 1)
    n_words = np.diff(firsts)
    many = np.maximum(n_words, 1)
    share = lambda mask: text.segment_sums(mask[data], bounds) / size
    row = np.repeat(np.arange(n_rows), n_words)
    order = np.lexsort((hashed, row))
    r, h = row[order], hashed[order]
    new = np.ones(len(h), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(h)))
    r, h = r[at], h[at]
    top, same = np.zeros(n_rows), np.zeros(n_rows)
    np.maximum.at(top, r, count)
    repeat = np.zeros(len(hashed))
    if len(hashed) > 1:
        repeat[1:] = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
        np.add.at(same, row, repeat)
    stats = np.stack(
        [
            np.log2(1 + n_words) / 20,
            text.segment_sums(ends - begins, firsts) / many / 20,
            share(_UPPER) * 2,
            share(_DIGIT) * 4,
            share(_MARK & ~_STOP) * 4,
            share(_STOP) * 8,
            share(_LINE) * 20,
            np.bincount(r, minlength=n_rows) / many,
            top / many * 2,
            same / many * 2,
            text.segment_sums((ends - begins > 20).astype(float), firsts) / many * 4,
        ],
        axis=1,
    )
    return np.clip(stats, 0, 1), r, h, count


def features(texts: pa.Array, metadata: list[pa.Array], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids, their values, and each row's first feature."""
    data, bounds = text.raw(texts)
    n_rows, n_buckets = len(texts), 1 << bits
    begins, ends, firsts = text.words(data, bounds)
    hashed = text.hashes(text.LOWER[data], begins, ends)
    stats, row, h, _ = statistics(data, bounds, begins, ends, firsts, hashed)
    n_distinct = np.maximum(np.bincount(row, minlength=n_rows), 1)
    columns = [np.minimum((stats * BINS).astype(np.int64), BINS - 1)]
    for column in metadata:
        x = np.array(column.cast(pa.float64()).fill_null(np.nan))
        with np.errstate(invalid="ignore", divide="ignore"):
            x = np.where(np.isnan(x), 0, 1 + np.minimum(np.log2(1 + np.abs(np.nan_to_num(x))), BINS - 2))
        columns.append(x.astype(np.int64)[:, None])
    dense = np.concatenate(columns, axis=1)
    dense += n_buckets + BINS * np.arange(dense.shape[1])
    rows = np.concatenate([row, np.repeat(np.arange(n_rows), dense.shape[1])])
    ids = np.concatenate([(h >> np.uint64(64 - bits)).astype(np.int64), dense.ravel()])
    values = np.concatenate([n_distinct[row] ** -0.5, np.full(dense.size, dense.shape[1] ** -0.5)]).astype(np.float32)
    order = np.argsort(rows, kind="stable")
    return ids[order], values[order], np.searchsorted(rows[order], np.arange(n_rows + 1))


class FactorisationMachine:
    """score = sigmoid(bias + sum w x + half of (square of sums - sum of squares) of v x)."""

    def __init__(self, n_features: int, rank: int = RANK, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.fitted = False
        self.w = np.zeros(n_features, np.float32)
        self.v = rng.normal(0, 0.05, (n_features, rank)).astype(np.float32)

    def _forward(self, ids, values, firsts):
        wx = text.segment_sums(self.w[ids] * values, firsts)
        vx = self.v[ids] * values[:, None]
        sums = text.segment_sums(vx, firsts)
        return self.bias + wx + 0.5 * (sums**2 - text.segment_sums(vx**2, firsts)).sum(1), sums

    def score(self, ids, values, firsts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._forward(ids, values, firsts)[0], -30, 30)))

    def fit(self, ids, values, firsts, labels, epochs: int = 12, batch: int = 128, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> None:
        """Adam on the logistic loss, over shuffled mini-batches."""
        rng, n, step = np.random.default_rng(seed), len(labels), 0
        self.fitted = True
        moments = [np.zeros_like(x) for x in (self.w, self.w, self.v, self.v)]
        bias = [0.0, 0.0]
        for _ in range(epochs):
            order = rng.permutation(n)
            for at in range(0, n, batch):
                rows, step = order[at : at + batch], step + 1
                sizes = firsts[rows + 1] - firsts[rows]
                take = np.concatenate([np.arange(firsts[r], firsts[r + 1]) for r in rows])
                f = np.concatenate([[0], np.cumsum(sizes)])
                i, x = ids[take], values[take]
                z, sums = self._forward(i, x, f)
                error = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - labels[rows]) / len(rows)
                e = np.repeat(error, sizes).astype(np.float32)
                used, inverse = np.unique(i, return_inverse=True)
                gw = np.bincount(inverse, e * x, len(used)).astype(np.float32) + decay * self.w[used]
                each = (e * x)[:, None] * (np.repeat(sums, sizes, axis=0).astype(np.float32) - self.v[i] * x[:, None])
                gv = np.stack([np.bincount(inverse, each[:, k], len(used)) for k in range(each.shape[1])], 1).astype(np.float32) + decay * self.v[used]
                lr = rate * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                for p, g, m, s in ((self.w, gw, moments[0], moments[1]), (self.v, gv, moments[2], moments[3])):
                    m[used] = 0.9 * m[used] + 0.1 * g
                    s[used] = 0.999 * s[used] + 0.001 * g * g
                    p[used] -= lr * m[used] / (np.sqrt(s[used]) + 1e-8)
                g = float(error.sum())
                bias = [0.9 * bias[0] + 0.1 * g, 0.999 * bias[1] + 0.001 * g * g]
                self.bias -= lr * bias[0] / (bias[1] ** 0.5 + 1e-8)


def fit(docs: DataFrame, labels: DataFrame, fold: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = ("n_chars",), bound: int = BOUND, bits: int = BITS) -> FactorisationMachine:
    """A model of at most ``bound`` labelled rows of the fold; their features, not their texts, come to the driver."""

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text.slices(batch.column(0)):
                part = batch.slice(a, b - a)
                ids, values, firsts = features(part.column(0), part.columns[2:], bits)
                lists = [pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(x)) for x in (ids.astype(np.int32), values)]
                yield pa.RecordBatch.from_arrays([part.column(1).cast(pa.int32()), *lists], ["label", "ids", "values"])

    label = names.fresh("label", docs)
    sample = sampling.labelled(docs, labels, label_col, fold, bound, id_col, label)
    table = sample.select(text_col, label, *metadata).mapInArrow(extracted, "label int, ids array<int>, values array<float>").toArrow()
    model = FactorisationMachine((1 << bits) + BINS * (N_STATS + len(metadata)))
    y = np.asarray(table["label"].combine_chunks(), np.float64) if len(table) else np.zeros(0)
    if len(y) and 0 < y.sum() < len(y):
        lists = table["ids"].combine_chunks(), table["values"].combine_chunks()
        firsts = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists[0]), np.int64))])
        order = np.lexsort((y, firsts[:-1] - firsts[1:]))  # not the order in which tasks end
        take = np.concatenate([np.arange(firsts[r], firsts[r + 1]) for r in order])
        sizes = np.diff(firsts)[order]
        model.fit(np.asarray(lists[0].flatten(), np.int64)[take], np.asarray(lists[1].flatten(), np.float32)[take], np.concatenate([[0], np.cumsum(sizes)]), y[order])
    else:
        model.v[:] = 0  # no random start in the scores
    return model


def score(model, text_col: Column, *metadata: Column, bits: int = BITS) -> Column:
    """Score of each text, 0 to 1; ``model`` is a broadcast."""

    @F.arrow_udf("double")
    def of(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            columns = columns if isinstance(columns, tuple) else (columns,)
            out = []
            for a, b in text.slices(columns[0]):
                out.append(model.value.score(*features(columns[0][a:b], [c[a:b] for c in columns[1:]], bits)))
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    return of.asNondeterministic()(text_col, *metadata)


def applied(docs: DataFrame, model: FactorisationMachine, into: str = "score", text_col: str = "text", metadata: tuple[str, ...] = ("n_chars",), bits: int = BITS) -> DataFrame:
    """``docs`` with the score of a model that ``fit`` returned."""
    return docs.withColumn(into, score(docs.sparkSession.sparkContext.broadcast(model), F.col(text_col), *map(F.col, metadata), bits=bits))


def scored(docs: DataFrame, labels: DataFrame, fold: Column, into: str = "score", text_col: str = "text", metadata: tuple[str, ...] = ("n_chars",), bits: int = BITS, **options) -> DataFrame:
    """``docs`` with a quality score learned from the fold's labels."""
    return applied(docs, fit(docs, labels, fold, text_col=text_col, metadata=metadata, bits=bits, **options), into, text_col, metadata, bits)
