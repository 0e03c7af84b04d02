"""Hard negatives of embeddings by an exact search of an inverted multi-index.

A vector is cut into two halves with a codebook each, fitted on a bounded sample;
a pair of codewords is a cell of the index, and every row is in its cell. For an
anchor, a half's score with any row of a codeword is at most its product with the
codeword plus its norm times the codeword's radius, the largest distance of any
row from it. A heap visits cells by the sum of the two bounds, largest first
(multi-sequence order), and stops where the bound certifies that no cell left can
change the answer:

* positives are the first rows of the anchor's label: a first round visits cells
  until it has seen ``FIRST_ROWS`` rows, a second goes on to the bound of the worst
  positive found;
* negatives of a positive are the first rows of other labels in a window of scores
  below its own: cells whose lower bound is above all windows are passed over, and
  the second round goes on to the worst negative found or the window's lower end.

Anchors ask for cells, and cells are dealt out in chunks of bounded size: small cells
share one, a common vector or a large cell is many. An anchor goes to a chunk once, with
the cells that it asks for there, and a chunk meets the anchors that ask for it in blocks
of bounded size, one cogroup each. Of a block's chunk each anchor gets its best few rows
only. Asks are made for a few anchors at a time, so no task holds those of all anchors.

Components are whole numbers, floor(256 x), and products are exact. Rows without an
id, a label or a vector, or with a component that is null or not finite, take no
part; missing components of a shorter vector are 0. Rows with an anchor's id are
never its partners; repeated anchors count once, other repeated rows each; ties go by
id. Scores beyond a long are cut to its range. Fewer partners than asked give fewer
rows, no positive or no row in the window none; an empty table gives an empty
result. Other columns don't matter, whatever their names.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm import scratch

SCALE = 256
POSITIVES = NEGATIVES = 5
#: A window in percent of the positive's score, both ends included.
LEAST, MOST = 80, 100
#: Rows that the codebooks are fitted on, and codewords of a half, at most; rows of a cell that make it share a chunk, at most.
SAMPLE_ROWS, CODEWORDS, CHUNK_ROWS = 1 << 16, 256, 8192
FIRST_ROWS = 2048
#: Anchors of a block that meets a chunk, about; anchors that one task plans for; asks of a batch, about.
BLOCK_ANCHORS, TASK_ANCHORS, BATCH_ASKS = 1 << 14, 128, 2048
_BATCH = 1024
#: Scores of a step, and partners found before the best are kept, at most.
_SCORES = 1 << 18


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers as doubles, short rows filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes, flat = np.diff(np.asarray(column.offsets)), np.asarray(column.flatten(), np.float64)
    out = np.zeros((len(column), dims))
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as longs."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = [np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object) for x in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -(2**63), 2**63 - 1).astype(np.int64)


def codebook(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of k-means."""
    rng = np.random.default_rng(7)
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]].astype(np.float64)
    for _ in range(rounds):
        at = nearest(points, centres)[0]
        sizes = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, and its distance."""
    at, far = np.zeros(len(points), np.int64), np.zeros(len(points))
    for k in range(0, len(points), _BATCH):
        part = points[k : k + _BATCH]
        at[k : k + _BATCH] = ((centres**2).sum(axis=1) - 2 * part @ centres.T).argmin(axis=1)
        far[k : k + _BATCH] = np.sqrt(((part - centres[at[k : k + _BATCH]]) ** 2).sum(axis=1))
    return at, far


def firsts(shape: tuple[int, int], i: np.ndarray, j: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k``-th score of each row of a matrix (the least long if it has fewer), and which of its given places, row by row, are above it or among the first ``k`` that have it."""
    held = np.full(shape, -(2**63))
    held[i, j] = score
    at = max(0, shape[1] - k)
    cut = np.partition(held, at, axis=1)[:, at] if shape[1] >= k else np.full(shape[0], -(2**63))
    tie = score == cut[i]
    nth = tie.cumsum()
    nth -= (nth - tie)[np.searchsorted(i, i)]
    return cut, (score > cut[i]) | tie & (nth <= k)


@dataclass
class Index:
    """Codebooks, radii and cells; bounded by the number of codewords, so a broadcast of it is."""

    dims: int
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    #: Rows of each cell, and a bit for each residue of the labels in it.
    counts: np.ndarray
    labels: np.ndarray
    rows: DataFrame | None = None

    def visits(self, q: np.ndarray) -> Iterator[tuple[int, float, float]]:
        """(cell, upper, lower bound of scores with ``q``) of cells with rows, by upper bound, largest first."""
        half = self.dims // 2
        uppers, lowers = [], []
        for part, book, radius in zip((q[:half], q[half:]), self.books, self.radii):
            middle, reach = book @ part, np.linalg.norm(part) * radius
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-6  # rounding of doubles
            uppers.append(middle + reach + slack)
            lowers.append(middle - reach - slack)
        orders = first, second = [np.argsort(-u, kind="stable") for u in uppers]
        filled = (self.counts[first][:, second] > 0).tolist()
        (i, j), (up, along), (low, below) = ([x.tolist() for x in pair] for pair in (orders, *([x[o] for x, o in zip(ends, orders)] for ends in (uppers, lowers))))
        heap = [(-(up[0] + along[0]), 0, 0)]
        while heap:
            upper, a, b = heap[0]
            if filled[a][b]:
                yield i[a] * len(j) + j[b], -upper, low[a] + below[b]
            if b + 1 < len(j):
                heapq.heapreplace(heap, (-(up[a] + along[b + 1]), a, b + 1))
            else:
                heapq.heappop(heap)
            if b == 0 and a + 1 < len(i):
                heapq.heappush(heap, (-(up[a + 1] + along[0]), a + 1, 0))


def prepared(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """(id, label, q): the rows that take part, with whole components."""
    q = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    fit = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fit)
    return rows.select(F.col(id_col).cast("long").alias("id"), (F.col("label") if label is None else label).cast("long").alias("label"), q.alias("q")).filter("label IS NOT NULL")


def index(rows: DataFrame, codewords: int = CODEWORDS, sample_rows: int = SAMPLE_ROWS) -> Index:
    """The index of ``rows`` (id, label, q); all of them are in it, a bounded sample shapes it."""
    spark = rows.sparkSession
    total, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    dims = max(2, dims)
    share = F.pmod(F.xxhash64("id"), F.lit(max(1, total // sample_rows))) == 0
    points = matrix(rows.filter(share).select("q").limit(2 * sample_rows).toArrow()["q"], dims)
    points = points if len(points) else np.zeros((1, dims))
    k, half = int(min(codewords, max(2, (total / 256) ** 0.5))), dims // 2
    books = codebook(points[:, :half], k), codebook(points[:, half:], k)
    shared = spark.sparkContext.broadcast((books, dims))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ((left, right), dims), seen = shared.value, 0
        for batch in batches:
            q = matrix(batch.column("q"), dims)
            (i, near), (j, far) = nearest(q[:, : dims // 2], left), nearest(q[:, dims // 2 :], right)
            place, seen = np.arange(seen, seen + len(q)), seen + len(q)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, (i * len(right) + j, i, j, near, far, place))], [*batch.schema.names, "cell", "i", "j", "near", "far", "place"])

    held = scratch.written(rows.mapInArrow(placed, "id long, label long, q array<long>, cell long, i long, j long, near double, far double, place long"))
    radii = tuple(np.zeros(len(b)) for b in books)
    counts, labels = (np.zeros((len(books[0]), len(books[1])), np.int64) for _ in range(2))
    bit = F.expr("bit_or(shiftleft(1L, cast(pmod(label, 63) as int)))")
    for r in held.groupBy("i", "j").agg(F.count("*").alias("n"), bit.alias("labels"), F.max("near").alias("near"), F.max("far").alias("far")).collect():  # as many as cells at most
        counts[r.i, r.j], labels[r.i, r.j] = r.n, r.labels
        radii[0][r.i], radii[1][r.j] = max(radii[0][r.i], r.near), max(radii[1][r.j], r.far)
    return Index(dims, books, radii, counts, labels, held.select("id", "label", "q", "cell", "place"))


def chunks(counts: np.ndarray, chunk_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The first chunk of each cell and how many it has: neighbours share one of up to twice ``chunk_rows`` rows, larger cells have their own."""
    counts = counts.ravel()
    shared, parts = np.where(counts <= chunk_rows, counts, 0), np.where(counts <= chunk_rows, 0, -(-counts // chunk_rows))
    together = (shared.cumsum() - shared) // chunk_rows
    return np.where(parts == 0, together, together.max() + 1 + parts.cumsum() - parts), np.maximum(parts, 1)


def _ends(windows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, lower end, upper end) of windows, a row for each place in the lists; where a list is shorter nothing fits.

    A full window can still gain from scores that reach the worst it has, others from their lower end on.
    """
    windows = windows.combine_chunks() if isinstance(windows, pa.ChunkedArray) else windows
    sizes, flat = np.diff(np.asarray(windows.offsets)), windows.flatten()
    row, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = tuple(np.full((sizes.max(initial=1), len(sizes)), none, np.int64) for none in (0, 2**63 - 1, -(2**63)))
    for end, values in zip(out, (flat.field("window"), pc.coalesce(flat.field("worst"), flat.field("least")), flat.field("most"))):
        end[place, row] = np.asarray(values)
    return out


def _asked(states: DataFrame, found: Index, chunk_rows: int, anchors: int, negatives: bool, again: bool) -> DataFrame:
    """(anchor, label, id, q, windows, chunk, cell) of the chunks with cells that anchors ask for in a round; ``cell`` lists those of the chunk."""
    shared = states.sparkSession.sparkContext.broadcast(Index(found.dims, found.books, found.radii, found.counts, found.labels))

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        counts, labels = held.counts.ravel(), held.labels.ravel()
        first, parts = chunks(held.counts, chunk_rows)

        def wanted(q: np.ndarray, label: int, bars: np.ndarray, tops: np.ndarray) -> np.ndarray:
            """The cells that an anchor asks for."""
            visited, bar, seen = [], int(bars.min()), 0
            for cell, upper, lower in held.visits(q):
                if upper < bar or not again and seen >= FIRST_ROWS:
                    break
                visited.append((cell, upper, lower, seen))
                seen += int(counts[cell])
            cell, upper, lower, before = (np.array(x) for x in zip(*visited)) if visited else np.zeros((4, 0))
            cell = cell.astype(np.int64)
            fit = ((before < FIRST_ROWS) != again) & ((lower <= tops[:, None]) & (upper >= bars[:, None])).any(axis=0)
            return cell[fit if negatives else fit & (labels[cell] & np.int64(1 << label % 63) != 0)]

        def packed(batch: pa.RecordBatch, asks: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            row, chunk, size, cell = map(np.concatenate, zip(*asks))
            cells = pa.ListArray.from_arrays(pa.array(np.append(0, size.cumsum()), pa.int32()), pa.array(cell, pa.int64()))
            return pa.RecordBatch.from_arrays([*batch.take(pa.array(row)).columns, pa.array(chunk, pa.int64()), cells], [*batch.schema.names, "chunk", "cell"])

        for batch in batches:
            q, label = matrix(batch.column("q"), held.dims), batch.column("label").to_pylist()
            _, bars, tops = _ends(batch.column("windows"))
            asks, n = [], 0
            for k in range(len(q)):
                cell = wanted(q[k], label[k], bars[:, k], tops[:, k])
                ends = parts[cell].cumsum()
                nth = np.arange(ends[-1] if len(cell) else 0) - np.repeat(ends - parts[cell], parts[cell])
                cell = np.repeat(cell, parts[cell])
                chunk = first[cell] + nth
                order = np.argsort(chunk, kind="stable")
                chunk, size = np.unique(chunk, return_counts=True)
                asks.append((np.full(len(chunk), k), chunk, size, cell[order]))
                n += len(chunk)
                if n >= BATCH_ASKS or k + 1 == len(q):
                    yield packed(batch, asks)
                    asks, n = [], 0

    dealt = states.select("anchor", "id", "label", "q", "windows").repartition(max(1, -(-anchors // TASK_ANCHORS)))
    return dealt.mapInArrow(planned, f"anchor long, id long, label long, q array<long>, windows {_WINDOWS}, chunk long, cell array<long>")


_WINDOWS = "array<struct<window:int,least:long,most:long,worst:long>>"
_FOUND = "anchor long, window int, partner long, score long"


def _searched(states: DataFrame, found: Index, k: int, chunk_rows: int, anchors: int, negatives: bool, again: bool) -> DataFrame:
    """(anchor, window, partner, score): the best ``k`` rows of each chunk asked for and window."""
    first, parts = chunks(found.counts, chunk_rows)
    # As many rows as cells, so its size is bounded.
    dealt = states.sparkSession.createDataFrame(pa.table({"cell": np.arange(len(first)), "first": first, "parts": parts}))
    chunk = F.col("first") + F.pmod(F.xxhash64("id", "place"), F.col("parts"))
    blocks = max(1, -(-anchors // BLOCK_ANCHORS))
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = found.rows.join(F.broadcast(dealt), "cell").select("id", "label", "q", "cell", chunk.alias("chunk"), block.alias("block"))
    dims = found.dims

    def scored(asks: pa.Table, rows: pa.Table) -> pa.Table:
        if not asks.num_rows or not rows.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())], ["anchor", "window", "partner", "score"])
        rows = rows.sort_by([("cell", "ascending"), ("id", "ascending")])
        cells, ids, labels, points = *(np.asarray(rows[c]) for c in ("cell", "id", "label")), matrix(rows["q"], dims)
        anchor, own, label, q = *(np.asarray(asks[c]) for c in ("anchor", "id", "label")), matrix(asks["q"], dims)
        window, bars, tops = _ends(asks["windows"])
        wanted = asks["cell"].combine_chunks()
        row, cell = np.repeat(np.arange(len(q)), np.diff(np.asarray(wanted.offsets))), np.asarray(wanted.flatten())
        order = np.argsort(cell, kind="stable")
        row, cell = row[order], cell[order]
        held, more = [], 0  # slots (anchors' windows), scores and partners

        def best() -> list[tuple[np.ndarray, ...]]:
            """The first ``k`` of each slot; rows below the worst of a full one can't enter it any more."""
            slot, score, partner = map(np.concatenate, zip(*held))
            order = np.lexsort((partner, ~score, slot))
            slot, score, partner = slot[order], score[order], partner[order]
            place = np.arange(len(slot)) - np.searchsorted(slot, slot)
            bars.ravel()[slot[place == k - 1]] = score[place == k - 1]
            return [(slot[place < k], score[place < k], partner[place < k])]

        for c in np.unique(cell):
            low, high = np.searchsorted(cells, (c, c + 1))
            asking = row[slice(*np.searchsorted(cell, (c, c + 1)))]
            step = max(1, _SCORES // max(1, high - low))
            for at in range(0, len(asking), step):
                part = asking[at : at + step]
                s = products(q[part], points[low:high])
                i, j = np.nonzero(s >= bars[:, part].min(axis=0)[:, None])
                of, to = labels[low:high][j], label[part][i]
                fit = (ids[low:high][j] != own[part][i]) & ((of != to) if negatives else (of == to))
                i, j = i[fit], j[fit]
                score = s[i, j]
                for w in range(len(bars)):
                    fit = (score >= bars[w, part][i]) & (score <= tops[w, part][i])
                    if fit.sum() > 8 * k * len(part):
                        cut, fit[fit] = firsts(s.shape, i[fit], j[fit], score[fit], k)
                        bars[w, part] = np.maximum(bars[w, part], cut)
                    held.append((w * len(q) + part[i[fit]], score[fit], ids[low:high][j[fit]]))
                    more += int(fit.sum())
                    if more > _SCORES:
                        held, more = best(), 0
        slot, score, partner = best()[0]
        return pa.table([pa.array(c, t) for c, t in ((anchor[slot % len(q)], pa.int64()), (window.ravel()[slot], pa.int32()), (partner, pa.int64()), (score, pa.int64()))], ["anchor", "window", "partner", "score"])

    asks = _asked(states, found, chunk_rows, anchors, negatives, again).withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int"))
    return asks.groupBy("chunk", "block").cogroup(rows.groupBy("chunk", "block")).applyInArrow(scored, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "partner"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def _search(states: DataFrame, found: Index, k: int, chunk_rows: int, anchors: int, negatives: bool) -> DataFrame:
    """(anchor, window, partner, score, rank): the first ``k`` partners in each window, in two rounds."""
    first = scratch.written(_best(_searched(states, found, k, chunk_rows, anchors, negatives, False), k))
    full = first.filter(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("worst"))
    worst = F.transform("windows", lambda w: F.struct(w["window"].alias("window"), w["least"].alias("least"), w["most"].alias("most"), F.try_element_at("worst", w["window"]).alias("worst")))
    states = scratch.written(states.join(full, "anchor", "left").withColumn("windows", worst).drop("worst"))
    rest = _searched(states, found, k, chunk_rows, anchors, negatives, True)
    return scratch.written(_best(first.drop("rank").unionByName(rest), k))


def hard_negatives(rows: DataFrame, anchors: Column, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, codewords: int = CODEWORDS, chunk_rows: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``rows`` (id, label, q) that ``anchors`` picks.

    A negative's score lies between ``least`` and ``most`` percent of the positive's.
    Chunks have up to twice ``chunk_rows`` rows; by default it grows with the table up to CHUNK_ROWS.
    """
    rows = scratch.written(rows)
    found = index(rows, codewords)
    chunk_rows = chunk_rows or int(min(CHUNK_ROWS, max(128, found.counts.sum() // 128)))
    every = F.array(F.struct(F.lit(0).alias("window"), F.lit(-(2**63)).alias("least"), F.lit(2**63 - 1).alias("most"), F.lit(None).cast("long").alias("worst")))
    chosen = scratch.written(rows.filter(anchors).distinct().withColumn("anchor", F.monotonically_increasing_id()))
    count = chosen.count()
    positives = _search(chosen.withColumn("windows", every), found, n_positives, chunk_rows, count, False)
    # Whole ends of a window: the scores s with least * p <= 100 * s <= most * p.
    p = F.col("score").cast("decimal(38,0)")
    low, high = F.ceil(p * least / 100).cast("long"), F.floor(p * most / 100).cast("long")
    window = F.struct(F.col("rank").alias("window"), low.alias("least"), high.alias("most"), F.lit(None).cast("long").alias("worst"))
    windows = positives.filter(low <= high).groupBy("anchor").agg(F.collect_list(window).alias("windows"))  # n_positives at most
    negatives = _search(chosen.join(windows, "anchor"), found, n_negatives, chunk_rows, count, True)
    out = negatives.join(positives.select("anchor", F.col("rank").alias("window"), F.col("partner").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor", "window"])
    return out.join(chosen.select("anchor", F.col("id").alias("anchor_id")), "anchor").select("anchor_id", "positive_id", "rank", F.col("partner").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
