"""Benchmark decontamination with an FM-index per training shard.

A shard is the batch of documents that a task holds at a time. Its words are
numbered once and then mapped to the benchmark's vocabulary. A window can occur
only where all its pairs of neighbours do, so runs end at words outside the
vocabulary and between words that are no neighbours in the benchmark, runs too
short for any window go, and so do windows with a pair that the shard lacks; all
of that is exact. The shard's index is the Burrows-Wheeler transform of what is
left in a wavelet matrix, with a bit for each suffix whose position is kept: each
run's first word and every ``SAMPLE`` words. The windows left are searched
backwards at once; occurrences are located by walking to a kept position, and
overlapping spans are merged for each document.

The benchmark goes through the driver in blocks of at most ``block_bytes`` of
text, as word ids and the places where windows begin. A pass over the documents
has up to ``PASS_BLOCKS`` of them, so memory doesn't grow with the benchmark, and
only for what is beyond them are the documents written and read again.

Null and empty texts have no words; a document longer than a shard is a shard of
its own. Benchmark items without words are ignored; an item without an id counts
for hits and is left out of the list of items; repeated items all count; repeated
documents are each reported. With an empty benchmark nothing is hit; an empty
table gives an empty result. A column that has the result's name (``into``) is
replaced; other columns stay, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import names, scratch
from quarterdeck.llm import text as bytes_of
from quarterdeck.llm.wavelet import Plane, WaveletMatrix

WINDOW = 13
SAMPLE = 8
BLOCK_BYTES = 16 << 20
PASS_BLOCKS = 4
#: ASCII letters in lower case; every ASCII character that is no letter or digit becomes a space.
FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())


def tokens(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


class Phrases:
    """Distinct windows of the benchmark as places in a sequence of word ids, with the items that have them."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.words: dict[bytes, int] = {}
        self.items: list[str | None] = []
        self.window = window
        ids, begins, lengths, owner, lasts, held = [], [], [], [], [], window
        for item, text in items:
            mine = [self.words.setdefault(w, len(self.words) + 1) for w in tokens(text)]
            if mine:
                n = max(1, len(mine) - window + 1)
                ids.append(np.array(mine, np.int32))
                begins.append(np.arange(held, held + n))
                lengths.append(np.full(n, min(window, len(mine))))
                owner.append(np.full(n, len(self.items)))
                self.items.append(item)
                held += len(mine)
                lasts.append(held - 1)
        join = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
        # Zeros before and after, so that every window has a whole row of places to look at.
        self.ids = np.concatenate([np.zeros(window, np.int32), *ids, np.zeros(window, np.int32)])
        begins, lengths, owner = join(begins), join(lengths), join(owner)
        which, first = self._same(begins, lengths)
        self.begins, self.lengths = begins[first].astype(np.int32), lengths[first].astype(np.int32)
        order = np.argsort(which, kind="stable")
        self.owner, self.owned = owner[order].astype(np.int32), np.searchsorted(which[order], np.arange(len(first) + 1)).astype(np.int32)
        # Neighbours within items: their codes in order, and the number of each place's own pair (the last number for none).
        codes = self.code(self.ids[:-1], self.ids[1:])
        inside = (self.ids[:-1] > 0) & (self.ids[1:] > 0)
        inside[lasts] = False
        self.pairs, number = np.unique(codes[inside], return_inverse=True)
        self.pair = np.full(len(codes), len(self.pairs), np.int32)
        self.pair[inside] = number

    def code(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One number for a pair of word ids."""
        return a.astype(np.int64) * (len(self.words) + 1) + b

    def possible(self, symbols: np.ndarray, neighbours: np.ndarray) -> np.ndarray:
        """Windows whose first word is among the symbols and whose pairs are all among the neighbours (numbers of pairs)."""
        word, pair = np.zeros(len(self.words) + 1, bool), np.zeros(len(self.pairs) + 1, bool)
        word[symbols], pair[neighbours] = True, True
        upto = np.concatenate([[0], np.cumsum(pair[self.pair], dtype=np.int32)])
        all_pairs = upto[self.begins + self.lengths - 1] - upto[self.begins] == self.lengths - 1
        return np.flatnonzero(all_pairs & word[self.ids[self.begins]])

    def _same(self, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each window's words, equal for equal windows, and the first window of each number: built word by word, so it is exact."""
        which = np.zeros(len(begins), np.int64)
        for back in range(1, self.window + 1):
            which = np.unique(which * (len(self.words) + 1) + self.word(begins, lengths, back), return_inverse=True)[1]
        return which, np.unique(which, return_index=True)[1]

    def word(self, begins: np.ndarray, lengths: np.ndarray, back: int) -> np.ndarray:
        """The ``back``-th word from the end of each window, 0 if it has fewer."""
        return np.where(back <= lengths, self.ids[begins + lengths - back], 0)

    def pairs_of(self, windows: np.ndarray) -> np.ndarray:
        """For each pair whether it is in one of the windows."""
        change = np.zeros(len(self.ids) + 1, np.int32)
        np.add.at(change, self.begins[windows], 1)
        np.add.at(change, self.begins[windows] + self.lengths[windows] - 1, -1)
        held = np.zeros(len(self.pairs) + 1, bool)
        held[self.pair[np.cumsum(change)[: len(self.pair)] > 0]] = True
        return held


class FMIndex:
    """Index of a sequence of word ids; 0 separates runs and is never searched."""

    def __init__(self, text: np.ndarray, n_words: int):
        n, gaps = len(text), np.flatnonzero(text == 0)
        # Separators differ from each other, so sorting ends once 2**k covers the longest run.
        rank = text + len(gaps)
        rank[gaps] = np.arange(len(gaps))
        k = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: max(0, n - k)] = rank[k:] + 1
            order = np.lexsort((after, rank))
            fresh = np.ones(n, np.int64)
            fresh[0] = 0
            fresh[1:] = (rank[order[1:]] != rank[order[:-1]]) | (after[order[1:]] != after[order[:-1]])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh)
            k *= 2
            if n == 0 or rank[order[-1]] == n - 1:
                break
        self.n = n
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_words + 1))])
        self.bwt = WaveletMatrix.of(text[order - 1].astype(np.uint32), max(1, int(n_words).bit_length()))
        sampled = (order % SAMPLE == 0) | (text[order - 1] == 0)
        self.sampled, self.position = Plane.of(sampled), order[sampled]

    def search(self, phrases: Phrases, windows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each of the windows (all, if none are named); empty where none does."""
        begins, lengths = (phrases.begins, phrases.lengths) if windows is None else (phrases.begins[windows], phrases.lengths[windows])
        n = len(begins)
        low, high = np.zeros(n, np.int64), np.full(n, self.n, np.int64)
        live = np.arange(n)
        for back in range(1, phrases.window + 1):
            live = live[(back <= lengths[live]) & (high[live] > low[live])]
            c = phrases.word(begins[live], lengths[live], back)
            low[live] = self.first[c] + self.bwt.rank(c, low[live])
            high[live] = self.first[c] + self.bwt.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        steps, out, left = np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64), np.arange(len(rows))
        rows = rows.copy()
        while len(left):
            kept = self.sampled.get(rows[left]).astype(bool)
            here = left[kept]
            out[here] = self.position[self.sampled.rank1(rows[here])] + steps[here]
            left = left[~kept]
            word, before = self.bwt.access_rank(rows[left])
            rows[left] = self.first[word] + before
            steps[left] += 1
        return out


def _expand(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every integer of each range, and the range it is of."""
    sizes = np.maximum(ends - begins, 0)
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[of], of


def _union(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch become one."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate([[True], begins[1:] > reach[:-1]])[: len(begins)])
    return begins[new], reach[np.append(new[1:], len(reach)) - 1] if len(new) else reach


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


class Shard:
    """Some documents, their words numbered once, and what the blocks of the benchmark hit in them."""

    def __init__(self, texts: list[str | None], only: Phrases | None = None):
        """With an ``only`` block, its own word ids are the numbers, and other words have none."""
        self.words = only.words if only else _Numbers()
        found, get = map(tokens, texts), self.words.get
        if only:
            ids = [np.array([get(w, 0) for w in mine], np.int32) for mine in found]
        else:
            ids = [np.fromiter(map(self.words.__getitem__, mine), np.int32, len(mine)) for mine in found]
        self.counts = np.array([len(w) for w in ids], np.int64)
        # One separator before each document, and one at the end.
        self.base = np.concatenate([[0], np.cumsum(self.counts + 1)])
        self.numbers = np.zeros(self.base[-1] + 1, np.int32)
        for b, w in zip(self.base.tolist(), ids):
            self.numbers[b + 1 : b + 1 + len(w)] = w
        self.hits, self.items = [], [set() for _ in texts]

    def look_for(self, phrases: Phrases) -> None:
        get = phrases.words.get
        symbols = self.numbers
        if self.words is not phrases.words:
            known = np.fromiter((get(w, 0) for w in self.words), np.int32, len(self.words))
            symbols = np.concatenate([np.zeros(1, np.int32), known])[symbols]
        if not symbols.any():
            return
        # A run goes on while its neighbours are neighbours in the benchmark.
        joined = (symbols[:-1] > 0) & (symbols[1:] > 0)
        codes, number = np.unique(phrases.code(symbols[:-1][joined], symbols[1:][joined]), return_inverse=True)
        at = np.searchsorted(phrases.pairs, codes)
        pair = np.full(len(joined), len(phrases.pairs))
        pair[joined] = np.where(np.append(phrases.pairs, -1)[at] == codes, at, len(phrases.pairs))[number]
        joined = pair < len(phrases.pairs)
        windows = np.arange(len(phrases.begins))
        # Fewer windows leave fewer pairs and shorter runs, and these fewer windows, until little more goes.
        while len(windows):
            begins = np.flatnonzero((symbols > 0) & ~np.concatenate([[False], joined]))
            ends = np.flatnonzero((symbols > 0) & ~np.append(joined, False)) + 1
            long = ends - begins >= phrases.lengths[windows].min()
            begins, ends = begins[long], ends[long]
            inside = np.zeros(len(symbols), bool)
            inside[_expand(begins, ends)[0]] = True
            joined &= inside[:-1]
            before, windows = len(windows), phrases.possible(symbols[inside], pair[joined])
            if 10 * len(windows) > 9 * before:
                break
            joined &= phrases.pairs_of(windows)[pair]
        if not len(windows):
            return
        # Each run with a separator before it, and one more separator at the end.
        at, _ = _expand(begins - 1, ends)
        at = np.append(at, len(symbols) - 1)
        text = symbols[at].astype(np.int64)
        sizes = ends - begins + 1
        text[np.cumsum(sizes) - sizes] = 0
        index = FMIndex(text, len(phrases.words))
        low, high = index.search(phrases, windows)
        rows, which = _expand(low, high)
        if not len(rows):
            return
        window = windows[which]
        begins = at[index.locate(rows)]
        self.hits.append(_union(begins, begins + phrases.lengths[window]))
        doc = np.searchsorted(self.base, begins, side="right") - 1
        pairs = np.unique(np.stack([doc, window], 1), axis=0)
        own, which = _expand(phrases.owned[pairs[:, 1]], phrases.owned[pairs[:, 1] + 1])
        for d, k in np.unique(np.stack([pairs[which, 0], phrases.owner[own]], 1), axis=0).tolist():
            self.items[d].add(phrases.items[k])

    def found(self) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
        """For each text its number of words, the merged (begin, end) spans of words that are hit, and the items found."""
        spans = [[] for _ in self.items]
        if self.hits:
            begins, ends = _union(*map(np.concatenate, zip(*self.hits)))
            doc = np.searchsorted(self.base, begins, side="right") - 1
            first = self.base[doc] + 1
            for d, b, e in zip(doc.tolist(), (begins - first).tolist(), (ends - first).tolist()):
                spans[d].append((b, e))
        return self.counts.tolist(), spans, [sorted(x - {None}) for x in self.items]


def scan(texts: list[str | None], *blocks: Phrases) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
    """What the blocks hit in a shard of these texts (``Shard.found``)."""
    shard = Shard(texts, blocks[0] if len(blocks) == 1 else None)
    for phrases in blocks:
        shard.look_for(phrases)
    return shard.found()


RESULT = "struct<n_words:long,spans:array<struct<begin:long,end:long>>,items:array<string>>"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _scanned(text: Column, blocks: list, shard_bytes: int) -> Column:
    @F.arrow_udf(RESULT)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            counts, spans, items = [], [], []
            # A document longer than a shard is a shard of its own.
            for a, b in bytes_of.slices(texts, shard_bytes):
                n, s, i = scan(texts[a:b].to_pylist(), *(block.value for block in blocks))
                counts, spans, items = counts + n, spans + s, items + i
            spans = pa.array([[{"begin": b, "end": e} for b, e in s] for s in spans], _SPANS)
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), spans, pa.array(items, pa.list_(pa.string()))], ["n_words", "spans", "items"])

    return of.asNondeterministic()(text)


def _merged(a: Column, b: Column) -> Column:
    """Spans of two passes as one list."""

    @F.arrow_udf("array<struct<begin:long,end:long>>")
    def of(x: pa.Array, y: pa.Array) -> pa.Array:
        doc, begins, ends = (np.concatenate(both) for both in zip(*((np.asarray(pc.list_parent_indices(z)), *(np.asarray(part) for part in pc.list_flatten(z).flatten())) for z in (x, y))))
        # Rows lie so far apart that spans of two never touch.
        apart = int(ends.max(initial=0)) + 2
        begins, ends = _union(doc * apart + begins, doc * apart + ends)
        doc = begins // apart
        spans = pa.StructArray.from_arrays([pa.array(begins - doc * apart), pa.array(ends - doc * apart)], ["begin", "end"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(x) + 1)), pa.int32()), spans)

    return of(a, b)


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shard_bytes: int = 8 << 20, block_bytes: int = BLOCK_BYTES, into: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, spans (merged, in words), items (sorted as strings), n_hit."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    n_blocks = -(-items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0] // block_bytes) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks))
    found, new = names.fresh("found", docs), names.fresh("new", docs)
    out = docs
    for k in range(0, n_blocks, PASS_BLOCKS):
        blocks = [spark.sparkContext.broadcast(Phrases([(r.item, r.text) for r in items.filter(part == j).toLocalIterator()], window)) for j in range(k, min(k + PASS_BLOCKS, n_blocks))]
        scanned = out.withColumn(new, _scanned(F.col(text_col), blocks, shard_bytes))
        if k:
            a, b = F.col(found), F.col(new)
            both = F.struct(a["n_words"].alias("n_words"), _merged(a["spans"], b["spans"]).alias("spans"), F.array_sort(F.array_union(a["items"], b["items"])).alias("items"))
            out, before = scanned.withColumn(found, both).drop(new), out
        else:
            out, before = scanned.withColumnRenamed(new, found), None
        if k + PASS_BLOCKS < n_blocks:
            # The blocks of one pass at a time in the workers' memory.
            out = scratch.written(out)
            for block in blocks:
                block.destroy()
            if before is not None:
                scratch.discard(before)
    n_hit = F.aggregate(F.col(found)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return out.withColumn(into, F.col(found).withField("n_hit", n_hit)).drop(found)


def contaminated(into: str = "contamination", per: int = 20) -> Column:
    """At least one word in ``per`` is hit."""
    return (F.col(f"{into}.n_hit") > 0) & (per * F.col(f"{into}.n_hit") >= F.col(f"{into}.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones; the others are left as they are."""
    into = names.fresh("contamination", docs)
    return contamination(docs, benchmark, into=into, **options).filter(~contaminated(into)).select(names.columns(docs))
