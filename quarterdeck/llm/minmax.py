"""Near-duplicate documents by min-max hashing, with links confirmed on full shingle sets.

Each of ``PERMUTATIONS`` permutations of the shingles' hashes gives two values of
a signature: its minimum and its maximum over the document's set. Either of them
agrees between two sets with a probability equal to their Jaccard similarity, so
one hash evaluation serves two rows. ``BANDS`` bands of four values, two minima and
two maxima of other permutations each, are the buckets; at a similarity of 0.8 all
of them miss with a probability of (1 - 0.8**4) ** 32 = 5e-8, and less above.

Equal sets are one node. Buckets are never expanded into pairs. Each bucket is
named after its smallest node, its lead, and the nodes that meet under a lead are
confirmed in two rounds:

* against the lead alone, which is linear and gathers most of each group;
* where a bucket still holds nodes of more than one class, those outside the
  lead's class against all others under the lead, in blocks of bounded size, so
  that no link between different texts is lost and no task gets a large group.

Both rounds compare whole sets, rebuilt from whole texts.

Null texts, and those without a word, have an empty set that is linked with
nothing; fewer words than a shingle are one shingle. Very long texts are taken
whole. Repeated rows are copies. A row without an id is in its class but names no
class; where no row of its class has an id, the class is null and the row isn't
kept. An empty table gives an empty result. Other columns don't matter, whatever
their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import scratch, simhash, text

SHINGLE_WORDS = 4
PERCENT = 80
PERMUTATIONS = 64
BANDS = 32
#: Nodes and bytes of text on each side of a block.
STAR_NODES, BLOCK_NODES, BLOCK_BYTES = 128, 256, 4 << 20

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
_PLACES = _rng.integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, n_words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of each text, sorted, one text after another; and where each text begins."""
    data, bounds = text.raw(texts)
    data = text.LOWER[data]
    begins, ends, firsts = text.words(data, bounds)
    words = text.hashes(data, begins, ends)
    places = [_PLACES[k % len(_PLACES)] + np.uint64(k) for k in range(n_words)]
    long = np.zeros(max(0, len(words) - n_words + 1), np.uint64)
    for k, place in enumerate(places):
        long += words[k : k + len(long)] * place
    long = text.mix(long)
    sets = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= n_words:
            sets.append(np.unique(long[a : b - n_words + 1]))
        elif b > a:  # the whole sequence, told from shingles by its length
            sets.append(text.mix(np.array([sum(int(w) * int(p) for w, p in zip(words[a:b], places)) + b - a & 0xFFFFFFFFFFFFFFFF], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.cumsum([0, *map(len, sets)])


def signatures(sets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of each set (none may be empty) under each permutation."""
    low, high = (np.empty((PERMUTATIONS, len(starts) - 1), np.uint64) for _ in range(2))
    for k in range(PERMUTATIONS):
        v = sets * _FACTORS[k] + _SHIFTS[k]
        low[k], high[k] = np.minimum.reduceat(v, starts[:-1]), np.maximum.reduceat(v, starts[:-1])
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band and set."""
    keys, half = [], PERMUTATIONS // 2
    for j in range(BANDS):
        rows = [(low, 2 * j), (low, 2 * j + 1), (high, 2 * j + half), (high, 2 * j + half + 1)]
        key = np.full(low.shape[1], j, np.uint64)
        for values, k in rows:
            key = text.mix(key * text.BASE + values[k % PERMUTATIONS])
        keys.append(key)
    return np.array(keys)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, h, n, k1, k2, b0, b1, ...) of each row: hash of the text, size and 128-bit digest of the set, keys of its bands."""
    names = ["id", "h", "n", "k1", "k2", *[f"b{j}" for j in range(BANDS)]]

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts = batch.columns
            for a, b in text.slices(texts):
                sets, starts = shingle_sets(texts.slice(a, b - a), n_words)
                sizes = np.diff(starts)
                some = np.flatnonzero(sizes)
                digest, keys = np.zeros((2, b - a), np.uint64), np.zeros((BANDS, b - a), np.uint64)
                if len(some):
                    at = np.append(starts[some], len(sets))
                    digest[:, some] = [np.add.reduceat(text.mix(sets * f), at[:-1]) for f in _PLACES[-2:]]
                    keys[:, some] = band_keys(*signatures(sets, at))
                arrays = [ids.slice(a, b - a), hashes.slice(a, b - a), pa.array(sizes, pa.int64()), *[pa.array(x.view(np.int64)) for x in (*digest, *keys)]]
                yield pa.RecordBatch.from_arrays(arrays, names)

    given = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(sketched, ", ".join(f"{c} long" for c in names))


def _nodes(sketch: DataFrame) -> DataFrame:
    """One row of each distinct set: its smallest id, the hash of a text that has it, the keys of its bands."""
    keys = [f"b{j}" for j in range(BANDS)]
    first = F.coalesce(F.min_by("h", "id"), F.min("h")).alias("h")
    sets = sketch.filter("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("id"), first, *[F.min(k).alias(k) for k in keys])
    return sets.withColumn("node", F.monotonically_increasing_id())


def _members(nodes: DataFrame) -> DataFrame:
    """(key, node, lead) of buckets with more than one node; the lead is the smallest."""
    rows = nodes.select("node", F.explode(F.array(*[f"b{j}" for j in range(BANDS)])).alias("key"))
    leads = rows.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead < last")
    return rows.join(leads.select("key", "lead"), "key").select("key", "node", "lead")


def _texts(docs: DataFrame, nodes: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text, size) of the nodes that share a bucket."""
    shared = members.select("node").distinct()
    wanted = nodes.select("node", "id", "h").join(shared, "node", "left_semi").select("node", F.col("id").alias("_id"), F.col("h").alias("_h"))
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("string").alias("text"))
    found = given.join(wanted, (F.col("h") == F.col("_h")) & F.col("id").eqNullSafe(F.col("_id")))
    return found.select("node", "text", F.octet_length("text").cast("long").alias("size"))


def _linked(inter: np.ndarray, a, b, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (a + b - inter)


def _star_links(pairs: DataFrame, texts: DataFrame, n_words: int, percent: int) -> DataFrame:
    """(a, b): nodes and the leads (``pairs``: node, lead) that they link to."""
    sizes = pairs.join(texts.select("node", "size"), "node").groupBy("lead").agg(F.count("*").alias("count"), F.sum("size").alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("count") / STAR_NODES, F.col("bytes") / BLOCK_BYTES))
    leads = scratch.written(sizes.select("lead", blocks.alias("blocks")))
    dealt = pairs.join(leads, "lead").select("lead", F.pmod(F.xxhash64("node"), "blocks").alias("block"), "node")
    own = leads.select("lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("lead").alias("node"))

    def confirmed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node = np.asarray(table["node"])
        sets, starts = shingle_sets(table["text"].combine_chunks(), n_words)
        lead = int(np.flatnonzero(node == key[0].as_py())[0])
        held = sets[starts[lead] : starts[lead + 1]]
        inside = held[np.minimum(np.searchsorted(held, sets), len(held) - 1)] == sets
        found = _linked(np.add.reduceat(inside, starts[:-1], dtype=np.int64), np.diff(starts), len(held), percent) & (node != node[lead])
        return pa.table({"a": node[found], "b": np.full(int(found.sum()), node[lead], np.int64)})

    return dealt.union(own).join(texts.select("node", "text"), "node").groupBy("lead", "block").applyInArrow(confirmed, "a long, b long")


def _block_links(members: DataFrame, classes: DataFrame, texts: DataFrame, n_words: int, percent: int) -> DataFrame:
    """(a, b): links between classes in buckets that hold more than one class."""
    classed = scratch.written(members.join(classes, "node", "left").select("key", "lead", "node", F.coalesce("component", "node").alias("class")))
    open_ = classed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    rows = classed.join(open_.select("key"), "key", "left_semi").select("lead", "node", "class").distinct()
    own = classed.filter("lead = node").select("lead", F.col("class").alias("lead_class")).distinct()
    rows = rows.join(own, "lead").join(texts.select("node", "size"), "node")
    rows = scratch.written(rows.select("lead", "node", "class", "size", (F.col("class") != F.col("lead_class")).alias("outside")))
    total = lambda c, side: F.sum(F.when(F.col("outside") == side, c).otherwise(0))
    n = lambda side: F.greatest(F.lit(1), F.ceil(F.greatest(total(F.lit(1), side) / BLOCK_NODES, total(F.col("size"), side) / BLOCK_BYTES))).cast("long")
    # Written, so that Spark can split a lead with many nodes where it joins them.
    blocks = scratch.written(rows.groupBy("lead").agg(n(False).alias("n_in"), n(True).alias("n_out")))
    upto = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
    zero, at = F.lit(0).cast("long"), F.pmod(F.xxhash64("node"), F.when(F.col("outside"), F.col("n_out")).otherwise(F.col("n_in")))
    # A block inside the lead's class meets each block outside; blocks outside meet each other too.
    meets = F.when(~F.col("outside"), F.transform(upto(zero, F.col("n_out") - 1), lambda o: F.struct(F.col("at").alias("x"), o.alias("y")))).otherwise(
        F.concat(
            F.transform(upto(zero, F.col("n_in") + F.col("at") - 1), lambda x: F.struct(x.alias("x"), F.col("at").alias("y"))),
            F.transform(upto(F.col("at") + 1, F.col("n_out") - 1), lambda o: F.struct((F.col("n_in") + F.col("at")).alias("x"), o.alias("y"))),
        )
    )
    dealt = rows.join(blocks, "lead").withColumn("at", at).select("lead", "node", "class", F.explode(meets).alias("meet")).select("lead", "node", "class", "meet.x", "meet.y")

    def confirmed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node, label = np.asarray(table["node"]), np.unique(np.asarray(table["class"]), return_inverse=True)[1]
        parent = np.arange(len(node))
        if label.max(initial=0):
            sets, starts = shingle_sets(table["text"].combine_chunks(), n_words)
            universe, ids = np.unique(sets, return_inverse=True)
            sizes, held = np.diff(starts), np.zeros(len(universe), bool)
            most = np.bincount(label).argmax()
            for q in np.flatnonzero(label != most):
                held[ids[starts[q] : starts[q + 1]]] = True
                found = _linked(np.add.reduceat(held[ids], starts[:-1], dtype=np.int64), sizes, sizes[q], percent) & (label != label[q])
                held[ids[starts[q] : starts[q + 1]]] = False
                others = np.flatnonzero(found)
                parent = simhash.merge(parent, np.full(len(others), q), others)
        out = np.flatnonzero(parent != np.arange(len(node)))
        return pa.table({"a": node[out], "b": node[parent[out]]})

    return dealt.join(texts.select("node", "text"), "node").groupBy("lead", "x", "y").applyInArrow(confirmed, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; component_id is the smallest id reachable over links of at least ``percent``."""
    sketch = scratch.written(sketches(docs, id_col, text_col, n_words))
    nodes = scratch.written(_nodes(sketch))
    members = scratch.written(_members(nodes))
    texts = scratch.written(_texts(docs, nodes, members, id_col, text_col))
    stars = scratch.written(_star_links(scratch.written(members.filter("node != lead").select("lead", "node").distinct()), texts, n_words, percent))
    blocks = _block_links(members, simhash.components(stars), texts, n_words, percent)
    classes = simhash.components(stars.union(blocks))
    named = nodes.select("k1", "k2", "id", "node").join(classes, "node", "left").withColumn("class", F.coalesce("component", "node"))
    lowest = named.groupBy("class").agg(F.min("id").alias("component_id"))
    of_set = named.join(lowest, "class").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "component_id")
    same = (F.col("n") > 0) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    out = sketch.select("id", "n", "k1", "k2").join(of_set, same, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
