"""SimHash fingerprints and exact near-duplicate groups through vantage-point trees.

Fingerprints are joined at a Hamming distance of ``max_bits`` or less. Their 64
bits are cut into ``n_blocks`` blocks: two fingerprints within ``max_bits``
differ by at most ``max_bits // n_blocks`` bits in one of the blocks at least,
and a block's distance obeys the triangle bound as the whole distance does. So
each block has its own vantage-point tree with that smaller radius. The upper
levels of a tree come from a bounded sample of fingerprints and make the shards
(leaves); each fingerprint lives in one leaf and is also sent to the leaves on
the right of it that the radius reaches. Inside a leaf the tree goes on, and
pairs are verified on all 64 bits. A leaf returns a spanning star of each
group found there, never its pairs, and the stars are merged in Spark.

The sample grows with the number of fingerprints up to a bound, and a leaf that
is still large goes on splitting in its task: by its block, and where all
fingerprints agree on that, by the other blocks.

Nulls and empty texts have the fingerprint zero and are linked as any other; very
long texts are taken whole. Repeated rows and ties link alike; an empty table
gives an empty result. Other columns don't matter, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import names, scratch

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
#: 8 MB of fingerprints at most shape the trees.
MOST_SAMPLED = 1 << 20


def _fingerprint(text: str, n_words: int) -> int:
    words = text.encode().lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[n_words - 1 :] or ends[-1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones, step = np.zeros(64, np.int64), 1 << 16
    for at in range(0, len(ends), step):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(begins[at : at + step], ends[at : at + step])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(ends), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, n_words: int = SHINGLE_WORDS) -> Column:
    """64-bit SimHash of the word shingles of a text, as a long."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([_fingerprint(t or "", n_words) for t in texts.to_pylist()], pa.int64())

    return of.asNondeterministic()(text)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def _split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and the radius that halves the points best; None if no point helps."""
    best = None
    for vantage in points[:: max(1, len(points) // 4)][:4]:
        counts = np.bincount(_distance(points, vantage), minlength=65).cumsum()
        radius = int(np.abs(counts - len(points) / 2).argmin())
        uneven = abs(int(counts[radius]) * 2 - len(points))
        if 0 < counts[radius] < len(points) and (best is None or uneven < best[0]):
            best = uneven, vantage, radius
    return best and best[1:]


def _tree(points: np.ndarray, leaf_points: int):
    """Nested (vantage point, radius, within, beyond) down to leaves, which are None."""
    if len(points) > leaf_points and (split := _split(points)):
        near = _distance(points, split[0]) <= split[1]
        return (*split, _tree(points[near], leaf_points), _tree(points[~near], leaf_points))
    return None


def _route(tree, points: np.ndarray, rows: np.ndarray, home: np.ndarray, reach: int, leaf: int = 1):
    """(leaf, rows, home flags) of each leaf that rows reach: their own, and those to its right within the radius."""
    if not len(rows):
        return
    if tree is None:
        yield leaf, rows, home
        return
    vantage, radius, within, beyond = tree
    d = _distance(points[rows], vantage)
    near = d <= radius
    left, right = near | (~home & (d - reach <= radius)), ~near | (d + reach > radius)
    yield from _route(within, points, rows[left], home[left], reach, leaf * 2)
    yield from _route(beyond, points, rows[right], home[right] & ~near[right], reach, leaf * 2 + 1)


def _matches(fps: np.ndarray, masks: list[np.uint64], block: int, homes: np.ndarray, queries: np.ndarray, reach: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (query, home) within ``max_bits`` that are within ``reach`` in a block: the tree goes on until few are left.

    Where all homes agree on the block, two fingerprints that match are within
    ``max_bits`` over the other blocks together, so they are near in one of those.
    """
    blocks = [fps & m for m in masks]
    todo = [(homes, queries, (block,), reach)]
    while todo:
        homes, queries, used, reach = todo.pop()
        if not len(homes) or not len(queries):
            continue
        if len(homes) > 256 and len(queries) > 64:
            bits = blocks[used[-1]]
            if split := _split(bits[homes]):
                dh, dq = _distance(bits[homes], split[0]), _distance(bits[queries], split[0])
                todo.append((homes[dh <= split[1]], queries[dq - reach <= split[1]], used, reach))
                todo.append((homes[dh > split[1]], queries[dq + reach > split[1]], used, reach))
                continue
            if others := [k for k in range(len(masks)) if k not in used]:
                todo += [(homes, queries, (*used, k), max_bits // len(others)) for k in others]
                continue
        for at in range(0, len(homes), 2048):
            part = homes[at : at + 2048]
            for to in range(0, len(queries), 512):
                q, h = np.nonzero(np.bitwise_count(fps[queries[to : to + 512], None] ^ fps[None, part]) <= max_bits)
                yield queries[to : to + 512][q], part[h]


def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the classes of a[i] and b[i]; ``parent`` holds each element's smallest member."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := parent[parent], parent):
            parent = up


def links(points: DataFrame, max_bits: int = MAX_BITS, n_blocks: int = 3, leaf_size: int = 4096, most_sampled: int = MOST_SAMPLED) -> DataFrame:
    """(a, b) nodes that connect all points (``node``, ``fp``; distinct fingerprints) within ``max_bits`` of each other.

    ``most_sampled`` bounds (nearly: twice as many at most, by hash) the fingerprints
    that shape the trees on the driver; below it there are sixteen for each leaf.
    """
    spark = points.sparkSession
    reach, width = max_bits // n_blocks, -(-64 // n_blocks)
    masks = [np.uint64(((1 << min(width, 64 - width * k)) - 1) << (width * k)) for k in range(n_blocks)]
    total = points.count()
    sample = min(most_sampled, max(65_536, 16 * total // leaf_size))
    # By hash, so that no task sends more than its share to the driver.
    share = F.pmod(F.xxhash64("fp"), F.lit(max(1, total // sample))) == 0
    some = np.sort(points.filter(share).select("fp").toPandas()["fp"].to_numpy(np.int64).view(np.uint64))
    leaf_points = max(8, int(leaf_size * len(some) / max(1, total)))
    trees = spark.sparkContext.broadcast([_tree(some & m, leaf_points) for m in masks])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp = (np.asarray(batch.column(k)) for k in ("node", "fp"))
            rows, home = np.arange(len(fp)), np.ones(len(fp), bool)
            for k, (mask, tree) in enumerate(zip(masks, trees.value)):
                for leaf, r, h in _route(tree, fp.view(np.uint64) & mask, rows, home, reach):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(r), k, np.int32), np.full(len(r), leaf, np.int64), node[r], fp[r], h)], ["block", "leaf", "node", "fp", "home"])

    def joined(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node, fps, home = np.asarray(table["node"]), np.asarray(table["fp"]).view(np.uint64), np.asarray(table["home"])
        parent = np.arange(len(node))
        for q, h in _matches(fps, masks, key[0].as_py(), np.flatnonzero(home), np.arange(len(node)), reach, max_bits):
            parent = merge(parent, q, h)
        out = np.flatnonzero(parent != np.arange(len(node)))
        return pa.table({"a": node[out], "b": node[parent[out]]})

    shards = points.select("node", "fp").mapInArrow(routed, "block int, leaf long, node long, fp long, home boolean")
    return shards.groupBy("block", "leaf").applyInArrow(joined, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches, by alternating star contraction."""
    edges = scratch.written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a != b").distinct()
        edges, before = scratch.written(small), edges
        scratch.discard(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, n_words: int = SHINGLE_WORDS, **tree) -> DataFrame:
    """(id, fingerprint, component_id) of every row; component_id is the smallest id reachable over links.

    Rows whose id is null don't link others; their component_id is that of the
    rows with the same fingerprint, or null if there is none with an id.
    """
    prints = scratch.written(docs.select(F.col(id_col).cast("long").alias("id"), fingerprint(F.col(text_col), n_words).alias("fp")))
    points = scratch.written(prints.filter("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("node")))
    classes = components(links(points, max_bits, **tree))
    of_print = points.join(classes, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(of_print, "fp", "left").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, n_words: int = SHINGLE_WORDS, null_ids: bool = False, **tree) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest id, then the smallest hash of its columns.

    Groups are of fingerprints, and rows are told apart by all their columns, so
    rows that share an id but not a group don't touch each other. Rows without
    an id stay, or with ``null_ids`` are in the groups too, after all ids.
    """
    hashed = [names.quoted(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    id_, row_ = names.fresh("id_", docs), names.fresh("row_", docs)
    keyed = docs.withColumns({id_: F.col(id_col).cast("long"), row_: F.xxhash64(*hashed, *[c.isNull() for c in hashed])})
    asked = keyed if null_ids else keyed.filter(F.col(id_).isNotNull())
    rows = scratch.written(asked.select(F.col(id_).alias("_id"), F.col(row_).alias("_row"), fingerprint(F.col(text_col), n_words).alias("fp")).groupBy("fp", "_id", "_row").agg(F.count("*").alias("n")))
    prints = scratch.written(rows.groupBy("fp").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("first")))
    classes = components(links(prints.select(F.col("fp").alias("node"), "fp"), max_bits, **tree))
    # A component's smallest node is in ``classes`` only as a component.
    classes = classes.unionByName(classes.select(F.col("component").alias("node"), "component").distinct())
    linked = scratch.written(prints.join(classes.withColumnRenamed("node", "fp"), "fp"))
    best = linked.groupBy("component").agg(F.min("first").alias("best"))
    of_print = prints.join(linked.join(best, "component").select("fp", "best"), "fp", "left").select("fp", F.coalesce("best", "first").alias("best"))
    kept = F.col("best._id").eqNullSafe(F.col("_id")) & (F.col("best._row") == F.col("_row"))
    special = scratch.written(rows.join(of_print, "fp").select("_id", "_row", "n", kept.alias("kept")).filter("NOT kept OR n > 1"))
    same = keyed[id_].eqNullSafe(special["_id"]) & (keyed[row_] == special["_row"])
    left = keyed.join(special.filter("NOT kept"), same, "left_anti")
    repeated = special.filter("kept")
    if not repeated.isEmpty():
        left = left.join(repeated, same, "left_anti").unionByName(keyed.join(repeated, same, "left_semi").dropDuplicates([id_, row_]))
    return left.select(names.columns(docs))
