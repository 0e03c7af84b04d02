"""Comparison of whole tables by trees of bucket digests.

Rows are dealt to buckets by a hash of their key. A bucket's digest is its number of
rows and sums of two 64-bit hashes of them, so digests add up: each level of the tree
is the sum of the one below, and the root stands for the table whatever order,
partitions or files its rows lie in. A tree is small (``FAN`` to the power of its
levels) and can be written beside a build, so that builds are compared without
reading the older one. Tables with equal roots are equal but for a chance far below
one in 2 to the power of 60; otherwise the descent goes only below nodes that differ,
and only rows of buckets that differ are joined.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.sources.writers import materialized

FAN, LEVELS = 16, 3
_LOW = (1 << 32) - 1
_SUMS = ["rows", "h0", "h1", "h2", "h3"]


def bucket_of(df: DataFrame, keys: list[str], levels: int = LEVELS) -> Column:
    """A row's leaf. Null keys have a leaf too."""
    return F.pmod(F.xxhash64(*_marked(df, keys)), F.lit(FAN**levels))


def _marked(df: DataFrame, columns: list[str]) -> list[Column]:
    """Columns with a mark of their nulls, which a hash would pass over; nested values as JSON, for the same reason."""
    nested = {c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))}
    return [x for c in columns for x in (F.col(c).isNull(), F.to_json(c) if c in nested else F.col(c))]


def digest_tree(df: DataFrame, keys: list[str], values: list[str] | None = None, levels: int = LEVELS) -> DataFrame:
    """(level, node, rows, h0..h3): digests of every node, the root at level 0; one aggregate over the rows. An empty table has no nodes.

    ``values`` are the columns compared beside the keys: all others if none are given.
    """
    values = sorted(c for c in df.columns if c not in keys) if values is None else values
    marked = _marked(df, [*keys, *values])
    hashed = df.select(bucket_of(df, keys, levels).alias("node"), *[F.xxhash64(F.lit(seed), *marked).alias(f"_{seed}") for seed in (0, 1)])
    # Halves of the hashes, whose sums don't overflow below two billion rows a leaf; the digest is the sums' lower half.
    halves = [x for s in ("_0", "_1") for x in (F.col(s).bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(F.col(s), 32))]
    leaves = hashed.groupBy("node").agg(F.count("*").alias("rows"), *[F.sum(h).bitwiseAND(F.lit(_LOW)).alias(f"h{k}") for k, h in enumerate(halves)])
    # Each leaf counts in all its ancestors: as many rows as leaves and levels.
    above = F.array(*[F.struct(F.lit(level).alias("level"), F.floor(F.col("node") / FAN ** (levels - level)).cast("long").alias("node")) for level in range(levels + 1)])
    held = leaves.withColumn("_at", F.explode(above)).select(F.col("_at.level").alias("level"), F.col("_at.node").alias("node"), *_SUMS)
    return held.groupBy("level", "node").agg(*[F.sum(s).alias(s) for s in _SUMS])


def differing(a: DataFrame, b: DataFrame, level: int) -> DataFrame:
    """(node): nodes of a level whose digests differ or that one tree lacks. Nothing is joined."""
    both = a.select("level", "node", *_SUMS).unionByName(b.select("level", "node", *_SUMS)).filter(F.col("level") == level)
    ends = [x for s in _SUMS for x in (F.min(s).alias(f"_min_{s}"), F.max(s).alias(f"_max_{s}"))]
    unequal = reduce(or_, [F.col(f"_min_{s}") != F.col(f"_max_{s}") for s in _SUMS])
    return both.groupBy("node").agg(F.count("*").alias("_n"), *ends).filter((F.col("_n") < 2) | unequal).select("node")


def same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two trees have equal roots; two empty tables are equal."""
    return not differing(a, b, 0).take(1)


def differing_leaves(a: DataFrame, b: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(node): leaves that differ, found from the root down; a node is looked at only below one that differs."""
    nodes = differing(a, b, 0)
    for level in range(1, levels + 1):
        # Nodes of a level are at most FAN ** level rows of one number.
        parents = F.broadcast(nodes.select(F.col("node").alias("_parent")))
        below = lambda t: t.filter(F.col("level") == level).join(parents, F.floor(F.col("node") / FAN) == F.col("_parent"), "left_semi")  # noqa: E731, B023
        nodes = differing(below(a), below(b), level)
    return nodes


def unequal_rows(a: DataFrame, b: DataFrame, keys: list[str], values: list[str], levels: int = LEVELS, trees: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame] | None:
    """Rows of either table in buckets that differ; none if the tables are equal.

    ``trees`` are digests made before of the same keys and values, written for choice;
    without them both tables are read once for their digests.
    """
    if not 1 <= levels <= 5:
        raise ValueError("a tree has one to five levels")
    tree = lambda df: materialized(digest_tree(df, keys, values, levels))
    ta, tb = trees or (tree(a), tree(b))
    if same(ta, tb):
        return None
    leaves = F.broadcast(materialized(differing_leaves(ta, tb, levels)).withColumnRenamed("node", "_leaf"))  # at most FAN ** levels numbers
    held = lambda df: df.join(leaves, bucket_of(df, keys, levels) == F.col("_leaf"), "left_semi")
    return held(a), held(b)
