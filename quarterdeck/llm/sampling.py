"""Bounded training samples of labelled rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``: the folds of held-out rows."""
    return F.crc32(id_col.cast("string").cast("binary")) % by


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, fold: Column, bound: int, id_col: str = "doc_id", into: str = "_label") -> DataFrame:
    """At most ``bound`` labelled rows of ``docs`` in the fold, the same ones in each run, with the label in ``into``.

    ``fold`` is a condition on the id. Rows without a label or an id don't count.
    ``into`` must be a name that ``docs`` lacks (``names.fresh``); other columns of
    either table don't matter.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & fold)
    some = known.groupBy(id_col).agg(F.max(label_col).alias(into))
    # The smallest hashes: about four times the bound at most meet in the task that sorts.
    n = some.count()
    if n > 4 * bound:
        some = some.filter(F.xxhash64(id_col) < F.lit(int(2**64 * (4 * bound / n) - 2**63)))
    some = some.orderBy(F.xxhash64(id_col), id_col).limit(bound)
    return docs.join(F.broadcast(some), id_col)
