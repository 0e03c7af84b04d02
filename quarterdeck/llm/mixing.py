"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source_size`` copies. The
expected copies are summed in a fixed order within the source, one random
offset (a hash of the source and the seed) is added, and a document is emitted
once for each integer boundary that its interval crosses. The order goes by
size class first, so that each size class is drawn at the source's rate and
the words taken come near the target. The running sum is built from counts per
(source, size class, hash slot), so no source has to fit in one task. All sums
are whole numbers: reruns agree under any partitioning.

Null text has size 0, a null source is a source of its own (the last), repeated
rows are each a document, an empty table gives an empty result; of a very long
text only the number of words counts. Other columns stay in the mix, whatever
their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm import names, scratch

#: Weights of the sources in order of their code points, repeating; nulls come last.
WEIGHTS = (5, 2, 1)
CAP = 3
SLOTS = 64


def n_words(text: Column) -> Column:
    """Runs of characters other than the six ASCII white spaces; 0 for null."""
    flat = F.translate(text, "\t\n\x0b\x0c\r", " " * 5)
    return F.coalesce(F.size(F.filter(F.split(flat, " +"), lambda w: w != "")), F.lit(0)).cast("long")


def hash32(*columns: Column) -> Column:
    """32 bits that other engines compute alike."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *columns)), 1, 8), 16, 10).cast("long")


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of two decimals without fractions, as a long."""
    return F.call_function("div", a, b)


def targets(sizes: DataFrame, source_col: str = "source", weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target): all words shared by weight, none above ``cap`` times its source.

    A source is stopped at its cap if its fair share exceeds it; in the order of
    cap per weight, the stopped ones come first, so running sums tell where
    sharing starts. ``sizes`` has one row per source.
    """
    by_name = Window.orderBy(F.col(source_col).asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    sources = sizes.withColumn("weight", weight.cast("long")).withColumn("most", cap * F.col("source_size"))
    fill = Window.orderBy((F.col("most").cast("double") / F.col("weight")).asc(), F.col(source_col).asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    shared = (
        sources.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("free", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("fits", F.col("most") * F.col("free") >= F.col("left") * F.col("weight"))
        # From the first source that fits, all fit, and share what was left there.
        .withColumn("level", F.first(F.when(F.col("fits"), F.struct("left", "free")), ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, 0)))
    )
    target = F.when(F.col("level").isNull(), F.col("most").cast("double")).otherwise((F.col("level.left") * F.col("weight")).cast("double") / F.col("level.free").cast("double"))
    return shared.select(source_col, "source_size", target.alias("target"), F.coalesce(F.col("level.left") * F.col("weight"), F.col("most")).alias("num"), F.coalesce(F.col("level.free"), F.lit(1)).alias("den"))


def copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 0, weights=WEIGHTS, cap: int = CAP, slots: int = SLOTS, carry: bool = False) -> DataFrame:
    """(id, source, size, source_size, target, copies) of every row of ``docs``: how often the mix has it.

    With ``carry``, the row itself is in a struct column ``row``.
    """
    named = [F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")]
    place = {"class": F.floor(F.sqrt("size")).cast("int"), "slot": F.pmod(hash32(F.col("id").cast("string")), F.lit(slots))}
    # Words are counted once; what is kept has no texts.
    sizes = sized = scratch.written(docs.select(*named)).withColumns(place)
    if carry:
        sized = docs.select(F.struct(*names.columns(docs)).alias("row"), *named).withColumns(place)
    cells = sizes.groupBy("source", "class", "slot").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    goal = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), "source", weights, cap)
    run = Window.partitionBy("source").orderBy("class", "slot").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col("source").alias("s"), F.col("class").alias("c"), F.col("slot").alias("k"), F.coalesce(F.sum("n").over(run), F.lit(0)).alias("before"))
    cells = cells.join(goal.withColumnRenamed("source", "g"), F.expr("s <=> g"))
    within = Window.partitionBy("source", "class", "slot").orderBy("size", F.col("id").asc_nulls_last())
    placed = sized.withColumn("rank", F.row_number().over(within)).join(cells, F.expr("source <=> s AND class = c AND slot = k"))
    # The k-th document's interval ends at k * num / unit plus the offset, a share of 2**32; all in whole numbers.
    unit = F.col("den").cast("decimal(19,0)") * F.col("source_size").cast("decimal(19,0)")
    offset = _div(hash32(F.coalesce("source", F.lit("")), F.lit(str(seed))).cast("decimal(10,0)") * F.col("unit"), F.lit(1 << 32).cast("decimal(10,0)"))
    placed = placed.withColumn("unit", F.nullif(unit, F.lit(0).cast("decimal(38,0)"))).withColumn("shift", offset)

    def boundaries(back: int) -> Column:
        step = (F.col("before") + F.col("rank") - back).cast("decimal(19,0)") * F.col("num").cast("decimal(19,0)")
        return _div(F.col("shift") + step, F.col("unit"))

    n = F.coalesce(boundaries(0) - boundaries(1), F.lit(0))
    return placed.select(*(["row"] if carry else []), "id", "source", "size", "source_size", "target", n.cast("long").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it was drawn."""
    drawn = copies(docs, carry=True, **options).filter("copies > 0")
    return drawn.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
