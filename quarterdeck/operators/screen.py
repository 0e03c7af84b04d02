"""Ranking of the composite, movers between quarters, and comparisons of builds."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.operators.parity import LEVELS, unequal_rows
from quarterdeck.operators.peers import PARTS
from quarterdeck.operators.ranks import with_ranks
from quarterdeck.sources.writers import materialized


def latest(df: DataFrame, date: str = "report_date") -> DataFrame:
    """Rows of the last period, a scalar: of a mart that is partitioned by it, only that period's files are read."""
    return df.filter(F.col(date) == df.agg(F.max(date)).scalar())


def rank_screen(flags: DataFrame, dim: DataFrame, fact: DataFrame, as_of=None, date: str = "report_date") -> DataFrame:
    """Ranks of one quarter's scored entities in their band and overall: the last, or the one at ``as_of``."""
    quarter = flags.filter(F.col(date) == F.lit(as_of)) if as_of else latest(flags, date)
    # One quarter's rows are read for several aggregates.
    rows = materialized(quarter.filter("composite_score IS NOT NULL"))
    ranked = with_ranks(rows, "composite_score", {"band": ["peer_band"], "overall": []})
    names = dim.select("cert", "bank_name", "is_active", "is_failed")
    facts = fact.select("cert", date, "total_assets", "likely_merger_quarter", "business_model")
    return ranked.join(names, "cert").join(facts, ["cert", date], "left")


def labeled_subset(ranked: DataFrame, groups: dict[str, list[int]], entity: str = "cert") -> DataFrame:
    """Rows of listed entities with the name of their list."""
    label = F.lit(None).cast("string")
    for name, keys in groups.items():
        label = F.when(F.col(entity).isin(keys), name).otherwise(label)
    return ranked.withColumn("label_group", label).filter(F.col("label_group").isNotNull())


def false_positive_sample(ranked: DataFrame, labeled: list[int], least: float = 0.9, n: int = 12) -> DataFrame:
    """The highest scores at the top of a band that are on no list."""
    rows = ranked.filter((F.col("band_percentile") >= least) & ~F.col("cert").isin(labeled))
    return rows.orderBy(F.desc("composite_score"), "cert").limit(n)


def prove_equivalence(a: DataFrame, b: DataFrame, keys: list[str], score: str = "composite_score", digits: int = 10, levels: int = LEVELS) -> DataFrame:
    """Rows that one build has and the other lacks, by keys and rounded score; empty if the builds agree, which bucket digests tell without a join."""
    view = lambda df: df.select(*keys, F.round(score, digits).alias(score))
    a, b = view(a), view(b)
    found = (a, b) if dict(a.dtypes) != dict(b.dtypes) else unequal_rows(a, b, keys, [score], levels)
    if found is None:
        return a.withColumn("only_in", F.lit(None).cast("string")).limit(0)
    a, b = found
    return a.exceptAll(b).withColumn("only_in", F.lit("first")).unionByName(b.exceptAll(a).withColumn("only_in", F.lit("second")))


def rank_differences(ranked: DataFrame, expected: DataFrame, key: str = "cert") -> DataFrame:
    """Pinned ranks that the screen does not have; a missing entity is a difference too."""
    pinned = [c for c in expected.columns if c != key]
    same = reduce(lambda x, y: x & y, [F.col(f"got.{c}").eqNullSafe(F.col(f"pin.{c}")) for c in pinned])
    joined = expected.alias("pin").join(ranked.select(key, *pinned).alias("got"), key, "left")
    return joined.filter(~same).select(key, *[F.col(f"pin.{c}").alias(f"expected_{c}") for c in pinned], *[F.col(f"got.{c}").alias(f"got_{c}") for c in pinned])


def screen_view(ranked: DataFrame, band: str | None = None, n: int = 50) -> DataFrame:
    """Active entities of a band (or all) by score."""
    rows = ranked.filter("is_active")
    rows = rows.filter(F.col("peer_band") == band) if band else rows
    return rows.orderBy(F.desc("composite_score"), "cert").limit(n)


def top_decile_line(ranked: DataFrame, by: list[str] = ["peer_band"], q: float = 0.9) -> DataFrame:  # noqa: B006
    return ranked.groupBy(*by).agg(F.percentile("composite_score", q).alias("top_decile_score"))


def _largest_rise(parts: list[str]) -> Column:
    """Name of the part that rose most, the first on a tie; null if none can be told."""
    rise = {p: F.coalesce(F.col(p) - F.col(f"prior_{p}"), F.lit(-99.0)) for p in parts}
    most = F.greatest(*rise.values())
    out = F.when(most == -99.0, F.lit(None).cast("string"))
    for p in parts:
        out = out.when(rise[p] == most, p)
    return out


def movers(flags: DataFrame, date: str = "report_date", parts: list[str] = PARTS, digits: int | None = None) -> DataFrame:
    """Change of the composite between the last two quarters for entities scored in both, and the part that drove it."""
    # Distinct dates are as many as there are quarters.
    dates = flags.select(date).distinct().orderBy(F.desc(date)).limit(2).agg(F.max(date).alias("now"), F.min(date).alias("then"))
    both = flags.filter("composite_score IS NOT NULL").join(F.broadcast(dates), F.col(date).isin(F.col("now"), F.col("then")))
    now = both.filter(F.col(date) == F.col("now")).select("cert", date, "peer_band", "composite_score", *parts)
    then = both.filter((F.col(date) == F.col("then")) & (F.col("now") > F.col("then"))).select("cert", F.col("composite_score").alias("prior_score"), *[F.col(p).alias(f"prior_{p}") for p in parts])
    out = now.join(then, "cert").withColumn("score_change", F.col("composite_score") - F.col("prior_score")).withColumn("main_driver", _largest_rise(parts))
    if digits is None:
        return out
    return out.withColumns({c: F.round(c, digits) for c in ("composite_score", "prior_score", "score_change", *parts)})


def movers_in_band(moved: DataFrame, ranked: DataFrame, band: str, n: int = 12) -> DataFrame:
    """The largest risers of a band with their rank as text."""
    label = F.concat(F.col("band_rank").cast("string"), F.lit(" of "), F.col("band_size").cast("string"))
    rows = moved.filter(F.col("peer_band") == band).join(ranked.select("cert", label.alias("rank_label")), "cert")
    return rows.orderBy(F.desc("score_change"), "cert").limit(n)


def top_n_per_side(moved: DataFrame, n: int = 15) -> DataFrame:
    """Risers and fallers of each band."""
    out = []
    for side, order in (("riser", F.desc("score_change")), ("faller", F.asc("score_change"))):
        place = F.row_number().over(Window.partitionBy("peer_band").orderBy(order, "cert"))
        out.append(moved.withColumn("side", F.lit(side)).withColumn("place", place).filter(F.col("place") <= n))
    return out[0].unionByName(out[1])


def band_summary(moved: DataFrame) -> DataFrame:
    return moved.groupBy("peer_band").agg(
        F.count("*").alias("entities"),
        F.avg("composite_score").alias("avg_score"),
        F.avg("score_change").alias("avg_change"),
        F.max("score_change").alias("max_change"),
        F.max_by("cert", F.struct("score_change", -F.col("cert"))).alias("top_mover"),
    )


def top_of_bands(ranked: DataFrame, n: int = 10) -> DataFrame:
    return ranked.filter(F.col("band_rank") <= n)


def outcomes(ranked: DataFrame, dim: DataFrame, year: int, other: dict[int, str], key: str = "cert") -> DataFrame:
    """Ranked entities that failed in a year, or came to another end that is given as text, with their rank and outcome as text."""
    ends = dim.select(key, F.when(F.col("is_failed") & (F.year("failure_date") == year), F.date_format("failure_date", "'Failed' MMM yyyy")).alias("outcome"))
    for entity, text in other.items():
        ends = ends.withColumn("outcome", F.when(F.col(key) == entity, text).otherwise(F.col("outcome")))
    rank = F.concat_ws(" of ", "band_rank", "band_size")
    rows = ranked.join(ends.filter("outcome IS NOT NULL"), key)
    return rows.select(key, "bank_name", "peer_band", "composite_score", rank.alias("band_rank_label"), "band_percentile", "outcome")


def components_long(ranked: DataFrame, parts: list[str] = PARTS, entity: str = "cert") -> DataFrame:
    """(entity, component, z) of a ranked slice."""
    return ranked.unpivot([entity], parts, "component", "z")


def input_trends(fact: DataFrame, entities: list[int], as_of, columns: list[str], date: str = "report_date") -> DataFrame:
    """Input columns of some entities up to a date."""
    return fact.filter(F.col("cert").isin(entities) & (F.col(date) <= F.lit(as_of))).select("cert", date, *columns)
