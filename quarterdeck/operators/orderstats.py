"""Exact order statistics of groups, several columns at a time, in bounded memory.

``medians`` works on wide rows: one aggregate has the medians of all columns, so
nothing is unpivoted and only aggregates are shuffled. Small groups use Spark's exact
percentile, whose state is a map of a group's distinct values. Above ``in_memory``
values in a group that map no longer has a bound, and ranges are refined instead:
each round brackets the wanted ranks of every group and column between two values,
taken from a bounded sketch whose rank error is known, and counts exactly what lies
below and between them; when few enough values are left between, they are gathered
and the ranks are read off. Every round is one partial and final aggregate over the
rows, and a sketch or a remainder is all that a group ever holds.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.sources.writers import materialized

IN_MEMORY = 1 << 16
#: Parts that a range is cut into by a sketch, and the sketch's accuracy: its rank error is at most 1 / ACCURACY of the range.
PARTS, ACCURACY = 256, 4096
#: A range of fewer values may have no cut on either side of the wanted ranks, so it isn't narrowed.
LEAST_LEFT = 64


def largest_group(rows: DataFrame, by: list[str]) -> int:
    return rows.groupBy(*by).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]


def medians(rows: DataFrame, by: list[str], columns: dict[str, Column], in_memory: int = IN_MEMORY, largest: int | None = None) -> DataFrame:
    """(by, name_median, name_count) of each named column: the exact, interpolated median of its values that aren't null.

    ``rows`` is read once for each round, so it should be a written table. ``largest``
    is the size of the largest group, where that is known.
    """
    if (largest_group(rows, by) if largest is None else largest) <= in_memory:
        return rows.groupBy(*by).agg(*[x for name, c in columns.items() for x in (F.median(c).alias(f"{name}_median"), F.count(c).alias(f"{name}_count"))])
    return _refined(rows, by, columns, in_memory)


def _with_states(rows: DataFrame, states: DataFrame, by: list[str]) -> DataFrame:
    """Rows with their group's state; whether the groups are broadcast is Spark's choice."""
    renamed = states.select(*[F.col(k).alias(f"_by_{k}") for k in by], "_state")
    return rows.join(renamed, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in by])).drop(*[f"_by_{k}" for k in by])


def _refined(rows: DataFrame, by: list[str], columns: dict[str, Column], in_memory: int) -> DataFrame:
    in_memory = max(in_memory, LEAST_LEFT)
    given = rows.select(*by, F.struct(*[c.cast("double").alias(n) for n, c in columns.items()]).alias("_v"))
    counts = given.groupBy(*by).agg(*[F.count(F.col("_v")[n]).alias(n) for n in columns])
    # The wanted ranks, from 0, are those of the two middle values; the range is open and has no ends yet.
    whole = {n: F.struct(F.col(n).alias("n"), F.floor((F.col(n) - 1) / 2).alias("r0"), F.floor(F.col(n) / 2).alias("r1"), *[F.lit(None).cast("double").alias(e) for e in ("lo", "hi")]) for n in columns}
    states = counts.select(*by, F.struct(*[s.alias(n) for n, s in whole.items()]).alias("_state"))
    while True:
        measured = _measured(given, states, by, list(columns)).persist()
        try:
            left = measured.agg(*[F.max(_open(n) * F.col(n)["inside"]).alias(n) for n in columns]).first()
            if max((left[n] or 0 for n in columns), default=0) <= in_memory:
                return _read_off(given, materialized(measured.select(*by, F.struct(*columns).alias("_state"))), by, list(columns))
            states = materialized(measured.select(*by, F.struct(*[_narrowed(n, in_memory).alias(n) for n in columns]).alias("_state")))
        finally:
            measured.unpersist()


def _inside(n: str) -> Column:
    v, s = F.col("_v")[n], F.col("_state")[n]
    return v.isNotNull() & (s["lo"].isNull() | (v > s["lo"])) & (s["hi"].isNull() | (v < s["hi"]))


def _measured(given: DataFrame, states: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Each state with the exact counts of values up to its range and inside it, and cuts of what is inside."""
    parts = F.array(*[F.lit(k / PARTS) for k in range(PARTS + 1)])
    parts_of = {n: (F.count_if(F.col("_v")[n] <= F.col("_state")[n]["lo"]), F.count_if(_inside(n)), F.percentile_approx(F.when(_inside(n), F.col("_v")[n]), parts, F.lit(ACCURACY))) for n in names}
    sums = _with_states(given, states, by).groupBy(*by).agg(*[x.alias(f"_{k}_{n}") for n, xs in parts_of.items() for k, x in zip(("upto", "inside", "cut"), xs)])
    out = _with_states(sums, states, by)
    return out.select(*by, *[F.struct("_state." + n + ".*", F.col(f"_upto_{n}").alias("upto"), F.col(f"_inside_{n}").alias("inside"), F.col(f"_cut_{n}").alias("cut")).alias(n) for n in names])


def _open(n: str) -> Column:
    """1 if a wanted rank lies inside the range, and not on one of its ends."""
    s = F.col(n)
    return ((s["r1"] >= s["upto"]) & (s["r0"] < s["upto"] + s["inside"])).cast("int")


def _narrowed(n: str, in_memory: int) -> Column:
    """The state with a range between cuts that lie on either side of the wanted ranks by more than the sketch's error.

    What is strictly between them is a few parts in PARTS of what was inside, whatever the ties.
    """
    s, error = F.col(n), 2.0 / ACCURACY
    low = F.floor(((s["r0"] - s["upto"]) / s["inside"] - error) * PARTS).cast("int") - 1
    high = F.ceil(((s["r1"] - s["upto"] + 1) / s["inside"] + error) * PARTS).cast("int") + 1
    ready = (_open(n) == 0) | (s["inside"] <= in_memory)
    lo = F.when(ready | (low < 0), s["lo"]).otherwise(F.get(s["cut"], low))
    hi = F.when(ready | (high > PARTS), s["hi"]).otherwise(F.get(s["cut"], high))
    return F.struct(s["n"].alias("n"), s["r0"].alias("r0"), s["r1"].alias("r1"), lo.alias("lo"), hi.alias("hi"))


def _read_off(given: DataFrame, states: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Medians from ranges of which few values are left inside."""
    opened = lambda n: (F.col("_state")[n]["r1"] >= F.col("_state")[n]["upto"]) & (F.col("_state")[n]["r0"] < F.col("_state")[n]["upto"] + F.col("_state")[n]["inside"])
    left = _with_states(given, states, by).groupBy(*by).agg(*[F.array_sort(F.collect_list(F.when(opened(n) & _inside(n), F.col("_v")[n]))).alias(f"_left_{n}") for n in names])

    def at(n: str, rank: str) -> Column:
        s = F.col("_state")[n]
        return F.when(s[rank] < s["upto"], s["lo"]).when(s[rank] < s["upto"] + s["inside"], F.get(F.col(f"_left_{n}"), (s[rank] - s["upto"]).cast("int"))).otherwise(s["hi"])

    out = _with_states(left, states, by)
    count = lambda n: F.col("_state")[n]["n"]
    return out.select(*by, *[x for n in names for x in (F.when(count(n) > 0, at(n, "r0") * 0.5 + at(n, "r1") * 0.5).alias(f"{n}_median"), count(n).alias(f"{n}_count"))])
