"""Forecasts kept up week by week: states of recursions by series and parameters.

``refresh`` folds new weeks into the states it keeps, so a week costs one step of each
recursion, however long the series is. At each origin of a rolling backtest the best
parameters' path is kept as well, and paths of one origin never change, so scores need
the kept paths and the actual values, and publishing needs the last states: neither
fits anything again. Results equal those of a fit of the whole series.

Three versioned tables lie below a folder: weeks (the series so far), paths of
origins, and states. States are committed last, so a run that breaks before that is
simply repeated: weeks and paths are merged by key and come out the same.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators import forecast as fc
from quarterdeck.sources import versioned
from quarterdeck.sources.writers import materialized

METHODS = {"ets_damped": fc.ETS, "arima_drift": fc.ARIMA}


def _parameters(method: fc.Recursion, grid: list | None) -> Column:
    """The grid as (number, parameters)."""
    return F.array(*[F.struct(F.lit(i).alias("choice"), F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(method.names, values)]).alias("p")) for i, values in enumerate(grid or method.grid)])


def _arrays(weeks: DataFrame) -> DataFrame:
    """(series_id, y, first_week, last_week): an array is as long as the weeks given of one series."""
    sorted_ = F.array_sort(F.collect_list(F.struct("obs_date", "value")))
    return weeks.groupBy("series_id").agg(F.transform(sorted_, lambda s: s["value"]).alias("y"), F.min("obs_date").alias("first_week"), F.max("obs_date").alias("last_week"))


def _folded(runs: DataFrame, method: fc.Recursion, step: int, min_train: int) -> DataFrame:
    """(series_id, choice, p, n, s, trained_through, kept): states after the values ``y``, and those at origins on the way."""
    kind = runs.schema["s"].dataType.simpleString()
    start = F.struct(F.col("s"), F.col("n").alias("i"), F.array().cast(f"array<struct<origin:int,s:{kind}>>").alias("kept"))

    def on(acc: Column, y: Column) -> Column:
        s, i = method.update(acc["s"], y), acc["i"] + 1
        origin = (i >= min_train) & ((i - min_train) % step == 0)
        kept = F.when(origin, F.concat(acc["kept"], F.array(F.struct(i.alias("origin"), s.alias("s"))))).otherwise(acc["kept"])
        return F.struct(s.alias("s"), i.alias("i"), kept.alias("kept"))

    done = runs.withColumn("_r", F.aggregate("y", start, on))
    return done.select("series_id", "choice", "p", F.col("_r.i").alias("n"), F.col("_r.s").alias("s"), "trained_through", F.col("_r.kept").alias("kept"))


def first_states(weeks: DataFrame, method: fc.Recursion, step: int = fc.STEP, min_train: int = fc.MIN_TRAIN, grid: list | None = None) -> DataFrame:
    """States of series from all their weeks; those of fewer than ``min_train`` have none yet."""
    whole = _arrays(weeks).filter(F.size("y") >= min_train)
    runs = whole.select("series_id", "y", F.col("last_week").alias("trained_through"), F.inline(_parameters(method, grid)))
    runs = runs.select("series_id", "choice", "p", "trained_through", method.start(min_train).alias("s"), F.lit(method.skip).alias("n"), F.slice("y", method.skip + 1, F.size("y")).alias("y"))
    return _folded(runs, method, step, min_train)


def advanced(states: DataFrame, weeks: DataFrame, method: fc.Recursion, step: int = fc.STEP, min_train: int = fc.MIN_TRAIN) -> DataFrame:
    """States of the series that have new ``weeks``, which follow on ``trained_through``: only the new values are read."""
    runs = states.select("series_id", "choice", "p", "n", "s").join(_arrays(weeks).select("series_id", "y", F.col("last_week").alias("trained_through")), "series_id")
    return _folded(runs, method, step, min_train)


def _origin_paths(folded: DataFrame, name: str, horizon: int) -> DataFrame:
    """(series_id, method, origin, k, point) of the origins that a fold went over."""
    best = fc.best_of(folded.select("series_id", "p", F.inline("kept")))
    return fc.paths_of(best, METHODS[name], horizon).select("series_id", F.lit(name).alias("method"), "origin", "k", "point")


def _following(weeks: DataFrame, held: DataFrame | None) -> DataFrame:
    """``weeks`` that are new, if all are on the grid and follow on the weeks held; weeks held already must have the same value."""
    weeks = fc.guarded(weeks.select("series_id", "obs_date", "value"))
    if held is None:
        return weeks
    old = held.select("series_id", "obs_date", F.col("value").alias("_held"))
    both = materialized(weeks.join(old, ["series_id", "obs_date"], "left"))
    if bad := both.filter("_held <> value").take(3):
        raise ValueError(f"weeks held with another value: fit anew: {bad}")
    new = both.filter("_held IS NULL").drop("_held")
    ends = held.groupBy("series_id").agg(F.max("obs_date").alias("_last"))
    begins = new.groupBy("series_id").agg(F.min("obs_date").alias("_first"))
    if bad := begins.join(ends, "series_id").filter("datediff(_first, _last) <> 7").take(3):
        raise fc.GridError(f"weeks that don't follow on those held: {bad}")
    return new


def refresh(weeks: DataFrame, path: str, step: int = fc.STEP, min_train: int = fc.MIN_TRAIN, horizon: int = fc.HORIZON, buckets: int = 8) -> int:
    """Add ``weeks`` (series_id, obs_date, value) to the forecasts kept below ``path``; returns how many states moved.

    Weeks given before are passed over, so a run may be repeated. A gap, a missing
    value or another value for a week held is an error and changes nothing. A series
    gets states when it has ``min_train`` weeks. ``step``, ``min_train`` and
    ``horizon`` must be those of the first run.
    """
    spark, moved = weeks.sparkSession, 0
    # States say what is done; weeks may be ahead of them after a run that broke.
    _following(weeks, versioned.read(spark, f"{path}/weeks"))
    versioned.upsert(weeks.select("series_id", "obs_date", "value"), f"{path}/weeks", ["series_id", "obs_date"], buckets)
    held = versioned.read(spark, f"{path}/weeks")
    given = weeks.select("series_id").distinct()
    for name, method in METHODS.items():
        states = versioned.read(spark, f"{path}/states_{name}")
        if states is None:
            folded = materialized(first_states(held, method, step, min_train))
        else:
            through = states.groupBy("series_id").agg(F.max("trained_through").alias("_through"))
            mine = held.join(given, "series_id", "left_semi").join(through, "series_id", "left")
            later = mine.filter("obs_date > _through").drop("_through")
            fresh = mine.filter("_through IS NULL").drop("_through")
            folded = materialized(advanced(states, later, method, step, min_train).unionByName(first_states(fresh, method, step, min_train)))
        # Paths first: states are what tells a week as done.
        versioned.upsert(_origin_paths(folded, name, horizon), f"{path}/paths", ["series_id", "method", "origin", "k"], buckets)
        moved += versioned.upsert(folded.drop("kept"), f"{path}/states_{name}", ["series_id", "choice"], buckets)
    return moved


def kept_scores(spark: SparkSession, path: str, step: int = fc.STEP, min_train: int = fc.MIN_TRAIN, horizon: int = fc.HORIZON) -> DataFrame:
    """What ``forecast.evaluate`` gives for the weeks so far, from kept paths and actual values."""
    held = versioned.read(spark, f"{path}/weeks").select("series_id", "obs_date", "value")
    windows = {"horizon": horizon, "step": step, "min_train": min_train}
    ahead = fc.rolling_origins(held, **windows)
    kept = ahead.join(versioned.read(spark, f"{path}/paths"), ["series_id", "origin", "k"]).select("series_id", "method", "origin", "actual", "point")
    naive = fc.naive_backtest(held, **windows).select("series_id", F.lit(fc.BASELINE).alias("method"), "origin", "actual", "point")
    return fc.select_method(fc.accuracy(naive.unionByName(kept)))


def kept_publish(spark: SparkSession, path: str, scores: DataFrame, horizon: int = fc.HORIZON) -> DataFrame:
    """What ``forecast.publish`` gives for the weeks so far, from the last states; only the baseline's series are read."""
    chosen = scores.filter("published").select("series_id", "method")
    held = versioned.read(spark, f"{path}/weeks").select("series_id", "obs_date", "value")
    of = lambda name: chosen.filter(F.col("method") == name).select("series_id")
    out = fc.naive_intervals(held.join(of(fc.BASELINE), "series_id", "left_semi"), horizon).withColumn("method", F.lit(fc.BASELINE))
    for name, method in METHODS.items():
        last = versioned.read(spark, f"{path}/states_{name}").join(of(name), "series_id", "left_semi")
        ahead = fc.paths_of(fc.best_of(last.select("series_id", "p", F.col("n").alias("origin"), "s")), method, horizon)
        bounds = [(F.col("point") + sign * 1.96 * F.col("sigma")).alias(c) for c, sign in (("lower", -1), ("upper", 1))]
        out = out.unionByName(ahead.select("series_id", "k", "point", *bounds, F.lit(name).alias("method")))
    ends = held.groupBy("series_id").agg(F.max("obs_date").alias("trained_through"))
    return out.join(ends, "series_id").select("series_id", "method", F.expr("date_add(trained_through, 7 * k)").alias("obs_date"), F.col("k").cast("int").alias("horizon_weeks"), "point", "lower", "upper", "trained_through")
