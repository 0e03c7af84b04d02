"""Rolling-origin forecasts of weekly series; a candidate is published only if it beats the seasonal-naive baseline.

Series, origins and parameters are rows: every training prefix and every
parameter choice is evaluated side by side. The smoothing candidates run one
recursion over a series' values per parameter choice, reading the state at each
origin; the initial state uses the first ``min_train`` values only.
"""

from collections.abc import Callable
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.sources.writers import truncate_load

SEASON, HORIZON, STEP, MIN_TRAIN = 52, 12, 4, 104
BASELINE = "seasonal_naive"
ETS_GRID = (0.1, 0.3, 0.5, 0.7, 0.9), (0.01, 0.05, 0.1, 0.3), (0.8, 0.9, 0.98)
ARIMA_GRID = (-0.6, -0.3, 0.0, 0.3, 0.6, 0.9), (-0.6, -0.3, 0.0, 0.3, 0.6)


class GridError(ValueError):
    """A weekly series has a step other than seven days, or a value is missing."""


def grid_gaps(series: DataFrame, days: int = 7) -> DataFrame:
    """Observations that do not follow the one before by exactly a week."""
    before = F.lag("obs_date").over(Window.partitionBy("series_id").orderBy("obs_date"))
    return series.withColumn("previous_date", before).filter(F.datediff("obs_date", "previous_date") != days)


def weekly_grid_check(series: DataFrame) -> DataFrame:
    if bad := grid_gaps(series).take(3):
        raise GridError(str(bad))
    return series


def guarded(series: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """``series`` if it can be forecast: on the weekly grid, without nulls, and just the ``expected`` series if these are given."""
    if bad := series.filter("series_id IS NULL OR obs_date IS NULL OR value IS NULL OR isnan(value)").take(3):
        raise GridError(f"missing values: {bad}")
    if expected is not None:
        found = {r.series_id for r in series.select("series_id").distinct().limit(len(set(expected)) + 1).collect()}
        if found != set(expected):
            raise ValueError(f"series differ from the expected ones: {sorted(found ^ set(expected))}")
    return weekly_grid_check(series)


def indexed(series: DataFrame) -> DataFrame:
    """Series with a running index from 0 and their length."""
    return series.withColumn("i", F.row_number().over(Window.partitionBy("series_id").orderBy("obs_date")) - 1).withColumn("n", F.count("*").over(Window.partitionBy("series_id")))


def seasonal_naive(series: DataFrame, horizon: int = HORIZON, season: int = SEASON) -> DataFrame:
    """(series_id, k, point): the value of one season before each of the next weeks. Series shorter than a season are errors."""
    rows = indexed(series)
    if short := rows.filter(F.col("n") < season).select("series_id").take(1):
        raise ValueError(f"{short[0][0]} is shorter than a season")
    k = F.col("i") - F.col("n") + season + 1
    return rows.filter(k.between(1, min(horizon, season))).select("series_id", k.cast("int").alias("k"), F.col("value").alias("point"))


def rolling_origins(series: DataFrame, horizon: int = HORIZON, step: int = STEP, min_train: int = MIN_TRAIN) -> DataFrame:
    """(series_id, origin, k, i, actual): each origin's next weeks; training is everything before the origin. Series too short for one origin are errors."""
    rows = indexed(series)
    sizes = series.groupBy("series_id").agg(F.count("*").alias("n"))
    if short := sizes.filter(F.col("n") < min_train + horizon).take(1):
        raise ValueError(f"{short[0].series_id} has no origin: {short[0].n} weeks of {min_train + horizon}")
    origins = sizes.select("series_id", F.explode(F.sequence(F.lit(min_train), F.col("n").cast("int") - horizon, F.lit(step))).alias("origin"))
    ahead = origins.select("series_id", "origin", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k")).withColumn("i", F.col("origin") + F.col("k") - 1)
    return ahead.join(rows.select("series_id", "i", F.col("value").alias("actual")), ["series_id", "i"])


def naive_backtest(series: DataFrame, season: int = SEASON, **windows) -> DataFrame:
    """(series_id, origin, k, actual, point) of the baseline."""
    ahead = rolling_origins(series, **windows)
    back = indexed(series).select("series_id", (F.col("i") + season).alias("i"), F.col("value").alias("point"))
    return ahead.join(back, ["series_id", "i"]).select("series_id", "origin", "k", "actual", "point")


def mape(actual: Column, point: Column) -> Column:
    return F.avg(F.try_divide(F.abs(point - actual), F.abs(actual))) * 100


def smape(actual: Column, point: Column) -> Column:
    """Symmetric error; 0 where both are 0."""
    size = F.abs(actual) + F.abs(point)
    return F.avg(F.when(size == 0, 0.0).otherwise(2 * F.abs(point - actual) / F.nullif(size, F.lit(0.0)))) * 100


def accuracy(backtest: DataFrame, by: tuple[str, ...] = ("series_id", "method")) -> DataFrame:
    """Errors pooled over all origins and steps, with the number of origins where the backtest has them."""
    a, p = F.col("actual"), F.col("point")
    origins = [F.countDistinct("origin").alias("n_origins")] if "origin" in backtest.columns else []
    return backtest.groupBy(*by).agg(mape(a, p).alias("mape"), smape(a, p).alias("smape"), F.count("*").alias("n_errors"), *origins)


def select_method(scores: DataFrame, baseline: str = BASELINE) -> DataFrame:
    """``scores`` with the published method: the least error, the baseline on a tie; a method without an error comes last."""
    order = Window.partitionBy("series_id").orderBy(F.col("smape").asc_nulls_last(), (F.col("method") != baseline), "method")
    return scores.withColumn("published", F.row_number().over(order) == 1)


def naive_intervals(series: DataFrame, horizon: int = HORIZON, season: int = SEASON) -> DataFrame:
    """The baseline's path with the 2.5 and 97.5 percentiles of seasonal differences around it."""
    rows = indexed(series)
    back = rows.select("series_id", (F.col("i") + season).alias("i"), F.col("value").alias("before"))
    spread = rows.join(back, ["series_id", "i"]).groupBy("series_id").agg(F.percentile(F.col("value") - F.col("before"), F.array(F.lit(0.025), F.lit(0.975))).alias("q"))
    return seasonal_naive(series, horizon, season).join(spread, "series_id").select("series_id", "k", "point", (F.col("point") + F.col("q")[0]).alias("lower"), (F.col("point") + F.col("q")[1]).alias("upper"))


def _values(series: DataFrame) -> DataFrame:
    """(series_id, y): values in order; an array is as long as one series."""
    return series.groupBy("series_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("obs_date", "value"))), lambda s: s["value"]).alias("y"))


def _with_parameters(df: DataFrame, names: list[str], grid: list[tuple[float, ...]]) -> DataFrame:
    rows = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(names, values)]) for values in grid])
    return df.withColumn("p", F.explode(rows))


def _states(runs: DataFrame, first: Column, skip: int, update, horizon: int, step: int, min_train: int) -> DataFrame:
    """(series_id, p, origin, s): states of a recursion over ``y`` after each origin of a backtest, and after the whole series.

    ``first`` is the state after ``skip`` values. Only the current state and
    those at origins are carried along. ``e`` is the squared error so far.
    """
    n = F.size("y")
    start = F.struct(first.alias("s"), F.lit(skip).alias("i"), F.array().cast("array<struct<origin:int,s:" + runs.select(first.alias("s")).schema["s"].dataType.simpleString() + ">>").alias("kept"))

    def step_on(acc: Column, y: Column) -> Column:
        s, i = update(acc["s"], y), acc["i"] + 1
        origin = (i == n) | ((i >= min_train) & (i <= n - horizon) & ((i - min_train) % step == 0))
        return F.struct(s.alias("s"), i.alias("i"), F.when(origin, F.concat(acc["kept"], F.array(F.struct(i.alias("origin"), s.alias("s"))))).otherwise(acc["kept"]).alias("kept"))

    kept = F.aggregate(F.slice("y", F.lit(skip + 1), n), start, step_on, lambda acc: acc["kept"])
    return runs.select("series_id", "p", F.inline(kept))


def best_of(states: DataFrame) -> DataFrame:
    """For each series and origin the parameters with the least error on the training prefix."""
    return states.groupBy("series_id", "origin").agg(F.min_by(F.struct("p", "s"), F.struct(F.col("s.e"), F.col("p"))).alias("b")).select("series_id", "origin", "b.*")


class Recursion(NamedTuple):
    """A method whose state is updated value by value, for each choice of a parameter grid ``p``.

    ``start`` is the state after ``skip`` values, told from ``y`` and the length of
    the first training prefix; ``ahead`` gives point and sum of squared error weights
    ``k`` weeks after a state ``s``. A state's ``e`` is its squared error so far.
    """

    names: list[str]
    grid: list[tuple[float, ...]]
    skip: int
    start: Callable[[int], Column]
    update: Callable[[Column, Column], Column]
    ahead: Callable[[], tuple[Column, Column]]


def _ets_start(min_train: int) -> Column:
    level = F.get("y", F.lit(0))
    trend = (F.get("y", F.lit(min_train - 1)) - level) / (min_train - 1)
    return F.struct(level.alias("l"), trend.alias("b"), F.lit(0.0).alias("e"))


def _ets_update(s: Column, y: Column) -> Column:
    guess = s["l"] + F.col("p.phi") * s["b"]
    error = y - guess
    return F.struct((guess + F.col("p.alpha") * error).alias("l"), (F.col("p.phi") * s["b"] + F.col("p.beta") * error).alias("b"), (s["e"] + error * error).alias("e"))


def _ets_ahead() -> tuple[Column, Column]:
    phi, k = F.col("p.phi"), F.col("k")
    damped = phi * (1 - F.pow(phi, k)) / (1 - phi)
    # Weight of an error j steps back: alpha + beta (phi + ... + phi^j).
    weights = F.aggregate(F.sequence(F.lit(0), k - 1), F.lit(0.0), lambda acc, j: acc + F.when(j == 0, 1.0).otherwise(F.pow(F.col("p.alpha") + F.col("p.beta") * phi * (1 - F.pow(phi, j)) / (1 - phi), F.lit(2.0))))
    return F.col("s.l") + damped * F.col("s.b"), weights


def _arima_start(min_train: int) -> Column:
    drift = (F.get("y", F.lit(min_train - 1)) - F.get("y", F.lit(0))) / (min_train - 1)
    return F.struct(F.get("y", F.lit(0)).alias("y"), F.lit(0.0).alias("d"), F.lit(0.0).alias("a"), F.lit(0.0).alias("e"), drift.alias("m"))


def _arima_update(s: Column, y: Column) -> Column:
    d = y - s["y"] - s["m"]
    a = d - F.col("p.phi") * s["d"] - F.col("p.theta") * s["a"]
    return F.struct(y.alias("y"), d.alias("d"), a.alias("a"), (s["e"] + a * a).alias("e"), s["m"].alias("m"))


def _arima_ahead() -> tuple[Column, Column]:
    phi, theta, k = F.col("p.phi"), F.col("p.theta"), F.col("k")
    first = phi * F.col("s.d") + theta * F.col("s.a")
    total = F.aggregate(F.sequence(F.lit(0), k - 1), F.lit(0.0), lambda acc, j: acc + first * F.pow(phi, j))
    psi = lambda j: F.lit(1.0) + F.aggregate(F.sequence(F.lit(0), j), F.lit(0.0), lambda acc, i: acc + F.when(i == 0, 0.0).otherwise((phi + theta) * F.pow(phi, i - 1)))
    weights = F.aggregate(F.sequence(F.lit(0), k - 1), F.lit(0.0), lambda acc, j: acc + F.pow(psi(j), F.lit(2.0)))
    return F.col("s.y") + k * F.col("s.m") + total, weights


ETS = Recursion(["alpha", "beta", "phi"], list(product(*ETS_GRID)), 0, _ets_start, _ets_update, _ets_ahead)
#: The first value is the state after one observation.
ARIMA = Recursion(["phi", "theta"], list(product(*ARIMA_GRID)), 1, _arima_start, _arima_update, _arima_ahead)


def paths_of(best: DataFrame, method: Recursion, horizon: int) -> DataFrame:
    """(series_id, origin, k, point, sigma): the weeks after each state."""
    point, weights = method.ahead()
    ahead = best.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return ahead.select("series_id", "origin", "k", point.alias("point"), F.sqrt(F.col("s.e") / F.col("origin") * weights).alias("sigma"))


def _fitted(series: DataFrame, method: Recursion, horizon: int, step: int, min_train: int, grid: list | None) -> DataFrame:
    runs = _with_parameters(_values(series).filter(F.size("y") >= min_train), method.names, grid or method.grid)
    return paths_of(best_of(_states(runs, method.start(min_train), method.skip, method.update, horizon, step, min_train)), method, horizon)


def ets_damped(series: DataFrame, horizon: int = HORIZON, step: int = STEP, min_train: int = MIN_TRAIN, grid: list[tuple[float, float, float]] | None = None) -> DataFrame:
    """(series_id, origin, k, point, sigma): additive errors with a damped trend, the best of a parameter grid."""
    return _fitted(series, ETS, horizon, step, min_train, grid)


def arima_drift(series: DataFrame, horizon: int = HORIZON, step: int = STEP, min_train: int = MIN_TRAIN, grid: list[tuple[float, float]] | None = None) -> DataFrame:
    """(series_id, origin, k, point, sigma): first differences with one autoregressive and one moving-average term around their mean.

    Parameters are the best of a grid by the conditional sum of squares; the
    drift is the mean difference over the first ``min_train`` values.
    """
    return _fitted(series, ARIMA, horizon, step, min_train, grid)


CANDIDATES = {"ets_damped": ets_damped, "arima_drift": arima_drift}


def evaluate(series: DataFrame, candidates=CANDIDATES, expected: list[str] | None = None, **windows) -> DataFrame:
    """(series_id, method, mape, smape, n_errors, n_origins, published) of the baseline and the candidates; faulty series are errors."""
    series = guarded(series, expected)
    ahead = rolling_origins(series, **windows)
    tests = naive_backtest(series, **windows).select("series_id", "origin", "actual", "point").withColumn("method", F.lit(BASELINE))
    for name, method in candidates.items():
        mine = ahead.join(method(series, **windows), ["series_id", "origin", "k"]).select("series_id", "origin", "actual", "point")
        tests = tests.unionByName(mine.withColumn("method", F.lit(name)))
    return select_method(accuracy(tests))


def publish(series: DataFrame, scores: DataFrame, candidates=CANDIDATES, expected: list[str] | None = None, **windows) -> DataFrame:
    """(series_id, series_title, method, obs_date, horizon_weeks, point, lower, upper, trained_through): the path of each series' published method; faulty series are errors.

    The title is null where ``series`` has none.
    """
    series = guarded(series, expected)
    title = F.max("series_title") if "series_title" in series.columns else F.lit(None).cast("string")
    horizon = windows.get("horizon", HORIZON)
    paths = naive_intervals(series, horizon).withColumn("method", F.lit(BASELINE))
    ends = series.groupBy("series_id").agg(F.max("obs_date").alias("trained_through"), F.count("*").alias("n"), title.alias("series_title"))
    for name, method in candidates.items():
        last = method(series, **windows).join(ends.select("series_id", F.col("n").alias("origin")), ["series_id", "origin"])
        mine = last.select("series_id", "k", "point", (F.col("point") - 1.96 * F.col("sigma")).alias("lower"), (F.col("point") + 1.96 * F.col("sigma")).alias("upper"))
        paths = paths.unionByName(mine.withColumn("method", F.lit(name)))
    chosen = scores.filter("published").select("series_id", "method")
    out = paths.join(chosen, ["series_id", "method"], "left_semi").join(ends.select("series_id", "series_title", "trained_through"), "series_id")
    week, ahead = F.expr("date_add(trained_through, 7 * k)").alias("obs_date"), F.col("k").cast("int").alias("horizon_weeks")
    return out.select("series_id", "series_title", "method", week, ahead, "point", "lower", "upper", "trained_through")


def load(series: DataFrame, path: str, candidates=CANDIDATES, expected: list[str] | None = None, **windows) -> tuple[DataFrame, DataFrame]:
    """Scores and paths as two truncating loads below ``path`` with one stamp; the scores that choose the paths are those written."""
    spark = series.sparkSession
    stamp = spark.range(1).select(F.current_timestamp()).first()[0]
    truncate_load(evaluate(series, candidates, expected, **windows), f"{path}/scores", at=stamp)
    scores = spark.read.parquet(f"{path}/scores")
    truncate_load(publish(series, scores, candidates, expected, **windows), f"{path}/paths", at=stamp)
    return scores, spark.read.parquet(f"{path}/paths")
