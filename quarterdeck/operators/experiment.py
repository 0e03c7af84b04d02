"""A/B experiments: assignment, arm counts, checks and tests, one row per experiment."""

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SRM_ALPHA = 0.001


def hash32(*columns) -> Column:
    """First 32 bits of an md5 hash, as other engines compute it."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *columns)), 1, 8), 16, 10).cast("bigint")


def assign_arm(user: str | Column, salt: str | None = None) -> Column:
    """Stateless assignment: an odd hash is treatment."""
    key = [user] if salt is None else [user, F.lit(salt)]
    return F.when(hash32(*key) % 2 == 1, "treatment").otherwise("control")


def user_outcomes(events: DataFrame, user: str, converted: Column, by: list[str] | None = None) -> DataFrame:
    """One row per user with whether it converted."""
    return events.groupBy(*(by or []), user).agg(F.max(F.coalesce(converted, F.lit(False))).alias("converted"))


def arm_counts(users: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Users and converters of each arm, side by side."""
    out = []
    for arm in ("control", "treatment"):
        mine = F.col("arm") == arm
        out += [F.count_if(mine).alias(f"n_{arm}"), F.count_if(mine & F.col("converted")).alias(f"conversions_{arm}")]
    return users.groupBy(*(by or [])).agg(*out)


def srm_chi2(a: str = "n_control", b: str = "n_treatment", share: float = 0.5) -> Column:
    """Chi-square of the arms' sizes against the expected split."""
    n = F.col(a) + F.col(b)
    return F.try_divide(F.pow(F.col(a) - n * share, F.lit(2.0)), n * share) + F.try_divide(F.pow(F.col(b) - n * (1 - share), F.lit(2.0)), n * (1 - share))


def pooled_rate(c: str = "control", t: str = "treatment") -> Column:
    """Conversions per user of both arms together."""
    return F.try_divide(F.col(f"conversions_{c}") + F.col(f"conversions_{t}"), F.col(f"n_{c}") + F.col(f"n_{t}"))


def two_proportion_z(c: str = "control", t: str = "treatment") -> Column:
    """Pooled z of treatment less control."""
    n1, n2, x1, x2 = F.col(f"n_{c}"), F.col(f"n_{t}"), F.col(f"conversions_{c}"), F.col(f"conversions_{t}")
    pooled = pooled_rate(c, t)
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return F.try_divide(F.try_divide(x2, n2) - F.try_divide(x1, n1), spread)


def _two_sided_p(z: pd.Series) -> pd.Series:
    return z.map(lambda x: math.erfc(abs(x) / math.sqrt(2)) if pd.notna(x) else None).astype(float)


def two_sided_p(z: str | Column) -> Column:
    """Two-sided normal p-value; of the root of a chi-square with one degree of freedom, its p-value. For aggregated rows."""
    return F.pandas_udf(_two_sided_p, "double")(z)


def required_n_per_arm(baseline: str | Column, mde: float = 0.2, alpha: float = 0.05, power: float = 0.8) -> Column:
    """Users needed in each arm for a relative lift, with the pooled variance under no difference; rates outside (0, 1) fail the query."""
    p1 = F.col(baseline) if isinstance(baseline, str) else baseline
    p2 = p1 * (1 + mde)
    mean = (p1 + p2) / 2
    level, strength = NormalDist().inv_cdf(1 - alpha / 2), NormalDist().inv_cdf(power)
    root = level * F.sqrt(2 * mean * (1 - mean)) + strength * F.sqrt(p1 * (1 - p1) + p2 * (1 - p2))
    fine = (p1 > 0) & (p1 < 1) & (p2 > 0) & (p2 < 1)
    return F.when(fine, F.ceil(root * root / ((p2 - p1) * (p2 - p1)))).otherwise(F.raise_error(F.lit("rates must lie between 0 and 1")).cast("bigint"))


def inject_lift(users: DataFrame, lift: float, seed: int, user: str = "user_id", arm: str = "treatment", by: list[str] | None = None) -> DataFrame:
    """Users of an arm with extra conversions: each non-converter converts if its own hash falls below the needed share.

    A negative lift, or one that needs more conversions than the arm has users left, fails the query.
    """
    by = by or []
    totals = users.filter(F.col("arm") == arm).groupBy(*by).agg(F.count("*").alias("_n"), F.count_if("converted").alias("_c"))
    left, wanted = F.col("_n") - F.col("_c"), F.col("_c") * lift
    share = F.when((left > 0) & (wanted >= 0) & (wanted <= left), wanted / left).otherwise(F.raise_error(F.lit(f"a lift of {lift} is out of reach")).cast("double"))
    totals = totals.select(*by, share.alias("_share"))
    draw = hash32(F.col(user).cast("string"), F.lit(str(seed))) / float(1 << 32)
    # One row for each experiment.
    joined = users.join(F.broadcast(totals), by, "left") if by else users.join(F.broadcast(totals))
    return joined.withColumn("converted", F.col("converted") | ((F.col("arm") == arm) & (draw < F.coalesce("_share", F.lit(0.0))))).drop("_share").select(users.columns)


def experiment_readout(users: DataFrame, by: list[str] | None = None, mde: float = 0.2, alpha: float = 0.05, power: float = 0.8, injected: float | None = None, seed: int = 0, user: str = "user_id") -> DataFrame:
    """Counts, sample-ratio check, test, lift and power of every experiment.

    Power is sized on the rate of both arms together. With ``injected``, the
    test is made once more on a treatment that has that lift on top:
    ``lifted_conversions``, ``lifted_z`` and ``lifted_p``.
    """
    by = by or []
    out = arm_counts(users, by)
    rate = {a: F.try_divide(f"conversions_{a}", f"n_{a}") for a in ("control", "treatment")}
    out = out.withColumns({"srm_chi2": srm_chi2(), "z": two_proportion_z(), "rate_control": rate["control"], "rate_treatment": rate["treatment"], "rate_pooled": pooled_rate()})
    out = out.withColumn("lift", F.try_divide("rate_treatment", "rate_control") - 1)
    out = out.withColumns({"srm_p": two_sided_p(F.sqrt("srm_chi2")), "p_value": two_sided_p("z")})
    sane = (F.col("rate_pooled") > 0) & (F.col("rate_pooled") * (1 + mde) < 1)
    needed = F.when(sane, required_n_per_arm(F.when(sane, F.col("rate_pooled")).otherwise(F.lit(0.1)), mde, alpha, power))
    out = out.withColumns({"srm_mismatch": F.col("srm_p") < SRM_ALPHA, "required_n": needed, "powered": F.least("n_control", "n_treatment") >= needed, "significant": F.col("p_value") < alpha})
    if injected is None:
        return out
    lifted = arm_counts(inject_lift(users, injected, seed, user, by=by), by).withColumn("lifted_z", two_proportion_z())
    lifted = lifted.select(*by, F.col("conversions_treatment").alias("lifted_conversions"), "lifted_z", two_sided_p("lifted_z").alias("lifted_p"))
    return out.join(lifted, by) if by else out.join(F.broadcast(lifted))
