"""Column expressions shared by the operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a, b) -> Column:
    """a / b as double; null where b is zero."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return a / F.nullif(b, F.lit(0))


def quarter_index(date: str | Column) -> Column:
    return F.year(date) * 4 + F.quarter(date)


def quarter_end(date: str | Column) -> Column:
    return F.last_day(F.add_months(F.trunc(date, "quarter"), 2))


def quarter_tag(date: str | Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def week_of(date: str | Column) -> Column:
    """Monday of the date's week."""
    return F.trunc(date, "week")


def _value(params: Column, key: str) -> Column:
    # By position rather than by a filter: a lambda is interpreted for each entry and keeps its projection out of generated code.
    return F.get(params, F.array_position(params["key"], F.lit(key)).cast("int") - 1)["value"]


def param_str(params: Column, key: str) -> Column:
    """String value of the first parameter with a key; null if there is none."""
    return _value(params, key)["string_value"]


def param_int(params: Column, key: str) -> Column:
    """Integer value of the first parameter with a key, else its string value if that is an integer."""
    value = _value(params, key)
    return F.coalesce(value["int_value"], value["string_value"].try_cast("bigint"))


def param_repeated(params: Column, key: str) -> Column:
    """Whether a key occurs more than once."""
    return F.size(F.filter(params, lambda p: p["key"] == key)) > 1


def pair_corr(a: str, b: str) -> Column:
    """Correlation over rows that have both values; null where one is constant."""
    x, y = (F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(c)) for c in (a, b))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded, without negative zeros."""
    return df.select(*[(F.round(F.col(c), digits) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
