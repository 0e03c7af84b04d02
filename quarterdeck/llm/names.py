"""Column names that may clash with a table's own."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column of this very name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def columns(df: DataFrame) -> list[Column]:
    return [quoted(c) for c in df.columns]


def fresh(name: str, *tables: DataFrame) -> str:
    """``name``, with underscores after it until no table has it."""
    taken = {c.lower() for df in tables for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
