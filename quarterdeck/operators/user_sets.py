"""Exact sets of users that can be merged: distinct users of any span from daily sets.

Users get dense numbers, and a set is a row of 4 KB of bits for each block of 32,768
numbers. Days are counted once; a week, a month or any other span is the union of
its days' sets, where sums of daily users would count people once a day.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.operators.ranks import dense_numbers


def user_numbers(s: DataFrame, user: str = "user_pseudo_id") -> DataFrame:
    """(user, user_number): dense numbers from 1. Sets that are to be merged need the numbers of the same table."""
    return dense_numbers(s, user, "_n").select(user, (F.col("_n") + 1).alias("user_number"))


def user_sets(s: DataFrame, numbers: DataFrame, by: dict[str, Column], user: str = "user_pseudo_id") -> DataFrame:
    """(by, block, users): the bits of each group's users, by block of numbers. Rows without a user are in no set."""
    n = F.col("user_number")
    rows = s.withColumns(by).select(*by, user).join(numbers, user)
    return rows.groupBy(*by, F.bitmap_bucket_number(n).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("users"))


def merged_sets(sets: DataFrame, by: list[str]) -> DataFrame:
    """The unions of sets over all columns but ``by``."""
    return sets.groupBy(*by, "block").agg(F.bitmap_or_agg("users").alias("users"))


def distinct_users(sets: DataFrame, by: list[str], into: str = "users") -> DataFrame:
    """(by, into): how many users the union of a group's sets has."""
    return merged_sets(sets, by).groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias(into))


def users_of_spans(sets: DataFrame, spans: DataFrame, date: str = "date", into: str = "users") -> DataFrame:
    """(span, into): distinct users of each span (``span``, ``first``, ``last``: dates, both included) from daily sets."""
    days = spans.select("span", F.explode(F.sequence("first", "last")).alias(date))
    return distinct_users(days.join(sets, date).select("span", "block", "users"), ["span"], into)
