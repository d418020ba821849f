"""The four analytic queries, with column names as arguments, and their snapshot presets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfold.operators.dedup import unique_entities
from snapfold.operators.topn import top_n, top_n_with_ties, top_per_group
from snapfold.schema import YEAR_TAG


def filtered_top_n(
    df: DataFrame, condition: Column, group: str, n: int, count_name: str = "n"
) -> DataFrame:
    """Rows that meet ``condition`` counted per group, the ``n`` largest groups; null is a group.

    Equal counts come in group order, nulls first.
    """
    counts = df.where(condition).groupBy(group).agg(F.count("*").alias(count_name))
    return top_n(counts, n, F.desc(count_name), F.asc(group))


def group_avg_top_n(
    df: DataFrame,
    group: str,
    value: str,
    n: int,
    highest: bool = True,
    condition: Column | None = None,
    avg_name: str = "avg_value",
) -> DataFrame:
    """Non-null groups with the ``n`` highest (lowest) averages, ties at the cut kept.

    A group with no value at all has no average and takes no place. No rows give an empty frame.
    """
    if n <= 0:
        raise ValueError("n must be a positive integer.")
    rows = df if condition is None else df.where(condition)
    averages = (
        rows.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(value).alias(avg_name))
    )
    inexact = isinstance(df.schema[value].dataType, T.FractionalType)
    return top_n_with_ties(averages, avg_name, n, highest, [F.asc(group)], settle=inexact)


def mode_per_period(
    df: DataFrame, period: str, category: str, count_name: str = "n", rank_name: str = "rank"
) -> DataFrame:
    """The most frequent category of each period, one row per period; equal counts go by category."""
    counts = df.groupBy(period, category).agg(F.count("*").alias(count_name))
    order = [F.desc(count_name), F.asc(category)]
    return top_per_group(counts, [period], order, 1, rank_name).orderBy(period)


def unique_histogram(
    df: DataFrame, key: str, category: str, latest_by: Sequence[str], count_name: str = "n"
) -> DataFrame:
    """Entities per category, each entity once under its latest category; largest first."""
    counts = unique_entities(df, key, category, latest_by, count_name)
    return counts.orderBy(F.desc(count_name), F.asc(category))


def clubs_with_contracts(df: DataFrame, X: int, Y: int, Z: int) -> DataFrame:
    """In year ``X``, the ``Y`` clubs with most players under contract until ``Z`` or later."""
    condition = (F.col(YEAR_TAG) == X) & (F.col("club_contract_valid_until") >= Z)
    return filtered_top_n(df, condition, "club_name", Y, "player_count")


def clubs_by_avg_age(
    df: DataFrame,
    X: int,
    Y: int,
    highest: bool = True,
    valid_years: tuple[int, int] | None = (2015, 2022),
) -> DataFrame:
    """In year ``Y``, the clubs with the ``X`` highest (lowest) mean ages, ties kept."""
    if X <= 0:
        raise ValueError("X must be a positive integer.")
    if valid_years is not None and not valid_years[0] <= Y <= valid_years[1]:
        raise ValueError(f"Y must be between {valid_years[0]} and {valid_years[1]}.")
    return group_avg_top_n(df, "club_name", "age", X, highest, F.col(YEAR_TAG) == Y, "avg_age")


def most_popular_nationality(df: DataFrame) -> DataFrame:
    """The nationality with most players in each year."""
    return mode_per_period(df, YEAR_TAG, "nationality_name", "player_count")


def nationality_histogram(df: DataFrame) -> DataFrame:
    """Different players per nationality over all years, the whole table, largest first."""
    return unique_histogram(df, "sofifa_id", "nationality_name", [YEAR_TAG], "unique_players")


def nationality_bars(df: DataFrame, top_n: int = 20) -> DataFrame:
    """The ``top_n`` bars of the nationality chart; small enough to collect and draw."""
    return nationality_histogram(df).limit(top_n)
