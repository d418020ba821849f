"""One row per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedup_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key, null keys counting as one key: the greatest by ``latest_by``.

    Ties go to the greatest remaining columns, in the frame's order, so the outcome is fixed. ``max``
    over a struct combines within each task first: a key that holds a third of all rows crosses the
    shuffle as one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    fields = [*latest_by, *rest]
    if not fields:
        return df.distinct()
    newest = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_newest"))
    return newest.select(
        *[F.col(c) if c in keys else F.col("_newest").getField(c).alias(c) for c in df.columns]
    )


def unique_entities(
    df: DataFrame, key: str, category: str, latest_by: Sequence[str], count_name: str = "n"
) -> DataFrame:
    """Entities per category, each entity counted once, under its latest category.

    With one order column of fixed width, the latest date of each entity in each category comes first: a hash
    aggregate, so that only pairs of entity and category are sorted for the struct's ``max``, not all rows.
    """
    columns = list(dict.fromkeys([key, *latest_by, category]))
    order = [c for c in latest_by if c != key]
    rows = df.select(*columns)
    fixed_width = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if len(order) == 1 and order[0] != category and isinstance(df.schema[order[0]].dataType, fixed_width):
        rows = rows.groupBy(*dict.fromkeys([key, category])).agg(F.max(order[0]).alias(order[0]))
    latest = dedup_latest(rows, [key], order)
    return latest.groupBy(category).agg(F.count("*").alias(count_name))
