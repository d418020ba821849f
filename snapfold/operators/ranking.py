"""Consecutive numbers over a whole table, and category indexes built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.session import ready_for_checkpoint

_ROW_BITS = 33  # monotonically_increasing_id(): partition number above, row number below


def global_index(df: DataFrame, order: Sequence[Column], name: str = "index") -> DataFrame:
    """Number all rows 0, 1, 2, ... in ``order`` without drawing them into one task.

    A range sort, written to the checkpoint folder so that a lost executor cannot renumber it; then
    each partition's first number is added, from one tiny row per partition. Rows equal by ``order``
    are told apart by their other columns, so that a frequent value is spread over several tasks.
    """
    ready_for_checkpoint(df.sparkSession)
    spot = F.monotonically_increasing_id()
    placed = (
        df.orderBy(*order, *df.columns)
        .withColumn("_spot", spot)
        .withColumn("_part", F.shiftright("_spot", _ROW_BITS))
        .withColumn("_nth", F.col("_spot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_spot")
        .checkpoint()
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    # One row per partition of the sort: its size is bounded by the number of shuffle partitions.
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, F.col("_start") + F.col("_nth")).drop("_part", "_nth", "_start")


def frequency_index(df: DataFrame, column: str, name: str, labels_from: DataFrame | None = None) -> DataFrame:
    """Index of each row's category, most frequent first, ties alphabetical.

    Null, and a category ``labels_from`` (default: ``df``) has not seen, get the number after the last.
    Any number of categories will do: the label table is joined, and Spark broadcasts it only where its
    measured size is under the threshold; otherwise the join is a shuffle whose hot keys AQE splits.
    """
    source = df if labels_from is None else labels_from
    counts = source.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    labels = global_index(counts, [F.desc("_n"), F.asc(column)], name).select(column, name)
    beyond = labels.agg(F.count("*")).scalar()
    joined = df.join(labels, column, "left")
    return joined.select(*df.columns, F.coalesce(F.col(name), beyond).cast("double").alias(name))
