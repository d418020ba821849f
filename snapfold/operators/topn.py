"""Top-N reports: plain, with ties, and per group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.session import ready_for_checkpoint


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows; give a total order, or ties at the cut are arbitrary."""
    return df.orderBy(*order).limit(n)


def top_n_with_ties(
    df: DataFrame,
    value: str,
    n: int,
    highest: bool = True,
    tie_break: Sequence[Column | str] = (),
    settle: bool = False,
) -> DataFrame:
    """Rows whose ``value`` is among the ``n`` highest (lowest), all ties at the cut kept, sorted.

    Equal values come in order of ``tie_break``, by default all other columns: a sort that told ties
    not apart would put them all into one task.
    The cut is a one-row scalar subquery, so every task filters its own rows and ties of any number
    stay spread out. Where ``df`` is an aggregate, both readers share one shuffle (ReusedExchange).
    ``settle`` writes ``df`` to the checkpoint folder first: needed where ``value`` sums doubles, as
    their last bits depend on the order in which shuffle blocks arrive and the two readers could differ.
    """
    if n <= 0:
        raise ValueError("n must be a positive integer.")
    rows = df.where(F.col(value).isNotNull())
    if settle:
        ready_for_checkpoint(df.sparkSession)
        rows = rows.checkpoint()
    if highest:
        order, edge = F.col(value).desc(), F.min(value)
    else:
        order, edge = F.col(value).asc(), F.max(value)
    cut = rows.select(value).orderBy(order).limit(n).agg(edge.alias("cut")).scalar()
    kept = rows.where(F.col(value) >= cut if highest else F.col(value) <= cut)
    return kept.orderBy(order, *(tie_break or [c for c in df.columns if c != value]))


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    rank_name: str = "rank",
    rows_per_task: int = 1 << 20,
) -> DataFrame:
    """The first ``n`` rows of each group by ``order``, numbered from 1.

    Spark cuts each task's rows to ``n`` per group before the shuffle (WindowGroupLimit) while ``n`` is not above
    ``spark.sql.optimizer.windowGroupLimitThreshold``. For larger ``n`` the rows of a group are dealt by their hash to parts of about
    ``rows_per_task``, as many as the table needs, each is cut to ``n``, and parts meet in a tree: no task gets more than some
    ``rows_per_task``, or twice ``n``, rows of a group.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        parts = math.ceil(df.count() / max(rows_per_task, 2 * n))
        fan_in = max(2, rows_per_task // n)
        plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        df = df.withColumn("_part", F.pmod(F.xxhash64(*plain), F.lit(max(1, parts))))
        while parts > 1:
            within = Window.partitionBy(*keys, "_part").orderBy(*order)
            df = df.withColumn("_nth", F.row_number().over(within)).where(F.col("_nth") <= n).drop("_nth")
            df, parts = df.withColumn("_part", F.floor(F.col("_part") / fan_in)), math.ceil(parts / fan_in)
        df = df.drop("_part")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(window)).where(F.col(rank_name) <= n)
