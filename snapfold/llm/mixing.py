"""Mixing sources to target weights: hash-random order, prefix sums of token counts, a cut at each source's exact budget.

Every document gets a hash-random key. Within its source the key's leading bits put it in a range, ranges are sorted, and
their sums tell where each begins, so that the prefix sums of a source of any size are computed by many tasks. A source
whose budget exceeds its tokens is repeated: whole epochs first, then the same order up to the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.tables import Scratch, running, uniform_key

WEIGHTS = (3, 1, 2)
WHITE = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """The number of runs of ``[^\\x20\\x09-\\x0D]``; 0 for null."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, WHITE))).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, repeats: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source.

    Sources in the order of their code points, null last, take ``weights`` in turn. Target = min(repeats * size, level *
    weight), with the level at which the targets add up to ``share`` of all sizes: sources in the order of repeats * size /
    weight are full up to some place, and the level follows from what is left for the others.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("weight", F.get(table, F.pmod(rank, F.lit(len(weights))))).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    fills = F.col("cap") / F.col("weight")
    order = Window.orderBy(fills, F.col("source").isNull(), "source")
    all_rows = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(all_rows) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / rest
    rows = rows.withColumn("level", level).withColumn("place", F.row_number().over(order))
    # The first source in the order that its level does not fill sets the level of all.
    first = F.min(F.when(F.col("level") <= fills, F.struct("place", "level"))).over(all_rows)
    target = F.least(F.col("cap"), F.coalesce(first["level"] * F.col("weight"), F.col("cap")))
    return rows.select(*sizes.columns, target.alias("target"))


def measured(docs: DataFrame, size: Column | None = None, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` as ``row``, with their (source, group, size, key)."""
    name = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").alias("source"), name.alias("group"),
        (n_words(F.col("text")) if size is None else size).alias("size"),
        uniform_key("doc_id", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")), seed=seed).alias("key"),
    )


def mix(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """Adds (source_size, target, epochs, part, taken) to rows that ``measured`` gave.

    A row is taken ``epochs`` times whole, and once more ``part`` of its ``size`` tokens; ``taken`` is the sum. Of each source
    at most one row is taken in part, so that the tokens taken are the target, rounded. A null text has no tokens, a null
    source is a source, repeated rows are taken each on their own, and no rows give no rows. Rows of a source that agree in
    key and size are alike to the mix, so reruns agree.
    """
    totals = rows.groupBy("group", "source").agg(F.sum("size").alias("source_size"))
    budgets = targets(totals, weights, share, repeats).drop("source")
    placed = running(rows, ["group"], "key", ["size"], rows.count(), F.col("size"))
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    joined = placed.join(budgets, "group").withColumn("epochs", epochs)
    left = budget - F.col("epochs") * F.col("source_size") - F.col("before")
    joined = joined.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("bigint"))
    return joined.withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))


def cuts(taken: DataFrame, scratch: Scratch) -> DataFrame:
    """(group, epochs, key, size, whole, part), one row a source, from what ``mix`` gives.

    Beyond its epochs a source takes once more, whole, its rows up to the last (key, size); ``whole`` of the rows that have just these, and
    ``part`` words of one more.
    """
    taken = scratch.save(taken.select("group", "key", "size", "epochs", "part"))
    last = taken.groupBy("group").agg(F.max("epochs").alias("epochs"), F.max(F.when(F.col("part") > 0, F.struct("key", "size"))).alias("last"))
    last = scratch.save(last.select("group", "epochs", "last.key", "last.size"))
    there = taken.join(last.select("group", "key", "size"), ["group", "key", "size"], "left_semi")
    words = there.groupBy("group").agg(F.sum("part").alias("words"))
    whole = F.floor(F.col("words") / F.col("size")).cast("bigint")
    return scratch.save(last.join(words, "group", "left").select("group", "epochs", "key", "size", whole.alias("whole"), (F.col("words") - whole * F.col("size")).alias("part")))


def mixed(docs: DataFrame, scratch: Scratch | None = None, **settings) -> DataFrame:
    """``docs`` as the mix has them: a row for each epoch, and one with the first words where a budget ends within a text.

    The mix is computed on keys and sizes alone; its outcome is one line a source, by which every row of ``docs`` knows how often it is
    taken. So no text is shuffled, but for the rows that agree with the last of a source, which are numbered.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    bounds = cuts(mix(scratch.save(measured(docs).drop("row")), **settings), scratch)
    bounds = bounds.select(F.col("group").alias("_group"), "epochs", F.col("key").alias("cut"), "size", "whole", "part")
    has_word = F.coalesce(F.col("row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = measured(docs, F.lit(0)).select("row", "key", F.col("group").alias("_group")).join(bounds, "_group")
    # Words are counted again only where a key is that of the last row.
    rows = rows.withColumn("own", F.when(F.col("key") == F.col("cut"), n_words(F.col("row.text"))))
    among_last = F.coalesce(F.col("own") == F.col("size"), F.lit(False))
    before = (F.coalesce((F.col("key") < F.col("cut")) | (F.col("own") < F.col("size")), F.lit(False)) & has_word).cast("int")
    times = lambda n: F.explode(F.when(n > 0, F.sequence(F.lit(1), n.cast("int")))).alias("copy")
    plain = rows.where(~among_last).select("row", times(F.col("epochs") + before), F.lit(None).cast("bigint").alias("words"))
    last = rows.where(among_last).withColumn("number", F.row_number().over(Window.partitionBy("_group").orderBy(F.xxhash64("row.text"))))
    partly = (F.col("number") == F.col("whole") + 1) & (F.col("part") > 0)
    last = last.select("*", times(F.col("epochs") + ((F.col("number") <= F.col("whole")) | partly).cast("int")))
    return _written(plain.union(last.select("row", "copy", F.when(partly & (F.col("copy") > F.col("epochs")), F.col("part")))), docs)


def _written(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from rows (row, copy, words), texts cut to so many words where ``words`` is given."""
    cut = F.col("words").isNotNull()
    words = F.filter(F.split("row.text", WHITE), lambda w: w != "")
    text = F.when(cut, F.array_join(F.slice(words, 1, F.col("words").cast("int")), " ")).otherwise(F.col("row.text"))
    columns = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == "text":
            value = text
        elif c == "n_chars":
            value = F.when(cut, F.length(text).cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return rows.select(*columns)
