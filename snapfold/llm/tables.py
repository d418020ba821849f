"""Spark helpers of the operators: written tables, positions in a random order, connected components."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from snapfold.session import fresh_path

#: Rows that one cell of ``running`` holds on average.
CELL_ROWS = 4096


#: Bytes of the batches in which rows go to Python, unless the session names a size of its own. Spark's own bound is 64 MB, which a task
#: holds several times over: in the JVM, on the way, and as Python's objects.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Long texts in batches of few rows: the session's bound by bytes, where it has none of its own."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no more than one step.

    ``save`` writes and rereads a frame; ``drop`` deletes everything saved so far.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, []
        bounded_batches(spark)

    def save(self, df: DataFrame) -> DataFrame:
        path = fresh_path(self.spark, self.label)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        context = self.spark.sparkContext
        for name in self.paths:
            path = context._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        self.paths = []


def map_texts(df: DataFrame, function: Callable[..., list], added: str, keep_text: bool = False, step: int = 512, given: Sequence[str] = ()) -> DataFrame:
    """``df`` with new columns computed from its column ``text`` by Python, ``step`` texts at a time.

    ``function`` takes the texts, then a list for each column that ``given`` names, and gives a list for each column that the
    DDL ``added`` names. Other columns pass through in Arrow as they are.
    """
    bounded_batches(df.sparkSession)
    fields = [f for f in df.schema.fields if keep_text or f.name != "text"]
    names = [f.name for f in fields]
    new = StructType.fromDDL(added)
    types = to_arrow_schema(new)
    schema = StructType(fields + new.fields)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                values = function(*[part.column(part.schema.get_field_index(n)).to_pylist() for n in ("text", *given)])
                arrays = [part.column(part.schema.get_field_index(n)) for n in names]
                arrays += [pa.array(v, t.type) for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *types.names])

    return df.mapInArrow(apply, schema)


def whole_rows(docs: DataFrame) -> DataFrame:
    """(_row, text): all columns as one, so that new columns cannot clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def uniform_key(*columns: Column | str, seed: int = 0) -> Column:
    """A hash in [0, 2^63) that follows from the values alone."""
    return F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def running(df: DataFrame, groups: list[str], key: str, ties: list[str], rows: int, value: Column | None = None) -> DataFrame:
    """Adds ``before``: how many rows (or how much of ``value``) of a row's group precede it by ``key``, then ``ties``.

    ``key`` is uniform in [0, 2^63). Each group is cut into cells of about CELL_ROWS rows by the key's leading bits,
    so that no task sorts a whole group; a cell starts where the sums of the cells before it end. ``groups`` hold no nulls.
    """
    bits = max(0, math.ceil(math.log2(max(rows, 1) / CELL_ROWS))) if rows > CELL_ROWS else 0
    cells = df.withColumn("_cell", F.shiftrightunsigned(F.col(key), 63 - bits))
    one = F.lit(1).cast("bigint") if value is None else value.cast("bigint")
    sums = cells.groupBy(*groups, "_cell").agg(F.sum(one).alias("_sum"))
    ahead = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*groups, "_cell", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*groups, "_cell").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cells.join(starts, [*groups, "_cell"])
        .withColumn("before", F.col("_start") + F.coalesce(F.sum(one).over(inside), F.lit(0)))
        .drop("_cell", "_start")
    )


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root being the component's smallest node.

    Alternating large-star and small-star rounds: each hangs a node's neighbours on the smallest node it knows, so the
    edges shrink to stars in a logarithmic number of rounds, and no group is ever gathered in one task.
    """
    now = scratch.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
        seen = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.save(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        now = scratch.save(small.where("u <> v").distinct())
