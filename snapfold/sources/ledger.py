"""Tables of batches: every batch is in once, however often it is loaded, and never in part.

A table is a folder. ``batches/<id>/`` holds what one load has written, ``log/<version>.json`` what it has committed: one
line with its batches, each with a name, a fingerprint and a folder. A load writes its folder first and then creates the next log
file, which only one writer can. So a load that fails leaves nothing that readers see, one that is run again finds its batches in
the log, and of two at the same time one commits first. The newest entry of a name counts: the same name with another fingerprint
replaces the batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from snapfold.schema import align
from snapfold.session import drop_path, hadoop_path

_LOG = "schema string, batches array<struct<name:string,fingerprint:string,folder:string>>"
_ENTRY = "name string, version bigint, fingerprint string, folder string"


@dataclass(frozen=True)
class Batch:
    """A batch to be committed; without a folder it holds no rows."""

    name: str
    fingerprint: str = ""
    folder: str | None = None


def _files(spark: SparkSession, folder: str) -> list[str]:
    fs, path = hadoop_path(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def _versions(spark: SparkSession, table: str) -> list[int]:
    return [int(name.removesuffix(".json")) for name in _files(spark, f"{table}/log") if name.endswith(".json")]


def _create(spark: SparkSession, file: str, text: str) -> bool:
    """Create a file; False if there is one already."""
    fs, path = hadoop_path(spark, file)
    try:
        out = fs.create(path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or fs.exists(path):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def entries(spark: SparkSession, table: str) -> DataFrame:
    """(name, version, fingerprint, folder): the newest entry of each batch. A log file that was not written to its end commits nothing."""
    if not _versions(spark, table):
        return spark.createDataFrame([], _ENTRY)
    version = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("bigint").alias("version")
    lines = spark.read.schema(_LOG).json(f"{table}/log").select(version, F.inline("batches"))
    newest = lines.groupBy("name").agg(F.max_by(F.struct("version", "fingerprint", "folder"), "version").alias("entry"))
    return newest.select("name", "entry.*")


def table_schema(spark: SparkSession, table: str) -> StructType | None:
    """The schema that the first commit set; None before it."""
    if not _versions(spark, table):
        return None
    found = spark.read.schema(_LOG).json(f"{table}/log").where("schema is not null").select("schema").limit(1).collect()
    return StructType.fromJson(json.loads(found[0][0])) if found else None


def new_folder(table: str) -> str:
    """A name, relative to the table, that no load has had."""
    return f"batches/{uuid.uuid4().hex}"


def commit(spark: SparkSession, table: str, batches: Sequence[Batch], schema: StructType) -> bool:
    """Enter batches, all of them or none; False if each is in already, as another load has entered them meanwhile.

    As in any Parquet table, each column may hold nulls.
    """
    columns = StructType([StructField(f.name, f.dataType) for f in schema.fields])
    line = json.dumps({"schema": columns.json(), "batches": [vars(b) for b in batches]})
    while True:
        versions = _versions(spark, table)
        wanted = spark.createDataFrame([(b.name, b.fingerprint) for b in batches], "name string, fingerprint string")
        if versions and wanted.join(entries(spark, table), ["name", "fingerprint"], "left_anti").isEmpty():
            return False
        if _create(spark, f"{table}/log/{max(versions, default=0) + 1:012d}.json", line + "\n"):
            return True


def aligned(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the table's columns by name; as it is before the first commit."""
    schema = table_schema(df.sparkSession, table)
    return df if schema is None else align(df, schema)


def append_batch(df: DataFrame, table: str, name: str, fingerprint: str = "") -> bool:
    """Add the rows of a batch, once: False, and nothing is read, if the table has this batch with this fingerprint.

    Columns match by name, extra ones are refused. A batch of the same name and another fingerprint replaces the old one.
    """
    spark = df.sparkSession
    if not entries(spark, table).where((F.col("name") == name) & (F.col("fingerprint") == fingerprint)).isEmpty():
        return False
    rows, folder = aligned(df, table), new_folder(table)
    rows.write.parquet(f"{table}/{folder}")
    if commit(spark, table, [Batch(name, fingerprint, folder)], rows.schema):
        return True
    drop_path(spark, f"{table}/{folder}")
    return False


def read_batches(spark: SparkSession, table: str, versions: bool = False) -> DataFrame:
    """The rows of all batches that are in; with ``versions``, also the number of the commit that brought each."""
    schema = table_schema(spark, table)
    if schema is None:
        raise ValueError(f"{table} has no batches.")
    live = entries(spark, table).where("folder is not null")
    folders = [r["folder"] for r in live.select("folder").collect()]  # as Spark lists a table's files
    if not folders:
        rows = spark.createDataFrame([], schema)
        return rows.withColumn("version", F.lit(None).cast("bigint")) if versions else rows
    rows = spark.read.schema(schema).parquet(*[f"{table}/{f}" for f in folders])
    if not versions:
        return rows
    folder = F.regexp_extract(F.col("_metadata.file_path"), r".*/(batches/.*)/[^/]*$", 1)
    return rows.withColumn("_folder", folder).join(live.select(F.col("folder").alias("_folder"), "version"), "_folder").drop("_folder")


def clean_up(spark: SparkSession, table: str) -> int:
    """Delete what failed or replaced loads have left; how many folders. Only while nobody loads."""
    live = {r["folder"].split("/")[1] for r in entries(spark, table).where("folder is not null").select("folder").collect()}
    dead = [name for name in _files(spark, f"{table}/batches") if name not in live]
    for name in dead:
        drop_path(spark, f"{table}/batches/{name}")
    return len(dead)
