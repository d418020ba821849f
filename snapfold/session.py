"""Session for local runs, and the shared folder that written tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "snapfold", cores: str = "*", **conf: str) -> SparkSession:
    """A ``local[cores]`` session; on a cluster pass the cluster's own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # HotSpot leaves methods over 8000 bytes uncompiled: wide projections do better in pieces.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session's ``spark.checkpoint.dir`` names it.

    Only a local session may go without the setting; it then gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="snapfold-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_folder(spark)}/snapfold/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """The file system that a path lies in, and the path as that names it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that ``fresh_path`` placed; nothing happens where it was never written."""
    files, place = hadoop_path(spark, path)
    files.delete(place, True)


def ready_for_checkpoint(spark: SparkSession) -> None:
    """Make sure ``DataFrame.checkpoint()`` has a folder to write to."""
    if not spark.sparkContext.getCheckpointDir():
        folder = shared_folder(spark)
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its source comes in fewer pieces, such as a file of one row group.

    For work that costs more per row than moving the row. A table of many files stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def gathered(df: DataFrame, most: int = 4) -> DataFrame:
    """``df`` in whole rounds of tasks on all cores, up to ``most`` of its source's partitions in one; nothing is shuffled.

    For work whose tasks each send much, whatever the number of their rows. A source of no more partitions than cores stays as it is.
    """
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df if parts <= cores else df.coalesce(cores * -(-parts // (cores * most)))
