"""Sources and sinks. Written tables go to the session's shared folder."""

from __future__ import annotations

import contextlib

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from snapfold.catalog.registry import query, table
from snapfold.plans.ingest import ingest, ingest_new
from snapfold.schema import CastSpec
from snapfold.session import fresh_path
from snapfold.sources import (
    FileEntry,
    append_batch,
    append_table,
    footer_report,
    overwrite_table,
    read_batches,
    read_manifest,
    read_table,
    read_text_csv,
    replace_partitions,
    sample_rows,
    schema_report,
)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


@query(
    "csv_scan_typed",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_scan_typed(spark, sf_dir):
    path = fresh_path(spark, "customer-csv")
    table(spark, sf_dir, "customer").write.csv(path, header=True)
    text = read_text_csv(spark, path)
    return text.select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
        F.col("c_acctbal").try_cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )


@query("parquet_roundtrip", _ORDERS_SQL)
def parquet_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "orders")
    overwrite_table(_orders(spark, sf_dir), path)
    return read_table(spark, path)


@query("table_append_roundtrip", _ORDERS_SQL)
def table_append_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "orders-append")
    orders = _orders(spark, sf_dir)
    append_table(orders.where(F.col("o_orderstatus") == "F"), path)
    others = orders.where(~F.col("o_orderstatus").eqNullSafe("F"))
    append_table(others.select(*reversed(others.columns)), path)  # matched by name, not place
    return read_table(spark, path)


@query("table_overwrite_subset", _ORDERS_SQL + " WHERE o_orderstatus = 'F'")
def table_overwrite_subset(spark, sf_dir):
    path = fresh_path(spark, "orders-slice")
    orders = _orders(spark, sf_dir)
    overwrite_table(orders, path)
    overwrite_table(orders.where(F.col("o_orderstatus") == "F"), path)
    return read_table(spark, path)


@query("idempotent_reload", _ORDERS_SQL)
def idempotent_reload(spark, sf_dir):
    path = fresh_path(spark, "orders-reload")
    orders = _orders(spark, sf_dir)
    overwrite_table(orders, path, ["o_orderstatus"])
    replace_partitions(orders, path, ["o_orderstatus"])
    return read_table(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _yearly_order_files(spark, sf_dir) -> list[FileEntry]:
    """Orders as one CSV folder per year; the odd years with their columns in another order."""
    path = fresh_path(spark, "orders-by-year")
    orders = table(spark, sf_dir, "orders").select(
        F.coalesce(F.year("o_orderdate"), F.lit(0)).alias("y"),  # 0: without a date
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 == 0, "NULL").otherwise(F.col("o_custkey").cast("string")).alias("cust"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.when(F.col("o_orderkey") % 3 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.col("o_orderpriority").alias("priority"),
    )
    odd = F.col("y") % 2 == 1
    orders.where(~odd).write.partitionBy("y").csv(f"{path}/even", header=True)
    swapped = orders.where(odd).select("y", "priority", "day", "o_orderkey", "cust", "price")
    swapped.write.partitionBy("y").csv(f"{path}/odd", header=True)
    return [
        FileEntry(f"{path}/{'odd' if year % 2 else 'even'}/y={year}", {"resource_year": year, "gender": "all"})
        for (year,) in orders.select("y").distinct().orderBy("y").collect()
    ]


@query(
    "manifest_union",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
              CASE WHEN o_orderkey % 5 = 0 THEN 'NULL' ELSE CAST(o_custkey AS VARCHAR) END AS cust,
              CASE WHEN o_orderkey % 3 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
              o_orderpriority AS priority, CAST(year(o_orderdate) AS INTEGER) AS resource_year, 'all' AS gender
       FROM orders""",
)
def manifest_union(spark, sf_dir):
    rows = read_manifest(spark, _yearly_order_files(spark, sf_dir))
    return rows.select("o_orderkey", "cust", "day", "priority", "resource_year", "gender")


@query(
    "ingest_end_to_end",
    """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey,
              CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS cust,
              o_totalprice AS price,
              CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
              o_orderpriority AS priority, CAST(year(o_orderdate) AS INTEGER) AS resource_year, 'all' AS gender
       FROM orders""",
)
def ingest_end_to_end(spark, sf_dir):
    path = fresh_path(spark, "orders-table")
    casts = CastSpec(["price"], ["o_orderkey", "cust"], ["day"], ["priority"])
    ingest(spark, _yearly_order_files(spark, sf_dir), path, casts)
    loaded = read_table(spark, path)
    return loaded.select("o_orderkey", "cust", "price", "day", "priority", "resource_year", "gender")


@query(
    "append_exactly_once",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS version FROM orders""",
)
def append_exactly_once(spark, sf_dir):
    """Two batches, the second loaded three times: once with a task that fails half-way, once whole, and once again."""
    path = fresh_path(spark, "orders-batches")
    orders = _orders(spark, sf_dir)
    finished = F.col("o_orderstatus").eqNullSafe("F")
    append_batch(orders.where(finished), path, "finished")
    others = orders.where(~finished).select(*reversed(orders.columns))
    breaking = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("a task is lost")).cast("double")).otherwise(F.col("o_totalprice"))
    with contextlib.suppress(PySparkException):
        append_batch(others.withColumn("o_totalprice", breaking), path, "others")
    for _ in range(2):
        append_batch(others, path, "others")
    return read_batches(spark, path, versions=True)


@query(
    "ingest_by_ledger",
    """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey,
              CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS cust,
              o_totalprice AS price, CAST(year(o_orderdate) AS INTEGER) AS resource_year,
              CAST(CASE WHEN year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) THEN 2 ELSE 1 END AS BIGINT) AS version
       FROM orders""",
)
def ingest_by_ledger(spark, sf_dir):
    """All years but the last, then all of them, then all again: each file is read once, the last year's by the second load."""
    path = fresh_path(spark, "orders-by-ledger")
    casts = CastSpec(["price"], ["o_orderkey", "cust"], ["day"], ["priority"])
    files = _yearly_order_files(spark, sf_dir)
    for some in (files[:-1], files, files):
        ingest_new(spark, some, path, casts)
    return read_batches(spark, path, versions=True).select("o_orderkey", "cust", "price", "resource_year", "version")


_PART_TYPES = [
    ("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
    ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double"),
]


@query(
    "schema_report",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS present FROM part"
        for i, (c, t) in enumerate(_PART_TYPES)
    ),
)
def schema_report_query(spark, sf_dir):
    return schema_report(table(spark, sf_dir, "part"), count=True)


@query(
    "footer_report",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS data_type, count(*) AS rows, count({c}) AS present, "
        + (f"CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high" if t in ("bigint", "int") else "CAST(NULL AS VARCHAR) AS low, CAST(NULL AS VARCHAR) AS high")
        + " FROM part"
        for i, (c, t) in enumerate(_PART_TYPES)
    ),
)
def footer_report_query(spark, sf_dir):
    """The same from the files' footers, with the bounds of integers."""
    return footer_report(spark, f"{sf_dir}/part.parquet", [c for c, t in _PART_TYPES if t in ("bigint", "int")])


@query(
    "sample_rows",
    "SELECT p_name, p_brand, p_size, p_type FROM part ORDER BY p_partkey LIMIT 5",
)
def sample_rows_query(spark, sf_dir):
    return sample_rows(table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_size", "p_type"], ["p_partkey"])
