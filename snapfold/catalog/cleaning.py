"""Cleaning and projection queries, over text columns made dirty by a rule on the row's key."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapfold.catalog.registry import query, table
from snapfold.functions import lenient_date, null_tokens, safe_double, safe_int, strip_modifier
from snapfold.plans.ingest import clean_and_cast
from snapfold.schema import CastSpec

_DIRTY_SQL = """CASE event_id % 7 WHEN 0 THEN 'NULL' WHEN 1 THEN '' WHEN 2 THEN ' ' WHEN 3 THEN 'NaN'
     WHEN 4 THEN '12.9' WHEN 5 THEN 'N/A' ELSE CAST(event_id AS VARCHAR) END"""
_CLEAN_SQL = f"CASE WHEN {_DIRTY_SQL} IN ('NULL', '', ' ', 'NaN') THEN NULL ELSE {_DIRTY_SQL} END"
_INT_SQL = (
    rf"try_cast(regexp_replace(trim({_CLEAN_SQL}), '^([+-]?)([0-9]*)[.][0-9]*$', '\1\2') AS INTEGER)"
)
_DATE_TEXT_SQL = """CASE o_orderkey % 4 WHEN 0 THEN '24/06/1987' WHEN 1 THEN ''
     WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END"""


def _dirty(key: str):
    k = F.col(key)
    return (
        F.when(k % 7 == 0, "NULL")
        .when(k % 7 == 1, "")
        .when(k % 7 == 2, " ")
        .when(k % 7 == 3, "NaN")
        .when(k % 7 == 4, "12.9")
        .when(k % 7 == 5, "N/A")
        .otherwise(k.cast("string"))
    )


def _dirty_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", _dirty("event_id").alias("v"))


def _date_text():
    k = F.col("o_orderkey") % 4
    return (
        F.when(k == 0, "24/06/1987")
        .when(k == 1, "")
        .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )


@query("null_token_clean", f"SELECT event_id, {_CLEAN_SQL} AS v FROM events")
def null_token_clean(spark, sf_dir):
    return _dirty_events(spark, sf_dir).select("event_id", null_tokens("v").alias("v"))


@query("safe_cast_double", f"SELECT event_id, try_cast({_CLEAN_SQL} AS DOUBLE) AS v FROM events")
def safe_cast_double(spark, sf_dir):
    return _dirty_events(spark, sf_dir).select("event_id", safe_double("v").alias("v"))


@query("safe_cast_int", f"SELECT event_id, {_INT_SQL} AS v FROM events")
def safe_cast_int(spark, sf_dir):
    return _dirty_events(spark, sf_dir).select("event_id", safe_int("v").alias("v"))


@query("lenient_date", f"SELECT o_orderkey, CAST(try_cast({_DATE_TEXT_SQL} AS TIMESTAMP) AS DATE) AS d FROM orders")
def lenient_date_query(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", lenient_date(_date_text()).alias("d"))


@query(
    "cast_string",
    "SELECT CAST(c_custkey AS VARCHAR) AS custkey_text, CAST(c_nationkey AS VARCHAR) AS nation_text FROM customer",
)
def cast_string(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("custkey_text"),
        F.col("c_nationkey").cast("string").alias("nation_text"),
    )


@query(
    "strip_modifier",
    """SELECT o_orderkey, try_cast(regexp_replace(o_orderpriority, '([+-].*)$', '') AS DOUBLE) AS rating
       FROM orders""",
)
def strip_modifier_query(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", strip_modifier("o_orderpriority").alias("rating"))


_LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "bulk_cast_double",
    f"SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _LINE_NUMBERS)}, l_returnflag FROM lineitem",
)
def bulk_cast_double(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(*_LINE_NUMBERS, "l_returnflag")
    return items.withColumns({c: F.col(c).cast("double") for c in _LINE_NUMBERS})


@query(
    "drop_columns",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus
       FROM lineitem""",
)
def drop_columns(spark, sf_dir):
    # A name that is not there is ignored.
    return table(spark, sf_dir, "lineitem").drop(
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_no_such_column"
    )


@query("select_columns", "SELECT p_partkey, p_name, p_size FROM part")
def select_columns(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")


@query(
    "tag_columns",
    "SELECT c_custkey, CAST(2020 AS INTEGER) AS resource_year, 'male' AS gender FROM customer",
)
def tag_columns(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return customers.withColumns({"resource_year": F.lit(2020).cast("int"), "gender": F.lit("male")})


@query(
    "fill_constant",
    "SELECT event_id, coalesce(nullif(event_type, 'error'), 'Unknown') AS kind FROM events",
)
def fill_constant(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return events.fillna({"kind": "Unknown"})


@query(
    "drop_null_rows",
    "SELECT event_id, event_type AS kind FROM events WHERE nullif(event_type, 'error') IS NOT NULL",
)
def drop_null_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return events.dropna(subset=["kind"])


@query(
    "clean_and_cast",
    f"""SELECT event_id, try_cast({_CLEAN_SQL} AS DOUBLE) AS money, {_INT_SQL} AS rating,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS joined,
               CAST(user_id AS VARCHAR) AS club
        FROM events""",
)
def clean_and_cast_query(spark, sf_dir):
    key = F.col("event_id")
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        _dirty("event_id").alias("money"),
        _dirty("event_id").alias("rating"),
        F.when(key % 3 == 0, "bad").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("joined"),
        F.col("user_id").alias("club"),
    )
    return clean_and_cast(raw, CastSpec(["money"], ["rating"], ["joined"], ["club"]))
