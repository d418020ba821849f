"""Filters, aggregates, windows, sorts and the four analytic queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.catalog.registry import query, table
from snapfold.operators import (
    dedup_latest,
    hash_split,
    top_n,
    top_n_with_ties,
    top_per_group,
    unique_entities,
)
from snapfold.plans import filtered_top_n, group_avg_top_n, mode_per_period, unique_histogram


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


@query("filter_slice", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "filter_conjunction",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE year(l_shipdate) = 1997 AND l_quantity >= 25""",
)
def filter_conjunction(spark, sf_dir):
    # The year as a range of dates: year(l_shipdate) = 1997 could not be pushed to the Parquet scan.
    items = table(spark, sf_dir, "lineitem")
    in_year = (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (
        F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    )
    return items.where(in_year & (F.col("l_quantity") >= 25)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("group_count", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def group_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("group_avg", "SELECT p_brand, avg(p_size) AS avg_size FROM part GROUP BY p_brand")
def group_avg(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.avg("p_size").alias("avg_size"))


@query(
    "group_count_two_keys",
    "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
)
def group_count_two_keys(spark, sf_dir):
    return _daily_events(spark, sf_dir).groupBy("day", "event_type").agg(F.count("*").alias("n"))


@query(
    "having_not_null",
    """SELECT nullif(event_type, 'error') AS kind, count(*) AS n FROM events
       GROUP BY 1 HAVING nullif(event_type, 'error') IS NOT NULL""",
)
def having_not_null(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("kind", F.nullif("event_type", F.lit("error")))
    return events.groupBy("kind").agg(F.count("*").alias("n")).where(F.col("kind").isNotNull())


@query(
    "dedup_latest",
    """SELECT event_id, ts, user_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events)
       WHERE nth = 1""",
)
def dedup_latest_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return dedup_latest(events, ["user_id"], ["ts", "event_id"])


_LATEST_TYPE = """SELECT event_type FROM (
  SELECT event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events)
  WHERE nth = 1"""


@query(
    "unique_entities_per_category",
    f"SELECT event_type, count(*) AS n FROM ({_LATEST_TYPE}) GROUP BY event_type",
)
def unique_entities_per_category(spark, sf_dir):
    return unique_entities(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"])


@query(
    "split_counts",
    """SELECT CASE WHEN h < 3435973837 THEN 'train' WHEN h < 3865470566 THEN 'val' ELSE 'test' END AS split,
              count(*) AS n
       FROM (SELECT CAST('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM orders)
       GROUP BY 1""",
)
def split_counts(spark, sf_dir):
    tagged = hash_split(table(spark, sf_dir, "orders"), ["o_orderkey"])
    return tagged.groupBy("split").agg(F.count("*").alias("n"))


@query(
    "top_n",
    """SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey
       ORDER BY n DESC, l_suppkey LIMIT 10""",
)
def top_n_query(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return top_n(counts, 10, F.desc("n"), F.asc("l_suppkey"))


@query(
    "top_n_with_ties",
    """SELECT p_partkey, p_size FROM (SELECT *, rank() OVER (ORDER BY p_size DESC) AS place FROM part)
       WHERE place <= 5""",
)
def top_n_with_ties_query(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return top_n_with_ties(parts, "p_size", 5, True, ["p_partkey"])


@query(
    "bottom_n_with_ties",
    """SELECT p_partkey, p_size FROM (SELECT *, rank() OVER (ORDER BY p_size) AS place FROM part)
       WHERE place <= 5""",
)
def bottom_n_with_ties_query(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return top_n_with_ties(parts, "p_size", 5, False, ["p_partkey"])


@query(
    "row_number_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice, nth FROM (
         SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER)
                   AS nth FROM orders) WHERE nth <= 3""",
)
def row_number_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, "nth")


@query(
    "filtered_top_n",
    """SELECT l_suppkey, count(*) AS n FROM lineitem
       WHERE year(l_shipdate) = 1997 AND l_quantity >= 25
       GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 5""",
)
def filtered_top_n_query(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    condition = (
        (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        & (F.col("l_quantity") >= 25)
    )
    return filtered_top_n(items, condition, "l_suppkey", 5)


def _avg_ties_sql(direction: str) -> str:
    return f"""SELECT p_brand, avg_size FROM (
        SELECT *, rank() OVER (ORDER BY avg_size {direction}) AS place FROM (
          SELECT p_brand, avg(p_size) AS avg_size FROM part WHERE p_type IS NOT NULL GROUP BY p_brand)
        WHERE p_brand IS NOT NULL AND avg_size IS NOT NULL) WHERE place <= 5"""


@query("avg_top_n_ties", _avg_ties_sql("DESC"))
def avg_top_n_ties(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return group_avg_top_n(parts, "p_brand", "p_size", 5, True, F.col("p_type").isNotNull(), "avg_size")


@query("avg_bottom_n_ties", _avg_ties_sql("ASC"))
def avg_bottom_n_ties(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return group_avg_top_n(parts, "p_brand", "p_size", 5, False, F.col("p_type").isNotNull(), "avg_size")


@query(
    "mode_per_period",
    """SELECT day, event_type, n, CAST(nth AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, event_type) AS nth FROM (
           SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2))
       WHERE nth = 1""",
)
def mode_per_period_query(spark, sf_dir):
    return mode_per_period(_daily_events(spark, sf_dir), "day", "event_type")


@query(
    "unique_histogram",
    f"SELECT event_type, count(*) AS unique_users FROM ({_LATEST_TYPE}) GROUP BY event_type",
)
def unique_histogram_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return unique_histogram(events, "user_id", "event_type", ["ts", "event_id"], "unique_users")


@query(
    "histogram_top_n",
    f"""SELECT event_type, count(*) AS unique_users FROM ({_LATEST_TYPE}) GROUP BY event_type
        ORDER BY unique_users DESC, event_type LIMIT 3""",
)
def histogram_top_n(spark, sf_dir):
    return unique_histogram_query(spark, sf_dir).limit(3)
