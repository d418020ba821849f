"""Imputation, indexing, one-hot, assembly, scaling, and splits."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from snapfold.catalog.registry import query, table
from snapfold.ml.features import (
    ColumnDropper,
    FeatureTypeCaster,
    PositionCaster,
    check_categories,
    export_features,
    fit_features,
)
from snapfold.ml.moments import correlated_columns
from snapfold.ml.sparse import vector_entries
from snapfold.operators import frequency_index, hash_split, impute_median, with_fold
from snapfold.schema import FeatureRoles

# md5(seed:key) as used by hash_split and with_fold, in SQL.


def hash_sql(key: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


def split_sql(key: str) -> str:
    # 0.8, 0.9 of 2**32
    return f"""CASE WHEN {hash_sql(key)} < 3435973837 THEN 'train'
                    WHEN {hash_sql(key)} < 3865470566 THEN 'val' ELSE 'test' END"""


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]


def _with_gaps(spark, sf_dir):
    """Events with every fifth value missing."""
    value = F.when(F.col("event_id") % 5 != 0, F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))


@query(
    "median_impute",
    """WITH gaps AS (SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events)
       SELECT event_id, coalesce(value, (SELECT quantile_disc(value, 0.5) FROM gaps)) AS value FROM gaps""",
)
def median_impute(spark, sf_dir):
    return impute_median(_with_gaps(spark, sf_dir), ["value"])


def _kinds(spark, sf_dir):
    """Events with one type made null, so that the index has an unknown category to place."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("kind")
    )


_INDEX_SQL = """WITH kinds AS (SELECT event_id, nullif(event_type, 'error') AS kind FROM events),
  counts AS (SELECT kind, count(*) AS n FROM kinds WHERE kind IS NOT NULL GROUP BY kind),
  labels AS (SELECT kind, CAST(row_number() OVER (ORDER BY n DESC, kind) - 1 AS DOUBLE) AS idx FROM counts),
  indexed AS (SELECT k.event_id, k.kind,
    coalesce(l.idx, (SELECT CAST(count(*) AS DOUBLE) FROM labels)) AS kind_index
  FROM kinds k LEFT JOIN labels l ON k.kind = l.kind) """


@query("frequency_index", _INDEX_SQL + "SELECT event_id, kind, kind_index FROM indexed")
def frequency_index_query(spark, sf_dir):
    return frequency_index(_kinds(spark, sf_dir), "kind", "kind_index")


@query(
    "frequency_index_large",
    """WITH counts AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey),
         labels AS (SELECT l_partkey, row_number() OVER (ORDER BY n DESC, l_partkey) - 1 AS idx FROM counts)
       SELECT i.l_orderkey, i.l_linenumber, i.l_partkey, CAST(l.idx AS DOUBLE) AS part_index
       FROM lineitem i JOIN labels l ON i.l_partkey = l.l_partkey""",
)
def frequency_index_large(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return frequency_index(items, "l_partkey", "part_index")


@query(
    "one_hot",
    _INDEX_SQL
    + """SELECT event_id, CAST(kind_index = 0 AS DOUBLE) AS is_0, CAST(kind_index = 1 AS DOUBLE) AS is_1,
                CAST(kind_index = 2 AS DOUBLE) AS is_2, CAST(kind_index = 3 AS DOUBLE) AS is_3 FROM indexed""",
)
def one_hot(spark, sf_dir):
    kinds = _kinds(spark, sf_dir)
    check_categories(kinds, ["kind"])
    stages = [
        StringIndexer(inputCols=["kind"], outputCols=["kind_index"], handleInvalid="keep"),
        OneHotEncoder(inputCols=["kind_index"], outputCols=["kind_encoded"]),
    ]
    encoded = Pipeline(stages=stages).fit(kinds).transform(kinds)
    flags = encoded.select("event_id", vector_to_array("kind_encoded").alias("f"))
    return flags.select("event_id", *[F.col("f")[i].alias(f"is_{i}") for i in range(4)])


@query(
    "assemble_features",
    "SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2 FROM lineitem",
)
def assemble_features(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_MEASURES)
    vectors = VectorAssembler(inputCols=_MEASURES, outputCol="v", handleInvalid="error").transform(items)
    arrays = vectors.select("l_orderkey", "l_linenumber", vector_to_array("v").alias("f"))
    return arrays.select("l_orderkey", "l_linenumber", *[F.col("f")[i].alias(f"f{i}") for i in range(3)])


def _scaled(spark, sf_dir, rows, fit_rows):
    stages = [
        VectorAssembler(inputCols=_MEASURES, outputCol="v"),
        StandardScaler(inputCol="v", outputCol="scaled"),
    ]
    return Pipeline(stages=stages).fit(fit_rows).transform(rows).withColumn("f", vector_to_array("scaled"))


def _scaled_sql(source: str, fit_source: str, extra: str = "") -> str:
    return f"""SELECT l_orderkey, l_linenumber{extra}, {', '.join(
        f'round({c} / (SELECT stddev_samp({c}) FROM {fit_source}), 6) AS f{i}' for i, c in enumerate(_MEASURES)
    )} FROM {source}"""


@query("standard_scale", _scaled_sql("lineitem", "lineitem"))
def standard_scale(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_MEASURES)
    scaled = _scaled(spark, sf_dir, items, items)
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(F.col("f")[i], 6).alias(f"f{i}") for i in range(3)])


@query(
    "split_then_scale",
    f"WITH tagged AS (SELECT *, {split_sql('l_orderkey')} AS split FROM lineitem), "
    "train AS (SELECT * FROM tagged WHERE split = 'train') " + _scaled_sql("tagged", "train", ", split"),
)
def split_then_scale(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_MEASURES)
    tagged = hash_split(items, ["l_orderkey"])
    scaled = _scaled(spark, sf_dir, tagged, tagged.where(F.col("split") == "train"))
    return scaled.select(
        "l_orderkey", "l_linenumber", "split", *[F.round(F.col("f")[i], 6).alias(f"f{i}") for i in range(3)]
    )


@query(
    "exclude_columns",
    """SELECT round(corr(l_quantity, l_extendedprice), 6) AS quantity_price,
              round(corr(l_quantity, l_discount), 6) AS quantity_discount,
              round(corr(l_extendedprice, l_discount), 6) AS price_discount FROM lineitem""",
)
def exclude_columns(spark, sf_dir):
    """The correlations that an exclusion list rests on, all in one pass."""
    pair = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount"}
    pairs = [("quantity", "price"), ("quantity", "discount"), ("price", "discount")]
    return table(spark, sf_dir, "lineitem").agg(
        *[F.round(F.corr(pair[a], pair[b]), 6).alias(f"{a}_{b}") for a, b in pairs]
    )


_CLOSE = 0.9
_NAMES = ["quantity", "price", "noisy_quantity", "discount", "minus_discount", "half_quantity"]
_CLOSE_SQL = f"""WITH RECURSIVE wide AS (
    SELECT l_quantity AS quantity, l_extendedprice AS price, l_quantity + l_linenumber * 0.5 AS noisy_quantity, l_discount AS discount,
           0.01 * (l_linenumber % 2) - l_discount AS minus_discount,
           CASE WHEN l_linenumber % 2 = 0 THEN l_quantity * 3 + l_tax END AS half_quantity
    FROM lineitem),
  r AS (SELECT {', '.join(f"corr({a}, {b}) AS {a}__{b}" for i, a in enumerate(_NAMES) for b in _NAMES[i + 1 :])} FROM wide),
  pairs AS ({' UNION ALL '.join(f"SELECT {i} AS a, {j} AS b, {a}__{b} AS r FROM r" for i, a in enumerate(_NAMES) for j, b in enumerate(_NAMES) if i < j)}),
  close AS (SELECT a, b FROM pairs WHERE abs(r) >= {_CLOSE} UNION ALL SELECT b, a FROM pairs WHERE abs(r) >= {_CLOSE}),
  steps(gone) AS (
    SELECT CAST([] AS INTEGER[])
    UNION ALL
    SELECT list_append(gone, (
      SELECT a FROM close WHERE NOT list_contains(gone, a) AND NOT list_contains(gone, b) GROUP BY a ORDER BY count(*) DESC, a DESC LIMIT 1))
    FROM steps WHERE EXISTS (SELECT 1 FROM close WHERE NOT list_contains(gone, a) AND NOT list_contains(gone, b))),
  last AS (SELECT gone FROM steps ORDER BY len(gone) DESC LIMIT 1)
  SELECT CAST(n AS INTEGER) AS place, name, list_contains((SELECT gone FROM last), CAST(n AS INTEGER)) AS excluded
  FROM (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(_NAMES))}) names(n, name)"""


@query("exclude_correlated", _CLOSE_SQL)
def exclude_correlated(spark, sf_dir):
    """Which columns a greedy cover of the close pairs leaves out, from one pass; one column has gaps."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), (F.col("l_quantity") + F.col("l_linenumber") * 0.5).alias("noisy_quantity"),
        F.col("l_discount").alias("discount"), (0.01 * (F.col("l_linenumber") % 2) - F.col("l_discount")).alias("minus_discount"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity") * 3 + F.col("l_tax")).alias("half_quantity"),
    )
    gone = correlated_columns(items, _NAMES, _CLOSE)
    return spark.createDataFrame([(i, c, c in gone) for i, c in enumerate(_NAMES)], "place int, name string, excluded boolean")


_BLOCKS_SQL = """WITH rows AS (SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_partkey AS VARCHAR) AS part, CAST(l_orderkey AS VARCHAR) AS ord FROM lineitem),
  total AS (SELECT CAST(count(*) AS DOUBLE) AS n, stddev_samp(l_quantity) AS quantity, stddev_samp(l_linenumber) AS line FROM rows),
  parts AS (SELECT part, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, part) AS place FROM rows GROUP BY part),
  orders_ AS (SELECT ord, count(*) AS n, (SELECT count(*) FROM parts) + row_number() OVER (ORDER BY count(*) DESC, ord) AS place FROM rows GROUP BY ord)
  SELECT l_orderkey, l_linenumber, CAST(p.place AS INTEGER) AS part_at, CAST(o.place AS INTEGER) AS order_at,
         CAST(1 + (SELECT count(*) FROM parts) + (SELECT count(*) FROM orders_) AS INTEGER) AS line_at,
         round(l_quantity / t.quantity, 6) AS quantity_value, round(1 / sqrt(p.n * (t.n - p.n) / (t.n * (t.n - 1))), 6) AS part_value,
         round(1 / sqrt(o.n * (t.n - o.n) / (t.n * (t.n - 1))), 6) AS order_value, round(l_linenumber / t.line, 6) AS line_value
  FROM rows JOIN parts p USING (part) JOIN orders_ o USING (ord), total t"""


@query("one_hot_large", _BLOCKS_SQL)
def one_hot_large(spark, sf_dir):
    """Scaled vectors with a block for each part and one for each order, whose categories stay in a table; their entries as columns."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_partkey").alias("part"), F.col("l_orderkey").alias("ord"), F.col("l_linenumber").alias("line"))
    roles = FeatureRoles(continuous=["l_quantity"], nominal=["part", "ord"], ordinal=["line"])
    vectors = fit_features(items, roles, split=None, max_categories=100).transform(items)
    cells = vectors.select("l_orderkey", "l_linenumber", vector_entries("features").alias("e"))
    names = ["quantity", "part", "order", "line"]
    return cells.select(
        "l_orderkey", "l_linenumber", *[F.col("e")[i]["at"].alias(f"{c}_at") for i, c in enumerate(names) if i],
        *[F.round(F.col("e")[i]["value"], 6).alias(f"{c}_value") for i, c in enumerate(names)],
    )


@query("hash_split", f"SELECT o_orderkey, {split_sql('o_orderkey')} AS split FROM orders")
def hash_split_query(spark, sf_dir):
    return hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@query(
    "entity_split",
    f"SELECT o_orderkey, o_custkey, {split_sql('o_custkey')} AS split FROM orders",
)
def entity_split(spark, sf_dir):
    """All rows of an entity in one split."""
    return hash_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"])


@query(
    "hash_fold",
    f"SELECT o_orderkey, CAST({hash_sql('o_orderkey', 7)} % 4 AS INTEGER) AS fold FROM orders",
)
def hash_fold(spark, sf_dir):
    return with_fold(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


def order_roles() -> FeatureRoles:
    return FeatureRoles(
        continuous=["price", "day"],
        nominal=["o_orderstatus"],
        ordinal=["month"],
        modified=["o_orderpriority"],
        imputed=["price"],
        excluded=["day"],
        dropped=["o_custkey"],
    )


def order_snapshot(spark, sf_dir):
    """Orders with a rating text, a price with gaps, and a label that follows from both."""
    price = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "o_orderstatus",
        price.alias("price"),
        F.dayofmonth("o_orderdate").alias("day"),
        F.month("o_orderdate").alias("month"),
        (F.substring("o_orderpriority", 1, 1).cast("double") * 10 + F.month("o_orderdate")).alias("overall"),
    )


_STAGES_SQL = f"""WITH rows AS (
    SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS rating, o_orderstatus AS kind,
           CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS price,
           CAST(month(o_orderdate) AS DOUBLE) AS month, {split_sql('o_orderkey')} AS split FROM orders),
  labels AS (
    SELECT kind, row_number() OVER (ORDER BY n DESC, kind) - 1 AS idx
    FROM (SELECT kind, count(*) AS n FROM rows WHERE split = 'train' GROUP BY kind)),
  wide AS (
    SELECT r.o_orderkey, r.rating * 10 + r.month AS overall, r.split,
           coalesce(r.price, (SELECT quantile_disc(price, 0.5) FROM rows WHERE split = 'train')) AS price,
           CAST(l.idx = 0 AS DOUBLE) AS k0, CAST(l.idx = 1 AS DOUBLE) AS k1, CAST(l.idx = 2 AS DOUBLE) AS k2,
           r.month, r.rating
    FROM rows r JOIN labels l ON r.kind = l.kind),
  train AS (SELECT * FROM wide WHERE split = 'train')
  SELECT o_orderkey, overall, split, {', '.join(
      f'round({c} / (SELECT stddev_samp({c}) FROM train), 6) AS f{i}'
      for i, c in enumerate(['price', 'k0', 'k1', 'k2', 'month', 'rating'])
  )} FROM wide"""


@query("feature_stages", _STAGES_SQL)
def feature_stages_query(spark, sf_dir):
    """All eight stages, fitted on the training rows; the vector's values as columns."""
    rows = hash_split(order_snapshot(spark, sf_dir), ["o_orderkey"])
    out = fit_features(rows, order_roles()).transform(rows)
    arrays = out.withColumn("f", vector_to_array("features"))
    return arrays.select(
        "o_orderkey", "overall", "split", *[F.round(F.col("f")[i], 6).alias(f"f{i}") for i in range(6)]
    )


@query(
    "custom_transformers",
    """SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS o_orderpriority,
              CAST(month(o_orderdate) AS DOUBLE) AS month FROM orders""",
)
def custom_transformers(spark, sf_dir):
    rows = order_snapshot(spark, sf_dir).select("o_orderkey", "o_orderpriority", "o_orderstatus", "month")
    for stage in (
        PositionCaster(inputCols=["o_orderpriority"]),
        FeatureTypeCaster(inputCols=["month"]),
        ColumnDropper(columnsToDrop=["o_orderstatus", "not_there"]),
    ):
        rows = stage.transform(rows)
    return rows


@query(
    "feature_export",
    """SELECT CAST(CAST(p_size AS FLOAT) AS DOUBLE) AS f0, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS f1,
              CAST(CAST(p_partkey AS FLOAT) AS DOUBLE) AS label
       FROM part WHERE p_partkey % 7 <> 0""",
)
def feature_export(spark, sf_dir):
    label = F.when(F.col("p_partkey") % 7 != 0, F.col("p_partkey"))
    parts = table(spark, sf_dir, "part").select("p_size", "p_retailprice", label.alias("label"))
    vectors = VectorAssembler(inputCols=["p_size", "p_retailprice"], outputCol="features").transform(parts)
    arrays = export_features(vectors, "label")
    return arrays.select(
        F.col("features")[0].cast("double").alias("f0"),
        F.col("features")[1].cast("double").alias("f1"),
        F.col("label").cast("double").alias("label"),
    )
