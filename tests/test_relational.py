import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapfold.operators import (
    dedup_latest,
    exact_median,
    frequency_index,
    global_index,
    hash_split,
    impute_median,
    top_n,
    top_n_with_ties,
    top_per_group,
    with_fold,
)
from snapfold.plans import (
    clubs_by_avg_age,
    clubs_with_contracts,
    group_avg_top_n,
    most_popular_nationality,
    nationality_histogram,
)

SNAPSHOT = "sofifa_id int, resource_year int, gender string, club_name string, nationality_name string, age int, " \
    "club_contract_valid_until int, overall int"
ROWS = [
    (1, 2018, "male", "A", "X", 20, 2023, 70),
    (1, 2019, "male", "A", "X", 21, 2023, 71),
    (1, 2020, "male", "B", "Y", 22, 2024, 72),  # changed nationality
    (2, 2020, "male", "A", "X", 30, 2022, 60),
    (3, 2020, "male", "C", "X", 22, 2025, 65),
    (4, 2020, "male", None, "Z", 40, 2023, 50),
    (5, 2020, "male", None, "Z", 41, 2023, 51),
    (6, 2020, "male", "D", None, None, 2023, 52),  # a club without ages
    (None, 2020, "male", "E", "Z", 18, None, 53),
    (None, 2018, "male", "E", "Y", 19, 2023, 54),
]

ANY_SPARK = {"deadline": None, "suppress_health_check": [HealthCheck.function_scoped_fixture]}


@pytest.fixture(scope="module")
def snapshot(spark):
    return spark.createDataFrame(ROWS, SNAPSHOT)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_clubs_with_contracts(snapshot):
    assert rows(clubs_with_contracts(snapshot, 2020, 2, 2023)) == [(None, 2), ("B", 1)]
    assert rows(clubs_with_contracts(snapshot, 1999, 2, 2023)) == []


def test_clubs_by_avg_age_keeps_ties(snapshot):
    assert rows(clubs_by_avg_age(snapshot, 2, 2020)) == [("A", 30.0), ("B", 22.0), ("C", 22.0)]
    assert rows(clubs_by_avg_age(snapshot, 2, 2020, highest=False)) == [("E", 18.0), ("B", 22.0), ("C", 22.0)]


def test_clubs_by_avg_age_ignores_groups_without_values(snapshot):
    everything = rows(clubs_by_avg_age(snapshot, 100, 2020))
    assert [c for c, _ in everything] == ["A", "B", "C", "E"]
    assert len(rows(clubs_by_avg_age(snapshot, 1, 2020, highest=False))) == 1


def test_clubs_by_avg_age_arguments(snapshot):
    with pytest.raises(ValueError):
        clubs_by_avg_age(snapshot, 0, 2020)
    for year in (2014, 2023):
        with pytest.raises(ValueError):
            clubs_by_avg_age(snapshot, 1, year)
    empty = clubs_by_avg_age(snapshot, 1, 2016)
    assert empty.columns == ["club_name", "avg_age"] and rows(empty) == []
    assert rows(clubs_by_avg_age(snapshot, 1, 1999, valid_years=None)) == []


def test_averages_of_doubles_agree_with_themselves(spark):
    """The cut and the filter must see the same sums, whatever the order of the rows."""
    df = spark.range(0, 20000, 1, 16).select((F.col("id") % 500).alias("g"), (F.rand(3) / 7).alias("v"))
    for n in (1, 7, 100):
        assert group_avg_top_n(df, "g", "v", n).count() == n


def test_most_popular_nationality(snapshot):
    assert rows(most_popular_nationality(snapshot)) == [(2018, "X", 1, 1), (2019, "X", 1, 1), (2020, "Z", 3, 1)]


def test_nationality_histogram(snapshot):
    # Player 1 counts under its latest nationality; the null keys are one player, in its latest year.
    assert rows(nationality_histogram(snapshot)) == [("Z", 3), ("X", 2), (None, 1), ("Y", 1)]


def test_unique_entities_hash_all_rows_before_any_sort(snapshot):
    plan = nationality_histogram(snapshot)._jdf.queryExecution().executedPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate(" in lowest and "SortAggregate(" not in lowest


def test_dedup_latest_keeps_whole_rows(snapshot):
    kept = dedup_latest(snapshot, ["sofifa_id"], ["resource_year"])
    assert kept.columns == snapshot.columns
    assert sorted(rows(kept), key=str) == sorted([r for r in ROWS if r[1] == 2020], key=str)


def test_top_per_group_beyond_the_window_limit(spark):
    df = spark.range(0, 6000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "100")
    try:
        top = top_per_group(df, ["g"], [F.desc("v")], 500)
        assert top.groupBy("g").agg(F.count("*"), F.min("v")).orderBy("g").collect() == [(0, 500, 5000), (1, 500, 5001)]
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_top_per_group_in_a_tree(spark):
    """A group of most rows, cut in parts that meet in several rounds; map columns; the limit itself needs no parts."""
    rows = spark.range(9000).select(F.when(F.col("id") % 9 == 0, F.col("id") % 4).otherwise(0).alias("k"), (F.col("id") * 7919 % 9001).alias("v"), F.create_map(F.lit("a"), "id").alias("m"))
    found = top_per_group(rows, ["k"], [F.col("v").desc()], 1200, rows_per_task=300)
    want = {(r.k, r.v, r.rank) for r in top_per_group(rows.drop("m"), ["k"], [F.col("v").desc()], 9000).where("rank <= 1200").collect()}
    assert {(r.k, r.v, r.rank) for r in found.collect()} == want and len(want) == 1200 + 3 * 250
    assert found._jdf.queryExecution().toString().count("Window") > top_per_group(rows, ["k"], [F.col("v").desc()], 1000)._jdf.queryExecution().toString().count("Window")


def test_window_limit_runs_before_the_shuffle(snapshot):
    plan = most_popular_nationality(snapshot)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=6, **ANY_SPARK)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(1, 12), st.integers(1, 7), st.booleans())
def test_top_n_with_ties_against_a_model(spark, values, n, parts, highest):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int").repartition(parts)
    cut = sorted(values, reverse=highest)[: n][-1]
    wanted = sorted((i, v) for i, v in enumerate(values) if (v >= cut if highest else v <= cut))
    found = rows(top_n_with_ties(df, "v", n, highest, ["i"]))
    assert sorted(found) == wanted
    order = F.col("v").desc() if highest else F.col("v").asc()
    assert set(rows(top_n(df, n, order, F.asc("i")))) <= set(found)


def test_global_index_numbers_every_row_once(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5003).alias("v"))
    indexed = global_index(df, [F.asc("v")])
    ranks = [r["index"] for r in indexed.orderBy("v").collect()]
    assert ranks == list(range(5000))


def test_frequency_index_places_null_and_unseen_last(spark):
    seen = spark.createDataFrame([(v,) for v in ["b", "b", "a", "a", "c", None]], "k string")
    scored = spark.createDataFrame([(v,) for v in ["a", "b", "c", "zzz", None]], "k string")
    found = {r["k"]: r["i"] for r in frequency_index(scored, "k", "i", seen).collect()}
    assert found == {"a": 0.0, "b": 1.0, "c": 2.0, "zzz": 3.0, None: 3.0}


def test_frequency_index_without_a_broadcast(spark):
    # A third of the rows hold one category, a third hold none, the others a category each.
    df = spark.range(0, 9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        found = frequency_index(df, "k", "i")
        assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
        sizes = found.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("i")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    by_key = {r["k"]: (r["n"], r["i"]) for r in sizes}
    assert by_key["hot"] == (3000, 0.0) and by_key[None] == (3000, 3001.0)
    others = sorted((k for k in by_key if k not in ("hot", None)))
    assert [by_key[k] for k in others] == [(1, float(i + 1)) for i in range(3000)]


def test_global_index_spreads_ties(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("v"), "id")
    indexed = global_index(df, [F.asc("v")])
    assert sorted(r["index"] for r in indexed.collect()) == list(range(4000))
    assert indexed.select(F.spark_partition_id()).distinct().count() > 1


@settings(max_examples=8, **ANY_SPARK)
@given(st.lists(st.one_of(st.none(), st.integers(0, 30).map(float), st.just(float("nan"))), min_size=1, max_size=300))
def test_exact_median_against_sorting(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    present = sorted(v for v in values if v is not None and v == v)
    wanted = present[(len(present) - 1) // 2] if present else None
    assert exact_median(df, ["v"])["v"] == wanted
    assert exact_median(df, ["v"], small=3)["v"] == wanted  # several rounds of bracketing


def test_exact_median_with_a_hot_value_beside_it(spark):
    # 40 % of rows hold one value; the median is some ranks above it.
    hot = spark.range(0, 4000).select(F.lit(1.0).alias("v"))
    rest = spark.range(0, 6000).select((F.col("id") + 2).cast("double").alias("v"))
    assert exact_median(hot.union(rest), ["v"], small=10)["v"] == 1001.0


def test_impute_median(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,), (9.0,)], "v double")
    assert sorted(r[0] for r in impute_median(df, ["v"]).collect()) == [1.0, 3.0, 3.0, 3.0, 9.0]


def test_hash_split_is_a_partition_of_the_rows(spark):
    df = spark.range(0, 10000)
    first = {tuple(r) for r in hash_split(df, ["id"]).collect()}
    again = {tuple(r) for r in hash_split(df.repartition(7).coalesce(3), ["id"]).collect()}
    assert first == again and len(first) == 10000
    sizes = {s: sum(1 for _, t in first if t == s) for s in ("train", "val", "test")}
    assert abs(sizes["train"] - 8000) < 200 and abs(sizes["val"] - 1000) < 120
    assert {tuple(r) for r in hash_split(df, ["id"], seed=1).collect()} != first


def test_hash_split_arguments_and_nulls(spark):
    df = spark.createDataFrame([(None,), (1,)], "k int")
    assert hash_split(df, ["k"]).where("split is null").count() == 0
    assert with_fold(df, ["k"]).where("fold is null").count() == 0
    for weights in ({}, {"a": -1.0, "b": 2.0}, {"a": 0.0}):
        with pytest.raises(ValueError):
            hash_split(df, ["k"], weights)


def test_entity_split_keeps_entities_together(snapshot):
    tagged = hash_split(snapshot, ["sofifa_id"])
    assert tagged.groupBy("sofifa_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
