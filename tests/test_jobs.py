"""The four jobs, one after the other, on full-width CSV files of every year and gender."""

import pytest
from pyspark.sql import functions as F

from snapfold.catalog.snapshot import raw_snapshot
from snapfold.jobs import main
from snapfold.schema import SNAPSHOT_CASTS
from snapfold.sources import read_table, snapshot_manifest


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("snapshot"))
    raw = raw_snapshot(spark, "/root/testdata/sf0.001").cache()
    for entry in snapshot_manifest(f"{folder}/data"):
        year = min(entry.tags["resource_year"], 2021)  # the orders end there; 2022 repeats 2021
        part = raw.where((F.col("resource_year") == year) & (F.col("gender") == entry.tags["gender"]))
        part.drop("resource_year", "gender").coalesce(1).write.csv(entry.path, header=True)
    raw.unpersist()
    main(["ingest", "--data", f"{folder}/data", "--table", f"{folder}/table"])
    return f"{folder}/table"


def test_ingest(spark, table):
    df = read_table(spark, table)
    assert len(df.columns) == 112
    kinds = dict(df.dtypes)
    assert all(kinds[c] == "int" for c in SNAPSHOT_CASTS.integers) and kinds["gk"] == "string"
    assert df.select("resource_year", "gender").distinct().count() == 15
    only = df.where("resource_year = 2020 AND gender = 'male'").select("age")
    assert "PartitionFilters: [isnotnull(resource_year" in only._jdf.queryExecution().executedPlan().toString()


def test_analytics(table, capsys):
    main(["analytics", "--table", table])
    printed = capsys.readouterr().out
    for column in ("short_name", "player_count", "avg_age", "rank", "unique_players"):
        assert column in printed


def test_train(spark, table, tmp_path, capsys):
    main(["train", "--table", table, "--out", str(tmp_path)])
    printed = capsys.readouterr().out
    assert "regParam" in printed and "numTrees" in printed and printed.count("rmse") == 2
    assert set(read_table(spark, f"{tmp_path}/training").columns) == {"features", "overall", "fold", "split"}


def test_train_mlp(spark, table, tmp_path, capsys):
    main(["train-mlp", "--table", table, "--out", str(tmp_path)])
    assert "stepSize" in capsys.readouterr().out
    history = spark.read.csv(f"{tmp_path}/deep/history", header=True)
    assert history.count() == 10
