"""Batches that are in once: appends, files by a ledger, the database's form of it, reports from footers."""

import importlib
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from snapfold.plans.ingest import ingest_new
from snapfold.schema import CastSpec
from snapfold.session import fresh_path
from snapfold.sources import FileEntry, JdbcConfig, append_batch, footer_report, jdbc_append_once, ledger, read_batches
from snapfold.sources.jdbc import ROW_COLUMN, merge_statements

jdbc = importlib.import_module("snapfold.sources.jdbc")
CASTS = CastSpec(doubles=["val"], integers=["id"], dates=[], strings=[])


@pytest.fixture
def table(spark):
    return fresh_path(spark, "batches")


def ids(spark, table):
    return sorted(r.id for r in read_batches(spark, table).collect())


def test_a_batch_is_in_once(spark, table):
    first, second = spark.range(5).withColumn("v", F.lit("a")), spark.range(5, 8).select(F.lit("b").alias("v"), "id")
    assert append_batch(first, table, "one") and append_batch(second, table, "two")
    assert not append_batch(first, table, "one") and not append_batch(second, table, "two")
    assert ids(spark, table) == list(range(8)) and read_batches(spark, table).columns == ["id", "v"]
    with pytest.raises(ValueError, match="not in the target"):
        append_batch(second.withColumn("more", F.lit(1)), table, "three")
    assert append_batch(spark.range(8, 9), table, "three") and read_batches(spark, table).where("v is null").count() == 1
    assert append_batch(spark.range(20, 21), table, "one", "changed") and ids(spark, table) == [5, 6, 7, 8, 20]
    assert {r.id: r.version for r in read_batches(spark, table, versions=True).collect()} == {5: 2, 6: 2, 7: 2, 8: 3, 20: 4}


def test_a_load_that_fails_leaves_nothing_that_is_read(spark, table):
    append_batch(spark.range(3), table, "one")
    broken = spark.range(10, 20, 1, 4).select(F.when(F.col("id") == 19, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        append_batch(broken, table, "two")
    assert ids(spark, table) == [0, 1, 2] and len(ledger._files(spark, f"{table}/batches")) == 2
    assert ledger.clean_up(spark, table) == 1 and ids(spark, table) == [0, 1, 2]
    assert append_batch(spark.range(10, 20), table, "two") and len(ids(spark, table)) == 13


def test_writers_at_the_same_time(spark, table, monkeypatch):
    append_batch(spark.range(3), table, "one")
    versions, seen = ledger._versions, []

    def stale(*args):  # what another writer commits between the look at the log and the write is not seen at first
        found = versions(*args)
        if not seen:
            seen.append(1)
            append_batch(spark.range(100, 101), table, "other")
        return found

    monkeypatch.setattr(ledger, "_versions", stale)
    assert ledger.commit(spark, table, [ledger.Batch("empty", "x")], spark.range(1).schema)
    monkeypatch.setattr(ledger, "_versions", versions)
    assert sorted(map(tuple, ledger.entries(spark, table).select("name", "version").collect())) == [("empty", 3), ("one", 1), ("other", 2)]
    # The same batch, written by two: the later commit gives way, and its folder goes.
    commit = ledger.commit
    monkeypatch.setattr(ledger, "commit", lambda *a: (commit(a[0], a[1], [ledger.Batch("twin", "", None)], a[3]), commit(*a))[1])
    before = len(ledger._files(spark, f"{table}/batches"))
    assert not append_batch(spark.range(7), table, "twin") and len(ledger._files(spark, f"{table}/batches")) == before


def test_a_log_file_cut_short_commits_nothing(spark, table):
    append_batch(spark.range(3), table, "one")
    line = json.dumps({"schema": spark.range(1).schema.json(), "batches": [{"name": "two", "fingerprint": "", "folder": "batches/none"}]})
    for text in ("", line[: len(line) // 2]):
        number = len(ledger._versions(spark, table)) + 1
        assert ledger._create(spark, f"{table}/log/{number:012d}.json", text) and not ledger._create(spark, f"{table}/log/{number:012d}.json", text)
    assert ids(spark, table) == [0, 1, 2]
    assert append_batch(spark.range(3, 4), table, "two") and ids(spark, table) == [0, 1, 2, 3]


def test_only_new_and_changed_files_are_read(spark, table, tmp_path):
    def file(name, text):
        (tmp_path / name).write_text(text)
        return FileEntry(str(tmp_path / name), {"year": int(name[1:3])})

    one, two, none = file("f15.csv", "id,val\n1,12.9\n2,x\n"), file("f16.csv", "val,id\n7,3\n"), file("f17.csv", "id,val\n")
    assert ingest_new(spark, [one, two], table, CASTS) == [one.path, two.path]
    assert ingest_new(spark, [one, two], table, CASTS) == []
    assert ingest_new(spark, [one, two, none], table, CASTS) == [none.path] and ingest_new(spark, [none], table, CASTS) == []
    rows = sorted(tuple(r) for r in read_batches(spark, table, versions=True).select("id", "val", "year", "version").collect())
    assert rows == [(1, 12.9, 15, 1), (2, None, 15, 1), (3, 7.0, 16, 1)]
    (tmp_path / "f15.csv").write_text("id,val\n1,13\n4,5\n")
    os.utime(tmp_path / "f15.csv", (2_000_000_000, 2_000_000_000))
    assert ingest_new(spark, [one, two, none], table, CASTS) == [one.path]
    rows = sorted(tuple(r) for r in read_batches(spark, table, versions=True).select("id", "val", "year", "version").collect())
    assert rows == [(1, 13.0, 15, 3), (3, 7.0, 16, 1), (4, 5.0, 15, 3)]
    # The load of a file without rows has left a folder; the first load's one still holds a file that is in.
    assert ledger.clean_up(spark, table) == 1 and ledger.clean_up(spark, table) == 0 and read_batches(spark, table).count() == 3
    with pytest.raises(ValueError):
        read_batches(spark, f"{table}-none")


def test_the_database_merges_each_row_once_and_each_batch_once():
    """The statements themselves, run by an engine inside this process."""
    db = duckdb.connect()
    db.execute("CREATE TABLE target (id INT, name VARCHAR); CREATE TABLE done (batch VARCHAR(512) PRIMARY KEY)")
    db.execute(f"CREATE TABLE stage AS SELECT * FROM (VALUES (0, 'a', 10), (0, 'a', 11), (5, 'b', 12), (0, 'a', 10)) t(id, name, {ROW_COLUMN})")
    statements = merge_statements("target", "stage", "done", ["id", "name"], "o'ne")
    db.begin()
    for s in statements:
        db.execute(s)
    db.commit()
    want = [(0, "a"), (0, "a"), (5, "b")]
    assert sorted(db.execute("SELECT * FROM target").fetchall()) == want and db.execute("SELECT * FROM done").fetchall() == [("o'ne",)]
    db.begin()
    with pytest.raises(duckdb.ConstraintException):
        db.execute(statements[0])
    db.rollback()
    assert sorted(db.execute("SELECT * FROM target").fetchall()) == want


def test_steps_of_a_database_append(spark, monkeypatch):
    config, steps = JdbcConfig("jdbc:x", "u", "secret"), []
    monkeypatch.setattr(jdbc, "_write", lambda df, config, table, mode, *a: steps.append((table.split("_stage_")[0], "_stage_" in table, mode, df.columns, df.count())))
    monkeypatch.setattr(jdbc, "_in_one_transaction", lambda spark, config, statements: steps.append([s.split(" (")[0].split("_stage_")[0] for s in statements]) or len(statements) < 2)
    assert jdbc_append_once(spark.range(6).withColumn("v", F.lit(1)), config, "s.t", "b1", "s.done") is False
    assert steps == [
        ("s.t", True, "overwrite", ["id", "v", ROW_COLUMN], 6), ("s.t", False, "append", ["id", "v"], 0), ["CREATE TABLE IF NOT EXISTS s.done"],
        ["INSERT INTO s.done", "INSERT INTO s.t"], ["DROP TABLE IF EXISTS s.t"],
    ]


class Failure(Exception):
    pass


@pytest.mark.parametrize(("state", "outcome"), [("23505", False), ("42P01", None), (None, True)])
def test_a_transaction_is_all_or_nothing(monkeypatch, state, outcome):
    done = []

    class Connection:
        def __getattr__(self, name):
            if name == "createStatement":
                return lambda: self
            if name == "executeUpdate":
                return self.run
            return lambda *a: done.append(name)

        def run(self, text):
            done.append(text)
            if state and text == "b":
                error = Failure()
                error.java_exception = type("E", (), {"getSQLState": lambda self: state})()
                raise error

    class Anything:
        def __getattr__(self, name):
            return (lambda *a: Connection()) if name == "getConnection" else (lambda *a: None) if name == "forName" else self

    monkeypatch.setattr(jdbc, "Py4JJavaError", Failure)
    spark = type("S", (), {"_jvm": Anything()})()
    run = lambda: jdbc._in_one_transaction(spark, JdbcConfig("jdbc:x", "u", "p"), ["a", "b"])
    if outcome is None:
        with pytest.raises(Failure):
            run()
    else:
        assert run() is outcome
    assert done == ["setAutoCommit", "a", "b", *(["commit"] if state is None else ["rollback"]), "close"]


def test_footers_tell_rows_nulls_and_bounds(spark, table):
    rows = spark.range(100, numPartitions=3).select("id", F.when(F.col("id") % 4 == 0, F.lit("x")).alias("a.b"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    rows.write.parquet(table)
    report = footer_report(spark, table, ["id", "day"])
    assert [tuple(r) for r in report.orderBy("position").collect()] == [
        (0, "id", "bigint", 100, 100, "0", "99"), (1, "a.b", "string", 100, 25, None, None), (2, "day", "date", 100, 100, "2024-01-01", "2024-04-09"),
    ]
    plan = report._jdf.queryExecution().toString()
    assert "PushedAggregation: [" in plan and "COUNT(id)" in plan and "PushedAggregation: []" not in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
