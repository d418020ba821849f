import datetime
import importlib

import duckdb
import pytest
from pyspark.sql import functions as F

from snapfold.plans.ingest import ingest, ingest_to_database
from snapfold.schema import CastSpec, align
from snapfold.session import fresh_path
from snapfold.sources import (
    FileEntry,
    JdbcConfig,
    append_table,
    ensure_schema,
    equi_depth_predicates,
    jdbc_append,
    jdbc_overwrite,
    jdbc_scan,
    jdbc_table,
    overwrite_table,
    read_manifest,
    read_table,
    read_text_csv,
    replace_partitions,
    schema_report,
    snapshot_manifest,
)
from snapfold.sources.jdbc import equi_depth_query, range_predicates


manifest = importlib.import_module("snapfold.sources.manifest")
plans_ingest = importlib.import_module("snapfold.plans.ingest")  # the package exports a function of the same name


@pytest.fixture
def files(tmp_path):
    (tmp_path / "f15.csv").write_text("id,dob,ls,val,club\n1,1987-06-24,89+3,NULL,A\n2,bad,70,7.5,\n")
    (tmp_path / "f16.csv").write_text("dob,id,ls,val\n1990-01-02,3,89,12.9\n")
    return [
        FileEntry(str(tmp_path / "f15.csv"), {"resource_year": 2015, "gender": "male"}),
        FileEntry(str(tmp_path / "f16.csv"), {"resource_year": 2016, "gender": "male"}),
    ]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_manifest_matches_columns_by_name(spark, files):
    df = read_manifest(spark, files).select("id", "dob", "ls", "val", "club", "resource_year", "gender")
    assert rows(df, "id") == [
        ("1", "1987-06-24", "89+3", "NULL", "A", 2015, "male"),
        ("2", "bad", "70", "7.5", None, 2015, "male"),
        ("3", "1990-01-02", "89", "12.9", None, 2016, "male"),
    ]
    assert dict(df.dtypes)["resource_year"] == "int"
    with pytest.raises(ValueError):
        read_manifest(spark, [])


def test_filter_on_a_tag_drops_the_other_files(spark, files):
    df = read_manifest(spark, files).where("resource_year = 2016").select("id")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    assert len(df.inputFiles()) == 1


def test_a_folder_of_differing_headers_is_refused(spark, files, tmp_path):
    folder = fresh_path(spark, "mixed")
    spark.range(2).selectExpr("id AS a", "id AS b").write.csv(folder, header=True)
    spark.range(2).selectExpr("id AS b", "id AS a").write.mode("append").csv(folder, header=True)
    with pytest.raises(Exception, match="(?i)header"):
        read_text_csv(spark, folder, ["a", "b"]).collect()


def test_ingest_twice_is_ingest_once(spark, files):
    path = fresh_path(spark, "ingest")
    casts = CastSpec(["val"], ["id"], ["dob"], ["club", "added"])
    ingest(spark, files, path, casts)
    once = rows(read_table(spark, path), "id")
    ingest(spark, files, path, casts)
    assert rows(read_table(spark, path), "id") == once
    ingest(spark, files, path, casts, compact=True)
    assert rows(read_table(spark, path), "id") == once
    ingest(spark, files[1:], path, casts, reset=False)  # only the partition of 2016 is replaced
    assert rows(read_table(spark, path), "id") == once
    table = read_table(spark, path)
    assert dict(table.dtypes)["val"] == "double" and dict(table.dtypes)["added"] == "string"
    assert [r["id"] for r in table.orderBy("id").collect()] == [1, 2, 3]


def test_append_aligns_by_name(spark):
    path = fresh_path(spark, "append")
    first = spark.createDataFrame([(1, "a")], "x int, y string")
    append_table(first, path)
    append_table(spark.createDataFrame([("b", 2)], "y string, x int"), path)
    append_table(spark.createDataFrame([(3,)], "x int"), path)
    assert rows(read_table(spark, path), "x") == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError, match="not in the target"):
        append_table(spark.createDataFrame([(1, "a", 2)], "x int, y string, z int"), path)
    with pytest.raises(ValueError, match="another type"):
        align(spark.createDataFrame([("1",)], "x string"), first.schema)


def test_overwrite_and_replace(spark):
    path = fresh_path(spark, "replace")
    df = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("p"))
    overwrite_table(df, path, ["p"])
    replace_partitions(df.where("p = 1").withColumn("id", F.col("id") + 100), path, ["p"])
    assert [r[0] for r in rows(read_table(spark, path), "id")] == [0, 2, 4, 6, 8, 101, 103, 105, 107, 109]
    overwrite_table(df.where("p = 0"), path, ["p"])
    assert read_table(spark, path).count() == 5
    with pytest.raises(ValueError):
        replace_partitions(df, path, [])


def test_schema_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(schema_report(df, count=True), "position") == [(0, "a", "int", 2), (1, "b", "string", 1)]
    assert rows(schema_report(df), "position") == [(0, "a", "int"), (1, "b", "string")]


def test_known_headers_are_not_looked_up(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    monkeypatch.setattr(manifest, "_header", lambda *_: pytest.fail("looked up"))
    known = FileEntry(str(tmp_path / "a.csv"), {"t": 1}, ("x", "y"))
    assert rows(read_manifest(spark, [known]), "x") == [("1", "2", 1)]
    wrong = FileEntry(str(tmp_path / "a.csv"), {"t": 1}, ("y", "x"))
    with pytest.raises(Exception, match="(?i)header"):
        read_manifest(spark, [wrong]).collect()


def test_a_database_ingest_cleans_in_all_tasks_and_writes_through_the_asked_connections(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("id,val\n1,12.9\n2,x\n")
    seen = {}

    def copied(df, config, table, connections):
        seen.update(table=table, connections=connections, rows=rows(df, "id"), files=df.inputFiles())

    monkeypatch.setattr(plans_ingest, "ensure_schema", lambda *_: None)
    monkeypatch.setattr(plans_ingest, "jdbc_overwrite", copied)
    casts = CastSpec(doubles=["val"], integers=["id"], dates=[], strings=[])
    ingest_to_database(spark, [FileEntry(str(tmp_path / "a.csv"))], CONFIG, "s", "t", casts, connections=48)
    assert (seen["table"], seen["connections"]) == ("s.t", 48)
    assert seen["rows"] == [(1, 12.9), (2, None)]
    assert all(name.endswith(".parquet") for name in seen["files"])


def test_snapshot_manifest():
    entries = snapshot_manifest("in/")
    assert len(entries) == 15
    assert entries[0] == FileEntry("in/players_15.csv", {"resource_year": 2015, "gender": "male"})
    assert entries[-1] == FileEntry("in/female_players_22.csv", {"resource_year": 2022, "gender": "female"})


# No database may be started here, so these look at what Spark's reader and writer are asked for.


class Recorder:
    def __init__(self, answers=()):
        self.calls, self.answers = [], list(answers)
        self.read = self.write = self.conf = self

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))
        return self

    def first(self):
        return self.answers.pop(0)

    def set(self, key, value):
        self.calls.append((key, value))

    def sql(self, text):
        self.calls.append(text)


CONFIG = JdbcConfig("jdbc:postgresql://h:1/d", "u", "secret")


def test_jdbc_config_from_env():
    env = {"DB_HOST": "h", "DB_PORT": "1", "DB_NAME": "d", "DB_USER": "u", "DB_PASSWORD": "secret"}
    assert JdbcConfig.from_env(env) == CONFIG
    assert JdbcConfig.from_env({"DB_PASSWORD": "x"}).url == "jdbc:postgresql://localhost:5432/postgres"
    assert "secret" not in repr(CONFIG)
    with pytest.raises(ValueError):
        JdbcConfig.from_env({})


def test_jdbc_scan_in_ranges():
    spark = Recorder(answers=[(1, 900)])
    jdbc_scan(spark, CONFIG, "s.t", "id", 8)
    (_, bounds), _ = spark.calls[0]
    assert bounds == '(SELECT min("id") AS lo, max("id") AS hi FROM s.t) ends'
    _, options = spark.calls[1]
    assert (options["column"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "1", "900", 8)


def test_jdbc_scan_otherwise():
    empty = Recorder(answers=[(None, None)])
    jdbc_scan(empty, CONFIG, "s.t", "id", 8)
    assert "column" not in empty.calls[-1][1]
    whole = Recorder()
    jdbc_scan(whole, CONFIG, "s.t")
    assert len(whole.calls) == 1 and "predicates" not in whole.calls[0][1]
    by_tag = Recorder()
    jdbc_scan(by_tag, CONFIG, "s.t", predicates=["y = 1", "y = 2"])
    assert by_tag.calls[0][1]["predicates"] == ["y = 1", "y = 2"]


def test_jdbc_writes_and_schema():
    df = Recorder()
    jdbc_append(df, CONFIG, "s.t")
    jdbc_overwrite(df, CONFIG, "s.t")
    assert [call[1]["mode"] for call in df.calls] == ["append", "overwrite"]
    assert df.calls[1][1]["properties"]["truncate"] == "true"
    spark = Recorder()
    ensure_schema(spark, CONFIG, "s")
    assert spark.calls[-1] == "CREATE NAMESPACE IF NOT EXISTS `snapfold_jdbc`.`s`"


def test_equal_parts_of_an_uneven_column():
    """The query and the conditions, run by an engine inside this process: each row in one part, no part much above its share."""
    db = duckdb.connect()
    db.execute("CREATE TABLE t AS SELECT CASE WHEN i % 50 = 0 THEN NULL WHEN i % 3 = 0 THEN 7 ELSE i * i END AS v FROM range(6000) r(i)")
    edges = [r[1] for r in db.execute(f"SELECT depth, edge FROM {equi_depth_query('t', 'v', 12)}").fetchall()]
    parts = [db.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in range_predicates("v", edges)]
    assert sum(parts) == 6000 and len(parts) > 6 and sorted(parts)[-2] <= 700 and max(parts) < 2500
    days = [datetime.date(2020, 1, 1), datetime.date(2021, 1, 1), datetime.date(2021, 1, 1), "it's"][:3]
    assert range_predicates("d", days) == ["\"d\" <= '2020-01-01' OR \"d\" IS NULL", "\"d\" > '2020-01-01'"]
    assert range_predicates("d", []) == [] == range_predicates("d", [1, 1]) and range_predicates("n", ["it's", "z"])[1] == "\"n\" > 'it''s'"
    spark = Recorder()
    spark.collect = lambda: [{"edge": 5}, {"edge": 9}]
    assert equi_depth_predicates(spark, CONFIG, "s.t", "v", 2) == ['"v" <= 5 OR "v" IS NULL', '"v" > 5']
    assert spark.calls[0][0][1].startswith("(SELECT depth, max(edge)")


def test_a_table_of_the_catalog_pushes_its_work_down():
    spark = Recorder()
    spark.table = lambda name: name
    assert jdbc_table(spark, CONFIG, "s.t") == "`snapfold_jdbc`.`s`.`t`"
    settings = dict(spark.calls)
    assert settings["spark.sql.catalog.snapfold_jdbc"].endswith("JDBCTableCatalog")
    assert all(settings[f"spark.sql.catalog.snapfold_jdbc.{k}"] == "true" for k in ("pushDownPredicate", "pushDownAggregate", "pushDownLimit"))


def test_a_write_by_tags_sorts_no_wide_rows(spark, tmp_path):
    """Files of one tag each reach the table without a sort, which would hold or spill a task's full-width rows."""
    from snapfold.sources.tables import overwrite_table, unsorted_writes

    rows = spark.range(100).selectExpr("id", "cast(id % 3 as int) AS y").repartition(2)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with unsorted_writes(spark):
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 1
        overwrite_table(rows, str(tmp_path / "t"), ["y"])  # tasks that meet several partitions lose nothing
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(i, i % 3) for i in range(100)]
    with pytest.raises(ZeroDivisionError), unsorted_writes(spark):
        1 / 0
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
