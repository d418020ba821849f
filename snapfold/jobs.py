"""Command line: ``python -m snapfold.jobs ingest|analytics|train|train-mlp``. Submit it to any cluster."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from snapfold.plans.analytics import (
    clubs_by_avg_age,
    clubs_with_contracts,
    most_popular_nationality,
    nationality_bars,
)
from snapfold.plans.ingest import ingest, ingest_to_database
from snapfold.plans.neural import network_training_table, train_deep, train_shallow
from snapfold.plans.regression import split_sizes, train_forest, train_linear, write_training_table
from snapfold.schema import GENDER_TAG, YEAR_TAG
from snapfold.session import drop_path, fresh_path
from snapfold.sources import JdbcConfig, jdbc_overwrite, jdbc_scan, overwrite_table, read_table, sample_rows, snapshot_manifest

ROW_KEYS = ["sofifa_id", YEAR_TAG, GENDER_TAG]
# The columns a sample shows.
SAMPLE_COLUMNS = ["short_name", "long_name", "age", "club_name", "nationality_name"]


def _load(spark: SparkSession, args: argparse.Namespace):
    """The table, from Parquet or, with --database, over JDBC by one connection per year and gender, and one for all other rows."""
    if not args.database:
        return read_table(spark, args.table)
    predicates = [
        f"{YEAR_TAG} = {entry.tags[YEAR_TAG]} AND {GENDER_TAG} = '{entry.tags[GENDER_TAG]}'"
        for entry in snapshot_manifest()
    ]
    # Rows of other years or genders, or without them, are in none of the above.
    predicates.append(f"CASE WHEN {' OR '.join(f'({p})' for p in predicates)} THEN 0 ELSE 1 END = 1")
    return jdbc_scan(spark, JdbcConfig.from_env(), args.table, predicates=predicates)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    entries = snapshot_manifest(args.data)
    if args.database:
        schema, _, table = args.table.rpartition(".")
        ingest_to_database(spark, entries, JdbcConfig.from_env(), schema, table, connections=args.connections)
    else:
        ingest(spark, entries, args.table)
    _load(spark, args).printSchema()


def run_analytics(spark: SparkSession, args: argparse.Namespace) -> None:
    df = _load(spark, args)
    df.printSchema()
    sample_rows(df, SAMPLE_COLUMNS, ROW_KEYS).show(truncate=False)
    # A Parquet table is partitioned by gender, so the filter below reads that part only, uncopied.
    df = df.where(F.col(GENDER_TAG) == args.gender)
    if args.database and args.slice:
        jdbc_overwrite(df, JdbcConfig.from_env(), args.slice, truncate=False)
    clubs_with_contracts(df, 2020, 5, 2023).show()
    clubs_by_avg_age(df, 5, 2020, highest=True).show()
    most_popular_nationality(df).show()
    nationality_bars(df, 15).show()


def _training_table(spark: SparkSession, args: argparse.Namespace, **options) -> str:
    path = f"{args.out}/training"
    df = _load(spark, args).where(F.col(GENDER_TAG) == args.gender)
    copy = fresh_path(spark, "training-rows") if args.database else None
    if copy:  # one read of the database; the fits below scan the copy
        overwrite_table(df, copy)
        df = read_table(spark, copy)
    stages = write_training_table(df, path, ROW_KEYS, **options)
    stages.write().overwrite().save(f"{args.out}/stages")
    if copy:
        drop_path(spark, copy)
    split_sizes(spark, path).show()
    return path


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    path = _training_table(spark, args, fit_on="all")
    for name, train in (("linear", train_linear), ("forest", train_forest)):
        trained = train(spark, path)
        print(name, trained.validation.best_params())
        trained.report.show()
        trained.validation.model.write().overwrite().save(f"{args.out}/{name}")


def run_train_mlp(spark: SparkSession, args: argparse.Namespace) -> None:
    path = _training_table(spark, args, fill={"league_name": "Unknown"})
    shards = fresh_path(spark, "network-training")
    try:
        training = network_training_table(spark, path, shards)
        for name, train in (("shallow", train_shallow), ("deep", train_deep)):
            trained = train(spark, path, out=f"{args.out}/{name}", training=training)
            print(name, trained.params)
            trained.history.orderBy("config_id", "epoch").show()
            trained.report.show()
    finally:
        drop_path(spark, shards)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="snapfold")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, run in (
        ("ingest", run_ingest),
        ("analytics", run_analytics),
        ("train", run_train),
        ("train-mlp", run_train_mlp),
    ):
        job = jobs.add_parser(name)
        job.set_defaults(run=run)
        job.add_argument("--table", required=True, help="Parquet path, or schema.table with --database")
        job.add_argument("--database", action="store_true", help="use the database that DB_HOST etc. name")
        if name == "ingest":
            job.add_argument("--data", default="data", help="folder of the yearly CSV files")
            job.add_argument("--connections", type=int, default=16, help="tasks that write, with --database")
        else:
            job.add_argument("--gender", default="male")
        if name == "analytics":
            job.add_argument("--slice", help="table to write the gender's rows to, with --database")
        if name.startswith("train"):
            job.add_argument("--out", required=True, help="folder for the training table and the models")
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName(f"snapfold-{args.job}")
    # HotSpot leaves methods over 8000 bytes uncompiled: wide projections do better in pieces.
    args.run(builder.config("spark.sql.codegen.hugeMethodLimit", "8000").getOrCreate(), args)


if __name__ == "__main__":
    main()
