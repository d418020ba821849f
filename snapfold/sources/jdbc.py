"""Tables in a database, over JDBC. The driver's jar must be on the cluster's class path."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.session import drop_path, fresh_path


@dataclass(frozen=True)
class JdbcConfig:
    """Where the database is and how to log in."""

    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JdbcConfig:
        """From DB_HOST, DB_PORT, DB_NAME, DB_USER and DB_PASSWORD. The password has no default."""
        env = os.environ if env is None else env
        password = env.get("DB_PASSWORD")
        if not password:
            raise ValueError("DB_PASSWORD is not set.")
        host, port = env.get("DB_HOST", "localhost"), env.get("DB_PORT", "5432")
        name, user = env.get("DB_NAME", "postgres"), env.get("DB_USER", "postgres")
        return cls(f"jdbc:postgresql://{host}:{port}/{name}", user, password)

    def properties(self) -> dict[str, str]:
        return {"user": self.user, "password": self.password, "driver": self.driver}

    def __repr__(self) -> str:  # keeps the password out of logs
        return f"JdbcConfig(url={self.url!r}, user={self.user!r}, driver={self.driver!r})"


def jdbc_scan(
    spark: SparkSession,
    config: JdbcConfig,
    table: str,
    partition_column: str | None = None,
    num_partitions: int = 1,
    predicates: Sequence[str] = (),
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a table, in parallel where told how to divide it.

    ``predicates`` gives one partition per condition (say one per year and gender, each of which an
    index can serve). ``partition_column`` divides a numeric or date column's range evenly, its ends
    asked of the database first. With neither, one task reads the whole table.
    """
    properties = {**config.properties(), "fetchsize": str(fetch_size)}
    if predicates:
        return spark.read.jdbc(config.url, table, predicates=list(predicates), properties=properties)
    if partition_column is None or num_partitions <= 1:
        return spark.read.jdbc(config.url, table, properties=properties)
    ends = f'(SELECT min("{partition_column}") AS lo, max("{partition_column}") AS hi FROM {table}) ends'
    low, high = spark.read.jdbc(config.url, ends, properties=properties).first()
    if low is None:  # an empty table, or nothing but nulls
        return spark.read.jdbc(config.url, table, properties=properties)
    return spark.read.jdbc(
        config.url,
        table,
        column=partition_column,
        lowerBound=str(low),
        upperBound=str(high),
        numPartitions=num_partitions,
        properties=properties,
    )


def equi_depth_query(table: str, column: str, parts: int) -> str:
    """The greatest value of each of ``parts`` runs of about equal numbers of rows, in the order of ``column``."""
    return (
        f'(SELECT depth, max(edge) AS edge FROM (SELECT "{column}" AS edge, ntile({parts}) OVER (ORDER BY "{column}") AS depth '
        f'FROM {table} WHERE "{column}" IS NOT NULL) ranked GROUP BY depth) edges'
    )


def equi_depth_predicates(spark: SparkSession, config: JdbcConfig, table: str, column: str, parts: int) -> list[str]:
    """Conditions that divide a table's rows into at most ``parts`` of about equal size, whatever the values' distribution.

    Ranges of equal width leave most rows to one task where values are uneven. Null rows are in the first part; a value that
    fills several parts has one of its own. Pass the conditions to ``jdbc_scan``.
    """
    query = equi_depth_query(table, column, parts)
    edges = [r["edge"] for r in spark.read.jdbc(config.url, query, properties=config.properties()).collect()]
    return range_predicates(column, edges)


def range_predicates(column: str, edges: Sequence) -> list[str]:
    """One condition for each range up to an edge, the first with nulls, the last without an end; texts and dates are quoted."""
    literal = lambda v: str(v) if isinstance(v, int | float | Decimal) else "'" + str(v).replace("'", "''") + "'"
    cuts = [literal(v) for v in sorted(set(edges))[:-1]]
    if not cuts:
        return []
    name = f'"{column}"'
    middle = [f"{name} > {low} AND {name} <= {high}" for low, high in zip(cuts, cuts[1:], strict=False)]
    return [f"{name} <= {cuts[0]} OR {name} IS NULL", *middle, f"{name} > {cuts[-1]}"]


def _catalog(spark: SparkSession, config: JdbcConfig, catalog: str) -> None:
    prefix = f"spark.sql.catalog.{catalog}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    pushed = dict.fromkeys(("pushDownPredicate", "pushDownAggregate", "pushDownLimit", "pushDownOffset", "pushDownTableSample"), "true")
    for key, value in {"url": config.url, **config.properties(), **pushed}.items():
        spark.conf.set(f"{prefix}.{key}", value)


def jdbc_table(spark: SparkSession, config: JdbcConfig, table: str, catalog: str = "snapfold_jdbc") -> DataFrame:
    """A table (``schema.table``) of Spark's JDBC catalog: filters, aggregates, sorts with a limit and samples run in the database.

    For questions whose answer is small; what is read row by row, ``jdbc_scan`` reads in parallel.
    """
    _catalog(spark, config, catalog)
    return spark.table(".".join(f"`{part}`" for part in (catalog, *table.split("."))))


def _write(df: DataFrame, config: JdbcConfig, table: str, mode: str, connections: int, batch: int, **options: str):
    properties = {**config.properties(), "batchsize": str(batch), "numPartitions": str(connections), **options}
    df.write.jdbc(config.url, table, mode=mode, properties=properties)


def jdbc_append(df: DataFrame, config: JdbcConfig, table: str, connections: int = 16, batch: int = 10_000) -> None:
    """Add rows to a table, created at its first write; columns match by name.

    Each task commits its own transaction. A task lost after its commit is run again and would add its
    rows twice: ``jdbc_append_once`` does not.
    """
    _write(df, config, table, "append", connections, batch)


ROW_COLUMN = "load_row"


def merge_statements(table: str, stage: str, ledger: str, columns: Sequence[str], name: str) -> list[str]:
    """What moves a batch from its staging table in one transaction; the first one fails where the ledger has the batch."""
    quoted = ", ".join(f'"{c}"' for c in columns)
    text = name.replace("'", "''")
    copies = f'row_number() OVER (PARTITION BY "{ROW_COLUMN}" ORDER BY "{ROW_COLUMN}")'
    return [
        f"INSERT INTO {ledger} (batch) VALUES ('{text}')",
        f"INSERT INTO {table} ({quoted}) SELECT {quoted} FROM (SELECT {quoted}, {copies} AS nth FROM {stage}) staged WHERE nth = 1",
    ]


def _in_one_transaction(spark: SparkSession, config: JdbcConfig, statements: Sequence[str]) -> bool:
    """Run statements from the driver, all or none; False if one breaks a constraint (SQLSTATE 23)."""
    jvm = spark._jvm
    jvm.java.lang.Class.forName(config.driver)
    connection = jvm.java.sql.DriverManager.getConnection(config.url, config.user, config.password)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            for text in statements:
                statement.executeUpdate(text)
            connection.commit()
        except Py4JJavaError as error:
            connection.rollback()
            state = getattr(error.java_exception, "getSQLState", lambda: None)()
            if not (state or "").startswith("23"):
                raise
            return False
        return True
    finally:
        connection.close()


def jdbc_append_once(df: DataFrame, config: JdbcConfig, table: str, name: str, ledger: str, connections: int = 16, batch: int = 10_000) -> bool:
    """Add the rows of the batch ``name`` to a table, once, whatever is run again; False if ``ledger`` has it already.

    Three steps, each of which may be repeated. The rows are written to the shared folder with a number each, so that no retry
    numbers them anew. They are copied to a staging table, where a task that was lost after its commit leaves some twice. One
    transaction enters the batch in the ledger, whose key refuses a second entry, and moves one row of each number.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "jdbc-batch")
    stage = f"{table}_stage_{uuid.uuid4().hex[:12]}"
    try:
        df.withColumn(ROW_COLUMN, F.monotonically_increasing_id()).write.parquet(path)
        rows = spark.read.parquet(path)
        _write(rows, config, stage, "overwrite", connections, batch)
        _write(rows.drop(ROW_COLUMN).limit(0), config, table, "append", 1, batch)  # creates the table where there is none
        _in_one_transaction(spark, config, [f"CREATE TABLE IF NOT EXISTS {ledger} (batch VARCHAR(512) PRIMARY KEY)"])
        return _in_one_transaction(spark, config, merge_statements(table, stage, ledger, df.columns, name))
    finally:
        drop_path(spark, path)
        _in_one_transaction(spark, config, [f"DROP TABLE IF EXISTS {stage}"])


def jdbc_overwrite(
    df: DataFrame,
    config: JdbcConfig,
    table: str,
    truncate: bool = True,
    connections: int = 16,
    batch: int = 10_000,
) -> None:
    """Replace a table's rows. ``truncate`` keeps the table and its types, as a reset does."""
    _write(df, config, table, "overwrite", connections, batch, truncate=str(truncate).lower())


def ensure_schema(spark: SparkSession, config: JdbcConfig, schema: str, catalog: str = "snapfold_jdbc") -> None:
    """Create a database schema if it is missing, through Spark's JDBC catalog."""
    _catalog(spark, config, catalog)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{catalog}`.`{schema}`")
