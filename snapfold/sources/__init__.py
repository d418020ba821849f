from snapfold.sources.jdbc import (
    JdbcConfig,
    ensure_schema,
    equi_depth_predicates,
    jdbc_append,
    jdbc_append_once,
    jdbc_overwrite,
    jdbc_scan,
    jdbc_table,
)
from snapfold.sources.ledger import append_batch, read_batches
from snapfold.sources.manifest import FileEntry, read_manifest, read_text_csv, snapshot_manifest
from snapfold.sources.tables import (
    append_table,
    footer_report,
    overwrite_table,
    read_table,
    replace_partitions,
    sample_rows,
    schema_report,
)

__all__ = [
    "FileEntry",
    "JdbcConfig",
    "append_batch",
    "append_table",
    "ensure_schema",
    "equi_depth_predicates",
    "footer_report",
    "jdbc_append",
    "jdbc_append_once",
    "jdbc_overwrite",
    "jdbc_scan",
    "jdbc_table",
    "overwrite_table",
    "read_batches",
    "read_manifest",
    "read_table",
    "read_text_csv",
    "replace_partitions",
    "sample_rows",
    "schema_report",
    "snapshot_manifest",
]
