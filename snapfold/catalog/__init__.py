"""The registered queries and, where SQL can say the same, the SQL they are checked against."""

from snapfold.catalog import cleaning, features, learning, neural, relational, snapshot, storage  # noqa: F401
from snapfold.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
