"""Analytics over yearly entity snapshots, written as Spark jobs."""

__version__ = "0.1.0"
