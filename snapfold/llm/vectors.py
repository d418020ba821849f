"""Vectors in tiles: rows are dealt to tiles once, and every tile reads all queries as a stream of blocks."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of doubles that a tile of rows holds at most on average, and rows below which it is not cut to keep more cores busy.
TILE_BYTES, TILE_ROWS = 64 << 20, 2048
_LONG = (1 << 63) - 1


def usable(vector: str = "v") -> Column:
    """Whether a row takes part: a vector of numbers that are finite, none null."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def tile_count(rows: DataFrame, tile_rows: int | None = None, tile_bytes: int = TILE_BYTES) -> int:
    """How many tiles of rows (id, v) there are: by bytes, and on small tables by cores; or by the rows a tile shall hold."""
    found = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    if tile_rows:
        return max(1, math.ceil(found["n"] / tile_rows))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(found["n"] * 8 * (found["dim"] or 0) / tile_bytes), min(math.ceil(found["n"] / TILE_ROWS), 2 * cores))


class Part(NamedTuple):
    """Rows of one length of vector, one for each id, in the order of ids; ``rows`` has all their columns but the vectors."""

    ids: np.ndarray
    vectors: np.ndarray
    rows: pa.Table


def _part(batches: list[pa.RecordBatch], dim: int) -> Part:
    table = pa.Table.from_batches(batches)
    ids = table.column("id").to_numpy()
    first = np.concatenate([[True], ids[1:] != ids[:-1]])
    if not first.all():
        table, ids = table.filter(pa.array(first)), ids[first]
    values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("v").chunks])
    return Part(ids, values.reshape(len(ids), dim), table.drop_columns(["v"]))


Work = Callable[[Part, Part], Iterator[dict]]


def streamed(rows: DataFrame, queries: DataFrame, tiles: int, work: Work, schema: str) -> DataFrame:
    """What ``work`` gives as columns for each tile of ``rows`` and each block of ``queries`` with vectors of one length.

    Both frames hold (id bigint, v array<double>), ``queries`` also (block int). Of rows that repeat an id in one length, the
    smallest by their other columns, in alphabetical order, and then by vector, stays. Rows cross the shuffle once, queries
    once for each tile; a task holds its tile and one block at a time.
    """
    left = rows.select("*", F.lit(0).alias("_kind"), F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int").alias("_tile"))
    right = queries.select("*", F.lit(1).alias("_kind"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("_tile"))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_dim", F.size("v"))
    others = sorted(set(both.columns) - {"_kind", "_tile", "_dim", "block", "id", "v"})
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile: dict[int, Part] = {}
        for (kind, _, dim), part in _stretches(batches):
            if not kind:
                tile[dim] = _part(part, dim)
            elif dim in tile:
                for columns in work(tile[dim], _part(part, dim)):
                    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in types], schema=types)

    dealt = both.repartitionById(tiles, F.col("_tile")).sortWithinPartitions("_kind", "block", "_dim", "id", *others, "v")
    return dealt.drop("_tile").mapInArrow(run, schema)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], list[pa.RecordBatch]]]:
    """The rows of each (kind, block, dim), which come one after another."""
    of, held = None, []
    for batch in batches:
        keys = np.stack([batch.column(batch.schema.get_field_index(c)).fill_null(-1).to_numpy(zero_copy_only=False) for c in ("_kind", "block", "_dim")], axis=1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for s, e in zip(edges, edges[1:], strict=False):
            if s == e:
                continue
            key = tuple(keys[s].tolist())
            if held and key != of:
                yield of, held
                held = []
            of = key
            held.append(batch.slice(s, e - s))
    if held:
        yield of, held


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers: in doubles while every sum stays below 2^53, else in Python's integers held to 64 bits."""
    if not len(q) or not len(v) or not q.shape[1]:
        return np.zeros((len(q), len(v)), np.int64)
    if largest(q, v) < 2**53:
        return (q @ v.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    scores = exact(q).dot(exact(v).T)
    return np.clip(scores, -_LONG - 1, _LONG).astype(np.int64)


def largest(q: np.ndarray, v: np.ndarray) -> float:
    """What no product of a row of each exceeds."""
    return float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best, ties to the smaller id; ``ids`` ascend."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > cut)
        chosen = np.concatenate([above, np.flatnonzero(scores == cut)[: k - len(above)]])
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))]
