"""Exact top-k by inner product: tiles of queries against tiles of rows, a partial selection in each, lists merged in a tree.

Rows are dealt to tiles once, by a hash of their id; queries are dealt to blocks, and every tile of rows reads the blocks one after
another (``vectors.streamed``). Each block is multiplied with the tile as one matrix product that keeps the k best of every
query; the lists then meet in rounds of FAN tiles. What a task holds is a tile, a block and their product, whatever the number of rows.
What crosses the shuffle is every row once, and every query once for each tile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.vectors import TILE_BYTES, Part, best_of, products, streamed, tile_count, usable

QUERY_TILE, FAN = 1024, 32
#: Scores computed at a time.
PRODUCT = 1 << 22


def exact_topk(queries: DataFrame, rows: DataFrame, k: int = 10, query_tile: int = QUERY_TILE, row_tile: int | None = None, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k rows of the highest inner product, ties to the smaller id.

    Both frames hold (id bigint, v array<double>) with whole numbers; a row is no candidate of a query of its own id.
    Rows whose id or vector is null, or whose vector holds a null or a number that is not finite, take no part. Only
    vectors of equal length are compared. Rows that repeat an id in one length count as one, that of the smallest vector. Other columns are
    not looked at. Scores beyond 64 bits are held to the bound. A tile of rows holds ``row_tile`` rows, or by default
    at most ``tile_bytes`` of vectors.
    """
    whole = usable() & F.col("id").isNotNull()
    queries, rows = (df.where(whole).select("id", "v") for df in (queries, rows))
    blocks = max(1, math.ceil(queries.count() / query_tile))
    tiles = tile_count(rows, row_tile, tile_bytes)

    def select(tile: Part, block: Part) -> Iterator[dict]:
        step = max(1, PRODUCT // len(tile.ids))
        for at in range(0, len(block.ids), step):
            found = []
            for query, scores in zip(block.ids[at : at + step], products(block.vectors[at : at + step], tile.vectors), strict=True):
                best = best_of(scores, tile.ids, k + 1)
                found.append(best[tile.ids[best] != query][:k])  # a row is none of its own candidates
                found[-1] = (query, tile.ids[found[-1]], scores[found[-1]])
            sizes = [len(ids) for _, ids, _ in found]
            yield {
                "query_id": np.repeat([q for q, _, _ in found], sizes), "part": np.full(sum(sizes), int(tile.rows.column("part")[0].as_py())),
                "vec_id": np.concatenate([ids for _, ids, _ in found]), "score": np.concatenate([scores for _, _, scores in found]),
            }

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    parted = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int"))
    lists = streamed(parted, dealt, tiles, select, "query_id bigint, part int, vec_id bigint, score bigint")
    order = [F.desc("score"), "vec_id"]
    while tiles > FAN:
        tiles = math.ceil(tiles / FAN)
        lists = lists.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        best = F.row_number().over(Window.partitionBy("query_id", "part").orderBy(*order))
        lists = lists.withColumn("rank", best).where(F.col("rank") <= k).drop("rank")
    ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
