"""Hard negatives: for an anchor and one of its positives, the best rows of other labels within a window of scores.

The anchors of a block hang on a minimum spanning tree that starts at the origin, where every score is 0. A row c that has the
score s at a parent has at a child, whose edge is d long, a score between s - d |c| and s + d |c|, and nowhere more than |anchor| |c|. So the
tree is walked from parents to children with an interval for every row: exact where the row was scored, wider by d |c| where it was
not. A row is scored only where its interval meets a window of the anchor, above the k-th best that the tile has for that window.

Rows are dealt to tiles once; blocks of anchors with their trees, positives and windows go to every tile and are read there as a
stream (``vectors.streamed``). Each tile keeps the k best of a window, and the lists of all tiles are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.tables import Scratch
from snapfold.llm.vectors import TILE_BYTES, Part, best_of, largest, products, streamed, tile_count, usable
from snapfold.operators.ranking import global_index

POSITIVES, NEGATIVES = 5, 10
#: Percent of a positive's score between which a negative's lies.
WINDOW = (30, 90)
#: Anchors of a tree, and rows that walk down it together.
BLOCK, STEP = 256, 8192
_SIGNS = 16


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, reach): vectors so ordered that parents come first, the parent's place in that order, the edge's length.

    The root is the origin; its children have the parent -1. Of all trees that hold the origin the edges are the shortest.
    """
    n = len(vectors)
    squares = (vectors * vectors).sum(axis=1)
    apart = np.sqrt(np.maximum(0, squares[:, None] + squares - 2 * (vectors @ vectors.T)))
    near, parent, left, order = np.sqrt(squares), np.full(n, -1), np.ones(n, bool), np.empty(n, np.int64)
    for i in range(n):
        j = int(np.argmin(np.where(left, near, np.inf)))
        order[i], left[j] = j, False
        closer = left & (apart[j] < near)
        near[closer], parent[closer] = apart[j][closer], j
    place = np.empty(n + 1, np.int64)
    place[order], place[n] = np.arange(n), -1
    # Measured again without the cancellation of the distances above.
    upper = np.concatenate([vectors, np.zeros((1, vectors.shape[1]))])[parent[order]]
    return order, place[parent[order]], np.sqrt(((vectors[order] - upper) ** 2).sum(axis=1))


def signature(vectors: pd.Series) -> pd.Series:
    """On which side of some planes each vector lies, so that neighbours come to the same block."""
    out = np.zeros(len(vectors), np.int64)
    sizes = vectors.map(len).to_numpy()
    for dim in np.unique(sizes):
        here = np.flatnonzero(sizes == dim)
        planes = np.random.default_rng(int(dim)).normal(size=(dim, _SIGNS))
        sides = np.stack(vectors.iloc[here].to_numpy()).reshape(len(here), dim) @ planes > 0
        out[here] = sides @ (1 << np.arange(_SIGNS - 1, -1, -1))
    return pd.Series(out)


def _positives(k: int):
    def work(tile: Part, block: Part) -> Iterator[dict]:
        labels, own = (p.rows.column("label").to_numpy() for p in (tile, block))
        for label in np.unique(own):
            mine, rows = np.flatnonzero(own == label), np.flatnonzero(labels == label)
            ids, vectors = tile.ids[rows], tile.vectors[rows]
            step = max(1, (1 << 22) // max(1, len(rows)))
            for at in range(0, len(mine), step):
                part = mine[at : at + step]
                for anchor, scores in zip(block.ids[part], products(block.vectors[part], vectors), strict=True):
                    other = ids != anchor
                    scores, them = scores[other], ids[other]
                    best = best_of(scores, them, k)
                    yield {"anchor_id": np.full(len(best), anchor), "dim": np.full(len(best), block.vectors.shape[1]), "positive_id": them[best], "score": scores[best]}

    return work


def walk(vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, tree: tuple, anchors: np.ndarray, own: np.ndarray, windows: list[list[tuple[int, int]]], k: int) -> tuple[list, int]:
    """For each anchor and window the k best (score, id) of other labels; and how many scores were computed.

    ``tree`` has (parent, reach) of anchors in its order; ``ids`` ascend.
    """
    parent, reach = tree
    best = [[(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in w] for w in windows]
    size, scored = np.sqrt((anchors**2).sum(axis=1)), 0
    bounded = largest(anchors, vectors) < 2.0**62
    for at in range(0, len(ids), STEP):
        rows, names, marks = vectors[at : at + STEP], ids[at : at + STEP], labels[at : at + STEP]
        norm = np.sqrt((rows**2).sum(axis=1))
        low, high = np.zeros((len(anchors) + 1, len(rows))), np.zeros((len(anchors) + 1, len(rows)))  # the last is the origin
        for j in range(len(anchors)):
            # The small terms make up for the rounding of doubles.
            most = size[j] * norm * (1 + 1e-9) + 1e-6
            slack = reach[j] * norm * (1 + 1e-9) + 1e-9 * most + 1e-6
            low[j] = np.maximum(low[parent[j]] - slack, -most)
            high[j] = np.minimum(high[parent[j]] + slack, most)
            if not bounded:
                low[j], high[j] = -np.inf, np.inf
            meets = np.zeros(len(rows), bool)
            for (least, greatest), (scores, _) in zip(windows[j], best[j], strict=True):
                floor = max(least, int(scores[-1])) if len(scores) == k else least
                meets |= (high[j] >= floor) & (low[j] <= greatest)
            some = np.flatnonzero(meets & (marks != own[j]))
            if not len(some):
                continue
            exact = products(anchors[j : j + 1], rows[some])[0]
            low[j, some] = high[j, some] = exact
            scored += len(some)
            for w, (least, greatest) in enumerate(windows[j]):
                inside = np.flatnonzero((exact >= least) & (exact <= greatest))
                if len(inside):
                    # Rows come by ascending id, so those kept so far are the smaller ones of equal scores.
                    scores, held = np.concatenate([best[j][w][0], exact[inside]]), np.concatenate([best[j][w][1], names[some[inside]]])
                    order = np.lexsort((held, -scores))[:k]
                    best[j][w] = scores[order], held[order]
    return best, scored


def window_of(score: int, window: tuple[int, int] = WINDOW) -> tuple[int, int]:
    """The least and the greatest score s with window[0] * score <= 100 s <= window[1] * score."""
    return -(-window[0] * score // 100), window[1] * score // 100


def _negatives(k: int, window: tuple[int, int]):
    def work(tile: Part, block: Part) -> Iterator[dict]:
        order = np.argsort(block.rows.column("place").to_numpy(), kind="stable")
        columns = {c: block.rows.column(c).to_numpy()[order] for c in ("label", "parent", "reach")}
        positives = [block.rows.column("positives")[int(i)].as_py() for i in order]
        windows = [[window_of(p["score"], window) for p in some] for some in positives]
        tree = (columns["parent"], columns["reach"])
        best, _ = walk(tile.vectors, tile.rows.column("label").to_numpy(), tile.ids, tree, block.vectors[order], columns["label"], windows, k)
        out = [(block.ids[i], p["positive_id"], n, p["score"], s) for i, some, lists in zip(order, positives, best, strict=True) for p, found in zip(some, lists, strict=True) for s, n in zip(*found, strict=True)]
        if out:
            names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
            yield {n: np.array(c, np.int64) for n, c in zip(names, zip(*out, strict=True), strict=True)} | {"dim": np.full(len(out), block.vectors.shape[1])}

    return work


def anchor_trees(anchors: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """``anchors`` (id, dim, label, v, positives) with (block, place, parent, reach): the trees that ``walk`` goes down."""
    side = F.pandas_udf(signature, "bigint")("v")
    numbered = global_index(anchors.withColumn("side", side), [F.col("dim"), F.col("side")], "number")
    numbered = numbered.withColumn("block", F.floor(F.col("number") / block).cast("int"))

    def hang(frame: pd.DataFrame) -> pd.DataFrame:
        order, parent, reach = spanning_tree(np.stack(frame["v"].to_numpy()).astype(np.float64).reshape(len(frame), -1))
        return frame.iloc[order].assign(place=np.arange(len(order), dtype=np.int32), parent=parent.astype(np.int32), reach=reach)

    rows = numbered.select(*anchors.columns, "block")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return scratch.save(rows.groupBy("block", "dim").applyInPandas(hang, f"{kinds}, place int, parent int, reach double"))


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, scratch: Scratch, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, block: int = BLOCK, tile_rows: int | None = None, tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both frames hold (id bigint, label bigint, v array<double>) with whole numbers; anchors are rows as well. Positives are an anchor's
    best other rows of its label, negatives its best rows of other labels whose score lies within ``window`` percent of
    the positive's; higher scores first, ties by smaller id. An anchor without positives, or a positive without negatives, gives
    no row. Rows whose id, label or vector is null, or whose vector holds a null or a number that is not finite, take no part; only vectors of
    one length are compared; of rows that repeat an id in one length that of the smallest label, then vector, counts. Scores
    beyond 64 bits are held to the bound. Other columns are not looked at; no rows give no rows.
    """
    whole = usable() & F.col("id").isNotNull() & F.col("label").isNotNull()
    rows, anchors = (df.where(whole).select("id", "label", "v") for df in (rows, anchors))
    tiles = tile_count(rows, tile_rows, tile_bytes)
    once = anchors.groupBy("id", F.size("v").alias("dim")).agg(F.min(F.struct("label", "v")).alias("row"))
    anchors = scratch.save(once.select("id", "dim", "row.label", "row.v"))
    blocks = max(1, math.ceil(anchors.count() / 1024))
    dealt = anchors.drop("dim").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    found = streamed(rows, dealt, tiles, _positives(positives), "anchor_id bigint, dim int, positive_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "dim").orderBy(F.desc("score"), "positive_id"))
    lists = found.withColumn("rank", rank).where(F.col("rank") <= positives).groupBy("anchor_id", "dim")
    lists = lists.agg(F.sort_array(F.collect_list(F.struct("score", "positive_id"))).alias("positives"))
    paired = scratch.save(anchors.join(lists.withColumnRenamed("anchor_id", "id"), ["id", "dim"]))
    trees = anchor_trees(paired, scratch, block).drop("dim")
    schema = "anchor_id bigint, dim int, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"
    found = streamed(rows, trees, tiles, _negatives(negatives, window), schema)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "dim", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
