"""Hard negatives against SQL, a plain search, and the bounds that save scores."""

import numpy as np
import pytest

from snapfold.llm.hard_negatives import anchor_trees, hard_negatives, spanning_tree, walk, window_of
from snapfold.llm.tables import Scratch

SCHEMA = "id bigint, label bigint, v array<double>, rank string, score string"


@pytest.fixture
def scratch(spark):
    made = Scratch(spark, "negatives")
    yield made
    made.drop()


def plain(rows, anchors, positives=5, negatives=10, window=(30, 90)):
    good, best = {}, []
    for i, label, v in rows:
        if None not in (i, label, v) and all(x is not None and np.isfinite(x) for x in v):
            key = (i, len(v))
            good[key] = min(good.get(key, (label, tuple(v))), (label, tuple(v)))
    for (a, dim), (label, v) in good.items():
        if a not in anchors:
            continue
        scores = [(-sum(int(x) * int(y) for x, y in zip(v, w, strict=True)), i, m) for (i, d), (m, w) in good.items() if d == dim and i != a]
        for p, pid, _ in sorted(s for s in scores if s[2] == label)[:positives]:
            fit = sorted(s for s in scores if s[2] != label and window[0] * -p <= 100 * -s[0] <= window[1] * -p)[:negatives]
            best += [(a, pid, n, i, -p, -s) for n, (s, i, _) in enumerate(fit, 1)]
    return sorted(best)


def mined(spark, rows, anchors, scratch, **settings):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = hard_negatives(df, df.where(df["id"].isin(list(anchors))), scratch, **settings)
    assert found.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    return sorted(map(tuple, found.collect()))


def test_many_tiles_and_blocks(spark, scratch):
    """Clusters, equal vectors, a label of a third of the rows."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 8)) * 200
    rows = [(int(i), int(rng.integers(0, 6)) if i % 3 else 9, np.floor(centres[i % 12] + rng.normal(size=8) * 30).tolist()) for i in range(700)]
    rows += [(1000 + i, i % 4, rows[5][2]) for i in range(60)]
    anchors = [r[0] for r in rows if r[0] % 9 == 0]
    want = plain(rows, set(anchors))
    assert mined(spark, rows, anchors, scratch, block=16, tile_rows=90) == want and len(want) > 500
    assert mined(spark, rows, anchors, scratch, positives=2, negatives=3, window=(50, 100), block=1000, tile_rows=10_000) == plain(rows, set(anchors), 2, 3, (50, 100))


def test_edges(spark, scratch):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, 1, [3.0, 4.0]), (1, 1, [3.0, 4.0]), (2, 2, [1.0, 3.0]), (3, 2, [1.0, 3.0]), (3, 2, [1.0, 3.0]), (4, None, [1.0, 3.0]), (5, 2, None), (6, 2, [None, 3.0]), (7, 2, [nan, 3.0]), (8, 2, [inf, 3.0]),
        (None, 2, [1.0, 3.0]), (9, 2, [1.0]), (10, 2, []), (11, 3, [-1.0, -3.0]), (12, 3, [0.0, 0.0]), (0, 1, [5.0]), (13, 1, [2.0]), (14, 7, [1.0]), (15, 1, []), (16, 2, [9.0, 0.0]), (16, 1, [9.0, 9.0]),
    ]
    anchors = {0, 3, 10, 11, 12, 16}
    want = plain(rows, anchors)
    assert mined(spark, rows, anchors, scratch) == want == mined(spark, rows, anchors, scratch, block=1, tile_rows=1) and (0, 1, 1, 2, 25, 15) in want
    assert mined(spark, [], {0}, scratch) == [] == mined(spark, rows, {99}, scratch)
    huge = [(0, 1, [2.0**30, 1.0]), (1, 1, [2.0**31, 3.0]), (2, 2, [2.0**30, 5.0]), (3, 2, [2.0**29, 0.0]), (4, 3, [2.0**30 + 2**28, 9.0])]
    assert mined(spark, huge, {0}, scratch) == plain(huge, {0}) != []


def test_tree(spark, scratch):
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(size=(60, 5)) * 50)
    points[7] = points[3]
    order, parent, reach = spanning_tree(points)
    assert sorted(order) == list(range(60)) and (parent < np.arange(60)).all() and parent[0] == -1
    placed = points[order]
    upper = np.where(parent[:, None] >= 0, placed[parent], 0)
    assert np.allclose(reach, np.linalg.norm(placed - upper, axis=1))
    # Kruskal's total over all points and the origin.
    every, of = np.concatenate([points, np.zeros((1, 5))]), list(range(61))
    total = 0.0
    for d, i, j in sorted((float(np.linalg.norm(every[i] - every[j])), i, j) for i in range(61) for j in range(i)):
        if of[i] != of[j]:
            total, gone, stays = total + d, of[i], of[j]
            of = [stays if x == gone else x for x in of]
    assert np.isclose(reach.sum(), total)
    df = spark.createDataFrame([(i, 5, 1, p.tolist(), []) for i, p in enumerate(points)], "id bigint, dim int, label bigint, v array<double>, positives array<struct<score:bigint,positive_id:bigint>>")
    rows = anchor_trees(df, scratch, 25).collect()
    assert sorted(r.id for r in rows) == list(range(60)) and sorted(r.place for r in rows) == sorted([*range(25), *range(25), *range(10)])


def test_bounds_save_scores():
    """Anchors in tight clusters: most rows are never scored, and the result is that of scoring all."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 16)) * 300
    rows = np.floor(centres[rng.integers(0, 8, 6000)] + rng.normal(size=(6000, 16)) * 4)
    anchors = np.floor(centres[rng.integers(0, 8, 40)] + rng.normal(size=(40, 16)) * 4)
    order, parent, reach = spanning_tree(anchors)
    anchors, labels, own = anchors[order], np.ones(6000, np.int64), np.zeros(40, np.int64)
    windows = [[window_of(int((a**2).sum()), (85, 95))] for a in anchors]
    best, scored = walk(rows, labels, np.arange(6000), (parent, reach), anchors, own, windows, 10)
    for a, (window,), ((scores, ids),) in zip(anchors, windows, best, strict=True):
        exact = (rows @ a).astype(np.int64)
        fit = sorted((-int(s), i) for i, s in enumerate(exact) if window[0] <= s <= window[1])[:10]
        assert [(-int(s), int(i)) for s, i in zip(scores, ids, strict=True)] == fit
    assert scored < 0.5 * 40 * 6000, scored
