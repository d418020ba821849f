"""Quality classifier: histogram gradient-boosted trees over statistics of a text, flattened for numpy traversal.

The statistics of labelled rows are computed by tasks; the trees are fitted on the driver to a sample of at most
``max_rows`` of them, the rows of the smallest hashes. The fitted trees are arrays: a node holds a feature, a threshold and the
place of its children, so that a batch walks through all levels of a tree with a few numpy operations.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.tables import map_texts, whole_rows

#: The most labelled rows that a fit looks at, whatever the size of the table.
MAX_ROWS = 20_000
FEATURES = (
    "log_chars", "log_words", "mean_word", "long_words", "upper", "digits", "white", "marks", "bars", "sentence_marks",
    "marked_words", "shouted_words", "distinct_words", "commonest_word", "repeated_neighbours", "distinct_lines", "mean_line",
    "upper_starts", "non_ascii", "compressed", "bracketed", "short_words", "longest_run", "window_distinct",
)
_CLASS = np.zeros(256, np.uint8)
for _n, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c", b"#$%&*@^~+=_<>\\", b"|", b".!?,;:", b"()[]{}\"'/-`"), 1):
    _CLASS[list(_chars)] = _n
_CLASS[128:] = 8
_MARKED = re.compile(r"[^\w\s.,;:]$|!!$")


def statistics(text: str) -> list[float]:
    """One number for each of FEATURES; those of an empty text are 0."""
    data = text.encode()
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    shares = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=9) / len(data)
    lines = [x for x in text.split("\n") if x]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    same = np.fromiter((a == b for a, b in zip(words, words[1:])), bool, n - 1)  # noqa: B905
    breaks = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
    windows = [len(set(words[i : i + 50])) / min(50, n - i) for i in range(0, max(1, n - 49), 25)]
    return [
        np.log1p(len(text)), np.log1p(n), sizes.mean(), (sizes > 15).mean(), shares[1], shares[2], shares[3], shares[4], shares[5], shares[6],
        sum(_MARKED.search(w) is not None for w in words) / n, sum(len(w) > 1 and w.isupper() for w in words) / n, len(counts) / n,
        max(counts.values()) / n, same.mean() if n > 1 else 0.0, len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
        sum(w[0].isupper() for w in words) / n, shares[8], len(zlib.compress(data, 1)) / len(data), shares[7], (sizes < 3).mean(),
        np.log1p(np.diff(breaks).max()), min(windows),
    ]


@dataclass(frozen=True)
class Trees:
    """All trees side by side: arrays of (trees, nodes). A leaf is its own child."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for every row of ``x``."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, left, right, value in zip(self.feature, self.threshold, self.left, self.right, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = np.where(x[rows, feature[node]] <= threshold[node], left[node], right[node])
            total += value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, penalty: float = 1.0, least: int = 10) -> Trees:
    """Gradient boosting of the logistic loss. Features are put in at most ``bins`` bins of about equal numbers once; a level
    of a tree then needs one histogram of gradients over (node, feature, bin).

    Without rows every score is 0.5; where all labels agree the score is close to them.
    """
    n, features = x.shape
    share = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(share / (1 - share)))
    nodes = 2 ** (depth + 1) - 1
    shape = (0 if n == 0 else trees, nodes)
    feature, threshold = np.zeros(shape, np.int64), np.full(shape, np.inf)
    left, right = (np.tile(np.arange(nodes), (shape[0], 1)) for _ in range(2))
    value = np.zeros(shape)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for column in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1) if n else x.astype(np.int64)
    total = np.full(n, base)
    for t in range(shape[0]):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            open_ = node >= first
            code = ((node[open_] - first)[:, None] * features + np.arange(features)) * bins + binned[open_]
            size = count * features * bins
            g, h, c = (
                np.bincount(code.ravel(), None if w is None else np.repeat(w[open_], features), size).reshape(count, features, bins).cumsum(axis=2)
                for w in (gradient, weight, None)
            )
            g_all, h_all, c_all = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g**2 / (h + penalty) + (g_all - g) ** 2 / (h_all - h + penalty) - g_all**2 / (h_all + penalty)
            gain[(c < least) | (c_all - c < least)] = -np.inf
            for i in range(count):
                f, b = np.unravel_index(gain[i].argmax(), gain[i].shape)
                if not gain[i, f, b] > 1e-9 or b >= len(edges[f]):
                    continue
                at = first + i
                feature[t, at], threshold[t, at] = f, edges[f][b]
                left[t, at], right[t, at] = 2 * at + 1, 2 * at + 2
                here = node == at
                node[here] = np.where(binned[here, f] <= b, 2 * at + 1, 2 * at + 2)
        g, h = np.bincount(node, gradient, nodes), np.bincount(node, weight, nodes)
        value[t] = rate * g / (h + penalty)
        total += value[t][node]
    return Trees(base, feature, threshold, left, right, value, depth)


def held_out_bucket(column: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **settings) -> Trees:
    """Trees for ``labels`` (doc_id, quality) from the rows that aren't held out.

    A document labelled more than once has the mean of its labels, rounded up; null labels and labels without a document
    are left out. The sample, of at most ``max_rows`` ids, is the only thing broadcast.
    """
    marked = labels.where(~held_out_bucket() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = map_texts(rows, lambda texts: [[statistics(t or "") for t in texts]], "x array<double>")
    # Rows that repeat an id may exceed the bound: of each id the first by its statistics stays.
    found = found.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).orderBy("doc_id").collect()
    x = np.array([r.x for r in found], float).reshape(len(found), len(FEATURES))
    return fit_trees(x, np.array([r.quality for r in found], float), **settings)


def score(docs: DataFrame, model: Trees, threshold: float = 0.3) -> DataFrame:
    """(_row, score, predicted): every row with its score; a null text is empty, and empty texts have a score too."""

    def scored(texts: list[str | None]) -> list:
        values = model.scores(np.array([statistics(t or "") for t in texts], float).reshape(len(texts), len(FEATURES)))
        return [values, (values >= threshold).astype(np.int32)]

    return map_texts(whole_rows(docs), scored, "score double, predicted int")
