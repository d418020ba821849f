"""Language identification: the nearest of several centroids a language, by the cosine of TF-IDF vectors of letter n-grams.

A text becomes the counts of its words' grams of one to three letters, with the words' edges, in BUCKETS hashed places: log(1 +
count) times the inverse document frequency over all texts to learn from, scaled to length 1. A language is not one cloud (there
are lists, headings, several sources), so its vectors are clustered by the cosine and each cluster has a centroid of its own. A text has
the language of the centroid with the greatest cosine; beyond the distance that nearly all of that language's own texts keep, it is
marked as ``far``, and ``rejecting`` gives it no language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.buffers import U, mix
from snapfold.llm.tables import map_texts, uniform_key

BUCKETS, CLUSTERS = 8192, 4
#: The most texts of a language that are clustered, those of the smallest hashes, whatever the size of the table.
PER_LANGUAGE = 1000
#: The most bytes of centroids that a task may be sent.
MODEL_BYTES = 256 << 20
#: Code points that are looked at together, texts that are scored together, and rounds of clustering at most.
CHUNK, STEP, ROUNDS = 1 << 18, 256, 10
#: The share of a language's own texts within its bound, and how much further a text may lie before it is far.
WITHIN, BEYOND = 0.99, 1.1
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _grams(texts: list[str]) -> np.ndarray:
    """text * BUCKETS + bucket of every gram of some texts."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    edge = np.zeros(1, np.uint32)
    c = np.concatenate([edge, *(x for p in points for x in (p, edge))])
    text = np.repeat(np.arange(len(texts)), [len(p) + 1 for p in points])
    letter = _is_letter()[c]
    c = np.where(letter, c + 1, 1).astype(U)  # 1 is an edge, so that grams of different lengths differ
    at = np.flatnonzero(letter)  # the first and the last place are edges
    before, own, after = c[at - 1], c[at], c[at + 1]
    of, starts = text[at - 1].astype(np.int64) * BUCKETS, before == 1
    grams = [(of, own), (of, own << U(21) | after), (of, before << U(42) | own << U(21) | after), (of[starts], U(1) << U(21) | own[starts])]
    return np.concatenate([t + (mix(g) % U(BUCKETS)).astype(np.int64) for t, g in grams])


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces of at most CHUNK code points, cut at spaces where there are any."""
    start = 0
    while len(text) - start > CHUNK:
        space = text.rfind(" ", start + 1, start + CHUNK)
        end = space if space > 0 else start + CHUNK
        yield text[start:end]
        start = end
    yield text[start:]


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each text's grams; none without letters."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last] or "") <= CHUNK):
            size += len(texts[last] or "")
            last += 1
        if size > CHUNK:
            counts = sum(np.bincount(_grams([piece]), minlength=BUCKETS) for piece in _pieces(texts[first]))
            buckets = np.flatnonzero(counts)
            yield buckets, counts[buckets]
        else:
            code, count = np.unique(_grams([t or "" for t in texts[first:last]]), return_counts=True)
            edges = np.searchsorted(code, np.arange(last - first + 1) * BUCKETS)
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                yield code[s:e] % BUCKETS, count[s:e]
        first = last


def weighted(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The weights at ``buckets``, scaled to length 1."""
    weights = np.log1p(counts) * idf[buckets]
    return weights / max(1e-12, float(np.sqrt((weights**2).sum())))


def cluster(vectors: np.ndarray, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of rows of length 1, by the cosine; each of length 1. Seeds are drawn as far from one another as a fixed draw has it."""
    order = np.random.default_rng(0)
    centres = vectors[[int(order.integers(len(vectors)))]]
    while len(centres) < min(clusters, len(vectors)):
        apart = np.maximum(0, 1 - (vectors @ centres.T).max(axis=1)) ** 2
        if apart.sum() < 1e-9:
            break
        centres = np.concatenate([centres, vectors[[int(order.choice(len(vectors), p=apart / apart.sum()))]]])
    nearest = None
    for _ in range(rounds):
        now = (vectors @ centres.T).argmax(axis=1)
        if nearest is not None and (now == nearest).all():
            break
        nearest = now
        sums = np.stack([vectors[nearest == i].sum(axis=0) if (nearest == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(1e-12, np.linalg.norm(sums, axis=1))[:, None]
    return centres


@dataclass
class Model:
    """Centroids as columns, the language of each, the cosine below which a text is far from it, and the weights of buckets."""

    languages: list[str]
    centroids: np.ndarray
    least: np.ndarray
    idf: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, far) of each; UNKNOWN without letters."""
        found, rows = [(UNKNOWN, 0.0, True)] * len(texts), list(features(texts))
        if not self.languages:
            return found
        for at in range(0, len(texts), STEP):
            block = rows[at : at + STEP]
            table = np.zeros((len(block), BUCKETS), np.float32)
            for i, (buckets, counts) in enumerate(block):
                table[i, buckets] = weighted(buckets, counts, self.idf)
            cosines = table @ self.centroids
            for i, best in enumerate(cosines.argmax(axis=1)):
                if len(block[i][0]):
                    near = float(np.clip(cosines[i, best], 0, 1))
                    found[at + i] = (self.languages[best], near, near < self.least[best])
        return found


def bucket_of(doc_id: Column | str, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % folds


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each bucket is found, and the number of texts with a letter: counted by tasks, BUCKETS sums in all."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                for buckets, _ in features(batch.slice(at, STEP).column(0).to_pylist()):
                    sums[buckets] += 1
                    sums[BUCKETS] += len(buckets) > 0
        here = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(here, pa.int32()), pa.array(sums[here], pa.int64())], names=["bucket", "n"])

    total = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in docs.select("text").mapInArrow(counted, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total[:BUCKETS], int(total[BUCKETS])


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, clusters: int = CLUSTERS, model_bytes: int = MODEL_BYTES) -> Model:
    """A model of the languages of ``docs`` (doc_id, text, lang); rows without language, id or letters teach nothing.

    Document frequencies are those of all rows. At most ``per_language`` texts of each language, chosen by hash, are clustered, each language
    in a task of its own. Languages whose centroids would take more than ``model_bytes`` are refused.
    """
    known = docs.where("lang is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    most = max(1, model_bytes // (4 * BUCKETS * clusters))
    sizes = known.groupBy("lang").count().limit(most + 1).collect()
    if len(sizes) > most:
        raise ValueError(f"more than {most} languages; raise model_bytes, or take fewer clusters")
    frequency, n = document_frequencies(known)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    if not n:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), idf)
    # About twice as many as wanted by their hash alone, so that nothing but these is read on; then exactly so many.
    shares = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, 2.0 * per_language / r["count"])))])
    key = uniform_key("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")), seed=13)
    drawn = known.withColumn("key", key).where(F.col("key") < shares[F.col("lang")] * F.lit(float(1 << 63))).select("lang", "key", "text")

    def vectors(texts: list[str | None]) -> list:
        rows = list(features(texts))
        return [[b.tolist() for b, _ in rows], [weighted(b, c, idf).tolist() for b, c in rows]]

    rows = map_texts(drawn, vectors, "buckets array<int>, weights array<float>", step=64).where(F.size("buckets") > 0)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "buckets"))
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= per_language)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank")
        table = np.zeros((len(frame), BUCKETS), np.float32)
        for i, (b, w) in enumerate(zip(frame["buckets"], frame["weights"], strict=True)):
            table[i, np.asarray(b)] = w
        centres = cluster(table, clusters)
        near = (table @ centres.T).max(axis=1)
        least = max(0.0, 1 - BEYOND * (1 - float(np.quantile(near, 1 - WITHIN))) - 1e-5)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "cluster": range(len(centres)), "centroid": list(centres), "least": least})

    found = rows.groupBy("lang").applyInPandas(fit, "lang string, cluster int, centroid array<float>, least double").orderBy("lang", "cluster").collect()
    if not found:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), idf)
    return Model([r["lang"] for r in found], np.array([r["centroid"] for r in found], np.float32).T.copy(), np.array([r["least"] for r in found]), idf)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, far) of every whole text: a learned language and its cosine; UNKNOWN and 0 without a letter.

    A null text has no letter; repeated rows are rows of their own; other columns are not looked at; no rows give no rows, and a model
    that has learned from none knows no language. Equal cosines go to the language that sorts first.
    """

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(texts: list[str | None]) -> list:
        return [list(x) for x in zip(*shared.value.predict(texts), strict=True)] or [[], [], []]

    return map_texts(docs.select("doc_id", "text"), predicted, "lang_pred string, score double, far boolean")


def rejecting(found: DataFrame) -> DataFrame:
    """What ``identify`` gives, with UNKNOWN for texts that lie far from all centroids."""
    return found.withColumn("lang_pred", F.when(F.col("far"), F.lit(UNKNOWN)).otherwise(F.col("lang_pred")))
