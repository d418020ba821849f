"""Lempel-Ziv fingerprints: the phrases of an LZ78 parse, hashed, and the minimum of each of many hash functions.

Symbols are words (runs of ``[^\\x20\\x09-\\x0D]``) of at most 16 code points, and the single code points of longer runs, so that
a text without spaces is parsed into phrases too, wherever its copy starts. A phrase is the longest known one plus a symbol; two texts are alike as far as their phrase
sets agree, much as one compresses well with the other's dictionary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.buffers import U, mix
from snapfold.llm.tables import map_texts, text_of

HASHES, SYMBOL = 64, 16
#: Rows of a range of ids on average, and the most ranges; a range is read as a stream.
RANGE_ROWS, RANGES = 4096, 20_000
_WHITE = dict.fromkeys((9, 10, 11, 12, 13), " ")
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=U))


def symbols(text: str) -> list[str]:
    words = [w for w in text.translate(_WHITE).split(" ") if w]
    if len(text) <= SYMBOL or max(map(len, words), default=0) <= SYMBOL:
        return words
    return [s for w in words for s in (w if len(w) > SYMBOL else (w,))]


def phrases(text: str) -> set[str]:
    """The phrases of the text's LZ78 parse; the last counts even where it is a known one."""
    known: set[str] = set()
    phrase = ""
    for symbol in symbols(text):
        phrase = f"{phrase} {symbol}" if phrase else symbol
        if phrase not in known:
            known.add(phrase)
            phrase = ""
    return known


def _hashes(strings: set[str]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, strings), U, len(strings))


def signature(text: str) -> np.ndarray | None:
    """16 bits of each hash function's minimum over the phrases; None without phrases."""
    hashes = _hashes(phrases(text))
    if not len(hashes):
        return None
    least = np.full(HASHES, ~U(0))
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096, None] ^ _SEEDS
        block *= U(0xFF51AFD7ED558CCD)
        block ^= block >> U(32)
        np.minimum(least, (block * U(0xC4CEB9FE1A85EC53)).min(axis=0), out=least)
    return mix(least) >> U(48)  # minima are small, their leading bits would say little


def fingerprint(text: str) -> str:
    """The signature in hex; empty without phrases."""
    found = signature(text)
    return "" if found is None else found.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of equal minima, an estimate of the phrase sets' Jaccard similarity; two empty ones are alike."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(bytes.fromhex(s), ">u2") for s in (a, b))
    return float((x == y).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every whole text; a null text is empty, repeated rows have equal fingerprints."""
    return map_texts(docs.select("doc_id", "text"), lambda texts: [[fingerprint(t or "") for t in texts]], "fingerprint string")


def _ranged(docs: DataFrame, range_rows: int) -> tuple[DataFrame, int]:
    """The rows with ``range``, a range of about ``range_rows`` ids, the first id of each range also in the one before it as ``ahead``.

    The bounds are ids of the table: 8 bytes for each of at most RANGES ranges go to the driver and to the tasks.
    """
    rows = docs.count()
    n = min(RANGES, max(1, rows // range_rows))
    bounds: list[int] = []
    if n > 1:
        shares = [i / n for i in range(1, n)]
        bounds = sorted(set(docs.select(F.percentile_approx("doc_id", shares, 5 * n)).first()[0] or []))
    least = docs.select(F.min("doc_id")).first()[0]
    bounds = [b for b in bounds if least is not None and b > least]
    starts = np.array(bounds, np.int64)

    @F.pandas_udf("array<int>")
    def ranges(ids: pd.Series, given: pd.Series) -> pd.Series:
        values, known = ids.to_numpy(np.int64), given.to_numpy(bool)
        own = np.where(known, np.searchsorted(starts, values, "right"), len(starts))
        first = known & (own > 0) & (starts[np.maximum(own, 1) - 1] == values) if len(starts) else np.zeros(len(own), bool)
        head = known & (values == least) if least is not None else ~known
        return pd.Series([[int(o)] + [int(o) - 1] * bool(f) + [len(starts)] * bool(h) for o, f, h in zip(own, first, head, strict=True)])

    spread = docs.select("doc_id", "text", F.posexplode(ranges(_id(), F.col("doc_id").isNotNull())).alias("ahead", "range"))
    return spread.withColumn("ahead", (F.col("ahead") > 0).cast("int")), len(starts) + 1


def _id() -> Column:
    """The id without nulls, which would turn it to floats in pandas."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id")


EditedText = Callable[[str, str], str]


def half_replaced(text: str, following: str) -> str:
    """The last half of the text's code points replaced by as many of the next text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_neighbours(docs: DataFrame, edit: EditedText = half_replaced, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, text, edited, fingerprint, edited_fingerprint, near_edited, near_next), next being the next greater doc_id.

    Rows are ordered by doc_id, then by text, null ids last; the last row's next is the first. A null text is empty, and
    a table of one row is its own next. The table is shuffled once, by ranges of ids; a task reads its range as a stream
    and holds two rows.
    """
    spread, n = _ranged(docs, range_rows)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def one(row: tuple, after: tuple, marks: dict[str, str]) -> tuple:
        text, following = row[1], after[1]
        edited = edit(text, following)
        for t in (text, edited, following):
            if t not in marks:
                marks[t] = fingerprint(t)
        a, b, c = marks[text], marks[edited], marks[following]
        for t in [t for t in marks if t != following]:
            del marks[t]
        return row[0], text, edited, a, b, likeness(a, b), likeness(a, c)

    names = ["doc_id", "text", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, of, done, marks = None, None, False, {}
        out, size = [], 0
        for batch in batches:
            values, known, texts = batch["id"].to_numpy(), batch["known"].to_numpy(), batch["text"].to_numpy()
            for i, (part, ahead) in enumerate(zip(batch["range"].to_numpy(), batch["ahead"].to_numpy(), strict=True)):
                row = (int(values[i]) if known[i] else None, texts[i] or "")
                if part != of:
                    held, of, done = None, part, False
                if held is not None and not done:
                    out.append(one(held, row, marks))
                    size += 2 * len(held[1]) + 1024
                done = done or bool(ahead)
                held = row
                if size > 1 << 22:
                    yield _frame(out, names)
                    out, size = [], 0
        if out:  # a frame without rows has no types, and Arrow cannot guess those of strings
            yield _frame(out, names)

    schema = f"doc_id {kind}, text string, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    # Each range has the row that follows it, marked, as its last; only the first such row is looked at.
    # A range is a partition of its own, so that none stands empty beside one that holds several.
    dealt = spread.repartitionById(n, F.col("range")).sortWithinPartitions("range", "ahead", F.col("doc_id").asc_nulls_last(), text_of())
    return dealt.select(_id(), F.col("doc_id").isNotNull().alias("known"), "text", "range", "ahead").mapInPandas(compare, schema)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    columns = list(zip(*rows, strict=True))
    # Not by way of floats, which a null among the ids would make of them.
    return pd.DataFrame({n: pd.array(c, "Int64") if n == "doc_id" else list(c) for n, c in zip(names, columns, strict=True)})
