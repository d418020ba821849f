"""Best-fit packing: repeat counts of length patterns by non-negative least squares, the rest by best fit.

Texts become pieces of at most ``capacity`` tokens. Their histogram, one number for each length, is all the driver sees. It
enumerates patterns of two and three lengths that fill a sequence (the third length being one that is still plentiful), fits
the patterns' repeat counts to the histogram with non-negative least squares, rounds them down to what the histogram has,
and packs the lengths left over by best fit. The plan says for the n-th piece of a length in which sequence and at which
offset it lies; pieces are numbered by many tasks, as a length may hold any share of them.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.tables import Scratch, map_texts, running, uniform_key

CAPACITY, END = 1024, 2
#: A run of white space of so many characters goes to the library: the fast encoder's matcher recurses through it until its stack ends.
WHITE_RUN = 1 << 14
# Fixed value: the pattern by which byte-level BPE of this family cuts texts before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_loaded: dict[str, Encoder] = {}
_LONG_WHITE = re.compile(rf"\s{{{WHITE_RUN}}}")


def _ranks(path: str) -> dict[bytes, int] | None:
    """The ids of a byte-level BPE file by the bytes they stand for, if they ascend as the merges do; else None.

    None too where the file asks for anything that the fast encoder does not do.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, first = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or first.get("type") != "ByteLevel" or first.get("add_prefix_space"):
        return None
    if not first.get("use_regex", True) or any(model.get(k) for k in ("ignore_merges", "byte_fallback", "dropout", "continuing_subword_prefix", "end_of_word_suffix")):
        return None
    # Bytes that don't print stand as the characters from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if any(model["vocab"].get(m) != 256 + i for i, m in enumerate(merges)):
        return None
    return {bytes(signs[c] for c in token): i for token, i in model["vocab"].items() if i < 256 + len(merges)}


class Encoder:
    """The ids that the ``tokenizers`` library gives for a file.

    A byte-level BPE whose ids ascend as its merges do is run by ``tiktoken``, which gives the same ids in a quarter of the
    time. Texts with a special token's string or a very long run of white space, and all texts with any other file, go to
    the library itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = _ranks(path)
        self.fast = ranks and Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast and not any(s in text for s in self.special) and not (len(text) >= WHITE_RUN and _LONG_WHITE.search(text)):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, and before them what is left over."""
    first = length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int | None = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the tokens of every whole text, then ``end``, in pieces.

    A null text is empty and consists of ``end`` alone; without ``end`` it has no piece. ``tokenizer`` is a file that every
    executor can read.
    """

    def encoded(texts: list[str | None]) -> list:
        found = []
        for text in texts:
            ids = np.array(encoder(tokenizer).ids(text or "") + ([] if end is None else [end]), "<u4")
            found.append([
                {"piece": i, "start": s, "length": n, "ids_crc32": zlib.crc32(ids[s : s + n].tobytes())} | ({"ids": ids[s : s + n].tolist()} if with_ids else {})
                for i, (s, n) in enumerate(cut(len(ids), capacity) if len(ids) else [])
            ])
        return [found]

    kind = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint" + (",ids:array<bigint>>>" if with_ids else ">>")
    rows = map_texts(docs.select("doc_id", "text"), encoded, f"p {kind}", step=64)
    return rows.select("doc_id", F.explode("p").alias("p")).select("doc_id", "p.*")


def patterns(histogram: np.ndarray, limit: int = 2048) -> list[tuple[int, ...]]:
    """Patterns of one to three lengths that fill a sequence exactly, the most frequent lengths first."""
    capacity = len(histogram) - 1
    found = [(capacity,)] if histogram[capacity] else []
    present = np.flatnonzero(histogram)
    found += [(int(a), int(capacity - a)) for a in present if 2 * a >= capacity > a and histogram[capacity - a]]
    common = present[np.argsort(-histogram[present], kind="stable")][:48]
    triples = {tuple(sorted((int(a), int(b), int(capacity - a - b)), reverse=True)) for a in common for b in common if 0 < capacity - a - b and histogram[capacity - a - b]}
    ranked = sorted(triples, key=lambda t: (-min(int(histogram[x]) for x in t), t))
    return found + ranked[: max(0, limit - len(found))]


def fit_counts(shapes: list[tuple[int, ...]], histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative x for which the patterns' lengths come nearest to the histogram in squares: accelerated projected gradient."""
    if not shapes:
        return np.zeros(0)
    rows = np.array([x for s in shapes for x in s])
    columns = np.repeat(np.arange(len(shapes)), [len(s) for s in shapes])
    apply = lambda x: np.bincount(rows, x[columns], len(histogram))
    back = lambda r: np.bincount(columns, r[rows], len(shapes))
    v = np.ones(len(shapes))
    for _ in range(30):  # the largest singular value, squared
        v = back(apply(v))
        v /= np.linalg.norm(v)
    step = 0.99 / max(1e-9, float(v @ back(apply(v))))
    x = y = np.zeros(len(shapes))
    momentum = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(apply(y) - histogram))
        following = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        x, y, momentum = new, new + (momentum - 1) / following * (new - x), following
    return x


def best_fit(left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats) for what is left, longest first, each piece where it leaves the least room.

    Works on numbers of equal sequences, not on single ones: at most some lengths x lengths steps.
    """
    capacity = len(left) - 1
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for length in range(capacity, 0, -1):
        todo = int(left[length])
        room = length
        while todo:
            while room <= capacity and not open_[room]:
                room += 1
            if room > capacity:
                fits = capacity // length
                if whole := todo // fits:
                    shape = (length,) * fits
                    open_[capacity - length * fits][shape] = open_[capacity - length * fits].get(shape, 0) + whole
                if rest := todo % fits:
                    shape = (length,) * rest
                    open_[capacity - length * rest][shape] = open_[capacity - length * rest].get(shape, 0) + 1
                break
            shape, many = open_[room].popitem()
            used = min(many, todo)
            if many > used:
                open_[room][shape] = many - used
            grown = (*shape, length)
            open_[room - length][grown] = open_[room - length].get(grown, 0) + used
            todo -= used
            room = length
    return [(shape, many) for some in open_.values() for shape, many in some.items()]


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats) for all pieces; ``histogram[n]`` pieces have n tokens."""
    left = histogram.astype(np.int64).copy()
    done = []
    shapes = patterns(left)
    counts = fit_counts(shapes, left.astype(float))
    for i in np.argsort(-counts, kind="stable"):
        uses = np.bincount(shapes[i], minlength=len(left))
        many = min(int(counts[i] + 1e-6), *(int(left[x] // uses[x]) for x in set(shapes[i])))
        if many > 0:
            left -= uses * many
            done.append((shapes[i], many))
    return done + best_fit(left)


def pack_pieces(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` with (sequence_id, offset): pieces of a sequence lie one after another from 0 and hold ``capacity`` tokens at most.

    ``rows`` have (doc_id, piece, length) and come from a written table, as they are read more than once. Rows that repeat
    a document's piece are pieces of their own. What is broadcast is a plan of at most some thousand runs for each length.
    """
    histogram = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").count().collect():
        histogram[r["length"]] = r["count"]
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # of a length: first piece, first sequence, offset
    used = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for shape, many in plan(histogram):
        offset = 0
        for length in shape:
            runs[length].append((int(used[length]), sequence, offset))
            used[length] += many
            offset += length
        sequence += many
    tables = {n: np.array(r, np.int64).T for n, r in runs.items()}

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        where = np.zeros((2, len(lengths)), np.int64)
        for n in np.unique(lengths):
            here = np.flatnonzero(lengths == n)
            first, sequences, offsets = tables[int(n)]
            run = np.searchsorted(first, ranks[here], "right") - 1
            where[0, here] = sequences[run] + ranks[here] - first[run]
            where[1, here] = offsets[run]
        return pd.DataFrame({"sequence_id": where[0], "offset": where[1]})

    keyed = rows.withColumn("_key", uniform_key("doc_id", "piece", seed=5))
    numbered = running(keyed, ["length"], "_key", ["doc_id", "piece"], int(histogram.sum()))
    return numbered.withColumn("_place", place("length", "before")).select(*rows.columns, "_place.sequence_id", "_place.offset")


def pack(docs: DataFrame, tokenizer: str, scratch: Scratch, capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every document."""
    return pack_pieces(scratch.save(pieces(docs, tokenizer, capacity, end)), capacity)
