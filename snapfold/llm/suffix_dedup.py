"""Suffix-array dedup: bytes that a smaller document has too, in a string of 50, found by sorting suffixes column by column.

The sort is the multi-document construction that inserts one symbol of every string in each round: rounds go from the
strings' last column to their first, each string's next suffix takes its place among those of all strings by the counts of
symbols in the Burrows-Wheeler transform, and the transform is rewritten in one sequential pass. In the end suffixes that
share 50 bytes stand next to each other, and the smallest document among them is known.

A whole corpus is not one such collection. It is cut so that equal strings of 50 bytes meet: each has as its minimizer the
smallest hash of its 20-grams, runs of strings with one minimizer are a segment (50 to 81 bytes), and segments go to
buckets by minimizer. A bucket holds about the same number of bytes at every size of the corpus and is what a task sorts; the
"external files" between the steps are Spark's shuffles. Before any bytes are moved, packed minimizers alone are compared,
and segments whose minimizer is found only in one document are left where they are. Copies of a segment in one part of the
documents are settled there: all but the smallest document's are removed, and only that one travels.

Within a bucket, strings of 50 bytes can only be equal in segments of one minimizer. A segment whose minimizer no other segment of
other bytes has is told by its bytes alone; those that share a minimizer and differ, as at the edges of a passage, are sorted.

A phrase of many documents is the minimizer of as many different segments. The segments of each minimizer are counted, and
those of a hot one are taken apart: their strings go to buckets by their own hash, each at most once from a part of the
documents, and need only be told equal there, not sorted. So a bucket has at most HOT_SHARE of its size from one minimizer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.buffers import U, mix, pack, powers, prefix_hash, runs_of, sliding_min
from snapfold.llm.tables import text_of

SPAN, GRAM, RUN = 50, 20, 32
#: Bytes of text for each part of the documents, and for each bucket of segments.
PART_BYTES = 8 << 20
#: The share of a bucket that the segments of one minimizer may take.
HOT_SHARE = 1 / 8
_LAST = np.iinfo(np.int64).max
_END = 255  # no byte of UTF-8


def segments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, start, end) of the runs of strings of SPAN bytes that have one minimizer, at most RUN strings each."""
    if len(data) < SPAN:
        empty = np.empty(0, np.int64)
        return np.empty(0, U), empty, empty
    total = prefix_hash(data)
    grams = mix((total[GRAM:] - total[:-GRAM]) * powers(len(data))[1][: len(data) - GRAM + 1])
    least = sliding_min(grams, SPAN - GRAM + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    many = np.diff(np.append(first, len(least)))
    if many.max() > RUN:  # periodic text
        pieces = -(-many // RUN)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        last = np.repeat(first + many, pieces)
        first = np.repeat(first, pieces) + within * RUN
        many = np.minimum(RUN, last - first)
    return least[first], first, first + many + SPAN - 1


def sort_columns(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted suffixes of SPAN bytes or more of all strings: (string, start, begins a class), equal first SPAN bytes being a class.

    Round j inserts the symbol before the suffix of length j of every string that has one. ``bwt`` holds the symbol before
    each suffix so far, in their order; ``place`` the places of the strings' longest suffixes, ascending, and ``of`` their strings.
    """
    n = len(strings)
    lengths = np.fromiter(map(len, strings), np.int64, n)
    width = int(lengths.max(initial=0))
    table = np.full((width + 1, n), _END, np.uint8)  # column by column from the end
    data = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(n), lengths)
    table[ends[owner] - 1 - np.arange(len(data)), owner] = data
    bwt, place, of = table[0].copy(), np.arange(n), np.arange(n)
    for j in range(width):
        order = np.argsort(bwt, kind="stable")  # a counting sort: where each symbol's suffix goes
        going = np.zeros(len(bwt), bool)
        going[place[lengths[of] > j]] = True
        order = order[: len(bwt) - np.count_nonzero(bwt == _END)]
        moved = going[order]
        source = order[moved]
        of = of[np.searchsorted(place, source)]
        place = n + np.flatnonzero(moved)
        wider = np.empty(len(bwt) + len(place), np.uint8)
        old = np.ones(len(wider), bool)
        old[place] = False
        wider[old] = bwt
        wider[place] = table[j + 1, of]
        bwt = wider
    # Walk the finished transform from every string's empty suffix to find the places of its long ones.
    order = np.argsort(bwt, kind="stable")
    step = np.empty(len(bwt), np.int64)
    step[order] = n + np.arange(len(bwt))
    at, strings_at, starts = np.arange(n), [], []
    places = []
    for j in range(width):
        live = lengths > j
        at = np.where(live, step[np.minimum(at, len(step) - 1)], at)
        if j + 1 >= SPAN:
            whole = np.flatnonzero(live)
            places.append(at[whole])
            strings_at.append(whole)
            starts.append(lengths[whole] - j - 1)
    if not places:
        empty = np.empty(0, np.int64)
        return empty, empty, empty.astype(bool)
    rank = np.argsort(np.concatenate(places))
    string, start = np.concatenate(strings_at)[rank], np.concatenate(starts)[rank]
    begin = ends[string] - lengths[string] + start
    new = np.ones(len(begin), bool)
    windows = np.lib.stride_tricks.sliding_window_view(data, SPAN)
    for s in range(1, len(begin), 1 << 16):
        e = min(len(begin), s + (1 << 16))
        new[s:e] = (windows[begin[s:e]] != windows[begin[s - 1 : e - 1]]).any(axis=1)
    return string, start, new


def first_minimizers(strings: list[bytes]) -> np.ndarray:
    """The minimizer of each segment: the least hash of the grams of its first SPAN bytes."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    starts = np.cumsum([0, *map(len, strings[:-1])])
    total, inverse = prefix_hash(data), powers(len(data))[1]
    out = np.empty(len(strings), U)
    for s in range(0, len(strings), 1 << 14):
        at = starts[s : s + (1 << 14), None] + np.arange(SPAN - GRAM + 1)
        out[s : s + (1 << 14)] = mix((total[at + GRAM] - total[at]) * inverse[at]).min(axis=1)
    return out


def _found(blobs: list[bytes], lengths: np.ndarray, docs: np.ndarray, places: np.ndarray, rows: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """(part, row, start, end) of the bytes of segments that a smaller document has, in one bucket."""
    text = b"".join(blobs)
    ends = np.cumsum(lengths)
    number: dict[bytes, int] = {}
    which = np.fromiter((number.setdefault(text[e - n : e], len(number)) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)), np.int64, len(lengths))
    least = np.full(len(number), _LAST)
    np.minimum.at(least, which, docs)
    whole = docs > least[which]
    out = [np.stack([parts, rows, places, places + lengths])[:, whole]]
    string, start, new = _sorted_strings(list(number))
    if len(string):
        heads = np.flatnonzero(new)
        smallest = np.repeat(np.minimum.reduceat(least[string], heads), np.diff(np.append(heads, len(string))))
        hit = smallest < least[string]
        code = np.unique(string[hit] << 32 | start[hit])
        s, at = code >> 32, code & 0xFFFFFFFF
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1] + 1])) if len(code) else code
        many = np.diff(np.append(first, len(code)))
        runs, begins, stops = s[first], at[first], at[first] + many - 1 + SPAN
        # To the documents that have the string and none smaller has: usually one.
        own = np.flatnonzero(~whole)
        own = own[np.argsort(which[own], kind="stable")]
        low, high = np.searchsorted(which[own], runs, "left"), np.searchsorted(which[own], runs, "right")
        times = high - low
        to = own[np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
        out.append(np.stack([parts[to], rows[to], places[to] + np.repeat(begins, times), places[to] + np.repeat(stops, times)]))
    return np.concatenate(out, axis=1)


def _sorted_strings(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sort_columns`` of those strings whose minimizer others have too."""
    if not strings:
        return sort_columns(strings)
    _, which, times = np.unique(first_minimizers(strings), return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[which] > 1)
    string, start, new = sort_columns([strings[i] for i in some.tolist()])
    return some[string], start, new


def string_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of every string of SPAN bytes."""
    total = prefix_hash(data)
    return mix((total[SPAN:] - total[:-SPAN]) * powers(len(data))[1][: len(data) - SPAN + 1])


def _repeated(blobs: list[bytes], docs: np.ndarray, places: np.ndarray, rows: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """(part, row, start, end) of the strings of SPAN bytes that a smaller document has, in one bucket."""
    text = b"".join(blobs)
    number: dict[bytes, int] = {}
    which = np.fromiter((number.setdefault(text[s : s + SPAN], len(number)) for s in range(0, len(text), SPAN)), np.int64, len(docs))
    least = np.full(len(number), _LAST)
    np.minimum.at(least, which, docs)
    return np.stack([parts, rows, places, places + SPAN])[:, docs > least[which]]


def _occurrences(data: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Where the strings of SPAN bytes that start at ``of`` start in the text, each as often as it does."""
    hashes = string_hashes(data)
    of = of[np.unique(hashes[of], return_index=True)[1]]
    at = np.flatnonzero(np.isin(hashes, hashes[of]))
    like = of[np.searchsorted(hashes[of], hashes[at])]
    windows = np.lib.stride_tricks.sliding_window_view(data, SPAN)
    same = [(windows[at[s : s + (1 << 16)]] == windows[like[s : s + (1 << 16)]]).all(axis=1) for s in range(0, len(at), 1 << 16)]
    return at[np.concatenate(same)]


def _code(minimizers: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket in the upper, 32 bits of the minimizer in the lower half."""
    return (minimizers >> U(32)) % U(buckets) << U(32) | minimizers & U(0xFFFFFFFF)


def _rows(frame: pd.DataFrame) -> pd.DataFrame:
    """A part's rows in an order that follows from their contents, so that a row's number is the same each time."""
    return frame.sort_values(["id", "none", "text"], kind="stable", ignore_index=True)


def bucketed(docs: DataFrame, part_bytes: int = PART_BYTES) -> tuple[DataFrame, DataFrame]:
    """(id, none, text, part) of the documents, and the segments and strings that travel, by bucket.

    ``settled`` is 1 for what a smaller document of the same part is known to have, 2 for single strings of hot minimizers. The
    place of such a string is inverted where it starts in its row more than once.
    """
    hot_segments = max(1, int(part_bytes * HOT_SHARE) // SPAN)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(6, math.ceil(size / part_bytes))
    part = F.pmod(F.xxhash64("doc_id", text_of()), F.lit(parts)).cast("int")
    id_ = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST))
    rows = docs.select(id_.alias("id"), F.col("doc_id").isNull().alias("none"), text_of().alias("text"), part.alias("part"))

    def minimizers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, int, int, np.ndarray]] = []

        def packed() -> pd.DataFrame:
            code, times = (np.concatenate([h[i] for h in held]) for i in (0, 3))
            sizes = [len(h[0]) for h in held]
            where = np.repeat(np.array([h[1] for h in held], np.uint32), sizes)
            ids = np.repeat(np.array([h[2] for h in held], np.int64), sizes)
            order = np.lexsort((ids, where, code))
            code, where, ids, times = code[order], where[order], ids[order], times[order]
            new = np.concatenate([[True], code[1:] != code[:-1]])
            first = np.flatnonzero(new)
            shared = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
            shared = np.repeat(shared, np.diff(np.append(first, len(code))))
            once = new | np.concatenate([[True], where[1:] != where[:-1]])
            # How many segments there are beside the one of each part that the keys tell of.
            more = np.add.reduceat(times, first) - np.add.reduceat(once.astype(np.int64), first)
            again, more = code[first][more > 0], more[more > 0]
            code, where, shared = code[once], where[once], shared[once]
            out = []
            for b, s in runs_of((code >> U(32)).astype(np.int64)):
                a = slice(*np.searchsorted(again, np.array([b, b + 1], U) << U(32)))
                counted = (again[a] & U(0xFFFFFFFF)).astype(np.uint32), more[a].astype(np.uint32)
                out.append((b, *pack((code[s] & U(0xFFFFFFFF)).astype(np.uint32), where[s], np.packbits(shared[s]), *counted)))
            return pd.DataFrame(out, columns=["bucket", "keys", "parts", "shared", "again", "more"])

        bytes_held = 0
        for batch in batches:
            for name, text, where in zip(batch["id"], batch["text"], batch["part"], strict=True):
                data = text.encode()
                found, starts, stops = segments(np.frombuffer(data, np.uint8))
                if len(found):
                    code = _code(found, parts)
                    codes, times = np.unique(code, return_counts=True)
                    if len(codes) < len(code):  # equal segments of one document count once
                        twice = np.flatnonzero(np.isin(code, codes[times > 1]))
                        each = {(c, data[s:e]) for c, s, e in zip(code[twice].tolist(), starts[twice].tolist(), stops[twice].tolist(), strict=True)}
                        twice, many = np.unique(np.array([c for c, _ in each], U), return_counts=True)
                        times[np.searchsorted(codes, twice)] = many
                    held.append((codes, where, name, times))
                    bytes_held += len(data)
                if bytes_held > 4 * part_bytes:
                    yield packed()
                    held, bytes_held = [], 0
        if held:
            yield packed()

    def shared_keys(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(x, np.uint32) for x in frame["keys"]])
        where = np.concatenate([np.frombuffer(x, np.uint32) for x in frame["parts"]])
        marks = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k) // 4) for x, k in zip(frame["shared"], frame["keys"], strict=True)])
        order = np.argsort(keys, kind="stable")
        keys, where, marks = keys[order], where[order], marks[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        many = np.diff(np.append(first, len(keys)))
        good = np.repeat((many > 1) | (np.maximum.reduceat(marks, first) > 0), many)
        again, more = (np.concatenate([np.frombuffer(x, np.uint32) for x in frame[c]]) for c in ("again", "more"))
        total = many.copy()
        np.add.at(total, np.searchsorted(keys[first], again), more)
        hot_keys = keys[first][total > hot_segments]
        pairs = np.unique(where[good].astype(U) << U(32) | keys[good].astype(U))
        low = (pairs & U(0xFFFFFFFF)).astype(np.uint32)
        hot = np.isin(low, hot_keys)
        out = [(p, key[0], *pack(low[s], np.packbits(hot[s]))) for p, s in runs_of((pairs >> U(32)).astype(np.int64))]
        return pd.DataFrame(out, columns=["part", "bucket", "keys", "hot"])

    def cut(key: tuple, texts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "part", "settled", "bytes", "lengths", "docs", "places", "rows"]
        if not len(texts) or not len(known):
            return pd.DataFrame([], columns=columns)
        wanted = np.concatenate([np.frombuffer(k, np.uint32).astype(U) | U(b) << U(32) for b, k in zip(known["bucket"], known["keys"], strict=True)])
        hot = np.concatenate([np.unpackbits(np.frombuffer(h, np.uint8), count=len(k) // 4) for h, k in zip(known["hot"], known["keys"], strict=True)])
        order = np.argsort(wanted)
        wanted, hot = wanted[order], hot[order]
        frame = _rows(texts)
        first: dict[bytes, int] = {}
        seen: dict[bytes, tuple[int, int, int]] = {}  # strings of hot minimizers: document, row, place in spread
        found, spread = [], []

        def apart(data: bytes, hashes: np.ndarray, bucket: int, name: int, row: int, start: int, stop: int) -> None:
            known_at = []
            for s in range(start, stop - SPAN + 1):
                string = data[s : s + SPAN]
                held = seen.get(string)
                if held is None or (held[0] == name and held[1] != row):
                    seen[string] = name, row, len(spread)
                    spread.append([int(hashes[s] >> U(32)) % parts, string, name, s, row])
                elif held[0] < name:
                    known_at.append(s)
                elif spread[held[2]][3] >= 0:
                    spread[held[2]][3] = ~spread[held[2]][3]
            for _, some in runs_of(np.array(known_at, np.int64) - np.arange(len(known_at))):
                found.append((bucket, True, data[known_at[some][0] : known_at[some][-1] + SPAN], name, known_at[some][0], row))

        for row, (name, text) in enumerate(zip(frame["id"], frame["text"], strict=True)):
            data = text.encode()
            least, starts, stops = segments(np.frombuffer(data, np.uint8))
            code = _code(least, parts)
            at = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)
            hit = wanted[at] == code
            warm = hot[at[hit]]
            hashes = string_hashes(np.frombuffer(data, np.uint8)) if warm.any() else None
            for c, s, e, w in zip((code[hit] >> U(32)).tolist(), starts[hit].tolist(), stops[hit].tolist(), warm.tolist(), strict=True):
                # Rows ascend by id: a segment seen before has a document that is smaller or the same.
                held = first.setdefault(data[s:e], name)
                if w and held >= name:
                    apart(data, hashes, c, name, row, s, e)
                else:
                    found.append((c, held < name, data[s:e], name, s, row))
        settled = [x for x in found if x[1]]
        found = sorted((x for x in found if not x[1]), key=lambda x: x[0])
        out = []
        for bucket, s in runs_of(np.array([x[0] for x in found], np.int64)):
            some = found[s]
            lengths, names, places, numbers = (np.array(v, np.int64) for v in zip(*((len(x[2]), *x[3:]) for x in some), strict=True))
            out.append((bucket, key[0], 0, b"".join(x[2] for x in some), *pack(lengths.astype(np.uint8), names, places, numbers.astype(np.uint32))))
        spread.sort(key=lambda x: x[0])
        for bucket, s in runs_of(np.array([x[0] for x in spread], np.int64)):
            some = spread[s]
            names, places, numbers = (np.array(v, np.int64) for v in zip(*(x[2:] for x in some), strict=True))
            lengths = np.full(len(some), SPAN, np.uint8)
            out.append((bucket, key[0], 2, b"".join(x[1] for x in some), *pack(lengths, names, places, numbers.astype(np.uint32))))
        if settled:
            lengths, names, places, numbers = (np.array(v, np.int64) for v in zip(*((len(x[2]), *x[3:]) for x in settled), strict=True))
            out.append((key[0] % parts, key[0], 1, b"", *pack(lengths.astype(np.uint8), names, places, numbers.astype(np.uint32))))
        return pd.DataFrame(out, columns=columns)

    keys = rows.mapInPandas(minimizers, "bucket int, keys binary, parts binary, shared binary, again binary, more binary").groupBy("bucket")
    keys = keys.applyInPandas(shared_keys, "part int, bucket int, keys binary, hot binary")
    cuts = rows.groupBy("part").cogroup(keys.groupBy("part")).applyInPandas(
        cut, "bucket int, part int, settled int, bytes binary, lengths binary, docs binary, places binary, rows binary"
    )
    return rows, cuts


def suffix_dedup(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): the texts as UTF-8 bytes without those that a smaller document has.

    A byte goes if it lies in a string of SPAN bytes that starts in a document with a smaller doc_id too, in the input as it
    is. ``removed`` are the maximal runs (start, end) that went, ``kept`` the bytes that are left, which may end within a
    character. A null text is empty; texts under SPAN bytes lose nothing. A null doc_id is greater than all others (but on a par with
    2^63 - 1). Rows that repeat a doc_id are not smaller than each other. Other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows, cuts = bucketed(docs, part_bytes)

    def resolve(frame: pd.DataFrame) -> pd.DataFrame:
        lengths, names, places, numbers = (
            [np.frombuffer(x, t).astype(np.int64) for x in frame[c]] for c, t in (("lengths", np.uint8), ("docs", np.int64), ("places", np.int64), ("rows", np.uint32))
        )
        where = [np.full(len(x), p) for x, p in zip(lengths, frame["part"], strict=True)]
        out = [np.empty((4, 0), np.int64)]
        open_ = np.flatnonzero(frame["settled"].to_numpy() == 0)
        for i in np.flatnonzero(frame["settled"].to_numpy() == 1):
            out.append(np.stack([where[i], numbers[i], places[i], places[i] + lengths[i]]))
        if len(open_):
            joined = (np.concatenate([x[i] for i in open_]) for x in (lengths, names, places, numbers, where))
            out.append(_found([frame["bytes"].iloc[i] for i in open_], *joined))
        single = np.flatnonzero(frame["settled"].to_numpy() == 2)
        if len(single):
            joined = (np.concatenate([x[i] for i in single]) for x in (names, places, numbers, where))
            out.append(_repeated([frame["bytes"].iloc[i] for i in single], *joined))
        spans = np.concatenate(out, axis=1)
        spans = spans[:, np.argsort(spans[0], kind="stable")]
        return pd.DataFrame([(p, *pack(*spans[1:, s])) for p, s in runs_of(spans[0])], columns=["part", "rows", "starts", "ends"])

    def remove(key: tuple, texts: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame([], columns=["doc_id", "none", "n_bytes", "removed", "kept"])
        numbers, starts, ends = (np.concatenate([np.empty(0, np.int64), *(np.frombuffer(x, np.int64) for x in spans[c])]) for c in ("rows", "starts", "ends"))
        order = np.argsort(numbers, kind="stable")
        mine = dict(runs_of(numbers[order]))
        frame = _rows(texts)
        out = []
        for row, (name, none, text) in enumerate(zip(frame["id"], frame["none"], frame["text"], strict=True)):
            data = text.encode()
            runs, kept = [], data
            if row in mine:
                some = order[mine[row]]
                s, e = starts[some], ends[some]
                if (s < 0).any():
                    more = _occurrences(np.frombuffer(data, np.uint8), ~s[s < 0])
                    s, e = np.concatenate([s[s >= 0], more]), np.concatenate([e[s >= 0], more + SPAN])
                level = np.zeros(len(data) + 1, np.int64)
                np.add.at(level, s, 1)
                np.add.at(level, e, -1)
                gone = np.cumsum(level[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                runs = [{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2], strict=True)]
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            out.append((name, none, len(data), runs, kept))
        return pd.DataFrame(out, columns=["doc_id", "none", "n_bytes", "removed", "kept"])

    spans = cuts.groupBy("bucket").applyInPandas(resolve, "part int, rows binary, starts binary, ends binary")
    result = rows.groupBy("part").cogroup(spans.groupBy("part")).applyInPandas(
        remove, "doc_id bigint, none boolean, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary"
    )
    return result.select(F.when(~F.col("none"), F.col("doc_id")).cast(kind).alias("doc_id"), "n_bytes", "removed", "kept")
