"""Periodic runs of words: recursive frequency splitting, then a scan by lags of the segments that are left.

A run of period q is a stretch whose words q apart are identical, of at least ``repeats`` periods and ``least`` words, that no
neighbouring word extends. Each of its words occurs at least ``repeats`` times in it. So a word that occurs less often within
the present segment belongs to no run, and splits it; the parts are counted again, until no word is too rare. Most texts are
gone by then. Segments left are scanned by lags: grams of 1, 2, 4, ... words are numbered by pairs of shorter ones, and
for a lag g those of k words, k/2 < g <= k, are looked at. Within a run of smallest period g such a gram recurs after exactly g
words and not before, so a run is a stretch of places whose gram comes again g words on, and only the lags at which
some gram does are ever looked at. A text of n words costs O(n log n) a round, whatever its periods.

Texts are independent, so there is no shuffle; a task holds some chunks of texts, or one long text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.tables import map_texts

#: Words that a run has at least, and periods.
LEAST, REPEATS = 24, 3
#: Words that are looked at together, from many texts; a longer text is looked at alone.
CHUNK_WORDS = 1 << 19

#: The places, from an id and a number of words, from which the words of a changed text come; None leaves the text as it is.
Rearranged = Callable[[int | None, int], np.ndarray | None]


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _numbered(place: np.ndarray, of: np.ndarray) -> np.ndarray:
    """A number for each stretch of consecutive places with equal ``of``."""
    if not len(place):
        return place
    return np.cumsum(np.concatenate([[0], (place[1:] != place[:-1] + 1) | (of[1:] != of[:-1])]))


def surviving(word: np.ndarray, text: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """(place, segment) of the words that frequency splitting leaves; ``text`` says which text a word is in."""
    place, segment = np.arange(len(word)), _numbered(np.arange(len(word)), text)
    base, stable = int(word.max(initial=0)) + 1, []
    while len(place):
        place, segment = (x[np.bincount(segment)[segment] >= least] for x in (place, segment))
        _, which, count = np.unique(segment * base + word[place], return_inverse=True, return_counts=True)
        rare = count[which] < repeats
        changing = np.bincount(segment, rare)[segment] > 0 if len(segment) else rare
        stable.append(place[~changing])
        here = changing & ~rare
        place, segment = place[here], _numbered(place[here], segment[here])
    kept = np.sort(np.concatenate(stable)) if stable else place
    return kept, _numbered(kept, text[kept])


def scanned(word: np.ndarray, segment: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs within segments."""
    size = np.bincount(segment)
    at, k, found = np.arange(len(word)), 1, []
    _, gram = np.unique(segment * (int(word.max(initial=0)) + 1) + word, return_inverse=True)
    while len(at):
        order = np.argsort(gram, kind="stable")
        a, g = at[order], gram[order]
        gap = a[1:] - a[:-1]
        near = (g[1:] == g[:-1]) & (2 * gap > k) & (gap <= k)
        i, lag = a[:-1][near], gap[near]
        order = np.lexsort((i, lag))
        i, lag = i[order], lag[order]
        first = _first_of(i - np.arange(len(i)), lag)
        last = np.append(first[1:], len(i))[: len(first)] - 1
        length = i[last] - i[first] + lag[first] + k
        good = length >= np.maximum(least, repeats * lag[first])
        found.append((i[first][good], length[good], lag[first][good]))
        # Grams of twice the length, where both halves recur and the segment has room for a run of a lag beyond k.
        of = np.full(len(word), -1)
        of[at] = gram
        ahead = np.minimum(at + k, len(word) - 1)
        both = (at + k < len(word)) & (of[ahead] >= 0) & (segment[ahead] == segment[at]) & (size[segment[at]] >= repeats * (k + 1))
        at, code = at[both], gram[both] * (int(gram.max(initial=0)) + 1) + of[ahead[both]]
        _, gram, count = np.unique(code, return_inverse=True, return_counts=True)
        again = count[gram] > 1
        at, gram, k = at[again], gram[again], 2 * k
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (at, at, at)


def runs_of_words(texts: list[np.ndarray], least: int = LEAST, repeats: int = REPEATS) -> list[np.ndarray]:
    """The runs (start, length, period) of each text by start, then period; a text is an array of numbers of words."""
    if repeats < 3 or least < 1:
        raise ValueError("a run has at least three periods and one word")
    ends = np.cumsum([0, *map(len, texts)])
    word = np.concatenate([np.empty(0, np.int64), *texts])
    text = np.repeat(np.arange(len(texts)), np.diff(ends))
    place, segment = surviving(word, text, least, repeats)
    start, length, period = scanned(word[place], segment, least, repeats)
    start = place[start]
    of = text[start]
    order = np.lexsort((period, start))
    rows = np.stack([start - ends[of], length, period], axis=1)[order]
    return np.split(rows, np.searchsorted(of[order], np.arange(1, len(texts)))) if texts else []


def without_repeats(n: int, runs: np.ndarray) -> np.ndarray:
    """The places of ``n`` words that stay if each run keeps its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.flatnonzero(np.cumsum(edges)[:n] == 0)


def _chunks(texts: list[str | None], ids: list, change: Rearranged | None) -> Iterator[tuple[list[list[bytes]], list[np.ndarray]]]:
    """The words of some texts, and the numbers of their words, equal words having equal numbers."""
    words, numbers, known, size = [], [], {}, 0
    for text, doc_id in zip(texts, ids, strict=True):
        own = (text or "").encode().split()  # at \x20 and \x09-\x0D, as bytes do
        places = change(doc_id, len(own)) if change else None
        if places is not None:
            own = [own[i] for i in places.tolist()]
        words.append(own)
        numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in own), np.int64, len(own)))
        size += len(own)
        if size >= CHUNK_WORDS:
            yield words, numbers
            words, numbers, known, size = [], [], {}, 0
    if words:
        yield words, numbers


def periodic_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS, change: Rearranged | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every whole text; ``runs`` is an array of (start, length, period).

    Words are runs of ``[^\\x20\\x09-\\x0D]``, told apart by their bytes and numbered from 0. ``runs`` are sorted by start, then
    period; ``collapsed`` is the text's words without those that any run holds after its first period, joined by a space. ``change``
    may rearrange a text's words first, by its id (a null id is None to it). A null text is empty and has no runs; repeated rows
    are rows of their own; columns other than doc_id and text are not looked at, whatever their names; no rows give no rows.
    """

    def looked(texts: list[str | None], ids: list) -> list:
        n, runs, collapsed = [], [], []
        for words, numbers in _chunks(texts, ids, change):
            for own, found in zip(words, runs_of_words(numbers, least, repeats), strict=True):
                n.append(len(own))
                runs.append([{"start": s, "length": m, "period": q} for s, m, q in found.tolist()])
                collapsed.append((b" ".join([own[i] for i in without_repeats(len(own), found).tolist()] if len(found) else own)).decode())
        return [n, runs, collapsed]

    added = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return map_texts(docs.select("doc_id", "text"), looked, added, given=("doc_id",))


def most_repeated(runs: str = "runs") -> Column:
    """The run of the greatest exact length / period, of equal ones the first; null without runs."""
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.reduce(runs, none, lambda best, run: F.when(best.isNull() | better(best, run), run).otherwise(best))


def run_lines(runs: str = "runs") -> Column:
    """Each run's ``start,length,period`` and a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def planted_repeats(doc_id: int | None, n: int) -> np.ndarray | None:
    """From some place on, a tenth of the texts repeat their words from there with one period; by the id's CRC-32."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return places
