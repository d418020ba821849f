"""Numpy helpers over whole texts: hashes of words, shingles and byte windows.

Words are the runs of ``[^\\x20\\x09-\\x0D]``, with A-Z lower-cased on request. All hashes are 64 bits, follow from the
bytes alone and are the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
#: Bytes hashed at a time; a longer text is a chunk of its own.
CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on every input bit."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U) * U(_ODD)) | U(1)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse, kept as long as the longest chunk asked for them."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        tables = [np.full(size, base, U) for base in (_ODD, _INVERSE)]
        for table in tables:
            table[0] = 1
        _powers[:] = [np.cumprod(table, dtype=U) for table in tables]
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums H with (H[j] - H[i]) * inverse ** i the same for equal bytes [i, j)."""
    total = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * powers(len(data))[0][: len(data)], out=total[1:])
    return total


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, encoded texts) in pieces of about CHUNK bytes; a null is empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append((text or "").encode())
        size += len(held[-1]) + 1
        if size >= CHUNK:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def word_hashes(encoded: list[bytes], lower: bool = True) -> list[np.ndarray]:
    """The hashes of each text's words in order."""
    data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    lengths = np.array([len(x) + 1 for x in encoded])
    ends_of_text = np.cumsum(lengths)
    if lower:
        data = _LOWER[data]
    white = _WHITE[data]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    total = prefix_hash(data)
    hashes = mix((total[ends] - total[starts]) * powers(len(data))[1][starts] + (ends - starts).astype(U))
    return np.split(hashes, np.searchsorted(starts, ends_of_text[:-1]))


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of ``width`` words in a row; of all words as one where there are fewer."""
    if not len(words):
        return np.empty(0, U)
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, U)
    for j in range(width):
        out = mix(out * U(_ODD) + words[j : j + n])
    return np.unique(out)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    for _, encoded in chunks(texts):
        for words in word_hashes(encoded):
            yield shingle_set(words)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row."""
    n, span = len(x) - width + 1, 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n]) if span < width else x[:n]


def pack(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(x).tobytes() for x in arrays]


def runs_of(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of equal keys next to each other."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist() if len(keys) else []
    for s, e in zip(first, [*first[1:], len(keys)], strict=False):
        yield int(keys[s]), slice(s, e)
