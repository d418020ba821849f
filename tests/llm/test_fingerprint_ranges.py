"""Fingerprints over one and many ranges of ids, against a plain parse and plain minima."""

import numpy as np
import pytest
import xxhash

from snapfold.llm.lz_fingerprint import HASHES, compare_neighbours, half_replaced

M = (1 << 64) - 1


def plain_mix(x):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> 33)) * factor & M
    return x ^ (x >> 33)


def plain_phrases(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    symbols = [s for w in words for s in ([w] if len(w) <= 16 else w)]
    book, start = set(), 0
    while start < len(symbols):
        end = start + 1
        while " ".join(symbols[start:end]) in book and end < len(symbols):
            end += 1
        book.add(" ".join(symbols[start:end]))
        start = end
    return book


def plain_signature(text):
    hashes = [xxhash.xxh64_intdigest(p.encode()) for p in plain_phrases(text)]
    if not hashes:
        return ""
    out = ""
    for seed in range(1, HASHES + 1):
        least = M
        for h in hashes:
            x = (h ^ plain_mix(seed)) * 0xFF51AFD7ED558CCD & M
            least = min(least, (x ^ (x >> 32)) * 0xC4CEB9FE1A85EC53 & M)
        out += f"{plain_mix(least) >> 48:04x}"
    return out


def near(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, 4 * HASHES, 4)) / HASHES


@pytest.fixture(scope="module")
def rows():
    order = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    found = [(int(i) * 7, " ".join(order.choice(words, int(order.integers(0, 60))))) for i in order.permutation(600)]
    found += [(10_000, "あいうえおかきくけこさしすせそたちつてとなにぬねの" * 3), (10_001, None), (10_002, ""), (10_003, "a" * 70), (None, "last"), (None, "of all")]
    return found


@pytest.mark.parametrize("range_rows", [10**6, 303, 86, 12])
def test_ranges(spark, rows, range_rows):
    got = {(r.doc_id, r.text): r for r in compare_neighbours(spark.createDataFrame(rows, "doc_id bigint, text string"), range_rows=range_rows).collect()}
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert len(got) == len(rows)
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        row, edited = got[i, text], half_replaced(text, following)
        marks = [plain_signature(t) for t in (text, edited, following)]
        assert (row.edited, row.fingerprint, row.edited_fingerprint) == (edited, marks[0], marks[1]), i
        assert (row.near_edited, row.near_next) == (near(marks[0], marks[1]), near(marks[0], marks[2]))


def test_many_more_ranges_than_rows_in_some(spark):
    """Ids in clumps and a table of 9,000 rows, which the default cuts into two ranges."""
    clumps = spark.range(400).selectExpr("if(id < 350, 5, id) as doc_id", "concat('text ', id) as text")
    assert compare_neighbours(clumps, range_rows=5).count() == 400
    wide = spark.range(9000).selectExpr("id as doc_id", "concat('some text ', id) as text")
    rows = compare_neighbours(wide).selectExpr("count(*) n", "count(distinct doc_id) d", "sum(cast(edited = concat(substr(text, 1, length(text) - length(text) div 2), substr(concat('some text ', (doc_id + 1) % 9000), 1, length(text) div 2)) as int)) good").first()
    assert (rows.n, rows.d, rows.good) == (9000, 9000, 9000)
