"""Every query against its SQL or a brute-force version, over the whole tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from oracle import compare, connect

import corpus_pipeline
from snapfold.llm import queries
from snapfold.llm.lz_fingerprint import fingerprint, likeness

SMALL = "/root/testdata/sf0.001"


def documents(folder):
    rows = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    return sorted(rows, key=lambda r: r["doc_id"])


def test_names():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES if n != "pipeline"]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None


def spans_of(text):
    found = []
    for kind, pattern, group, least in (
        (0, re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
        (1, re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
        (2, re.compile(r"[0-9a-f]+"), 0, 16),
    ):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found)


def test_secret_scan(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.op3_secret_scan(spark, sf_dir).collect()}
    names = ["assign", "access", "hex"]
    for d in documents(sf_dir):
        spans, row = spans_of(d["text"] or ""), rows.pop(d["doc_id"])
        said = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert row.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(row.spans.split(","))
    assert not rows


def without_repeats(docs):
    first = {}
    for d in docs:
        data = (d["text"] or "").encode()
        for i in range(len(data) - 49):
            first.setdefault(data[i : i + 50], d["doc_id"])
    for d in docs:
        data = (d["text"] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < d["doc_id"]:
                gone[i : i + 50] = True
        runs = int(np.count_nonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]])))
        kept = np.frombuffer(data, np.uint8)[~gone[:-1]].tobytes()
        yield d["doc_id"], len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def test_suffix_dedup(spark, sf_dir):
    assert sorted(map(tuple, queries.op4_suffix_dedup(spark, sf_dir).collect())) == list(without_repeats(documents(sf_dir)))


def test_shard(spark, sf_dir):
    docs = documents(sf_dir)
    rows = queries.op5_shard(spark, sf_dir).collect()
    texts = {d["doc_id"]: (d["text"] or "").encode() for d in docs}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    shards, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]), "rows", None)
        shards[r.shard].append(r.slot)
        groups[texts[r.doc_id]].add(r.shard)
    sizes = [len(shards[s]) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert sum(len(g) > 1 for g in groups.values()) == 0


def expected_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weights[s] for s in rest))
        over = [s for s in rest if level * weights[s] > 2 * sizes[s]]
        if not over:
            return fixed | {s: level * weights[s] for s in rest}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mix(spark, sf_dir):
    docs = documents(sf_dir)
    words = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")) for d in docs}
    sizes = Counter()
    for d in docs:
        sizes[d["source"]] += words[d["doc_id"]]
    targets, taken = expected_targets(sizes), Counter()
    source = {d["doc_id"]: d["source"] for d in docs}
    for r in queries.op6_mix(spark, sf_dir).collect():
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (words[r.doc_id], sizes[s]) and math.isclose(r.target, targets[s])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)


def test_lz_fingerprint(spark, sf_dir):
    docs = documents(sf_dir)
    rows = {r.doc_id: r for r in queries.op7_lz_fingerprint(spark, sf_dir).collect()}
    better = 0
    for d, following in zip(docs, docs[1:] + docs[:1], strict=True):
        text, half = d["text"] or "", len(d["text"] or "") // 2
        edited, row = text[: len(text) - half] + (following["text"] or "")[:half], rows.pop(d["doc_id"])
        marks = [fingerprint(t) for t in (text, edited, following["text"] or "")]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (marks[0], marks[1])
        assert (row.near_edited, row.near_next) == (likeness(marks[0], marks[1]), likeness(marks[0], marks[2]))
        better += row.near_edited > row.near_next or text == (following["text"] or "")
    assert not rows and better > 0.9 * len(docs)


def shingles(text):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(docs):
    sets = {d["doc_id"]: shingles(d["text"]) for d in docs}
    holders, parent = defaultdict(list), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        met = Counter(j for x in s for j in holders[x])
        for j, common in met.items():
            if 100 * common >= 75 * (len(s) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in s:
            holders[x].append(i)
    return sorted((i, len(s), root(i)) for i, s in sets.items())


def test_ngram_join(spark, sf_dir):
    rows = queries.op8_ngram_join(spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == brute_components(documents(sf_dir))


def test_quality(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()}
    rows = queries.op9_quality(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == [d["doc_id"] for d in documents(sf_dir)]
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held) > 0


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    found, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        pieces = sorted(found.pop(doc_id))
        assert sum(p[2] for p in pieces) == len(ids) and all(p[2] == 1024 for p in pieces[1:])
        assert [p[0] for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // 1024)
        for _, s, n, crc in pieces:
            assert zlib.crc32(ids[s : s + n].tobytes()) == crc
    assert not found
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return len(sequences), sum(r.length for r in rows)


def test_pack(spark, sf_dir):
    used, tokens = check_packing(queries.op10_pack(spark, sf_dir).collect(), {d["doc_id"]: d["text"] for d in documents(sf_dir)})
    assert used <= math.ceil(tokens / 1024) * 1.002 + 1


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SMALL)
        rows, old = after.collect(), {r.doc_id: r for r in before.collect()}
        if name == "quality classifier":
            score = {r.doc_id: r.predicted for r in queries.op9_quality(spark, SMALL).collect()}
            assert {r.doc_id for r in rows} == {i for i, p in score.items() if p}
        if name == "n-gram jaccard join":
            assert sorted(r.doc_id for r in rows) == sorted({c for _, _, c in brute_components([r.asDict() for r in old.values()])})
        if name == "secret scans":
            assert {r.doc_id for r in rows} == set(old) and not any(spans_of(r.text) for r in rows)
            assert all(r.text == old[r.doc_id].text for r in rows if not spans_of(old[r.doc_id].text))
        if name == "mixing sources to target weights":
            assert all(r.text == old[r.doc_id].text or shingles(r.text) for r in rows)
            size = Counter()
            for r in old.values():
                size[r.source] += len(r.text.split())
            taken = Counter()
            for r in rows:
                taken[r.source] += len(r.text.split())
            assert all(abs(taken[s] - t) <= 1 for s, t in expected_targets(size).items())
        if name == "best-fit packing":
            assert sum(r.start == 0 for r in rows) == before.count()
        else:
            assert after.columns == names
            before = spark.createDataFrame(rows, after.schema)
    assert corpus_pipeline.run(spark, SMALL).count() == len(rows)
