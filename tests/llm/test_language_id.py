"""Language identification: features against plain counts, held-out accuracy, rejection, edges."""

import zlib
from collections import Counter

import numpy as np
import pytest
from test_queries import documents

from snapfold.llm import language_id, queries
from snapfold.llm.buffers import mix
from snapfold.llm.language_id import BUCKETS, Model, bucket_of, cluster, features, identify, rejecting, train


def plain_grams(text):
    found, lower = Counter(), f" {(text or '').lower()} "
    lower = "".join(c if c.isalpha() else " " for c in lower)
    for i, c in enumerate(lower):
        if c != " ":
            grams = [c, c + lower[i + 1], lower[i - 1 : i + 2]] + ([" " + c] if lower[i - 1] == " " else [])
            found.update(grams)
    return found


def bucket(gram):
    code = 0
    for c in gram:
        code = code << 21 | (1 if c == " " else ord(c) + 1)
    return int(mix(np.array([code], np.uint64))[0] % np.uint64(BUCKETS))


def test_features(monkeypatch):
    texts = ["Ein Wort, zwei", None, "", "123 -- !", "a", "Ünïcode 中文字 über", "x " * 40, "langes " * 200, "ohneleerzeichen" * 90]
    for chunk in (1 << 18, 700):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        for text, (buckets, counts) in zip(texts, features(texts), strict=True):
            want = Counter()
            for g, n in plain_grams(text).items():
                want[bucket(g)] += n
            got = dict(zip(buckets.tolist(), counts.tolist(), strict=True))
            if len(text or "") <= chunk or " " in text:
                assert got == want, text
            else:  # without a space the text is cut all the same, and a cut loses the grams across it
                assert set(want) <= set(got) and abs(sum(got.values()) - sum(want.values())) < 10


def test_held_out_accuracy(spark, sf_dir):
    docs = {d["doc_id"]: d for d in documents(sf_dir)}
    rows = queries.op13_language(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    held = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred in {"en", "de", "fr", "es"} or (r.lang_pred == "und" and not any(c.isalpha() for c in docs[r.doc_id]["text"] or ""))
        held += r.held_out
    right = sum(r.held_out and r.lang_pred == docs[r.doc_id]["lang"] for r in rows)
    assert held > 200 and right >= 0.97 * held, (right, held)
    assert sum(r.far for r in rows) < 0.05 * len(rows)


def test_what_is_learned_from(spark, sf_dir):
    """Labels of rows that are held out, and columns other than the text, change nothing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 300").select("doc_id", "text", "lang")
    changed = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'xx', lang) as lang")
    found = [sorted(map(tuple, identify(d, train(d.where(bucket_of("doc_id") != 2))).collect())) for d in (docs, changed)]
    assert found[0] == found[1]


def test_clusters():
    rng = np.random.default_rng(0)
    centres = rng.random((3, 40)) ** 4
    rows = centres[rng.integers(0, 3, 300)] + rng.random((300, 40)) * 0.05
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    found = cluster(rows, 3)
    assert ((found @ (centres / np.linalg.norm(centres, axis=1)[:, None]).T).max(axis=0) > 0.98).all()
    assert len(cluster(rows[:1], 4)) == 1 and len(cluster(np.repeat(rows[:1], 9, axis=0), 4)) == 1


def test_edges(spark):
    schema = "doc_id bigint, text string, lang string, far string, score string, key int, lang_pred string"
    rows = [(i, f"der und die das ist nicht {i}" if i % 2 else f"the and of that is not {i}", "de" if i % 2 else "en") for i in range(80)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 34", "en"), (None, "the cat and the dog", None), (103, "und das ist die", None), (103, "und das ist die", None), (104, "the of and " * 100_000, "en"), (105, "中文字", None), (106, "x", "")]
    docs = spark.createDataFrame([(*r, "f", "s", 1, "l") for r in rows], schema)
    model = train(docs)
    got = rejecting(identify(docs, model)).collect()
    near = {r.doc_id: r for r in identify(docs, model).collect()}
    assert len(got) == len(rows) and set(model.languages) == {"", "de", "en"}
    assert [(near[i].lang_pred, near[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert near[None].lang_pred == "en" and near[103].lang_pred == "de" and near[104].lang_pred == "en" and near[103].score > 0.5
    assert near[105].far and near[105].lang_pred != "und" and {r.doc_id: r.lang_pred for r in got}[105] == "und" and not near[3].far
    nothing = docs.where("doc_id < 0")
    assert identify(nothing, model).collect() == [] and train(nothing).languages == []
    assert {(r.lang_pred, r.score) for r in identify(docs, train(nothing)).collect()} == {("und", 0.0)}
    assert len(train(docs, per_language=5, clusters=2).languages) <= 5
    with pytest.raises(ValueError):
        train(docs, model_bytes=4 * BUCKETS * 4 * 2)
    assert isinstance(model, Model) and model.centroids.shape == (BUCKETS, len(model.languages))
