"""One query for each operator, over its whole table with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.llm import language_id as language
from snapfold.llm import license_scan as licenses
from snapfold.llm import period_runs as runs
from snapfold.llm.hard_negatives import hard_negatives
from snapfold.llm.lz_fingerprint import compare_neighbours
from snapfold.llm.mixing import measured, mix
from snapfold.llm.ngram_join import component_ids
from snapfold.llm.packing import pack
from snapfold.llm.quality import held_out_bucket, score, train
from snapfold.llm.secret_scan import BASE, joined, secret_scan
from snapfold.llm.sharding import shard
from snapfold.llm.suffix_dedup import suffix_dedup
from snapfold.llm.tables import Scratch
from snapfold.llm.topk import exact_topk
from snapfold.llm.vectors import usable

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """A public vocabulary that is installed on every machine; any other file's path can be given instead."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = _table(spark, sf_dir, "embeddings").where(finite).select(F.col("vec_id").cast("bigint").alias("id"), whole.alias("v"))
    return exact_topk(rows.where("id % 100 = 0"), rows)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_scan(_table(spark, sf_dir, "documents"))
    names = [r.kind for r in BASE]
    base = spans.withColumn("base", F.filter("spans", lambda s: s["kind"].isin(names)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return base.select("doc_id", *[count(k).alias(f"n_{k}") for k in names], F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda total, r: total + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(_table(spark, sf_dir, "documents"), Scratch(spark, "op5"))
    none = F.lit(None).cast("int")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none.alias("grown_shard"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = measured(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    rows = Scratch(spark, "op6").save(sized.select(F.col("row.doc_id").alias("doc_id"), "source", "group", "size", "key"))
    return mix(rows).select("doc_id", "size", "source_size", "target", "taken")


def op7_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare_neighbours(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return component_ids(_table(spark, sf_dir, "documents"), Scratch(spark, "op8"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, _table(spark, sf_dir, "labels")))
    return scored.select(F.col("_row.doc_id").alias("doc_id"), held_out_bucket("_row.doc_id").alias("held_out"), "score", "predicted")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), tokenizer_path(), Scratch(spark, "op10"))


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_table(spark, sf_dir, "documents"), change=runs.planted_repeats)
    best = found.withColumn("best", runs.most_repeated())
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.run_lines().cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("bigint")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    rows = _table(spark, sf_dir, "embeddings").where(usable("embedding")).select(F.col("vec_id").cast("bigint").alias("id"), label.alias("label"), whole.alias("v"))
    return hard_negatives(rows, rows.where("id % 100 = 0"), Scratch(spark, "op12"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, language.train(docs.where(language.bucket_of("doc_id") != 2)))
    return found.select("doc_id", F.coalesce(language.bucket_of("doc_id") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "far")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_exact_topk, op3_secret_scan, op4_suffix_dedup, op5_shard, op6_mix, op7_lz_fingerprint, op8_ngram_join, op9_quality, op10_pack, op11_period_runs,
        op12_hard_negatives, op13_language, pipeline,
    )
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLES = {
    "op1_license_scan": rf"""
        WITH templates(license_id, text) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in licenses.TEMPLATES.items())}),
        texts AS (SELECT license_id AS id, NULL AS doc, text FROM templates UNION ALL SELECT NULL, doc_id, text FROM documents),
        words AS (SELECT id, doc, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM texts),
        places AS (SELECT id, doc, w, unnest(range(len(w) - 4)) AS p FROM words WHERE len(w) >= 5),
        shingles AS (SELECT id, doc, p, array_to_string(w[p + 1 : p + 5], ' ') AS s FROM places),
        known AS (SELECT DISTINCT id AS license_id, s FROM shingles WHERE id IS NOT NULL),
        sized AS (SELECT license_id, count(*) AS n FROM known GROUP BY ALL),
        met AS (
            SELECT d.doc AS doc_id, k.license_id, n, d.p // n AS k, d.s FROM shingles d JOIN known k USING (s) JOIN sized USING (license_id) WHERE d.doc IS NOT NULL
        ),
        windows AS (SELECT doc_id, license_id, n, k, s FROM met UNION ALL SELECT doc_id, license_id, n, k - 1, s FROM met WHERE k > 0),
        counted AS (SELECT doc_id, license_id, n, k, count(DISTINCT s) AS c FROM windows GROUP BY ALL),
        best AS (SELECT doc_id, license_id, n, max(c) AS c, arg_min(k, (-c) * 100000000 + k) AS k FROM counted GROUP BY ALL)
        SELECT doc_id, license_id, CAST(n AS INTEGER) AS n_shingles, CAST(c AS INTEGER) AS matched, c / n AS containment,
            CAST(k * n AS INTEGER) AS window_start
        FROM best WHERE 4 * c >= 3 * n
    """,
    "op2_exact_topk": """
        WITH rows AS (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
            FROM rows q JOIN rows r ON q.vec_id <> r.vec_id AND q.vec_id % 100 = 0
        ),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS alike, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
            FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND a.vec_id % 100 = 0
        ),
        firsts AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scored WHERE alike),
        pairs AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM firsts WHERE place <= 5),
        fitting AS (
            SELECT anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
                CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
            FROM pairs JOIN scored s USING (anchor_id)
            WHERE NOT alike AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM fitting WHERE rank <= 10
    """,
}
