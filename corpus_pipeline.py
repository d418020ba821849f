"""A corpus pipeline of five of the operators: each stage works on what the one before it kept.

    quality classifier -> n-gram Jaccard join -> secret scan -> mixing to target weights -> best-fit packing

Every stage is written as Parquet to the shared folder and read again, so that a lost executor repeats part of one stage
at most. The first four return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.llm.mixing import mixed
from snapfold.llm.ngram_join import one_of_each
from snapfold.llm.packing import pack
from snapfold.llm.quality import score, train
from snapfold.llm.queries import tokenizer_path
from snapfold.llm.secret_scan import redact
from snapfold.llm.tables import Scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects.

    Every row is scored on its own, repeated rows alike; a null text is empty, and has a score too. Other columns pass through, whatever their
    names. Without labels every score is 0.5, and all rows stay; no rows give no rows.
    """
    scored = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.where("predicted = 1").select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that of the smallest doc_id, null ids last.

    Of equal rows one stays. Documents without words, null texts among them, have no copies and all stay. Other columns pass through.
    """
    return one_of_each(docs, Scratch(spark, "pipeline"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the scan finds masked in their texts, and ``n_chars`` set to the new length.

    Null texts stay null; rows are masked one by one, so equal rows stay equal. Other columns pass through.
    """
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document; at most one text of a source is cut to its first words.

    A null source is a source; texts without words are taken in whole epochs only; equal rows are taken each on its own.
    """
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    A null or empty text is one piece of the end token; repeated rows are packed each; other columns are left behind.
    """
    return pack(docs, tokenizer_path(), Scratch(spark, "pipeline"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", drop_near_copies),
    ("secret scans", hide_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
