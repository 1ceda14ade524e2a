"""A training corpus from ``documents``: classify, deduplicate, decontaminate, pack.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir), where ``docs``
has the columns of ``documents``, and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``; a stage that rewrites texts sets ``n_chars``
anew.  Rows that share an id stay or go together; rows with a null id can't
be told apart and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import decontaminate, kneser_ney, line_dedup, near_dup, packing
from lectern.llm.common import Scratch, table
from lectern.llm.queries import vocabulary

SHINGLE_WORDS, SIMILARITY = 5, 80


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the ids in column ``doc`` of ``rejected``, which is never broadcast: it grows with the documents."""
    ids = rejected.where("doc is not null").select("doc").distinct().hint("merge")
    return docs.join(ids, docs["doc_id"] == ids["doc"], "left_anti").select(*docs.columns)


def _as_documents(rewritten: DataFrame, docs: DataFrame) -> DataFrame:
    out = rewritten.select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the Kneser-Ney model of the trusted documents rejects."""
    judged = kneser_ney.classify(docs, table(spark, sf_dir, "labels"))
    return _without(docs, judged.where(~F.col("kept")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that at least five documents share stay in the last of them only."""
    return _as_documents(line_dedup.dedup_lines(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    groups = near_dup.near_duplicates(docs, n_words=SHINGLE_WORDS, percent=SIMILARITY)
    return _without(docs, groups.where(~F.col("kept")))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of the benchmark out of the texts."""
    scanned = decontaminate.scan_documents(docs, table(spark, sf_dir, "benchmark"), remove_spans=True)
    return _as_documents(scanned, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids: a row per piece of a document, with its ids."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("decontamination", remove_benchmark),
    ("packing", pack_sequences),
]

#: The classifier and the tokenizer have no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
