"""Inverted-index tables built with aggregations.

Tables (all plain DataFrames, persisted by :mod:`lectern.sources.index_store`):

* ``postings(term, doc_id, tf, dl)``: one row per (term, document).  The
  document length is carried on every posting so that scoring needs no join
  with a per-document table at query time.
* ``doc_stats(doc_id, dl)``: terms per document after the stop filter.
* ``term_stats(term, df, cf)``: document and collection frequency.
* ``corpus(num_docs, docs_with_terms, sum_dl, avg_dl, max_doc_id)``: one row.

The only wide steps are one shuffle of the texts by document, after which
term counts and document lengths are aggregated in place, and the roll-ups of
the postings by term.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .analysis import Analyzer, analyze, stem_vocabulary, stemmed
from .lookup import column, dealt_by_bytes, dealt_by_rows, settled, slice_of, sliced, slices_for, tasks_for, written


def term_frequencies(terms: DataFrame) -> DataFrame:
    """(doc_id, term, tf) from term rows."""
    return terms.groupBy("doc_id", "term").agg(F.count(F.lit(1)).cast("int").alias("tf"))


def document_lengths(postings: DataFrame) -> DataFrame:
    """(doc_id, dl): number of indexed terms of each document with any."""
    return postings.groupBy("doc_id").agg(F.sum("tf").cast("long").alias("dl"))


def document_frequencies(postings: DataFrame) -> DataFrame:
    """(term, df, cf)."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("cf"))


def corpus_stats(docs: DataFrame, doc_stats: DataFrame) -> DataFrame:
    """One row: all documents (empty ones too), documents with terms, total and
    average length.  Both sides are global aggregates, so the cross join is
    one row by one row."""
    left = docs.agg(F.count(F.lit(1)).alias("num_docs"), F.max("doc_id").alias("max_doc_id"))
    right = doc_stats.agg(F.count(F.lit(1)).alias("docs_with_terms"),
                          F.coalesce(F.sum("dl"), F.lit(0)).cast("long").alias("sum_dl"))
    return left.crossJoin(right).select(
        "num_docs", "docs_with_terms", "sum_dl",
        F.when(F.col("docs_with_terms") > 0, F.col("sum_dl") / F.col("docs_with_terms")).alias("avg_dl"),
        "max_doc_id")


@dataclass
class Index:
    """The index tables; a stored one (:mod:`lectern.sources.index_store`) also
    has ``store``, whose scans open the folders of given keys only, and its
    ``totals``.  One that is being built gives its postings in slices of the
    documents too (``parts``); tables that it rests on until it is stored are
    in the folders ``scratch``."""

    docs: DataFrame        # doc_id, path, file_name, content
    postings: DataFrame    # term, doc_id, tf, dl
    doc_stats: DataFrame   # doc_id, dl
    term_stats: DataFrame  # term, df, cf
    corpus: DataFrame      # one row
    analyzer: Analyzer
    store: object | None = None
    totals: dict | None = None
    parts: Callable[[], list[DataFrame]] | None = None
    scratch: tuple[str, ...] = ()

    def resolve(self, terms: DataFrame) -> DataFrame:
        """Rows with a ``term`` that the index has, with its ``df``."""
        small, rows = settled(terms) if self.store else (terms, None)
        if rows is None:
            return self.term_stats.select("term", "df").join(terms, "term")
        stats = self.store.merged(self.store.rows("terms", column(rows, "term")))
        return settled(stats.join(F.broadcast(small), "term"))[0]

    def lookup(self, terms: DataFrame, narrow: Column | None = None, matches: int | None = None) -> DataFrame:
        """The postings joined to rows with a ``term``.

        Rows that are few go to the postings, which aren't shuffled by term for
        them.  For others ``narrow`` tells which postings can match at all.
        With their number ``matches`` given the rows come dealt by document, to
        as many tasks as it asks for; those of a frequent term that many rows
        have are dealt out before they multiply."""
        small, rows = settled(terms) if self.store else (terms, None)
        if rows is None:
            met = (self.postings if narrow is None else self.postings.where(narrow)).join(terms, "term")
            return met if matches is None else dealt_by_rows(met, matches, "doc_id")
        keys = column(rows, "term")
        held = self.store.rows("postings", keys)
        if matches is not None:
            wanted = small.sparkSession.createDataFrame(pa.table({"term": pa.array(keys, pa.string())}))
            held = dealt_by_rows(held.join(F.broadcast(wanted), "term", "left_semi"), matches, "doc_id")
        return held.join(F.broadcast(small), "term")

    def documents(self, ids: DataFrame) -> DataFrame:
        """The documents whose ``doc_id`` is in a table of ids, each once."""
        small, rows = settled(ids.select("doc_id").distinct()) if self.store else (ids, None)
        if rows is None:
            return self.docs.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
        return self.store.rows("docs", column(rows, "doc_id")).join(F.broadcast(small), "doc_id", "left_semi")

    def names(self, field: str) -> DataFrame:
        """(field, name, doc_id) of all documents for a name field."""
        return (self.store.table("names") if self.store else names_of(self.docs)).where(F.col("field") == field)

    def with_totals(self, rows: DataFrame) -> DataFrame:
        """``rows`` with n_docs (documents with terms), avgdl and num_docs."""
        if self.totals is None:
            side = self.corpus.select(F.col("docs_with_terms").alias("n_docs"), F.col("avg_dl").alias("avgdl"), "num_docs")
            return rows.crossJoin(side)  # one row
        t = self.totals
        return rows.select("*", F.lit(t["docs_with_terms"]).cast("long").alias("n_docs"), F.lit(t["avg_dl"]).cast("double").alias("avgdl"),
                           F.lit(t["num_docs"]).cast("long").alias("num_docs"))


def names_of(docs: DataFrame) -> DataFrame:
    """(field, name, doc_id): file names and paths of all documents."""
    pairs = F.array(F.struct(F.lit("fileName").alias("field"), F.col("file_name").alias("name")),
                    F.struct(F.lit("path").alias("field"), F.col("path").alias("name")))
    return docs.select("doc_id", F.inline(pairs)).where(F.col("name").isNotNull()).select("field", "name", "doc_id")


def totals_row(spark, totals: dict) -> DataFrame:
    """The corpus table of known totals."""
    kinds = {"avg_dl": pa.float64()}
    names = ["num_docs", "docs_with_terms", "sum_dl", "avg_dl", "max_doc_id"]
    return spark.createDataFrame(pa.table({n: pa.array([totals[n]], kinds.get(n, pa.int64())) for n in names}))


def build_index(docs: DataFrame, analyzer: Analyzer) -> Index:
    """Analyse every document and derive the index tables (lazy).

    With stemming the counts are written first; their distinct terms are then
    stemmed once and joined back, and the texts are read and cut once.

    The postings also come in slices of the documents, for a writer that
    shuffles them one slice after the other."""
    slices, texts = slices_for(docs), docs.select("doc_id", "content")
    if not analyzer.stem:
        index = from_postings(docs, _with_lengths(_counts(texts, analyzer)), analyzer)
        return replace(index, parts=lambda: [_with_lengths(_counts(some, analyzer, 1 / slices)) for some in sliced(texts, "doc_id", slices)])
    counts = _counts(texts, replace(analyzer, stem=False))
    if slices > 1:  # sorted, so that a slice reads its own pages
        counts = counts.withColumn("slice", slice_of("doc_id", slices)).sortWithinPartitions("slice")
    counts = written(counts, "counts")
    stems = written(stem_vocabulary(dealt_by_bytes(counts.select("term").distinct(), "term")), "stems")
    own = [counts] if slices == 1 else [counts.where(F.col("slice") == s) for s in range(slices)]
    index = from_postings(docs, _stemmed_postings(counts, stems), analyzer)
    return replace(index, parts=lambda: [_stemmed_postings(some, stems, 1 / slices) for some in own], scratch=(counts.written_to, stems.written_to))


def _counts(texts: DataFrame, analyzer: Analyzer, share: float = 1) -> DataFrame:
    """(doc_id, term, tf) of the texts (doc_id, content)."""
    # dealt by document once, the counts and the lengths of plain terms need no further shuffle
    return term_frequencies(analyze(dealt_by_bytes(texts, "doc_id", share=share), analyzer, positions=False))


def _with_lengths(tf: DataFrame) -> DataFrame:
    """The postings of term counts: the length is a window sum over each document's
    (bounded by one document), so one tokenisation feeds every table."""
    return tf.withColumn("dl", F.sum("tf").over(Window.partitionBy("doc_id")).cast("long")) \
        .select("term", "doc_id", "tf", "dl")


#: A byte of the written counts makes so many times the rows that one of a text does.
COUNT_SHARE = 2


def _stemmed_postings(counts: DataFrame, stems: DataFrame, share: float = 1) -> DataFrame:
    """The postings of written counts, or a ``share`` of them, once their terms are
    stemmed: met by term, then merged by document, in tasks that follow the size of the counts."""
    rows, tasks = counts.select("doc_id", "term", "tf"), tasks_for(counts, share * COUNT_SHARE)
    met = stemmed(rows.repartition(tasks, "term"), stems.repartition(tasks, "term"))
    merged = met.repartition(tasks, "doc_id").groupBy("doc_id", "term").agg(F.sum("tf").cast("int").alias("tf"))
    return _with_lengths(merged)


def from_postings(docs: DataFrame, postings: DataFrame, analyzer: Analyzer) -> Index:
    """Index whose statistics are derived from a postings table."""
    doc_stats = postings.groupBy("doc_id").agg(F.first("dl").alias("dl"))
    term_stats = document_frequencies(postings)
    corpus = corpus_stats(docs, doc_stats)
    return Index(docs=docs, postings=postings, doc_stats=doc_stats, term_stats=term_stats,
                 corpus=corpus, analyzer=analyzer)
