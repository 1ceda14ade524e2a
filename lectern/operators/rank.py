"""Ranking and score reports: BM25 per document, top-k, display order,
per-word IDF and the TF / TF-IDF report of each hit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import idf_log10, round_score, tf_weight
from ..functions.text import MAX_HITS
from ..functions.querysyntax import query_is_valid
from ..functions.text import token_array
from .analysis import Analyzer, analyze_tokens
from .index import Index
from .lookup import column, settled, written
from .match import (checked, clause_counts, document_matches, effective_clauses, free_text_clauses, held, match_clauses, query_status, query_words,
                    search_clauses, settled_terms, word_terms)


def bm25_scores(clauses: DataFrame, index: Index, quantized: bool = False) -> DataFrame:
    """(query_id, doc_id, score): BM25 summed over the matching term clauses
    of each document, in place: the postings come dealt by document."""
    rows = document_matches(clauses.select("query_id", "clause_no", "occur", "kind", "term", "boost"), index, quantized)
    return rows.groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"))


def top_k(scores: DataFrame, k: int = MAX_HITS) -> DataFrame:
    """(query_id, rank, doc_id, score): best k per query, score descending
    then document id.  ``row_number() <= k`` lets Spark cut every partition to
    k rows per query before the shuffle, so a query matching a third of the
    corpus still ships only k rows per task."""
    w = Window.partitionBy("query_id").orderBy(round_score(F.col("score")).desc(), F.col("doc_id").asc())
    ranked = scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "doc_id", round_score(F.col("score")).alias("score"))


#: Documents to a range of ids, on average.
RANGE_DOCS = 1024


def search_clauses_top_k(clauses: DataFrame, index: Index, k: int = MAX_HITS, quantized: bool = False,
                         max_expansions: int | None = None) -> DataFrame:
    """Clause table -> top-k hits (query_id, rank, doc_id, score).

    As ``top_k(search_clauses(...))``, but ``*:*`` clauses aren't paired with
    every document: the documents that another clause matches are scored one
    by one, the rest of the corpus all have one score and come in order of
    their ids.  So the first ``k`` of the rest are looked for in the first
    ``k`` ranges of ids that other clauses don't fill wholly, at any ``k``."""
    clauses, rows = settled(checked(clauses))
    if rows is not None and "all" not in column(rows, "kind"):
        return top_k(search_clauses(clauses, index, quantized, max_expansions), k)
    occur = F.col("occur")
    whole = clauses.where("kind = 'all'").groupBy("query_id").agg(
        F.sum(F.when(occur != "must_not", F.col("boost"))).alias("all_score"), F.count_if(occur == "must").alias("all_must"),
        F.count_if(occur == "should").alias("all_should"), F.count_if(occur == "must_not").alias("all_not"))
    rest = clauses.where("kind <> 'all'")
    terms = settled_terms(rest, index.analyzer)
    req = effective_clauses(clauses, terms).groupBy("query_id").agg(F.count_if(occur == "must").alias("n_must"))
    plan, _ = settled(req.join(whole, "query_id", "left").na.fill(0, ["all_must", "all_should", "all_not"]))
    touched = written(clause_counts(match_clauses(rest, terms, index, quantized, max_expansions)), "matches")
    found = touched.join(plan, "query_id").where(held(F.col("must_hit") + F.col("all_must"), F.col("should_hit") + F.col("all_should"), F.col("excluded") + F.col("all_not")))
    found = found.select("query_id", "doc_id", (F.coalesce("score", F.lit(0.0)) + F.coalesce("all_score", F.lit(0.0))).alias("score"))

    # the rest: queries that a document without any other match fits
    open_ = plan.where(F.col("all_score").isNotNull() & held(F.col("all_must"), F.col("all_should"), F.col("all_not"))).select("query_id", "all_score")
    n, least, largest = index.docs.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    if not n:
        return top_k(found, k)
    width = max(1, (largest - least + 1) * RANGE_DOCS // n)
    place = F.floor((F.col("doc_id") - least) / width).cast("long")
    sizes = index.docs.groupBy(place.alias("range")).agg(F.count("*").alias("n"))
    met = touched.join(open_, "query_id", "left_semi").groupBy("query_id", place.alias("range")).agg(F.count("*").alias("t"))
    full = written(met.join(sizes, "range").where("t = n").select("query_id", "range"), "full-ranges")
    filled = full.groupBy("query_id").agg(F.count("*").alias("filled"))
    most = filled.agg(F.max("filled")).first()[0] or 0
    first = sizes.orderBy("range").limit(k + most).select("range", F.row_number().over(Window.orderBy("range")).alias("r"))
    tried = open_.join(filled, "query_id", "left").select("query_id", "all_score", F.explode(F.sequence(F.lit(1), F.lit(k) + F.coalesce("filled", F.lit(0)))).alias("r"))
    free = tried.join(first, "r").join(full, ["query_id", "range"], "left_anti")
    free = free.withColumn("i", F.row_number().over(Window.partitionBy("query_id").orderBy("range"))).where(F.col("i") <= k)
    others = index.docs.select("doc_id", place.alias("range")).join(free, "range").join(touched.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    return top_k(found.unionByName(others.select("query_id", "doc_id", F.col("all_score").alias("score"))), k)


def search_free_text(queries: DataFrame, index: Index, k: int = MAX_HITS, quantized: bool = False) -> DataFrame:
    """Free-text queries -> top-k hits (query_id, rank, doc_id, score)."""
    clauses = free_text_clauses(queries, index.analyzer)
    return top_k(bm25_scores(clauses, index, quantized), k)


def total_hits(queries: DataFrame, index: Index) -> DataFrame:
    """(query_id, total_hits): documents matching any term of each query."""
    m = index.lookup(free_text_clauses(queries, index.analyzer).select("query_id", "term"))
    per_q = m.groupBy("query_id").agg(F.count_distinct("doc_id").alias("total_hits"))
    return queries.select("query_id").join(per_q, "query_id", "left").select(
        "query_id", F.coalesce(F.col("total_hits"), F.lit(0)).alias("total_hits"))


def search_status(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """(query_id, status, results_count): 'error' with 0 for queries that do
    not parse, else 'success' and the number of hits returned (<= k)."""
    counts = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    st = query_status(queries).join(counts, "query_id", "left")
    return st.select(
        "query_id",
        F.when(F.col("valid"), F.lit("success")).otherwise(F.lit("error")).alias("status"),
        F.when(F.col("valid"), F.coalesce(F.col("n"), F.lit(0))).otherwise(F.lit(0)).cast("int").alias("results_count"))


def query_word_df(queries: DataFrame, index: Index) -> DataFrame:
    """(query_id, word_no, word, df): documents matching each word run as its
    own query (union over the terms it analyses to; 0 for stop words).
    Queries that fail as a whole have no report."""
    queries = queries.where(query_is_valid(F.col("query")))
    words = query_words(queries)
    m = index.lookup(word_terms(queries, index.analyzer))
    dfs = m.groupBy("query_id", "word_no").agg(F.count_distinct("doc_id").alias("df"))
    return words.join(dfs, ["query_id", "word_no"], "left").select(
        "query_id", "word_no", "word", F.coalesce(F.col("df"), F.lit(0)).cast("long").alias("df"))


def word_idf(queries: DataFrame, index: Index) -> DataFrame:
    """(query_id, word_no, word, df, idf): idf = log10(N / df), N counting
    every document; +Infinity for a word found nowhere."""
    wdf = query_word_df(queries, index)
    return index.with_totals(wdf).select(
        "query_id", "word_no", "word", "df", idf_log10(F.col("num_docs"), F.col("df")).alias("idf"))


def tfidf_report(queries: DataFrame, hits: DataFrame, index: Index, term_key: str = "drop_last_char") -> DataFrame:
    """(query_id, doc_id, word_no, word, tf, idf, tfidf) for every hit and word.

    ``term_key='drop_last_char'`` looks the word up without its last
    character (the original behaviour); ``'analyzed'`` uses the first term
    the word analyses to."""
    idf = word_idf(queries, index)
    if term_key == "drop_last_char":
        keyed = idf.withColumn("key", F.expr("substring(word, 1, length(word) - 1)"))
    elif term_key == "analyzed":
        first = _first_terms(queries, index.analyzer)
        keyed = idf.join(first, ["query_id", "word_no"], "left").withColumn("key", F.coalesce("key", F.lit("")))
    else:
        raise ValueError(f"unknown term_key {term_key!r}")
    hw = hits.select("query_id", "doc_id").join(keyed, "query_id")
    post = index.lookup(keyed.select(F.col("key").alias("term")).distinct()) \
        .select(F.col("term").alias("key"), "doc_id", F.col("tf").alias("count"))
    joined = hw.join(post, ["key", "doc_id"], "left")
    tf = tf_weight(F.col("count"))
    return joined.select("query_id", "doc_id", "word_no", "word", tf.alias("tf"), "idf",
                         (tf * F.col("idf")).alias("tfidf"))


def _first_terms(queries: DataFrame, analyzer: Analyzer) -> DataFrame:
    """(query_id, word_no, key): first surviving term of each lower-cased word."""
    words = query_words(queries)
    toks = words.select("query_id", "word_no", F.posexplode(token_array(F.col("word"))).alias("token_no", "token"))
    terms = analyze_tokens(toks, analyzer)
    return terms.groupBy("query_id", "word_no").agg(F.min_by("term", "token_no").alias("key"))


def display_order(hits: DataFrame) -> DataFrame:
    """(query_id, hits ARRAY<STRUCT<rank, doc_id, score>>) re-sorted with the
    original comparator ``round(a.score - b.score)``: ascending, differences
    under half a point tie, stable on the relevance order."""
    arr = hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "doc_id", "score"))).alias("by_rank"))
    cmp = F.expr("array_sort(by_rank, (a, b) -> cast(floor(a.score - b.score + 0.5) as int))")
    return arr.select("query_id", cmp.alias("hits"))
