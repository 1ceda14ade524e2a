"""Named query plans: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  ``__spark_entry__`` only wires these."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_term
from ..operators import analysis as an
from ..operators import highlight as hl
from ..operators import index as ix
from ..operators import match as mt
from ..operators import rank as rk
from ..operators import response as rs
from ..operators.lookup import settled
from ..sources import documents as src
from ..sources import index_store as store
from .fixtures import SNIPPET_GROUPS, benchmark_queries, fixture_analyzer, fixture_clauses, fixture_docs, fixture_queries

Plan = Callable[[SparkSession, str], DataFrame]


_STORED: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str, table: str) -> tuple:
    """(name, length, time of change) of the files of a table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in listed))


def _index(spark: SparkSession, sf_dir: str, stem: bool = False, docs=fixture_docs) -> ix.Index:
    """The index of a folder's documents, stored once per application, analyser and state of the folder's files."""
    analyzer = fixture_analyzer(spark, stem)
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir, "pages" if docs is src.pages_table else "documents"), stem, docs.__name__)
    if key not in _STORED:
        root = store.scratch_root(spark)
        store.write_index(ix.build_index(docs(spark, sf_dir), analyzer), root)
        _STORED[key] = root
    return store.read_index(spark, _STORED[key], analyzer)


# --- sources and analysis ---------------------------------------------------------

def scan_documents(spark, sf_dir):
    return fixture_docs(spark, sf_dir)


def tokenize_offsets(spark, sf_dir):
    return an.tokenize_offsets(fixture_docs(spark, sf_dir), ["doc_id"])


def ascii_fold(spark, sf_dir):
    """(token, folded) for every distinct non-ASCII token of the corpus."""
    toks = an.tokens(fixture_docs(spark, sf_dir), ["doc_id"]).select("token").distinct()
    toks = toks.where(F.octet_length("token") != F.length("token"))
    return toks.select("token", normalize_term(F.col("token")).alias("folded"))


def remove_stopwords(spark, sf_dir):
    """(doc_id, n_tokens, n_kept): tokens of each document before/after the stop filter."""
    docs = fixture_docs(spark, sf_dir)
    a = fixture_analyzer(spark)
    toks = an.tokens(docs, ["doc_id"]).withColumn("term", a.normalize(F.col("token")))
    kept = an.remove_stopwords(toks, a).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_kept"))
    total = docs.select("doc_id", F.size(an.token_array(F.col("content"))).alias("n_tokens"))
    return total.join(kept, "doc_id", "left").select(
        "doc_id", F.col("n_tokens").cast("long").alias("n_tokens"),
        F.coalesce(F.col("n_kept"), F.lit(0)).cast("long").alias("n_kept"))


def analyze_documents(spark, sf_dir):
    return an.analyze(fixture_docs(spark, sf_dir), fixture_analyzer(spark))


def analyze_documents_stemmed(spark, sf_dir):
    """The whole chain: as analyze_documents, with every term stemmed."""
    return an.stemmed(an.analyze(fixture_docs(spark, sf_dir), fixture_analyzer(spark)))


def stem_vocabulary(spark, sf_dir):
    """(term, stem) for the whole vocabulary."""
    return an.stem_vocabulary(_index(spark, sf_dir).term_stats)


def stopword_set(spark, sf_dir):
    """The stop set, with the number of documents that hold each word before the stop filter."""
    a = fixture_analyzer(spark)
    toks = an.tokens(fixture_docs(spark, sf_dir), ["doc_id"]).select("doc_id", a.normalize(F.col("token")).alias("word")).distinct()
    held = toks.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return a.stopwords.join(held, "word", "left").select("word", F.coalesce("df", F.lit(0)).alias("df"))


def search_topk_stemmed(spark, sf_dir):
    return rk.search_free_text(fixture_queries(spark), _index(spark, sf_dir, stem=True))


def first_term_of_word(spark, sf_dir):
    return an.first_term_of_words(fixture_docs(spark, sf_dir), fixture_analyzer(spark))


# --- index statistics ------------------------------------------------------------------

def term_frequencies(spark, sf_dir):
    return _index(spark, sf_dir).postings.select("doc_id", "term", "tf")


def document_frequencies(spark, sf_dir):
    return _index(spark, sf_dir).term_stats


def document_lengths(spark, sf_dir):
    return _index(spark, sf_dir).doc_stats


def corpus_stats(spark, sf_dir):
    return _index(spark, sf_dir).corpus


def build_postings(spark, sf_dir):
    return _index(spark, sf_dir).postings.select("term", "doc_id", "tf", "dl")


# --- matching and ranking ----------------------------------------------------------------

def query_words(spark, sf_dir):
    return mt.query_words(fixture_queries(spark).unionByName(benchmark_queries(spark, sf_dir)))


def match_any(spark, sf_dir):
    idx = _index(spark, sf_dir)
    clauses = mt.free_text_clauses(fixture_queries(spark), idx.analyzer)
    rows = mt.term_matches(clauses.select("query_id", "clause_no", "occur", "kind", "term", "boost"), idx)
    return rows.select("query_id", "clause_no", "term", "doc_id", "tf")


def bm25_scores(spark, sf_dir):
    idx = _index(spark, sf_dir)
    s = rk.bm25_scores(mt.free_text_clauses(fixture_queries(spark), idx.analyzer), idx)
    return s.select("query_id", "doc_id", F.round("score", 6).alias("score"))


def bm25_scores_quantized(spark, sf_dir):
    idx = _index(spark, sf_dir)
    s = rk.bm25_scores(mt.free_text_clauses(fixture_queries(spark), idx.analyzer), idx, quantized=True)
    return s.select("query_id", "doc_id", F.round("score", 6).alias("score"))


def search_topk(spark, sf_dir):
    return rk.search_free_text(fixture_queries(spark), _index(spark, sf_dir))


def search_topk_benchmark(spark, sf_dir):
    return rk.search_free_text(benchmark_queries(spark, sf_dir), _index(spark, sf_dir))


def query_total_hits(spark, sf_dir):
    return rk.total_hits(fixture_queries(spark), _index(spark, sf_dir))


def search_status(spark, sf_dir):
    q = fixture_queries(spark)
    return rk.search_status(q, rk.search_free_text(q, _index(spark, sf_dir)))


def query_word_df(spark, sf_dir):
    return rk.word_idf(fixture_queries(spark), _index(spark, sf_dir))


def tfidf_report(spark, sf_dir):
    q = fixture_queries(spark)
    idx = _index(spark, sf_dir)
    return rk.tfidf_report(q, rk.search_free_text(q, idx), idx, "drop_last_char")


def tfidf_report_analyzed(spark, sf_dir):
    q = fixture_queries(spark)
    idx = _index(spark, sf_dir)
    return rk.tfidf_report(q, rk.search_free_text(q, idx), idx, "analyzed")


def search_display_order(spark, sf_dir):
    q = fixture_queries(spark)
    d = rk.display_order(rk.search_free_text(q, _index(spark, sf_dir)))
    return d.select("query_id", F.posexplode("hits").alias("display_pos", "hit")).select(
        "query_id", "display_pos", "hit.rank", "hit.doc_id", "hit.score")


def _clause_search(group: str):
    def plan(spark, sf_dir):
        idx = _index(spark, sf_dir)
        return rk.search_clauses_top_k(fixture_clauses(spark, group), idx)
    plan.__name__ = f"match_{group}"
    return plan


PLANS: dict[str, Plan] = {
    "scan_documents": scan_documents,
    "tokenize_offsets": tokenize_offsets,
    "ascii_fold": ascii_fold,
    "remove_stopwords": remove_stopwords,
    "analyze_documents": analyze_documents,
    "analyze_documents_stemmed": analyze_documents_stemmed,
    "stem_vocabulary": stem_vocabulary,
    "stopword_set": stopword_set,
    "first_term_of_word": first_term_of_word,
    "term_frequencies": term_frequencies,
    "document_frequencies": document_frequencies,
    "document_lengths": document_lengths,
    "corpus_stats": corpus_stats,
    "build_postings": build_postings,
    "query_words": query_words,
    "match_any": match_any,
    "bm25_scores": bm25_scores,
    "bm25_scores_quantized": bm25_scores_quantized,
    "search_topk": search_topk,
    "search_topk_stemmed": search_topk_stemmed,
    "search_topk_benchmark": search_topk_benchmark,
    "query_total_hits": query_total_hits,
    "search_status": search_status,
    "query_word_df": query_word_df,
    "tfidf_report": tfidf_report,
    "tfidf_report_analyzed": tfidf_report_analyzed,
    "search_display_order": search_display_order,
    "match_boolean": _clause_search("boolean"),
    "score_boosted": _clause_search("boosted"),
    "match_wildcard": _clause_search("wildcard"),
    "match_fuzzy": _clause_search("fuzzy"),
    "match_regexp": _clause_search("regexp"),
    "match_term_range": _clause_search("range"),
    "match_field": _clause_search("field"),
    "match_all": _clause_search("all"),
}


# --- highlighter --------------------------------------------------------------------

def _hl_inputs(spark, sf_dir):
    q = fixture_queries(spark)
    idx = _index(spark, sf_dir)
    clauses = hl.query_clauses(mt.free_text_clauses(q, idx.analyzer))
    hits = rk.search_free_text(q, idx)
    return q, idx, clauses, hits


def highlight_clauses(spark, sf_dir):
    a = fixture_analyzer(spark)
    return hl.query_clauses(mt.free_text_clauses(benchmark_queries(spark, sf_dir), a))


def _kwic(spark, sf_dir):
    q, idx, clauses, hits = _hl_inputs(spark, sf_dir)
    hits, contents = hl.prepare(hits, idx)
    return idx, clauses, contents, hl.keyword_in_context(hits, contents, clauses, idx.analyzer)


def keyword_in_context(spark, sf_dir):
    idx, clauses, contents, k = _kwic(spark, sf_dir)
    return k.withColumn("terms", F.array_sort("terms"))


def merge_fragments(spark, sf_dir):
    idx, clauses, contents, k = _kwic(spark, sf_dir)
    return hl.merge_fragments(k, contents)


def central_term_positions(spark, sf_dir):
    idx, clauses, contents, k = _kwic(spark, sf_dir)
    merged = hl.merge_fragments(k, contents)
    return hl.central_term_positions(merged, clauses, idx.analyzer)


def best_fragments(spark, sf_dir):
    idx, clauses, contents, k = _kwic(spark, sf_dir)
    merged = hl.merge_fragments(k, contents)
    b = hl.best_fragments(merged)
    return b.select("query_id", "doc_id", F.posexplode("ranked").alias("rank", "f")).select(
        "query_id", "doc_id", "rank", "f.start", "f.end", "f.text", "f.terms")


def highlight(spark, sf_dir):
    q, idx, clauses, hits = _hl_inputs(spark, sf_dir)
    return hl.highlight_hits(hits, idx, clauses, idx.analyzer)


def _printed_clauses(spark):
    rows = fixture_clauses(spark, SNIPPET_GROUPS[0])
    for group in SNIPPET_GROUPS[1:]:
        rows = rows.unionByName(fixture_clauses(spark, group))
    return rows


def highlight_clause_table(spark, sf_dir):
    """Snippets of the hits of clause tables: only clauses that print as bare terms are looked for."""
    idx = _index(spark, sf_dir)
    clauses = _printed_clauses(spark)
    hits = rk.search_clauses_top_k(clauses, idx)
    return hl.highlight_hits(hits, idx, hl.render_clauses(clauses, idx.analyzer), idx.analyzer)


PLANS.update({
    "highlight_clauses": highlight_clauses,
    "highlight_clause_table": highlight_clause_table,
    "keyword_in_context": keyword_in_context,
    "merge_fragments": merge_fragments,
    "central_term_positions": central_term_positions,
    "best_fragments": best_fragments,
    "highlight": highlight,
})


# --- sources and sinks ---------------------------------------------------------------

def index_append_stats(spark, sf_dir):
    """Index ``documents``, append ``conversations`` as a second segment, read
    the merged term statistics back."""
    a = fixture_analyzer(spark)
    root = store.scratch_root(spark)
    store.write_index(ix.build_index(fixture_docs(spark, sf_dir), a), root)
    store.append_documents(spark, root, src.conversations_table(spark, sf_dir), a)
    return store.read_index(spark, root, a).term_stats


def extract_page_text(spark, sf_dir):
    return src.pages_table(spark, sf_dir)


def document_metadata(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return p.select(F.col("page_id").cast("long").alias("doc_id"), F.col("url").alias("path"),
                    src.url_file_name(F.col("url")).alias("file_name"))


def search_pages_topk(spark, sf_dir):
    """The fixture queries over an index of the extracted web pages."""
    return rk.search_free_text(fixture_queries(spark), _index(spark, sf_dir, docs=src.pages_table))


PLANS.update({
    "index_append_stats": index_append_stats,
    "extract_page_text": extract_page_text,
    "document_metadata": document_metadata,
    "search_pages_topk": search_pages_topk,
})


def search_response(spark, sf_dir):
    q, idx, clauses, hits = _hl_inputs(spark, sf_dir)
    hits = settled(hits)[0]  # a small one is searched once for both uses
    snippets = hl.highlight_hits(hits, idx, clauses, idx.analyzer)
    return rs.search_response(q, hits, snippets, idx)


PLANS["search_response"] = search_response
