"""Inputs shared by the registered queries, the bench and the tests.

The query batch is small and fixed; every query built on it reads the whole
document table, so its work grows with the data.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.analysis import Analyzer, stopword_set
from ..sources.documents import documents_table

# --- fixed values -----------------------------------------------------------
# Fixture queries: rare terms, frequent terms in several languages, an
# unknown word, a stop word alone, a double space and an empty query.
FIXTURE_QUERIES = [
    (1, "aiment"),
    (2, "aielle anelle"),
    (3, "tion thin nicht"),
    (4, "zzzzunknown"),
    (5, "aiment zzzzunknown"),
    (6, "la"),
    (7, "aiment  tion"),
    (8, ""),
]
# Stop words used by the fixtures: some short function words of the corpus' and
# of other languages, two of them with marks.  Real runs pass a full list as a
# file (see lectern.operators.analysis.read_stopwords).
FIXTURE_STOPWORDS = ["and", "of", "to", "und", "der", "die", "les", "et", "los", "y", "la", "și", "über"]
# Clause-table fixtures (query_id, clause_no, occur, field, kind, term, term2, boost).
FIXTURE_CLAUSES = {
    "boolean": [
        (11, 0, "must", "content", "term", "tion", None, 1.0),
        (11, 1, "must", "content", "term", "thin", None, 1.0),
        (11, 2, "must_not", "content", "term", "nicht", None, 1.0),
        (12, 0, "should", "content", "term", "aiment", None, 1.0),
        (12, 1, "should", "content", "term", "aielle", None, 1.0),
        (12, 2, "must_not", "content", "term", "the", None, 1.0),
        (13, 0, "must_not", "content", "term", "tion", None, 1.0),
        (14, 0, "must", "content", "term", "nicht", None, 1.0),
        (14, 1, "should", "content", "term", "tion", None, 1.0),
    ],
    "boosted": [
        (21, 0, "should", "content", "term", "tion", None, 2.0),
        (21, 1, "should", "content", "term", "thin", None, 0.5),
        (22, 0, "should", "content", "term", "aiment", None, 1.0),
        (22, 1, "should", "content", "term", "aiment", None, 1.0),
    ],
    "wildcard": [
        (31, 0, "should", "content", "prefix", "aimen", None, 1.0),
        (32, 0, "should", "content", "wildcard", "ai?ent*", None, 1.0),
        (33, 0, "must", "content", "prefix", "nich", None, 2.0),
        (33, 1, "should", "content", "term", "aiment", None, 1.0),
    ],
    "fuzzy": [
        (41, 0, "should", "content", "fuzzy", "aiment", "2", 1.0),
        (42, 0, "should", "content", "fuzzy", "nicth", "1", 1.0),
        (43, 0, "should", "content", "fuzzy", "incth", None, 1.0),
        (44, 0, "should", "content", "fuzzy", "a", "2", 1.0),
    ],
    "regexp": [
        (51, 0, "should", "content", "regexp", "ai[a-z]ent", None, 1.0),
        (52, 0, "should", "content", "regexp", "n.cht?", None, 1.0),
    ],
    "range": [
        (61, 0, "should", "content", "range", "aielle", "aiment", 1.0),
        (62, 0, "should", "content", "range_exclusive", "nicht", "nichts", 1.0),
    ],
    "field": [
        (71, 0, "should", "fileName", "term", "42", None, 1.0),
        (72, 0, "should", "fileName", "term", "7", None, 1.0),
        (72, 1, "should", "content", "term", "tion", None, 1.0),
        (73, 0, "should", "path", "term", "src3/3", None, 1.0),
        (74, 0, "should", "path", "prefix", "src1/1", None, 1.0),
        (75, 0, "must", "fileName", "wildcard", "1?", None, 2.0),
        (75, 1, "should", "content", "exact", "tion", None, 1.0),
        (76, 0, "should", "fileName", "fuzzy", "1234", "1", 1.0),
    ],
    "all": [
        (81, 0, "should", "content", "all", None, None, 1.0),
        (82, 0, "must", "content", "all", None, None, 1.0),
        (82, 1, "must_not", "content", "term", "the", None, 1.0),
        (83, 0, "should", "content", "all", None, None, 1.0),
        (83, 1, "should", "content", "term", "aiment", None, 1.0),
    ],
}
# ---------------------------------------------------------------------------

# The groups whose hits get snippets.
SNIPPET_GROUPS = ["boolean", "boosted", "wildcard", "regexp", "range", "field"]

CLAUSE_DDL = ("query_id long, clause_no long, occur string, field string, kind string, "
              "term string, term2 string, boost double")


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows of the caller as a table that the planner sees through: it knows
    their number and drops the branches that none of them takes part in."""
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    fields = [f.split() for f in ddl.split(",")]
    columns = {name: pa.array([r[k] for r in rows], types[kind]) for k, (name, kind) in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns))


def fixture_queries(spark: SparkSession) -> DataFrame:
    return local_table(spark, FIXTURE_QUERIES, "query_id long, query string")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``benchmark`` passage as a free-text query (ids 1000 + item_id)."""
    b = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return b.select((F.lit(1000) + F.col("item_id")).cast("long").alias("query_id"),
                    F.coalesce(F.col("text"), F.lit("")).alias("query"))


def fixture_clauses(spark: SparkSession, group: str) -> DataFrame:
    return local_table(spark, FIXTURE_CLAUSES[group], CLAUSE_DDL)


def fixture_analyzer(spark: SparkSession, stem: bool = False) -> Analyzer:
    words = local_table(spark, [(w,) for w in FIXTURE_STOPWORDS], "word string")
    return Analyzer(stopwords=stopword_set(words), stem=stem)


def fixture_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_table(spark, sf_dir)
