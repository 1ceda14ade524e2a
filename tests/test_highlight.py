import pytest
from pyspark.sql import functions as F

from lectern.operators import highlight as hl
from lectern.operators import match as mt
from lectern.operators.analysis import Analyzer, stopword_set

GOLDENS = [
    ("H1", "alfa beta gama delta epsilon zeta", "delta", " ... beta gama <b>delta</b> epsilon zeta "),
    ("H2", "delta alfa beta gama", "delta", " <b>delta</b> alfa beta  ... "),
    ("H3", "unu doi trei alfa patru beta cinci sase sapte", "alfa beta",
     " ... doi trei <b>alfa</b> patru  <b>beta</b> cinci sase  ... "),
    ("H4", "alfa x1 x2 x3 x4 x5 alfa beta", "alfa beta", " ... x4 x5 <b>alfa</b>  <b>beta</b> "),
    ("H6", "alfa a1 a2 alfa b1 beta", "alfa beta", " ... a1 a2 <b>alfa</b> b1  <b>beta</b> "),
    ("H7", "gama", "alfa", " "),
]


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.createDataFrame([(i, f"p{i}", f"f{i}", c) for i, (_, c, _, _) in enumerate(GOLDENS)],
                                 "doc_id long, path string, file_name string, content string")
    queries = spark.createDataFrame([(i, q) for i, (_, _, q, _) in enumerate(GOLDENS)], "query_id long, query string")
    hits = spark.createDataFrame([(i, i) for i in range(len(GOLDENS))], "query_id long, doc_id long")
    an = Analyzer()
    clauses = hl.query_clauses(mt.free_text_clauses(queries, an))
    return {r.query_id: r.highlight for r in hl.highlight_hits(hits, docs, clauses, an).collect()}


@pytest.mark.parametrize("i", range(len(GOLDENS)))
def test_golden(results, i):
    assert results[i] == GOLDENS[i][3], GOLDENS[i][0]


def test_decorated_clauses_never_match(spark):
    an = Analyzer()
    cl = spark.createDataFrame([(0, 0, "must", "content", "term", "alfa", None, 1.0),
                                (0, 1, "must", "content", "term", "beta", None, 1.0)], mt.CLAUSE_SCHEMA)
    rc = hl.render_clauses(cl, an)
    assert rc.first().clauses == ["+alfa", "+beta"]
    docs = spark.createDataFrame([(0, "p", "f", "alfa beta")], "doc_id long, path string, file_name string, content string")
    hits = spark.createDataFrame([(0, 0)], "query_id long, doc_id long")
    assert hl.highlight_hits(hits, docs, rc, an).first().highlight == " "


def test_printed_clauses(spark):
    an = Analyzer(stopwords=stopword_set(spark.createDataFrame([("the",)], "word string")))
    rows = [("should", "content", "term", "Alfă-beta the", None, 1.0), ("should", "content", "term", "gama", None, 2.0), ("must_not", "content", "prefix", "De", None, 1.0),
            ("should", "fileName", "term", "A.txt", None, 1.0), ("must", "path", "wildcard", "a/?", None, 0.5), ("should", "content", "range", None, "z", 1.0),
            ("should", "content", "range_exclusive", "a", "b", 1.0), ("should", "content", "fuzzy", "epsilon", None, 1.0), ("should", "content", "regexp", "a.b", None, 1.0),
            ("must", "content", "all", None, None, 1.0), ("should", "content", "exact", "zeta", None, 1.0), ("should", "content", "term", "the", None, 1.0)]
    cl = spark.createDataFrame([(0, k, *r) for k, r in enumerate(rows)], mt.CLAUSE_SCHEMA)
    assert hl.render_clauses(cl, an).first().clauses == [
        "alfa", "beta", "(gama)^2.0", "-De*", "fileName:A.txt", "+(path:a/?)^0.5", "[*", "TO", "z]", "{a", "TO", "b}", "epsilon~2", "/a.b/", "+*:*", "zeta"]


def test_redundant_fragment_fold(spark):
    frags = [(i, 10 * i, 10 * i + 5, f"t{i}", t) for i, t in enumerate([["a"], ["a", "b"], ["b", "c"], ["c"]])]
    df = spark.createDataFrame([(0, 0, 100, frags)],
                               "query_id long, doc_id long, content_length int, "
                               "frags array<struct<island:int,start:int,end:int,text:string,terms:array<string>>>")
    ranked = df.select(hl._best_fragments(F.col("frags")).alias("r")).first().r
    assert sorted(f.i for f in ranked) == [1, 3]
