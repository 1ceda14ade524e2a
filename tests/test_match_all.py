"""``*:*`` by its complement against every query paired with every document."""
import pytest

from lectern.operators import index as ix
from lectern.operators import match as mt
from lectern.operators import rank as rk
from lectern.operators.analysis import Analyzer
from lectern.plans.fixtures import CLAUSE_DDL
from tests.test_probes import docs_of

ROWS = [
    (1, 0, "should", "content", "all", None, None, 1.0),
    (2, 0, "must", "content", "all", None, None, 1.0), (2, 1, "must_not", "content", "term", "even", None, 1.0),
    (3, 0, "should", "content", "all", None, None, 0.5), (3, 1, "should", "content", "term", "third", None, 1.0),
    (4, 0, "must", "content", "all", None, None, 1.0), (4, 1, "must", "content", "term", "third", None, 1.0),
    (5, 0, "must_not", "content", "all", None, None, 1.0), (5, 1, "should", "content", "term", "even", None, 1.0),
    (6, 0, "should", "content", "term", "even", None, 1.0),
    (7, 0, "should", "content", "all", None, None, 1.0), (7, 1, "should", "content", "all", None, None, 2.0), (7, 2, "must_not", "content", "term", "early", None, 1.0),
    (8, 0, "must", "content", "all", None, None, 1.0), (8, 1, "should", "fileName", "term", "7.txt", None, 1.0),
]


@pytest.mark.parametrize("k", [3, 200])
def test_complement(spark, monkeypatch, k):
    """Ranges of two documents, the first twelve all touched by query 7's other clause; k beyond the table's size."""
    monkeypatch.setattr(rk, "RANGE_DOCS", 2)
    texts = [" ".join(w for w, holds in (("even", i % 2 == 0), ("third", i % 3 == 0), ("early", i < 12), (f"own{i}", True)) if holds) for i in range(40)]
    idx = ix.build_index(docs_of(spark, texts), Analyzer())
    clauses = spark.createDataFrame(ROWS, CLAUSE_DDL)
    want = sorted(tuple(r) for r in rk.top_k(mt.search_clauses(clauses, idx), k).collect())
    assert sorted(tuple(r) for r in rk.search_clauses_top_k(clauses, idx, k).collect()) == want
    assert {r[0] for r in want} == {1, 2, 3, 4, 6, 7, 8}


def test_no_documents(spark):
    idx = ix.build_index(docs_of(spark, ["x"]).where("doc_id < 0"), Analyzer())
    assert rk.search_clauses_top_k(spark.createDataFrame(ROWS, CLAUSE_DDL), idx).collect() == []
