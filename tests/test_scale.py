"""What one task takes, and what is shuffled, as the tables grow (sizes are set low here)."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from lectern.operators import index as ix
from lectern.operators import lookup
from lectern.operators import match as mt
from lectern.operators import rank as rk
from lectern.operators.analysis import Analyzer
from lectern.plans.fixtures import CLAUSE_DDL, local_table
from lectern.sources import index_store as store


def _texts() -> list[tuple]:
    return [(d, f"p/{d}", str(d), " ".join([f"word{(d * 7 + k) % 1500}x" for k in range(40)] + ["often", "mangeait"])) for d in range(300)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scale") / "docs.parquet")
    local_table(spark, _texts(), "doc_id long, path string, file_name string, content string").coalesce(1).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(folder)


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("scale") / "idx")
    store.write_index(ix.build_index(docs, Analyzer()), root)
    return store.read_index(spark, root, Analyzer())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df) -> list[tuple]:
    return sorted((r["query_id"], r["doc_id"], round(r["score"], 6)) for r in df.collect())


def _clauses(spark, *rows):
    return local_table(spark, list(rows), CLAUSE_DDL)


WILD = (1, 0, "should", "content", "wildcard", "word*x", None, 1.0)
MIXED = [WILD, (1, 1, "should", "content", "term", "often", None, 1.0), (2, 0, "should", "content", "prefix", "word12", None, 2.0),
         (3, 0, "must", "content", "range", "word10x", "word11x", 1.0), (3, 1, "should", "path", "prefix", "p/1", None, 1.0)]


@pytest.mark.parametrize("stem", [False, True])
def test_more_input_is_more_tasks(spark, docs, folder, stem, monkeypatch):
    before = {(r["term"], r["doc_id"]): (r["tf"], r["dl"]) for r in ix.build_index(docs, Analyzer(stem=stem)).postings.collect()}
    size = sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))
    monkeypatch.setattr(lookup, "TASK_BYTES", size // 16)
    fixed = int(spark.conf.get("spark.sql.shuffle.partitions"))
    postings = ix.build_index(docs, Analyzer(stem=stem)).postings
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(doc_id#\d+L, (\d+)\)", _plan(postings))]
    assert dealt and max(dealt) > fixed
    assert {(r["term"], r["doc_id"]): (r["tf"], r["dl"]) for r in postings.collect()} == before


def test_a_stemmed_index_cuts_the_texts_once(docs):
    assert _plan(ix.build_index(docs, Analyzer(stem=True)).postings).count("regexp_extract_all") <= 1


def test_many_terms_do_not_shuffle_the_postings_by_term(spark, stored):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # 1500 terms are over a small threshold
    try:
        plan = _plan(mt.search_clauses(_clauses(spark, WILD), stored))
        queries = local_table(spark, [(q, " ".join(f"word{(q * 100 + k) % 1500}x" for k in range(150))) for q in range(20)], "query_id long, query string")
        plan += _plan(rk.bm25_scores(mt.free_text_clauses(queries, stored.analyzer), stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not re.search(r"Join \[term#", plan.replace("BroadcastHashJoin", ""))


def test_matches_are_dealt_by_their_number(spark, stored, monkeypatch):
    queries = local_table(spark, [(q, f"often word{q}x often") for q in range(20)], "query_id long, query string")
    find = lambda: rk.bm25_scores(mt.free_text_clauses(queries, stored.analyzer), stored)
    before, mixed = _rows(find()), _rows(mt.search_clauses(_clauses(spark, *MIXED), stored))
    monkeypatch.setattr(lookup, "TASK_ROWS", 100)
    assert "hashpartitioning(doc_id" in _plan(find()) and ", 122)" in _plan(find())  # 12,160 matches
    assert _rows(find()) == before
    assert _rows(mt.search_clauses(_clauses(spark, *MIXED), stored)) == mixed


def test_expansions_over_the_limit_give_the_same(spark, stored, monkeypatch):
    before = _rows(mt.search_clauses(_clauses(spark, *MIXED), stored))
    assert len(before) > 300
    monkeypatch.setattr(lookup.settled, "__defaults__", (8,))  # the clauses are known, what they stand for isn't
    found = mt.search_clauses(_clauses(spark, *MIXED), stored)
    assert _rows(found) == before
    # only postings that a clause can match meet the expansion
    assert "LIKE" in _plan(found).upper() or "StartsWith" in _plan(found) or "EndsWith" in _plan(found)
