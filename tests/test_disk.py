"""What the build of an index leaves on the disk (slices are set small here)."""

from __future__ import annotations

from pathlib import Path

import pytest

from lectern.operators import index as ix
from lectern.operators import lookup
from lectern.operators import rank as rk
from lectern.operators.analysis import Analyzer
from lectern.plans.fixtures import local_table
from lectern.session import ensure_checkpoint_dir
from lectern.sources import index_store as store


def _texts() -> list[tuple]:
    rows = [(d, f"p/{d}", str(d), " ".join([f"word{(d * 7 + k) % 500}x" for k in range(20)] + ["often", "frumoase", "frumosi"])) for d in range(200)]
    # a document without an id, ids that come twice, a text without words
    return [*rows, (None, "p/none", "none", "often frumoase"), (3, "p/3", "3", "frumosul often"), (None, "p/none", "none", "often"), (200, "p/200", "200", "")]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("disk") / "docs.parquet")
    local_table(spark, _texts(), "doc_id long, path string, file_name string, content string").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(lookup, "SLICE_BYTES", 64)


def _rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


def _scratch(spark) -> set[str]:
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    return {p.name for p in folder.iterdir() if p.name.startswith(("lectern-counts", "lectern-stems"))}


def _shuffles(spark) -> set[int]:
    known = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keysIterator()
    out = set()
    while known.hasNext():
        out.add(known.next())
    return out


@pytest.mark.parametrize("stem", [False, True])
def test_slices_hold_every_posting_once(spark, docs, stem, small_slices):
    index = ix.build_index(docs, Analyzer(stem=stem))
    parts = index.parts()
    assert len(parts) == lookup.MOST_SLICES
    held = [{r["doc_id"] for r in p.select("doc_id").distinct().collect()} for p in parts]
    assert sum(map(len, held)) == len(set().union(*held)) == 201  # with the null; one text has no words
    assert sorted((r for p in parts for r in _rows(p)), key=repr) == _rows(index.postings)


@pytest.mark.parametrize("stem", [False, True])
def test_an_index_in_slices_is_the_same(spark, docs, stem, tmp_path, monkeypatch):
    analyzer = Analyzer(stem=stem)
    queries = local_table(spark, [(1, "frumoase often"), (2, "word7x word9x"), (3, "word499x")], "query_id long, query string")

    def stored(name: str) -> dict:
        store.write_index(ix.build_index(docs, analyzer), str(tmp_path / name))
        index = store.read_index(spark, str(tmp_path / name), analyzer)
        tables = {t: _rows(index.store.table(t)) for t in store.SCHEMAS}
        return tables | {"totals": index.totals, "hits": _rows(rk.search_free_text(queries, index))}

    whole = stored("whole")
    monkeypatch.setattr(lookup, "SLICE_BYTES", 64)
    assert stored("sliced") == whole
    assert whole["totals"]["num_docs"] == 204 and len(whole["hits"]) > 20


def test_a_stemmed_build_leaves_only_the_index(spark, docs, tmp_path, small_slices):
    before, shuffles = _scratch(spark), _shuffles(spark)
    index = ix.build_index(docs, Analyzer(stem=True))
    store.write_index(index, str(tmp_path / "idx"))
    assert _scratch(spark) <= before
    # the counts of rows that a list of segments holds may still be there, the tables' shuffles may not
    assert len(_shuffles(spark) - shuffles) <= 3
    files = list((tmp_path / "idx").rglob("part-*.parquet"))
    assert files and all(".zstd." in f.name for f in files if "/list/" not in str(f))
    assert spark.conf.get(lookup.FREED) == "false"
