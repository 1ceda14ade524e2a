"""Lookups of a stored index: what a plan opens, deletion keys, trigrams, segments and their list."""
import itertools
import re

import pytest
from pyspark.sql import functions as F

from lectern.operators import highlight as hl
from lectern.operators import index as ix
from lectern.operators import lookup as lk
from lectern.operators import match as mt
from lectern.operators import rank as rk
from lectern.operators import response as rs
from lectern.operators.analysis import Analyzer
from lectern.plans.fixtures import CLAUSE_DDL
from lectern.sources import index_store as store
from tests.conftest import SF_SMALL
from tests.test_probes import docs_of, osa

WORDS = ["".join(w) for n in (1, 2, 3, 4) for w in itertools.product("ab", repeat=n)] + ["nicht", "incth", "nichts", "aiment", "aimable", "aimons", "faiment", "a_b"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lookup") / "index")
    texts = [" ".join(WORDS[k::3] + WORDS[k::5]) for k in range(12)]
    plain = ix.build_index(docs_of(spark, texts), Analyzer())
    store.write_index(plain, root)
    return plain, store.read_index(spark, root, Analyzer())


def explained(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def scans(text, table):
    """The scans of a table: their partition filters and pushed filters."""
    found = re.findall(r"Scan parquet.*?(?=\n\n)", text, flags=re.S)
    return [s for s in found if f"/{table}/" in s]


def test_a_search_opens_the_folders_of_its_terms(spark, stored, capsys):
    q = spark.createDataFrame([(1, "nicht")], "query_id long, query string")
    text = explained(rk.search_free_text(q, stored[1]), capsys)
    assert "Cartesian" not in text and "SortMergeJoin" not in text and not scans(text, "terms")
    (scan,) = scans(text, "postings")
    bucket = store._bucket("nicht", store.LEAST_BUCKETS)
    assert re.search(rf"PartitionFilters: .*bucket#\d+ (IN \({bucket}\)|= {bucket}\))", scan) and "EqualTo(term,nicht)" in scan


def test_snippets_open_the_folders_of_the_hits(spark, stored, capsys):
    hits = spark.createDataFrame([(1, 1, 3, 0.5), (1, 2, 4, 0.25)], "query_id long, rank int, doc_id long, score double")
    text = explained(hl.hit_contents(hits, stored[1]), capsys)
    (scan,) = scans(text, "docs")
    assert "bucket" in scan.split("PartitionFilters:")[1].split("\n")[0] and "EqualTo(doc_id,3)" in scan
    q = spark.createDataFrame([(1, "nicht")], "query_id long, query string")
    snippets = hits.select("query_id", "doc_id", F.lit("x").alias("highlight"))
    text = explained(rs.search_response(q, hits, snippets, stored[1]), capsys)
    assert all("bucket" in s.split("PartitionFilters:")[1].split("\n")[0] for s in scans(text, "docs"))


def test_a_large_batch_is_joined(spark, stored):
    rows = [(k, WORDS[k % len(WORDS)]) for k in range(lk.LIMIT + 100)]
    q = spark.createDataFrame(rows, "query_id long, query string")
    got = rk.bm25_scores(mt.free_text_clauses(q, Analyzer()), stored[1])
    one = rk.bm25_scores(mt.free_text_clauses(q.where(f"query_id < {len(WORDS)}"), Analyzer()), stored[1])
    assert lk.settled(q)[1] is None and got.where(f"query_id < {len(WORDS)}").count() == one.count() > 0


def test_deletion_keys_lose_no_pair(spark):
    keys = {r.w: set(r.k) for r in spark.createDataFrame([(w,) for w in WORDS + [""]], "w string").select("w", lk.deletion_keys(F.col("w")).alias("k")).collect()}
    for a, b in itertools.product(WORDS, WORDS):
        assert osa(a, b) > 2 or keys[a] & keys[b], (a, b)
    assert keys[""] == {""} and keys["abab"] >= {"abab", "aba", "bab", "ab", "ba", "aa", "bb"}
    long = "x" * 255
    assert len(one_row(spark, lk.deletion_keys(F.lit(long)))) == 3  # of the first signs only


def one_row(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_needed_trigrams():
    s, e = lk.START, lk.END
    assert lk.needed_trigrams("wildcard", "ai?ent*") == sorted([s + "ai", "ent"])
    assert lk.needed_trigrams("wildcard", "*ing") == sorted(["ing", "ng" + e]) and lk.needed_trigrams("wildcard", "*a*") == []
    assert lk.needed_trigrams("regexp", "ai[a-z]ent") == sorted([s + "ai", "ent", "nt" + e])
    assert lk.needed_trigrams("regexp", "abc?def+") == sorted([s + "ab"]) and lk.needed_trigrams("regexp", "(abc|def)") == []
    assert lk.needed_trigrams("regexp", "abc{2}d") == sorted([s + "ab"]) and lk.needed_trigrams("regexp", "a.c") == []


def test_trigrams_hold_what_patterns_need(spark):
    patterns = [("wildcard", p) for p in ("aim*", "*ent", "n?cht*", "*ab*a*", "a", "????", "a_b")] + [("regexp", p) for p in ("aim(ent|able)", "ai[a-z]ent", "nichts?", "[ab]{3}a", "a.*b")]
    grams = {r.w: set(r.g) for r in spark.createDataFrame([(w,) for w in WORDS], "w string").select("w", lk.trigrams(F.col("w")).alias("g")).collect()}
    for kind, p in patterns:
        fits = re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in p) if kind == "wildcard" else p)
        assert all(set(lk.needed_trigrams(kind, p)) <= grams[w] for w in WORDS if fits.fullmatch(w)), p


def test_successor():
    assert lk.successor("ab") == "ac" and lk.successor("") is None and lk.successor("\U0010ffff") is None
    assert lk.successor("a\U0010ffff") == "b" and lk.successor("퟿") == ""


KINDS = [("prefix", "ai", None), ("prefix", "", None), ("range", "ab", "b"), ("range", None, "aa"), ("range", "nicht", None), ("range_exclusive", "aimable", "aiment"),
         ("wildcard", "ai?ent*", None), ("wildcard", "*", None), ("wildcard", "??", None), ("regexp", "ai[a-z]ent", None), ("regexp", "(nicht|a+)", None),
         ("fuzzy", "nicth", "1"), ("fuzzy", "incth", None), ("fuzzy", "a", "2"), ("fuzzy", "zzzzzz", "2"), ("fuzzy", "abba", "0"), ("fuzzy", "aimenta", "2")]


def test_a_stored_index_expands_as_a_plain_one(spark, stored):
    rows = [(k, 0, "should", "content", kind, a, b, 1.0 + k) for k, (kind, a, b) in enumerate(KINDS)]
    rows += [(100 + k, 0, "should", "fileName", kind, a, b, 1.0) for k, (kind, a, b) in enumerate([("prefix", "1", None), ("wildcard", "?.txt", None), ("fuzzy", "3.txt", "1"), ("range", "2", "4")])]
    rows += [(200, 0, "must", "path", "term", "dir/3.txt", None, 1.0), (200, 1, "should", "content", "all", None, None, 1.0)]
    clauses = spark.createDataFrame(rows, CLAUSE_DDL)
    plain, pruned = ({tuple(r)[:2] + (round(r.score, 6),) for r in mt.search_clauses(clauses, index).collect()} for index in stored)
    assert plain == pruned and {q for q, _, _ in plain} >= {0, 2, 6, 9, 11, 100, 200}


def test_fuzzy_meets_no_vocabulary(spark, stored, capsys):
    clauses = spark.createDataFrame([(1, 0, "should", "content", "fuzzy", "nicth", "2", 1.0)], CLAUSE_DDL)
    c, rows = lk.settled(clauses)
    text = explained(mt.expand_multiterm(c, stored[1]), capsys)
    assert "NestedLoop" not in text and scans(text, "deletions") and not scans(text, "terms") and not scans(text, "names")


def appended(spark, root, n, fan):
    for k in range(n):
        store.append_documents(spark, root, docs_of(spark, [f"common word{k % 3} only{k}", "common"]), Analyzer(), fan=fan)


def test_segments_are_compacted_and_score_alike(spark, tmp_path):
    q = spark.createDataFrame([(1, "common word1 only4")], "query_id long, query string")
    texts = [t for k in range(7) for t in (f"common word{k % 3} only{k}", "common")]
    want = [tuple(r) for r in rk.search_free_text(q, ix.build_index(docs_of(spark, texts), Analyzer())).collect()]
    for fan, segments in ((3, 3), (100, 7)):  # two of the first level's ... one of the next; none merged
        root = str(tmp_path / f"index{fan}")
        appended(spark, root, 7, fan)
        idx = store.read_index(spark, root, Analyzer())
        listed = store.segments(spark, root)
        assert len(listed) == segments and sum(r["num_docs"] for r in listed) == 14
        hits = rk.search_free_text(q, idx)
        assert sorted(tuple(r) for r in hits.collect()) == sorted(want)
        assert {r.term: r.df for r in idx.term_stats.collect()}["common"] == 14
        assert sorted(r.doc_id for r in idx.documents(hits).collect()) == sorted(r[2] for r in want)
    assert sorted(r["level"] for r in store.segments(spark, str(tmp_path / "index3"))) == [0, 1, 1]


def test_a_writer_that_dies_leaves_the_list(spark, tmp_path, monkeypatch):
    root, an = str(tmp_path / "index"), Analyzer()
    store.write_index(ix.build_index(docs_of(spark, ["alpha beta", "beta"]), an), root)
    before = store.segments(spark, root)

    def dies(*_, **__):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:  # before the commit
        m.setattr(store, "_commit", dies)
        with pytest.raises(RuntimeError):
            store.write_index(ix.build_index(docs_of(spark, ["gamma"]), an), root)
    assert store.segments(spark, root) == before and store.read_index(spark, root, an).postings.count() == 3
    with monkeypatch.context() as m:  # between the commit and the deletion of what it replaced
        m.setattr(store, "drop_folder", dies)
        with pytest.raises(RuntimeError):
            store.write_index(ix.build_index(docs_of(spark, ["gamma"]), an), root)
    assert store.read_index(spark, root, an).postings.count() == 1
    spark.createDataFrame([], store.LIST).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/list/version={99:010d}")
    assert store.read_index(spark, root, an).postings.count() == 1  # a version without its marker isn't one
    store.append_documents(spark, root, docs_of(spark, ["delta"]), an)
    assert store.read_index(spark, root, an).postings.count() == 2


def test_rows_read_follow_the_terms(spark):
    """The postings that a rare word's lookup reads at two sizes of the table."""
    from lectern.plans.fixtures import fixture_analyzer, fixture_docs

    idx = ix.build_index(fixture_docs(spark, SF_SMALL), fixture_analyzer(spark))
    root = store.scratch_root(spark)
    store.write_index(idx, root, buckets=32)
    there = store.read_index(spark, root, fixture_analyzer(spark)).store
    files = there.rows("postings", ["aiment"]).inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in there.table("postings").inputFiles()}) > 20 and files
    got = {(r.doc_id, r.tf) for r in there.rows("postings", ["aiment"]).collect()}
    assert got == {(r.doc_id, r.tf) for r in idx.postings.where("term = 'aiment'").collect()} != set()
