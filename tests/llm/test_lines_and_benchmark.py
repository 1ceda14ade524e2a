import random

from lectern.llm import decontaminate as dc
from lectern.llm import line_dedup as ld
from tests.llm.conftest import same

LONG = "this line is long enough to be a key of its own in the table"


def test_line_dedup_equals_sql(query, oracle):
    same(query("op5_line_dedup"), oracle("op5_line_dedup"))


def test_line_dedup_keeps_the_last_and_short_lines(spark):
    rows = [(k, f"short\n {LONG.upper()} \nown {k}") for k in range(6)]
    out = {r.doc_id: r for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[5].text == rows[5][1] and out[5].n_dropped == 0
    assert all(out[k].text == f"short\nown {k}" and out[k].n_lines == 3 for k in range(5))


def test_line_dedup_under_five_documents_nothing_goes(spark):
    rows = [(k, f"{LONG}\n{LONG}") for k in range(4)]
    assert all(r.n_dropped == 0 for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_line_runs_do_not_depend_on_batches(documents):
    one, many = (ld.dedup_lines(documents.select("doc_id", "text"), batches=b, fan=2) for b in (1, 7))
    assert sorted(one.collect()) == sorted(many.collect())


def test_runs_hold_totals(spark):
    from lectern.llm.common import Scratch

    runs = ld.LineRuns(Scratch(spark, "test"), fan=2)
    rng = random.Random(1)
    rows = [(rng.randrange(20), 0, k) for k in range(100)] + [(100 + k, 0, k) for k in range(100)]
    told = {}
    for b in range(5):
        batch = [r for r in rows if r[2] % 5 == b]
        run = runs.add(spark.createDataFrame(batch, "k1 long, k2 long, doc long"))
        for k, _, doc in batch:
            n, last = told.get(k, (0, -1))
            told[k] = (n + 1, max(last, doc))
        got = {r.k1: (r.n, r.last) for r in run.collect()} if b not in (1, 3) else None  # compacted at once: the run is gone
        assert got is None or got == {k: told[k] for k in {r[0] for r in batch}}
    assert [len(level) for level in runs.levels] == [1, 0, 1]  # two compactions into level 1, one into level 2
    assert {r.k1: (r.n, r.last) for r in runs.held_by(1).collect()} == told
    assert {r.k1: (r.n, r.last) for r in runs.held_by(4).collect()} == {k: v for k, v in told.items() if v[0] >= 4}


def test_a_line_that_all_documents_hold(spark, monkeypatch):
    rows = [(k, f"{LONG}\n{LONG} {k % 7} of seven\nown {k}") for k in range(70)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (1, 5, 4096):  # no, some and all keys go through the broadcast
        monkeypatch.setattr(ld, "HOT", hot)
        out = {r.doc_id: r for r in ld.dedup_lines(table).collect()}
        for k in range(70):
            assert out[k].n_dropped == (k < 69) + (k < 63)
            assert out[k].text.split("\n")[-1] == f"own {k}"


def test_line_dedup_edges(edge, clashing, empty):
    out = ld.dedup_lines(edge).collect()
    assert len(out) == edge.count() and all(r.text is not None for r in out)
    assert {r.n_lines for r in out if r.doc_id in (0, 1)} == {1}
    assert ld.dedup_lines(clashing).count() == len(out)
    assert ld.dedup_lines(empty).count() == 0


def test_decontaminate_equals_sql(query, oracle):
    same(query("op6_decontaminate"), oracle("op6_decontaminate"))


def brute(text, items, n=10):
    words = dc.words_of(text.encode())
    hit, found = set(), set()
    for item, t in items:
        own = dc.words_of(t.encode())
        for at in range(max(1, len(own) - n + 1) if own else 0):
            gram = own[at:at + n]
            for k in range(len(words) - len(gram) + 1):
                if words[k:k + len(gram)] == gram:
                    hit.update(range(k, k + len(gram)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


def test_blocks_of_items_find_the_same(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcde")
    items = [(str(k), " ".join(word() for _ in range(rng.choice([0, 2, 3, 12, 15])))) for k in range(12)]
    docs = [(k, " ".join(word() for _ in range(60)) + " " + rng.choice(items)[1]) for k in range(20)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for most in (10, 10_000):
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in dc.scan_documents(table, bench, max_words=most).collect()}
        assert got == {k: brute(t, items) for k, t in docs}


def test_cut_removes_what_a_cut_joins(spark):
    item = "a b c d e f g h i j"
    docs = spark.createDataFrame([(1, f"start a b c {item.upper()} d e f g h i j end")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    text = dc.scan_documents(docs, bench, remove_spans=True).first().text
    assert text.split() == ["start", "end"]


def test_decontaminate_edges(spark, edge, clashing, empty):
    bench = spark.createDataFrame([(1, "lazy dog"), (1, "lazy dog"), (None, "fox jumps"), (3, None), (4, "")], "item_id long, text string")
    got = dc.scan_documents(edge, bench, remove_spans=True).collect()
    assert len(got) == edge.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].n_words == 0 and by_id[6]["items"] == ["", "1"] and by_id[6].n_hit == 4
    assert dc.scan_documents(clashing, bench).count() == len(got)
    assert dc.scan_documents(empty, bench).count() == 0
    assert all(r.n_hit == 0 for r in dc.scan_documents(edge, bench.limit(0)).collect())
