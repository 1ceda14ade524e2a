import random
import re

import pytest

from lectern.llm import near_dup as nd
from lectern.llm.common import Scratch
from lectern.llm.components import components
from lectern.llm.shingles import shingles, word_hashes
from tests.llm.conftest import edge_rows


def sets_of(rows, n):
    out = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        out[doc] = {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    return out


def brute(rows, n=4, percent=80):
    sets = sets_of(rows, n)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def got(df):
    return {r.doc: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_equals_brute_force(query, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in query("op10_near_duplicates")} == brute(rows)


def family(rng, n_docs, n_words, edits, vocabulary):
    base = [rng.choice(vocabulary) for _ in range(n_words)]
    for _ in range(n_docs):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(n_words)] = rng.choice(vocabulary)
        yield " ".join(own)


@pytest.mark.parametrize("edits", [3, 8])
def test_large_groups_of_near_copies(spark, edits):
    """Groups far larger than a small bucket, with pairs on either side of the threshold."""
    rng = random.Random(edits)
    vocabulary = [f"w{k}" for k in range(500)]
    texts = [*family(rng, 120, 100, edits, vocabulary), *family(rng, 60, 80, 2, vocabulary)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts += [f"{' '.join(rng.choice(vocabulary) for _ in range(40))} {passage}" for _ in range(80)]
    rows = [(k, t) for k, t in enumerate(rng.sample(texts, len(texts)))]
    assert got(nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == brute(rows)


def test_index_finds_all_pairs_within_the_threshold(spark):
    """Any signature with at most MAX_ERRORS other symbols shares a key."""
    rng = random.Random(2)
    chunk = lambda s: int.from_bytes(b"".join(x.to_bytes(2, "little") for x in s), "little", signed=True)
    rows, want = [], 40
    for k in range(want):
        sig = [rng.randrange(1 << 16) for _ in range(nd.SYMBOLS)]
        other = list(sig)
        for at in rng.sample(range(nd.SYMBOLS), nd.MAX_ERRORS):
            other[at] ^= 1 + rng.randrange((1 << 16) - 1)
        for rep, s in ((2 * k, sig), (2 * k + 1, other)):
            rows.append((rep, *(chunk(s[4 * j:4 * j + 4]) for j in range(nd.CHUNKS))))
    sets = spark.createDataFrame(rows, "rep long, " + ", ".join(f"{c} long" for c in nd.SIG))
    keys = nd.index_keys(sets)
    a, b = keys.toDF("key", "a"), keys.toDF("key", "b")
    pairs = a.join(b, "key").where("a < b and floor(a / 2) = floor(b / 2)").select("a", "b").distinct()
    assert pairs.count() == want
    assert nd._within(pairs, sets).count() == want


def test_chains_and_ties(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(100)]
    rows, now = [], [rng.choice(words) for _ in range(100)]
    for k in range(40):  # each a near copy of the last: a long chain
        rows.append((40 - k, " ".join(now)))
        for _ in range(2):
            now[rng.randrange(100)] = rng.choice(words)
    rows += [(200, "a b c"), (201, "A  B C"), (202, "a b"), (203, "a b c d"), (204, "a b c d e")]
    assert got(nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_components_of_random_links(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 580)]
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    out = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"))
    assert {r.node: r.component for r in out.collect()} == {x: find(x) for p in links if p[0] != p[1] for x in p}


def test_shingle_hashes(monkeypatch):
    text = "One two\tTHREE  four\x0bfive é日 six one two three four".encode()
    whole = word_hashes(text)
    assert len(whole) == 12 - 1 and whole[0] == whole[7] and len(set(whole.tolist())) == 7
    monkeypatch.setattr("lectern.llm.shingles.SLICE", 5)
    assert (word_hashes(text) == whole).all()
    assert len(shingles(text, 4)) == 7 and len(shingles(b"a b", 4)) == 1 and len(shingles(None, 4)) == 0


def test_edges(edge, clashing, empty):
    rows = [(r[0], r[1]) for r in edge_rows() if r[0] is not None]
    out = nd.near_duplicates(edge).collect()
    assert len(out) == len(edge_rows())
    assert {r.doc: (r.n_shingles, r.component_id, r.kept) for r in out if r.doc is not None} == brute(rows)
    assert all(r.kept and r.component_id is None for r in out if r.doc is None)
    assert nd.near_duplicates(clashing).count() == len(out)
    assert nd.near_duplicates(empty).count() == 0
