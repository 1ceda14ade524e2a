import hashlib
import random
import re

import numpy as np

from lectern.llm import pii

# the base patterns as they are given
PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
CARD = "4465758382889437"


def brute(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p.lstrip("0") or 0) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                twice = [int(c) * 2 if k % 2 else int(c) for k, c in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(x - 9 if x > 9 else x for x in twice) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def listed(text):
    return [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(text)]


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    signs = ["a", "B", "@", ".", "-", "+", "1", "23", "256", " ", "(", ")", "é", "%", "_", "\n", CARD[:5], "x.y", "@b.c"]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(30)))
        assert listed(text) == brute(text), text


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1.2.3 " * 50_000, "+1" + "(" * 300_000, "9 " * 100_000):
        pii.base_spans(text)


def test_query(query, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in query("op9_pii_skip_chain"):
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]
        got = r.spans.split(",") if r.spans else []
        assert set(want) <= set(got)
        assert got == sorted(got, key=lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))


def test_messages_on_a_tree_are_exact():
    """Without circles, message passing gives the exact marginals."""
    rng = np.random.default_rng(4)
    shapes = [(k,) for k in range(5)]
    field = pii.Field({(0, k): rng.normal(size=5) for k in range(5)}, [rng.normal(size=(5, 5)) for _ in range(2)])
    field.pairs = [p + p.T for p in field.pairs]
    chain, skip = np.array([(0, 1), (1, 2)]), np.array([(0, 3), (2, 4)])
    graph = pii.Graph([(0, k, k + 1) for k in range(5)], shapes, np.array([0, 0, 0, 2, 0]), np.zeros(5, bool), chain, skip)
    joint = np.zeros([5] * 5)
    for at in np.ndindex(*joint.shape):
        if at[3] == 2:
            joint[at] = np.exp(sum(field.weights[0, k][at[k]] for k in (0, 1, 2, 4)) + sum(field.pairs[0][at[u], at[v]] for u, v in chain) + sum(field.pairs[1][at[u], at[v]] for u, v in skip))
    joint /= joint.sum()
    got = field.marginals(graph, rounds=200)
    for k in range(5):
        assert np.allclose(got[k], joint.sum(axis=tuple(x for x in range(5) if x != k)), atol=1e-5)


def test_the_field_adds_repeated_and_hidden_mentions(spark):
    noise = [f"page {k} of {k + 7} in 19{k % 100:02d}" for k in range(40)]
    docs = [(k, f"call +1 ({200 + k}) 555-{1000 + k} or +1 ({200 + k}) 555-{1000 + k}, write a{k}@x.org from 10.0.0.{k}, card {CARD}. {noise[k % 40]}") for k in range(60)]
    docs += [(100, f"cards {CARD} {CARD} side by side"), (101, "call +1 (743) 555-3824 now, later (743) 555-3824 again"), (102, "only 1234567890123456 and 4.0 here")]
    docs += [(200 + k, x) for k, x in enumerate(noise)]
    texts = dict(docs)
    out = {r.doc: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    said = lambda d: [(s.kind, texts[d][s.start:s.end]) for s in out[d].added]
    assert [k for k, _ in said(100)] == ["card", "card"] or said(100) == [("card", f"{CARD} {CARD}")]
    assert ("phone", "(743) 555-3824") in said(101)
    assert not any(out[d].added for d in texts if d == 102 or d >= 200)


def test_evidence_reaches_all_mentions_of_a_document(spark):
    docs = [(k, f"call +1 ({200 + k}) 555-{1000 + k} or +1 ({200 + k}) 555-{1000 + k}, page {k} of {k + 7}") for k in range(60)]
    short = " then ".join(["(743) 555-3824"] * 50)
    docs += [(100, f"call +1 (743) 555-3824 now, later {short} again"), (101, f"first {short} and then +1 (743) 555-3824")]
    out = {r.doc: r for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    texts = dict(docs)
    for d in (100, 101):
        assert [texts[d][s.start:s.end] for s in out[d].added if s.kind == "phone"] == ["(743) 555-3824"] * 50


def test_settled_messages_equal_many_rounds():
    rng = np.random.default_rng(5)
    pair = np.eye(5) * 2
    n = 300
    field = pii.Field({(0, k): rng.normal(size=5) * 0.3 for k in range(9)}, [pair, pair])
    links = np.array([(k, k + 1) for k in range(n - 1)])
    known = np.zeros(n, dtype=np.int64)
    known[0] = 4
    graph = pii.Graph([(0, k, k + 1) for k in range(n)], [(k % 9,) for k in range(n)], known, known > 0, links, np.zeros((0, 2), dtype=np.int64))
    assert np.allclose(field.marginals(graph), field.marginals(graph, rounds=3000), atol=1e-4)
    assert field.reached(graph)[:, 4].all() and not field.reached(graph)[:, :4].any()


def test_edges(edge, clashing, empty):
    rows = pii.find(edge).collect()
    assert len(rows) == edge.count() and all(r.base is not None and r.added is not None for r in rows)
    assert len(next(r for r in rows if r.doc == 10).base) == 3000
    assert pii.find(clashing).count() == len(rows) and pii.find(empty).count() == 0
