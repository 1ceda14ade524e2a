import math
from collections import Counter

import numpy as np
import public_tokenizers

from lectern.llm import kneser_ney as kn
from lectern.llm import language_id as li
from lectern.llm.common import Scratch

PATH = public_tokenizers.path("piece_bpe_32k.model")


def split_sum(vocabulary, word, probs):
    """The sum over all segmentations, one by one."""
    if not word:
        return np.ones(probs.shape[1])
    total = np.zeros(probs.shape[1])
    for k in range(1, len(word) + 1):
        piece = vocabulary.number.get(word[:k])
        if piece is None and k == 1:
            piece = vocabulary.unknown
        if piece is not None:
            total += probs[piece] * split_sum(vocabulary, word[k:], probs)
    return total


def test_forward_sums_all_segmentations():
    v = li.vocabulary(PATH)
    rng = np.random.default_rng(1)
    probs = rng.dirichlet(np.ones(v.size), 3).T
    words = ["▁the", "▁nation", "▁für", "▁日本", "▁a", "▁straße"]
    want = np.log([split_sum(v, w, probs) for w in words])
    assert np.allclose(v.forward(words, probs), want)


def test_expected_counts_are_the_gradient():
    """Expected count of a piece = p * d log-likelihood / dp."""
    v = li.vocabulary(PATH)
    rng = np.random.default_rng(2)
    probs = rng.dirichlet(np.ones(v.size), 1).T
    counts = v.expected(["▁nation"], np.array([0]), np.array([3]), probs)
    for piece in np.flatnonzero(counts[:, 0])[:6]:
        up = probs.copy()
        up[piece] *= 1 + 1e-6
        slope = (v.forward(["▁nation"], up) - v.forward(["▁nation"], probs))[0, 0] / 1e-6
        assert math.isclose(3 * slope, counts[piece, 0], rel_tol=1e-3, abs_tol=1e-6)


def test_words_of_any_length(monkeypatch):
    """One by one in logarithms or many at a time: the same sums and counts, whatever the limit between the two."""
    v = li.vocabulary(PATH)
    probs = np.random.default_rng(3).dirichlet(np.ones(v.size), 2).T
    logs = np.log(probs)
    words = ["▁nation", "▁日本語の本", "▁a", "▁donaudampfschifffahrtsgesellschaft"]
    assert np.allclose([v.forward_long(w, logs) for w in words], v.forward(words, probs))
    assert np.allclose(v.forward_long("▁nation", logs), np.log(split_sum(v, "▁nation", probs)))
    for w in words:
        out = np.zeros_like(probs)
        v.expected_long(w, 1, 3, logs, out)
        assert np.allclose(out, v.expected([w], np.array([1]), np.array([3]), probs))
    texts = ["a donaudampfschifffahrt on the donau", "日本語の本" * 20 + " and 123", "1_2", None]
    want, letters = li.Scorer(PATH, probs).totals(texts)
    monkeypatch.setattr(li, "LONGEST", 4)
    some, same = li.Scorer(PATH, probs).totals(texts)
    assert np.allclose(some, want) and letters.tolist() == same.tolist() == [True, True, False, False]


def test_a_run_too_long_for_a_product():
    """No underflow, and a whole run isn't the sum of its parts: pieces lie over every place."""
    v = li.vocabulary(PATH)
    probs = np.random.default_rng(4).dirichlet(np.ones(v.size), 2).T
    run = "internationale" * 2000
    got = v.forward_long("▁" + run, np.log(probs))
    assert np.isfinite(got).all() and (got < -10_000).all()
    assert not np.allclose(got, sum(v.forward_long("▁" + run[k:k + 31], np.log(probs)) for k in range(0, len(run), 31)))


def test_long_runs_are_learned_from_and_told(spark):
    rows = [(k, "日本語の本を読む" * 12, "ja") if k % 2 else (k, "the people of this country read books", "en") for k in range(40)]
    got = {r.doc: (r.lang_pred, r.score) for r in li.identify(spark.createDataFrame([*rows, (40, "語の本" * 200, None)], "doc_id long, text string, lang string"), PATH).collect()}
    assert all(got[k][0] == lang for k, _, lang in rows) and got[40][0] == "ja" and got[40][1] > 0.99


def test_language_query(query, documents):
    langs = {r.doc_id: r.lang for r in documents.collect()}
    rows = query("op3_language_id")
    held = [r for r in rows if r.held_out]
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_is_not_read_from_held_out_rows(documents):
    from pyspark.sql import functions as F

    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    spoiled = documents.withColumn("lang", F.when(out, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = ({r.doc: r.lang_pred for r in li.identify(d, PATH).collect()} for d in (documents, spoiled))
    assert a == b and "xx" not in a.values()


def test_language_edges(edge, clashing, empty):
    rows = li.identify(edge, PATH).collect()
    assert len(rows) == edge.count()
    assert {(r.lang_pred, r.score) for r in rows if r.doc in (0, 1, 2, 10, 11)} == {("und", 0.0)}
    assert {r.lang_pred for r in rows if r.doc in (6, 7, 8, 9)} == {"en"}
    assert li.identify(clashing, PATH).count() == len(rows)
    assert li.identify(empty, PATH).count() == 0
    from pyspark.sql import functions as F
    unlabelled = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in li.identify(unlabelled, PATH).collect()} == {"und"}


def brute_model(texts):
    """Interpolated modified Kneser-Ney by plain dictionaries: a function (n-gram) -> probability."""
    n = kn.ORDER
    counts = {n: Counter()}
    for t in texts:
        padded = b"\0" * (n - 1) + t
        counts[n].update(padded[k:k + n] for k in range(len(t)))
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off = {}
    for k, c in counts.items():
        of = Counter(c.values())
        off[k] = kn._discounts([of[j] for j in (1, 2, 3, 4)])
    totals = {k: Counter() for k in counts}
    freed = {k: Counter() for k in counts}
    for k, c in counts.items():
        for g, m in c.items():
            totals[k][g[:-1]] += m
            freed[k][g[:-1]] += off[k][min(m, 3) - 1]

    def prob(g):
        k = len(g)
        if not k:
            return 1 / 256
        low, total = prob(g[1:]), totals[k][g[:-1]]
        if not total:
            return low
        m = counts[k][g]
        own = max(0.0, m - off[k][min(m, 3) - 1]) / total if m else 0.0
        return own + max(freed[k][g[:-1]] / total, 1e-9) * low

    return prob


def test_kneser_ney_equals_brute_force(spark, documents):
    docs = documents.where("doc_id < 60").selectExpr("doc_id doc", "lang", "text")
    texts = {r.doc: (r.text or "").encode() for r in docs.collect()}
    trusted = docs.where("doc % 2 = 0")
    prob = brute_model([t for d, t in texts.items() if d % 2 == 0])
    for cache in (kn.CACHE, 300):  # all entries broadcast, and hardly any: the sharded lookup does the rest
        scratch = Scratch(spark, "test")
        entries = kn.train(trusted.select("doc", "text"), scratch)
        scored = kn.score(docs, entries, scratch, cache).collect()
        assert len(scored) == len(texts)
        for r in scored[:12]:
            t = texts[r.doc]
            padded = b"\0" * (kn.ORDER - 1) + t
            bits = [-math.log2(prob(padded[k:k + kn.ORDER])) for k in range(len(t))]
            assert math.isclose(r.perplexity, 2 ** (sum(bits) / len(t)), rel_tol=1e-4)
            assert math.isclose(r.excess, sum(max(0, b - kn.SPIKE) for b in bits) / len(t), rel_tol=1e-3, abs_tol=1e-5)


def test_a_fold_is_left_out_of_its_model(spark, documents):
    docs = documents.where("doc_id < 40").selectExpr("doc_id doc", "lang", "text")
    docs = docs.withColumn("model", kn.fold_of(docs["doc"], 2) + 1)
    rows = docs.collect()
    for cache in (kn.CACHE, 300):
        scratch = Scratch(spark, "test")
        scored = {r.doc: r for r in kn.score(docs, kn.train(docs.select("doc", "text"), scratch, 2), scratch, cache).collect()}
        for m in (1, 2):
            prob = brute_model([(r.text or "").encode() for r in rows if r.model != m])
            own = [r for r in rows if r.model == m and r.text]
            assert own
            for r in own[:4]:
                padded = b"\0" * (kn.ORDER - 1) + r.text.encode()
                bits = [-math.log2(prob(padded[k:k + kn.ORDER])) for k in range(len(padded) - kn.ORDER + 1)]
                assert math.isclose(scored[r.doc].perplexity, 2 ** (sum(bits) / len(bits)), rel_tol=1e-4)


def test_limits_are_not_taken_in_sample(spark, documents, monkeypatch):
    seen = {}

    def caught(scored, trusted, *rest):
        seen.update(whole={r.doc: r.perplexity for r in scored.collect()}, limits={r.doc: r.perplexity for r in trusted.collect()})
        return scored

    monkeypatch.setattr(kn, "verdicts", caught)
    kn.classify(documents.where("doc_id < 60"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    assert len(seen["limits"]) >= 5
    assert np.mean([p > seen["whole"][d] for d, p in seen["limits"].items()]) > 0.9


def test_trusted_documents_are_exact(spark, documents):
    ids = documents.where("doc_id % 3 = 0").select("doc_id")
    got = kn.trusted_documents(documents.selectExpr("doc_id doc", "text"), ids).collect()
    assert sorted(r.doc for r in got) == sorted(r.doc_id for r in ids.collect())


def test_thresholds_are_quantiles(spark):
    rows = [("en", 10, 0.001 * k) for k in range(1, 1001)]
    table = spark.createDataFrame(rows, "lang string, n long, excess double").selectExpr("lang as __lang", "n", "excess")
    assert kn._thresholds(table, "excess", 0.9, ["__lang"], 1).first()["excess_1"] == 0.9
    assert kn._thresholds(table, "excess", 0.9, ["__lang"], 2000).count() == 0


def test_limits_follow_the_length_where_few_are_trusted(spark):
    rng = np.random.default_rng(6)

    def row(doc, lang, size, off):
        return doc, doc, lang, 1 << size, float(2 ** (4 - 0.2 * size + off * 2 ** (-0.25 * size))), 0.0

    trusted = [row(k, "en", size, rng.normal()) for size, many in ((6, 300), (8, 300), (10, 300), (14, 20)) for k in range(many)]
    schema = "uid long, doc long, lang string, n long, perplexity double, excess double"
    asked = [row(k, lang, size, off) for k, (lang, size, off) in enumerate((lang, size, off) for lang in ("en", "xx") for size in (5, 8, 14, 16) for off in (0.0, 12.0))]
    out = kn.verdicts(spark.createDataFrame(asked, schema), spark.createDataFrame(trusted, schema), kn.QUANTILES, kn.LEAST_TRUSTED).collect()
    assert len(out) == len(asked) and all(r.kept == (r.doc % 2 == 0) for r in out)


def test_classifier_tells_labels_apart(query, spark):
    labels = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    rows = query("op7_quality_kneser_ney")
    kept = lambda q, t: [r.kept for r in rows if r.doc_id in labels and (labels[r.doc_id].quality, labels[r.doc_id].toxic) == (q, t)]
    assert np.mean(kept(1, 0)) >= 0.95 and np.mean(kept(0, 0)) <= 0.2


def test_classifier_edges(spark, edge, clashing, empty):
    labels = spark.createDataFrame([(6, 1, 0), (6, 1, 0), (9, None, 0), (None, 1, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    rows = kn.classify(edge, labels).collect()
    assert len(rows) == edge.count() and all(r.kept is not None for r in rows)
    assert {(r.perplexity, r.kept) for r in rows if r.n == 0} == {(1.0, True)}
    assert kn.classify(clashing, labels).count() == len(rows)
    assert kn.classify(empty, labels).count() == 0
    assert all(r.kept for r in kn.classify(edge, labels.limit(0)).collect())
