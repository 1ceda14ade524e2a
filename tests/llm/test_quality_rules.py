import re
from collections import Counter

import numpy as np

from lectern.llm import quality_rules as qr
from tests.llm.conftest import edge_rows

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times, inside = Counter(windows), set()
    for k, x in enumerate(windows):
        if times[x] > 1:
            inside.update((k, k + 1, k + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w))


def brute(rows):
    """The whole method in numpy: {id: squared distance} of rows (id, lang, source, text) that pass the base rules."""
    groups = {}
    for doc, lang, source, text in rows:
        n, chars, symbols, lines, repeats, failed = base(text)
        if not failed:
            n_lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) for line in text.split("\n"))
            shares = [np.arcsin(np.sqrt(x)) for x in (symbols / chars, lines / (n_lines + qr.MORE_LINES), repeats / n)]
            groups.setdefault((lang, source), []).append((doc, [np.log(n), np.log(chars / n), *shares]))
    floor = np.array(list(qr.FLOORS.values()))
    out = {}

    def fit(cores, factor):
        """Per group (mean, root of the covariance)."""
        means, covs = [c.mean(0) for c in cores], [np.cov(c.T, bias=True).reshape(5, 5) for c in cores]
        within = sum(len(c) * v.diagonal() for c, v in zip(cores, covs)) / sum(map(len, cores))
        roots = []
        for c, v in zip(cores, covs):
            w = len(c) / (len(c) + qr.PRIOR)
            v, root = factor * (w * v + (1 - w) * np.diag(within)), np.zeros((5, 5))
            for i in range(5):
                for j in range(i):
                    root[i, j] = (v[i, j] - root[i, :j] @ root[j, :j]) / root[j, j]
                root[i, i] = max(v[i, i] - root[i, :i] @ root[i, :i], floor[i] ** 2) ** 0.5
            roots.append(root)
        return list(zip(means, roots))

    def far(x, mean, root):
        return (np.linalg.solve(root, (x - mean).T) ** 2).sum(0)

    def lower_median(v):
        return np.sort(v)[(len(v) + 1) // 2 - 1]

    def core(x, d2):
        step = np.floor(16 * np.log2(d2 + 1e-6))
        return x[step <= np.sort(step)[int(np.ceil(qr.CORE * len(step))) - 1]]

    every, d2 = [np.array([v for _, v in own]) for own in groups.values()], []
    for x in every:
        steps = np.floor(np.abs(x) * 64 + 0.5) * np.sign(x)
        mid = np.array([lower_median(c) for c in steps.T])
        mad = np.array([lower_median(c) for c in np.abs(steps - mid).T])
        d2.append((((x - mid / 64) / np.maximum(1.4826 * mad / 64, floor)) ** 2).sum(1))
    was = None
    for _ in range(qr.STEPS):
        found = fit([core(x, d) for x, d in zip(every, d2)], qr.CORE_FACTOR)
        d2 = [far(x, *f) for x, f in zip(every, found)]
        now = np.array([2 * np.log(root.diagonal()).sum() for _, root in found])
        if was is not None and (was - now).max() < qr.SETTLED:
            break
        was = now
    near = [x[d <= qr.FINAL_LIMIT] for x, d in zip(every, d2)]
    for own, x, f in zip(groups.values(), every, fit(near, qr.FINAL_FACTOR)):
        out.update(zip([doc for doc, _ in own], far(x, *f)))
    return out


def test_query_equals_brute_force(query, documents):
    rows = [(r.doc_id, r.lang, r.source, r.text) for r in documents.collect()]
    want = brute(rows)
    got = {r.doc_id: r for r in query("op4_quality_rules")}
    for doc, _, _, text in rows:
        assert tuple(got[doc][c] for c in COLUMNS) == base(text)
        if doc in want:
            assert np.isclose(got[doc].distance, want[doc], rtol=1e-3, atol=1e-3)
            assert got[doc].kept == (want[doc] <= qr.CUTOFF)
        else:
            assert got[doc].distance is None and not got[doc].kept


def test_repeats(spark):
    texts = ["a b c a b c a", "a a a a a", "a b c d e f", "x y", "", None, "a b c x a b c d a b c", "p q r s p q r s p"]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r in qr.base_counts(table).collect():
        assert tuple(r[c] for c in COLUMNS) == base(texts[r.id])


def test_an_outlier_among_many_is_found(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 9)))
    rows = [(k, " ".join(word() for _ in range(rng.integers(80, 300))), "en", "s") for k in range(200)]
    rows += [(1000 + k, " ".join(word() + "***" for _ in range(150)), "en", "s") for k in range(30)]
    got = {r.doc: r.kept for r in qr.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + k] for k in range(30)) and sum(got[k] for k in range(200)) >= 199


def test_each_statistic_rejects_alone(spark):
    rng = np.random.default_rng(5)
    word = lambda n=0: "".join(rng.choice(list("abcdefghijkl"), n or rng.integers(3, 9)))
    text = lambda n, size=0: "\n".join(" ".join(word(size) for _ in range(10)) for _ in range(n // 10))
    rows = [(k, text(int(rng.integers(8, 30)) * 10), "en", "s") for k in range(400)]
    planted = {"size": text(20000), "length": text(200, 16)}
    planted["symbols"] = text(200).replace("a", "#").replace("b", "#")
    once = word(6)  # duplicate lines of two words, so that no window of three repeats
    planted["lines"] = "\n".join(f"{word(7)}{k} {word(7)}{k}\n{once}" for k in range(60))
    one = text(190).split()
    planted["repeats"] = " ".join(one[:100] + ["other"] + one[:56] + one[100:])  # 112 of 247 words
    rows += [(1000 + k, t, "en", "s") for k, t in enumerate(planted.values())]
    got = {r.doc: r for r in qr.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    for k, name in enumerate(planted):
        assert not got[1000 + k].base_failed and not got[1000 + k].kept, name
    assert sum(got[k].kept for k in range(400)) >= 399


def test_edges(edge, clashing, empty):
    rows = qr.judge(edge).collect()
    want = sorted((repr(r[0]), base(r[1])) for r in edge_rows())
    assert sorted((repr(r.doc), tuple(r[c] for c in COLUMNS)) for r in rows) == want
    assert all(r.kept is not None for r in rows)
    assert qr.judge(clashing).count() == len(rows)
    assert qr.judge(empty).count() == 0
