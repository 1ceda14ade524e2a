import hashlib
import math
import re
from zlib import crc32

import numpy as np
import pytest

from lectern.llm import importance as im
from tests.llm.conftest import SMALL, same

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, n_max=2):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, n_max + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, min_words=20, percent=25):
    """(doc_id, n_words, n_features, weight, score, rank) with zlib over each n-gram."""
    count = lambda texts: np.bincount([crc32(f.encode()) % 10_000 for t in texts for f in features(t)[1]] or [0], minlength=10_000)
    s, t = count([x for _, x in docs]), count(target)
    s[0] -= 0 if any(features(x)[1] for _, x in docs) else 1
    t[0] -= 0 if any(features(x)[1] for x in target) else 1
    size, goal = int(s.sum()) + 10_000, int(t.sum()) + 10_000
    gain = [math.floor(1000 * math.log((int(b) + 1) * size / ((int(a) + 1) * goal))) for a, b in zip(s, t)]
    rows = []
    for doc, text in docs:
        n, fs = features(text)
        weight = sum(gain[crc32(f.encode()) % 10_000] for f in fs) // len(fs) if fs else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, n, len(fs), weight, score, None])
    able = sorted((r for r in rows if r[0] is not None and r[1] >= min_words), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("text", ["", "one", "Hello, World!  it's 3.14", "naïve — 日本語 Ünï Öl", "a" * 70_000 + " b " + "cd" * 9000, "x " * 5000 + "\x00\x7f~end"])
def test_crcs_from_prefixes(text):
    for n_max in (1, 2, 3):
        n, crcs = im.ngram_crcs(text.encode(), n_max)
        words, want = features(text, n_max)
        assert (n, crcs.tolist()) == (words, [crc32(f.encode()) for f in want])


def test_shift_is_linear_cancellation():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 255, 256, 257, 1000, 70_000):
        a, b = rng.bytes(int(rng.integers(0, 40))), rng.bytes(n)
        both = np.array([crc32(a + b)], dtype=np.uint32) ^ im.shift(np.array([crc32(a)], dtype=np.uint32), np.array([n]))
        assert both.tolist() == [crc32(b)]


def test_null_text_has_no_words():
    assert im.ngram_crcs(None)[0] == 0 and len(im.ngram_crcs(None)[1]) == 0


def test_brute_force(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    goal = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = im.resample(documents, goal).select("doc", "n_words", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, [r[0] for r in goal.select("text").collect()])


def test_edges(spark, edge, clashing, empty):
    for docs in (edge, clashing):
        got = im.resample(docs, empty, min_words=5).collect()
        want = brute([tuple(r) for r in edge.select("doc_id", "text").collect()], [], min_words=5)
        # repeated rows have equal scores: their ranks may change places
        key = lambda r: tuple(r[:5])
        assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)
        assert sorted(r[5] for r in got if r[5]) == sorted(r[5] for r in want if r[5])
    assert im.resample(empty, edge).collect() == []


def test_query(query, oracle):
    same(query("op12_importance_resampling"), oracle("op12_importance_resampling"))
