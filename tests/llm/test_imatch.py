import base64
import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

from lectern.llm import imatch
from lectern.llm.shingles import mixed, word_hashes
from tests.llm.conftest import PROSE

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def lowered(text):
    return bytes(b | 0x20 if 0x41 <= b <= 0x5A else b for b in text.encode())


def words_of(text):
    return set(WORD.findall(lowered(text)))


def brute(rows):
    """The result over (doc, text) rows: words by a pattern, subsets by their definition, one term at a time."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, np.uint64(xxhash.xxh64(r[1].encode(), seed=42).intdigest()).view(np.int64)))
    df = Counter(w for _, t in rows for w in words_of(t))
    n = len(rows)
    edge = max(n / 2000, sum(k for k in df.values() if k >= n / 2000) / imatch.MOST_TERMS)
    band = {w for w, k in df.items() if edge <= k <= n / 10}
    seeds = mixed(np.arange(1, imatch.GROUPS + 1, dtype=np.uint64) * imatch.STEP)
    code, known = {}, {}

    def signature(terms, seed):
        if not terms:
            return 0
        total, power = 0, 1
        for t in sorted(terms):
            power = power * int(imatch.STEP) % 2 ** 64
            total += int(mixed(np.array([(t + seed) % 2 ** 64], dtype=np.uint64))[0]) * power
        return int(mixed(np.array([total % 2 ** 64], dtype=np.uint64))[0]) % 0xFFFF + 1

    def fingerprint(text):
        if text not in known:
            words = words_of(text)
            kept = {code.setdefault(w, int(word_hashes(w)[0])) for w in (words & band or words)}
            kept = kept or {int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "little")}
            out = [signature(kept, 0)]
            dealt = {t: mixed(np.uint64([t]) ^ seeds) for t in kept}
            for j in range(1, imatch.LEVELS + 1):
                out += [signature({t for t in kept if int(dealt[t][g]) % 2 ** j == 0}, j) for g in range(imatch.GROUPS)]
            known[text] = out
        return known[text]

    def near(a, b):
        some = [(x, y) for x, y in zip(a, b) if x or y]
        return sum(x == y for x, y in some) / len(some)

    write = lambda s: base64.b64encode(b"".join(x.to_bytes(2, "big") for x in s)).decode()
    out = []
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % n][1]
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        a, b, c = fingerprint(text), fingerprint(changed), fingerprint(following)
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), write(a), write(b), near(a, b), near(a, c)))
    return sorted(out, key=str)


def compared(docs):
    return sorted(map(tuple, imatch.compare_edited(docs).collect()), key=str)


def test_brute_force(documents):
    """Many parts, so that texts at their ends meet those of other parts."""
    few = documents.where("length(text) < 1500").repartition(7)
    assert compared(few) == brute([tuple(r) for r in few.select("doc_id", "text").collect()])


def test_edges(edge, clashing, empty):
    small = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    want = brute(small)
    assert compared(edge) == want and compared(clashing) == want
    assert compared(empty) == []


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(3, "one two three")], "doc_id long, text string")
    (got,) = imatch.compare_edited(docs).collect()
    assert got["edited_sha256"] == hashlib.sha256(b"one twoone tw").hexdigest() and got["near_next"] == 1.0


def test_equal_texts_and_small_edits():
    rows = imatch.signatures([PROSE.encode(), PROSE.upper().encode(), PROSE.replace("mill", "barn").encode(), b"", b"", b" ", None, b"!"], np.empty(0, np.uint64))
    assert (rows[0] == rows[1]).all() and (rows[3] == rows[4]).all() and (rows[3] == rows[6]).all()
    assert (rows[3] != rows[5]).any() and (rows[5] != rows[7]).any()
    assert 0.3 < imatch.likeness(rows[:1], rows[2:3])[0] < 1 and imatch.likeness(rows[:1], rows[:1])[0] == 1
    assert imatch.likeness(rows[3:4], rows[6:7])[0] == 1


def test_lexicon_is_bounded(spark, documents):
    from lectern.llm.common import Scratch

    scratch = Scratch(spark, "test")
    whole = imatch.lexicon(documents, scratch, largest=1.0)
    small = imatch.lexicon(documents, scratch, largest=1.0, most_terms=1000)
    assert 0 < len(small) <= 1000 < len(whole) and np.isin(small, whole).all()


def test_query_tells_edits_from_neighbours(query):
    rows = [r for r in query("op13_imatch") if r["n_chars"] >= 400]
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.9 * len(rows)
    by_print = {}
    for r in query("op13_imatch"):
        by_print.setdefault(r["fingerprint"], set()).add(r["n_chars"])
    assert len(by_print) > 100
