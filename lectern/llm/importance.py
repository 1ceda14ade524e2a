"""Target-distribution importance resampling with n-grams hashed by prefix CRCs.

A text is normalised once: A-Z lower-cased, words joined by one blank.  One
scan stores the running CRC-32 before and after every word.  The CRC of any
run of words then follows from two of these prefixes: appending L bytes to a
prefix shifts its CRC by x^(8L) over GF(2), so shifting the earlier prefix
and cancelling it from the later one leaves the run's own CRC.  No n-gram is
ever built as a string.

Features are the runs of 1 to ``n_max`` words, hashed into ``buckets``.  The
raw corpus and the target are counted by bucket (each task adds up its own
counts), a bucket's gain is the scaled log ratio of its smoothed shares, a
document's weight the floored mean of its features' gains, and Gumbel noise
from a hash of the id turns the largest scores into a draw without
replacement in proportion to exp(weight / 1000).

Ranks come from a range-dealt sort with the parts' row counts, so no task
ever holds all documents.

Defined cases: a null text has no words, and a document without features the
weight 0; a row with a null id is counted in the corpus, has no score and is
never drawn (nor counted among those that could be); repeated rows each count
and have the same score, their ranks are in any order; an empty table gives
an empty result, an empty target gains of the corpus alone.  Texts of any
length are scanned whole.  Other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import Scratch

BUCKETS, N_MAX, MIN_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, 7
POLYNOMIAL = 0xEDB88320  # of CRC-32, reflected
SHORT = 256  # shifts by fewer bytes have a table of their own
#: A-Z to a-z; digits, a-z and what lies beyond ASCII stay; the rest are blanks.
WORD_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _byte_table() -> np.ndarray:
    """What one more byte does to a CRC register."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return t


BYTE = _byte_table()


@functools.lru_cache(maxsize=1)
def _short_shifts() -> np.ndarray:
    """[length, byte place, byte]: the register with that byte alone, shifted by ``length`` zero bytes."""
    out = np.empty((SHORT, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    for n in range(1, SHORT):
        out[n] = BYTE[out[n - 1] & np.uint32(255)] ^ (out[n - 1] >> np.uint32(8))
    return out


def _apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map of registers, given by its tables for the four bytes."""
    return table[0][c & 255] ^ table[1][(c >> 8) & 255] ^ table[2][(c >> 16) & 255] ^ table[3][c >> 24]


@functools.lru_cache(maxsize=64)
def _doubled(k: int) -> np.ndarray:
    """Shift by SHORT * 2^k bytes."""
    if k == 0:
        last = _short_shifts()[SHORT - 1]
        return BYTE[last & np.uint32(255)] ^ (last >> np.uint32(8))
    half = _doubled(k - 1)
    return _apply(half, half)


def shift(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The registers ``c`` shifted by ``n`` zero bytes each."""
    tables, near = _short_shifts().reshape(-1), (n % SHORT) * 1024
    c = c.astype(np.int64)
    out = tables[near + (c & 255)] ^ tables[near + 256 + ((c >> 8) & 255)] ^ tables[near + 512 + ((c >> 16) & 255)] ^ tables[near + 768 + (c >> 24)]
    far, k = n // SHORT, 0
    while far.any():
        odd = np.flatnonzero(far & 1)
        out[odd] = _apply(_doubled(k), out[odd])
        far, k = far >> 1, k + 1
    return out


def prefix_crcs(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(CRC before each word, CRC after it, byte length) of the normalised text, a blank before each word."""
    words = (text or b"").translate(WORD_BYTES).split()
    if not words:
        return np.empty(0, np.uint32), np.empty(0, np.uint32), np.empty(0, np.int64)
    spaced = (b" " + b" ".join(words)).replace(b" ", b"\n ").split(b"\n")[1:]
    running = np.fromiter(accumulate(spaced, lambda c, w: crc32(w, c), initial=0), np.uint32, len(words) + 1)
    before = ~running[:-1]  # the register; then the blank goes in
    before = ~(BYTE[(before ^ np.uint32(0x20)) & np.uint32(255)] ^ (before >> np.uint32(8)))
    return before, running[1:], np.fromiter(map(len, words), np.int64, len(words))


def ngram_crcs(text: bytes | None, n_max: int = N_MAX) -> tuple[int, np.ndarray]:
    """(number of words, CRC-32 of each run of 1 to ``n_max`` words joined by a blank)."""
    before, after, sizes = prefix_crcs(text)
    ends = np.cumsum(sizes + 1)  # with the blank before each word
    out = []
    for n in range(1, min(n_max, len(sizes)) + 1):
        first, last = slice(0, len(sizes) - n + 1), slice(n - 1, None)
        length = ends[last] - (ends[first] - sizes[first])
        out.append(after[last] ^ shift(before[first], length))
    return len(sizes), np.concatenate(out) if out else np.empty(0, np.uint32)


def bucket_counts(docs: DataFrame, text_col: str = "text", n_max: int = N_MAX, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all texts by bucket; a task gives a row for each bucket at most."""
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for at in range(0, len(texts), 256):
                found = [ngram_crcs(t, n_max)[1] for t in texts.slice(at, 256).to_pylist()]
                total += np.bincount(np.concatenate(found) % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    parts = docs.select(F.col(text_col).cast("string").alias("t")).where("t is not null").mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the log ratio of the target's to the raw corpus' smoothed share, floored."""
    size, goal = int(raw.sum()) + len(raw), int(target.sum()) + len(target)
    ratio = lambda s, t: float((t + 1) * size) / float((s + 1) * goal)
    return np.array([math.floor(1000 * math.log(ratio(int(s), int(t)))) for s, t in zip(raw, target)], dtype=np.int64)


def _by_bucket(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, dtype=np.int64)
    for row in counts.collect():  # a row for each bucket at most
        out[row["bucket"]] = row["n"]
    return out


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", n_max: int = N_MAX) -> DataFrame:
    """(doc, n_words, n_features, weight) of every row."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, batch.num_rows, 1024):
                rows = []
                for text in texts.slice(at, 1024).to_pylist():
                    n_words, crcs = ngram_crcs(text, n_max)
                    total = int(gain[crcs % len(gain)].sum())
                    rows.append((n_words, len(crcs), total // len(crcs) if len(crcs) else 0))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1024), *columns], names=["doc", "n_words", "n_features", "weight"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("t"))
    return narrow.mapInArrow(run, "doc long, n_words long, n_features long, weight long")


def noise(doc, seed: int = SEED):
    """1000 times a Gumbel number from a hash of the id, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def ranked(rows: DataFrame, scratch: Scratch, *order) -> DataFrame:
    """``rows`` (of a written table) with their place from 1 in ``order``.

    The rows are dealt by range, sorted part by part and written; a part's
    first place is the number of rows in the parts before it, one number each.
    """
    number = F.monotonically_increasing_id()
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.keep(placed.select("*", F.shiftright(number, 33).alias("part"), number.bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "sorted")
    counts = placed.groupBy("part").agg(F.count("*").alias("size"))
    first = counts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("first"))
    return placed.join(first, "part").withColumn("rank", F.col("first") + F.col("at") + 1).drop("part", "first", "at", "size")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", n_max: int = N_MAX,
             buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc, n_words, n_features, weight, score, rank): rank from 1 for the drawn ones, else null."""
    scratch = Scratch(docs.sparkSession, "importance")
    raw = _by_bucket(bucket_counts(docs, text_col, n_max, buckets), buckets)
    goal = _by_bucket(bucket_counts(target, target_col, n_max, buckets), buckets)
    weighed = weigh(docs, gains(raw, goal), id_col, text_col, n_max)
    scored = scratch.keep(weighed.withColumn("score", F.col("weight") + noise(F.col("doc"), seed)), "scored")
    able = (F.col("n_words") >= min_words) & F.col("doc").isNotNull()
    n = percent * scored.where(able).count() // 100
    places = ranked(scored.where(able), scratch, F.col("score").desc(), F.col("doc").asc())
    drawn = places.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return drawn.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
