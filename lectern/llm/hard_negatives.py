"""Hard negatives by exact integer inner products in a residue number system.

A component ``x`` becomes the integer ``floor(scale * x)``.  The inner products
of a block of anchors with all rows are matrix products modulo several small
primes: residues are kept symmetric about 0, so a product over up to
``CHUNK`` components stays under 2^24 and float32 sums it exactly.  The signed
score is put together from its residues by Chinese remaindering (mixed radix
digits, symmetric too).  The primes are as many as the largest possible score
needs, which the norms bound (Cauchy-Schwarz).

An anchor's positives are its ``n_positives`` best other rows of its label; for
each of them the ``n_negatives`` best rows of other labels are taken whose
score lies in the window ``low`` to ``high`` per cent of the positive's.
Higher scores come first, ties by smaller id.

Two passes over the rows for each block of anchors: every task keeps the best
rows of each anchor only, a window merges the tasks' lists.  Anchors are
handled in blocks of about ``block_bytes``, one after the other: a block goes
through the driver to the tasks, and its result is written before the next
one starts, so neither the driver nor a task holds more than one block.

Defined cases: a row with a null id, label or vector, or a null or non-finite
component takes no part; neither does one whose integer vector has a norm of
2^28 or more, as its scores may not fit a long.  An empty vector is
all zeros, a shorter one is filled up with zeros.  Repeated rows each count; a
row with the anchor's id is never its own positive or negative; anchors that
share an id are one anchor (smallest label, then vector).  An empty table, or one
without anchors, gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import Scratch

# Odd primes below 256, largest first; the product of all eight is under 2^63.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
CHUNK = 1024  # 1024 * 125^2 < 2^24: exact in float32
LARGEST_NORM2 = 2.0 ** 56  # scores stay under 2^56, a hundred times as much in 64 bits
TILE = 1 << 21  # scores held at a time
BLOCK_BYTES = 8 << 20
LOW = np.iinfo(np.int64).min
RESULT = "anchor long, positive long, rank int, negative long, positive_score long, negative_score long"


def centred(t: np.ndarray, p: int) -> np.ndarray:
    """t modulo the odd p, nearest to 0 (float32 integers)."""
    return t - np.float32(p) * np.rint(t * np.float32(1 / p))


def primes_for(bound: float) -> tuple[int, ...]:
    """Primes whose product holds all signed integers up to ``bound``."""
    product, out = 1, []
    for p in PRIMES:
        out.append(p)
        product *= p
        if product > 2 * bound + 1:
            return tuple(out)
    raise ValueError(f"scores up to {bound} don't fit")


def residues(q: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """Component matrices of an integer matrix, one for each prime, symmetric about 0."""
    out = []
    for p in primes:
        r = np.mod(q, p)
        out.append((r - p * (r > p // 2)).astype(np.float32))
    return out


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The exact products a . b' as int64, from the residues of both."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        r = np.zeros((len(a[k]), len(b[k])), dtype=np.float32)
        for at in range(0, a[k].shape[1], CHUNK):
            part = a[k][:, at:at + CHUNK] @ b[k][:, at:at + CHUNK].T
            r = centred(r + centred(centred(part, p), p), p)
        for j, d in enumerate(digits):  # mixed radix: the next digit, modulo p
            r = centred((r - d) * np.float32(pow(primes[j], -1, p)), p)
        digits.append(r)
    total = digits[-1].astype(np.int64)
    for p, d in zip(primes[-2::-1], digits[-2::-1]):
        total = total * p + d.astype(np.int64)
    return total


class Best:
    """The k best (score, id) of each of n queries: higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), LOW, dtype=np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)

    def add(self, at: np.ndarray, s: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        """Rows ``s`` (queries x ids, ids ascending) of the queries ``at``; only ``valid`` cells count."""
        k = self.score.shape[1]
        valid = valid & (s >= self.score[at, -1][:, None])
        if valid.sum() > 4 * k * len(at):  # only the k best of each row, with the first k of those that tie with the last of them
            masked = np.where(valid, s, LOW)
            limit = np.partition(masked, s.shape[1] - k, axis=1)[:, -k][:, None] if s.shape[1] > k else np.int64(LOW)
            tied = valid & (masked == limit)
            valid = (valid & (masked > limit)) | (tied & (np.cumsum(tied, axis=1) <= k))
        row, col = np.nonzero(valid)
        if not len(row):
            return
        touched = np.unique(row)
        q = np.concatenate([row, np.repeat(touched, k)])
        score = np.concatenate([s[row, col], self.score[at[touched]].ravel()])
        own = np.concatenate([ids[col], self.id[at[touched]].ravel()])
        order = np.lexsort((own, -np.maximum(score, -np.iinfo(np.int64).max), q))
        q, score, own = q[order], score[order], own[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < k
        self.score[at[q[best]], place[best]] = score[best]
        self.id[at[q[best]], place[best]] = own[best]


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Lists of integers as a matrix, short ones filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(np.asarray(vectors.offsets, dtype=np.int64))
    out = np.zeros((len(vectors), dim), dtype=np.int64)
    out[np.arange(dim) < sizes[:, None]] = np.asarray(vectors.flatten(), dtype=np.int64)
    return out


def _pieces(batches, dim: int, most: int):
    """(ids ascending, labels, matrix) of at most ``most`` rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            ids = np.asarray(part.column(0), dtype=np.int64)
            order = np.argsort(ids, kind="stable")
            yield ids[order], np.asarray(part.column(1), dtype=np.int64)[order], _matrix(part.column(2), dim)[order]


def prepared(rows: DataFrame, id_col: str, vector_col: str, label_col: str | Column, scale: int) -> DataFrame:
    """(id, label, q: integer vector, norm2) of the rows that take part."""
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    row = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))
    row = row.where("id is not null and label is not null and v is not null").where(~F.exists("v", odd))
    row = row.withColumn("d", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    row = row.withColumn("norm2", F.aggregate("d", F.lit(0.0), lambda s, x: s + x * x)).where(F.col("norm2") < LARGEST_NORM2)
    return row.select("id", "label", F.transform("d", lambda x: x.cast("int")).alias("q"), "norm2")


def mine(rows: DataFrame, anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label",
         scale: int = 256, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score).

    ``anchor``: condition on ``id`` that makes a row an anchor.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "negatives")
    own = scratch.keep(prepared(rows, id_col, vector_col, label_col, scale), "vectors")
    anchors = own.where(anchor).groupBy("id").agg(F.min(F.struct("label", "q")).alias("a")).select("id", "a.label", "a.q")
    anchors = scratch.keep(anchors, "anchors")
    size = own.agg(F.max(F.size("q")), F.max("norm2")).first()
    held = anchors.agg(F.count("*"), F.sum(F.size("q") * 4 + 16)).first()
    if not held[0]:
        return spark.createDataFrame([], RESULT)
    dim = max(size[0], 1)
    primes = primes_for(size[1] * (1 + 1e-9) + 1)
    n_blocks = math.ceil(held[1] / block_bytes)
    done = []
    for block in range(n_blocks):
        queries = anchors.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == block).orderBy("label", "id").toArrow()
        if queries.num_rows:
            done.append(scratch.keep(_mine_block(own, queries, dim, primes, n_positives, n_negatives, low, high), f"block{block}").scratch_path)
    return spark.read.schema(RESULT).parquet(*done)


def _mine_block(own: DataFrame, queries: pa.Table, dim: int, primes, n_positives: int, n_negatives: int, low: int, high: int) -> DataFrame:
    """The result for the anchors of one block (sorted by label)."""
    spark = own.sparkSession
    ids, labels = np.asarray(queries.column("id"), dtype=np.int64), np.asarray(queries.column("label"), dtype=np.int64)
    matrix = _matrix(queries.column("q"), dim).astype(np.int32)
    shared = spark.sparkContext.broadcast((ids, labels, matrix))
    most = max(1, min(8192, TILE // dim))
    narrow = own.select("id", "label", "q")

    def positives(batches):
        ids, labels, matrix = shared.value
        parts = residues(matrix, primes)
        best = Best(len(ids), n_positives)
        for row_ids, row_labels, q in _pieces(batches, dim, most):
            for label in np.unique(row_labels):
                first, last = np.searchsorted(labels, [label, label + 1])
                if first == last:
                    continue
                mine = row_labels == label
                rows, there = residues(q[mine], primes), row_ids[mine]
                step = max(1, TILE // len(there))
                for at in range(first, last, step):
                    some = np.arange(at, min(at + step, last))
                    s = scores([m[some] for m in parts], rows, primes)
                    best.add(some, s, there, there != ids[some][:, None])
        query, place = np.nonzero(best.score > LOW)
        yield pa.RecordBatch.from_arrays([pa.array(ids[query]), pa.array(best.score[query, place]), pa.array(best.id[query, place])], names=["anchor", "score", "id"])

    found = narrow.mapInArrow(positives, "anchor long, score long, id long")
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n_positives).toArrow()  # a few rows for each anchor of the block
    where = np.searchsorted(np.sort(ids), np.asarray(found.column("anchor"), dtype=np.int64))
    where = np.argsort(ids, kind="stable")[where]
    goal = spark.sparkContext.broadcast((where, np.asarray(found.column("score"), dtype=np.int64), np.asarray(found.column("id"), dtype=np.int64)))
    slots = len(where)
    under, over = Fraction(low, 100).as_integer_ratio(), Fraction(high, 100).as_integer_ratio()  # small factors: products stay in 64 bits

    def negatives(batches):
        ids, labels, matrix = shared.value
        where, positive_score, positive_id = goal.value
        parts = residues(matrix, primes)
        best = Best(slots, n_negatives)
        by_anchor = np.argsort(where, kind="stable")
        edge = np.searchsorted(where[by_anchor], np.arange(len(ids) + 1))
        for row_ids, row_labels, q in _pieces(batches, dim, most):
            rows = residues(q, primes)
            step = max(1, TILE // len(row_ids))
            for at in range(0, len(ids), step):
                some = np.arange(at, min(at + step, len(ids)))
                s = scores([m[some] for m in parts], rows, primes)
                other = (row_labels != labels[some][:, None]) & (row_ids != ids[some][:, None])
                for k in range(int((edge[some + 1] - edge[some]).max())):  # the anchors' k-th positives
                    has = edge[some] + k < edge[some + 1]
                    slot = by_anchor[edge[some][has] + k]
                    goal_score = positive_score[slot][:, None]
                    mine = s[has]
                    inside = other[has] & (under[0] * goal_score <= under[1] * mine) & (over[1] * mine <= over[0] * goal_score)
                    best.add(slot, mine, row_ids, inside)
        slot, place = np.nonzero(best.score > LOW)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(ids[where[slot]]), pa.array(positive_id[slot]), pa.array(positive_score[slot]), pa.array(best.score[slot, place]), pa.array(best.id[slot, place])],
            names=["slot", "anchor", "positive", "positive_score", "negative_score", "negative"])

    out = narrow.mapInArrow(negatives, "slot long, anchor long, positive long, positive_score long, negative_score long, negative long")
    order = Window.partitionBy("slot").orderBy(F.col("negative_score").desc(), "negative")
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    return out.select("anchor", "positive", "rank", "negative", "positive_score", "negative_score")
