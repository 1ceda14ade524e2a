"""MinHash near-duplicates through a multi-index Hamming join.

A document's signature is 64 symbols of 16 bits: one per hash function, the
b-bit digest of the smallest shingle hash.  Documents of similarity 0.8
differ in 13 symbols on average and in more than ``MAX_ERRORS`` = 29 with
probability 1e-6.  The signature is split into 16 chunks of four symbols; by
the pigeonhole principle two signatures within 31 errors have a chunk with at
most one error, so each document is entered under every chunk with each one
of its symbols left out: 64 keys, which find all pairs within the threshold.

Bounded work at any skew:

* documents of equal shingle sets are one class from the start;
* every bucket links its members to its smallest member (a star), and small
  buckets compare all their members; candidates within the threshold are
  confirmed on their full shingle sets and joined into components;
* a large bucket whose members then still lie in several components goes an
  exact way: its documents are joined on their rarest shingles, of which
  similar sets must share one (prefix filter), and compared across components.
  These documents alone get a finer signature, of 2048 single bits, whose
  Hamming distance is a condition of that join: sets that are alike but under
  the similarity don't become rows.

Nothing is capped or sampled, and no links or components reach the driver.

Defined cases: a null or empty text, or one without words, has an empty set
and is linked with nothing; with fewer words than a shingle the whole sequence
is one; repeated rows are copies; rows with a null id are linked with nothing
and kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import Scratch
from lectern.llm.components import components
from lectern.llm.shingles import mixed, share, shingles

SYMBOLS, CHUNKS, LANES, MAX_ERRORS = 64, 16, 4, 29
SMALL_BUCKET = 16
FACTORS = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SIG = [f"s{j}" for j in range(CHUNKS)]
BITS = 2048
BIT_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FINE = [f"b{j}" for j in range(BITS // 64)]
SET = ["h1", "h2", "n"]


def signature(hashes: np.ndarray) -> np.ndarray:
    """The 16 chunks, four 16-bit symbols in each, of a non-empty set."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 4096):
        least = np.minimum(least, np.multiply.outer(hashes[at:at + 4096], FACTORS).min(axis=0))
    return (mixed(least) >> np.uint64(48)).astype("<u2").view("<i8")


def fine_signature(hashes: np.ndarray) -> np.ndarray:
    """One bit of each of 2048 smallest hashes, as 32 numbers."""
    least = np.full(BITS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 128):
        least = np.minimum(least, np.multiply.outer(hashes[at:at + 128], BIT_FACTORS).min(axis=0))
    return np.packbits((mixed(least) >> np.uint64(63)).astype(bool)).view("<i8")


def fine_errors(percent: int) -> int:
    """The distance that sets of the similarity exceed with probability 1e-7: bits differ half as often as smallest hashes."""
    p = (1 - percent / 100) / 2
    return int(BITS * p + 5.2 * (BITS * p * (1 - p)) ** 0.5) + 1


def signatures(docs: DataFrame, id_col: str, text_col: str, n_words: int) -> DataFrame:
    """(doc, n, h1, h2: hash of the set, s0 .. s15), one row per document."""
    names = ["doc", "n", "h1", "h2", *SIG]
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, batch.num_rows, 256):
                part = texts.slice(at, 256).to_pylist()
                out = np.zeros((len(part), 3 + CHUNKS), dtype=np.int64)
                for k, text in enumerate(part):
                    hashes = shingles(text, n_words)
                    out[k, 0] = len(hashes)
                    if len(hashes):
                        out[k, 1:3] = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), dtype="<i8")
                        out[k, 3:] = signature(hashes)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), *(pa.array(out[:, c]) for c in range(3 + CHUNKS))], schema=schema)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("t"))
    return narrow.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def index_keys(sets: DataFrame) -> DataFrame:
    """(key, rep): each set under every chunk with each one of its symbols left out."""
    keys = []
    for j, chunk in enumerate(SIG):
        for lane in range(LANES):
            hole = _signed(~(0xFFFF << 16 * lane) & (1 << 64) - 1)
            keys.append(F.col(chunk).bitwiseAND(F.lit(hole)).bitwiseOR(F.lit(_signed(j * LANES + lane << 16 * lane))))
    return sets.select(F.explode(F.array(*keys)).alias("key"), "rep")


def errors(a: str, b: str) -> F.Column:
    """In how many symbols two signatures differ: the 16-bit lanes of the xor that aren't zero."""
    lanes, total = 0x0001000100010001, F.lit(0)
    for c in SIG:
        x = F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x3FFF * lanes))  # each lane folds into its lowest 14 bits
        total = total + F.bit_count((x + F.lit(0x3FFF * lanes)).bitwiseAND(F.lit(0x4000 * lanes)))  # 1 or more carries into bit 14
    return total


def _within(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) within the signature threshold."""
    pairs = pairs.distinct()
    x = pairs.join(sets.select(F.col("rep").alias("a"), F.struct(*SIG).alias("x")), "a")
    y = x.join(sets.select(F.col("rep").alias("b"), F.struct(*SIG).alias("y")), "b")
    return y.where(errors("x", "y") <= MAX_ERRORS).select("a", "b")


class NearDup:
    """The steps of one run; every table of theirs is written to the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, n_words: int, percent: int):
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
        self.n_words, self.percent = n_words, percent
        self.scratch = Scratch(docs.sparkSession, "near")
        self.rows = self.scratch.keep(signatures(docs, id_col, text_col, n_words), "signatures")
        sets = (self.rows.where("n > 0 and doc is not null").groupBy(*SET)
                .agg(F.min("doc").alias("rep"), *(F.min(c).alias(c) for c in SIG)))
        self.sets = self.scratch.keep(sets, "sets")

    def texts(self, ids: DataFrame) -> DataFrame:
        """(doc, text) of these representatives; of rows that share an id, the row that was chosen."""
        wanted = self.sets.join(ids.distinct(), "rep", "left_semi").select(F.col("rep").alias("doc"), "h1", "h2")
        found = self.docs.join(wanted.hint("merge"), "doc")  # never broadcast: it grows with the documents
        n_words = self.n_words

        def run(batches):
            for batch in batches:
                h1, h2 = batch.column("h1").to_pylist(), batch.column("h2").to_pylist()
                keep = []
                for k in range(batch.num_rows):
                    text = batch.column("text")[k].as_py()
                    digest = xxhash.xxh3_128_digest(shingles(text.encode() if text else None, n_words).tobytes())
                    keep.append(digest == h1[k].to_bytes(8, "little", signed=True) + h2[k].to_bytes(8, "little", signed=True))
                yield batch.select(["doc", "text"]).filter(pa.array(keep, pa.bool_()))

        same = found.mapInArrow(run, "doc long, text string")
        return self.scratch.keep(same.groupBy("doc").agg(F.any_value("text").alias("text")), "texts")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full shingle sets are similar enough."""
        pairs = self.scratch.keep(pairs, "pairs")
        texts = self.texts(pairs.select(F.explode(F.array("a", "b")).alias("rep")))
        x = pairs.hint("merge").join(texts.select(F.col("doc").alias("a"), F.col("text").alias("x")), "a")
        y = x.hint("merge").join(texts.select(F.col("doc").alias("b"), F.col("text").alias("y")), "b")
        n_words, percent = self.n_words, self.percent

        def run(batches):
            last, other = None, None
            for batch in batches:
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                xs, ys = batch.column("x").cast(pa.binary()), batch.column("y").cast(pa.binary())
                linked = []
                for k in range(batch.num_rows):
                    if b[k] != last:  # rows come sorted by b where the join sorted them
                        last, other = b[k], shingles(ys[k].as_py(), n_words)
                    both, union = share(shingles(xs[k].as_py(), n_words), other)
                    linked.append(100 * both >= percent * union)
                yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

        return self.scratch.keep(y.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "confirmed")

    def buckets(self) -> DataFrame:
        """(key, rep, n, pivot): the members of every bucket of two or more."""
        keys = index_keys(self.sets)
        stats = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("pivot")).where("n > 1")
        return self.scratch.keep(keys.join(stats, "key"), "members")

    def candidates(self, members: DataFrame) -> DataFrame:
        star = members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
        small = members.where(F.col("n").between(3, SMALL_BUCKET)).select("key", "rep")
        pairs = (small.select("key", F.col("rep").alias("a")).join(small.select("key", F.col("rep").alias("b")), "key")
                 .where("a < b").select("a", "b"))
        return _within(star.unionByName(pairs), self.sets)

    def unresolved(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """(rep, component) of the large buckets that still hold several components."""
        big = members.where(F.col("n") > SMALL_BUCKET).select("key", "rep")
        big = big.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
        big = self.scratch.keep(big, "big")
        mixed_up = big.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
        return self.scratch.keep(big.join(mixed_up, "key").select("rep", "component").distinct(), "unresolved")

    def rare_pairs(self, left: DataFrame) -> DataFrame:
        """Pairs across components that share one of their rarest shingles.

        Of sets of n and m shingles with similarity t each has at least
        ceil(t * n) common ones, so whichever order is used both share one of
        the first n - ceil(t * n) + 1.  Only their first common shingle has to
        find a pair, and after it (places i and j) no more than
        min(n - i, m - j) can be shared: most pairs end there.
        """
        texts = self.texts(left.select("rep"))
        n_words, percent = self.n_words, self.percent

        def run(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    hashes = shingles(batch.column("text")[k].as_py().encode(), n_words).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), batch.column("doc")[k].as_py())), pa.array(hashes)], names=["rep", "shingle"])

        def finer(batches):
            for batch in batches:
                bits = [fine_signature(shingles(t.as_py().encode(), n_words)) for t in batch.column("text")]
                columns = np.array(bits).reshape(-1, len(FINE)).T
                yield pa.RecordBatch.from_arrays([batch.column("doc"), *map(pa.array, columns)], names=["rep", *FINE])

        rows = texts.mapInArrow(run, "rep long, shingle long")
        fine = texts.mapInArrow(finer, "rep long, " + ", ".join(f"{c} long" for c in FINE))
        common = rows.groupBy("shingle").agg(F.count("*").alias("f")).where("f > 1")
        placed = rows.join(common, "shingle", "left").select("rep", "shingle", F.coalesce("f", F.lit(1)).alias("f"))
        order = Window.partitionBy("rep").orderBy("f", "shingle")
        placed = placed.select("*", F.row_number().over(order).alias("at"), F.count("*").over(Window.partitionBy("rep")).alias("size"))
        first = placed.where((F.col("at") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1) & (F.col("f") > 1))
        about = left.join(fine, "rep")
        first = self.scratch.keep(first.join(about, "rep").select("shingle", "rep", "at", "size", "component", F.struct(*FINE).alias("fine")), "rare")
        side = lambda x: first.select("shingle", *(F.col(c).alias(f"{c}_{x}") for c in ("rep", "at", "size", "component", "fine")))
        near = (F.col("size_a") * 100 >= F.col("size_b") * percent) & (F.col("size_b") * 100 >= F.col("size_a") * percent)
        near = near & ((1 + F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))) * (100 + percent) >= percent * (F.col("size_a") + F.col("size_b")))
        apart = F.lit(0)
        for c in FINE:
            apart = apart + F.bit_count(F.col(f"fine_a.{c}").bitwiseXOR(F.col(f"fine_b.{c}")))
        near = near & (F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b")) & (apart <= fine_errors(percent))
        pairs = side("a").join(side("b"), "shingle").where(near)
        return pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()

    def labels(self) -> DataFrame:
        """(node, component) of every representative that is linked."""
        members = self.buckets()
        links = self.confirm(self.candidates(members))
        labels = self.scratch.keep(components(links, self.scratch), "components")
        left = self.unresolved(members, labels)
        if left.isEmpty():
            return labels
        more = self.confirm(self.rare_pairs(left))
        return self.scratch.keep(components(links.unionByName(more), self.scratch), "components")

    def result(self) -> DataFrame:
        """(doc, n_shingles, component_id, kept), a row per row of the input."""
        labels = self.labels().withColumnRenamed("node", "rep")
        classes = self.sets.select(*SET, "rep").join(labels, "rep", "left").select(*SET, F.coalesce("component", "rep").alias("component"))
        linked = self.rows.select("doc", *SET).join(classes, SET, "left")
        component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
        return linked.select("doc", F.col("n").alias("n_shingles"), component.alias("component_id"),
                             F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, n_words: int = 4, percent: int = 80) -> DataFrame:
    """Per row: doc, n_shingles, component_id (smallest id reachable by links) and kept (it is that id)."""
    return NearDup(docs, id_col, text_col, n_words, percent).result()
