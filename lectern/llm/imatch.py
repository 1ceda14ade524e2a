"""I-Match fingerprints: hashes of a document's terms under randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band:
shares of ``LEAST_SHARE`` to ``LARGEST_SHARE`` of the documents.  A document's
distinct lexicon terms are sorted and hashed as a whole (the first signature)
and once more under each of ``GROUPS * LEVELS`` random lexicon subsets: a
group deals every term a level, and its j-th subset keeps the terms of level j
or more, a share of 2^-j.  Large subsets change with a single term, small ones
outlive larger edits, and some subset suits texts of any length.  A
fingerprint is the row of all signatures, 16 bits each, in base 64; the likeness
of two is the share of equal signatures among the subsets that keep a term of
either.

**Size of the lexicon.**  The shares of all terms add up to the mean number of
distinct terms of a document, so at most mean / ``LEAST_SHARE`` terms reach
the band, however many documents there are.  The band's lower edge is raised
to mean / ``MOST_TERMS`` where documents are so long that the lexicon would
be larger; it is broadcast as sorted 64-bit hashes (``8 * MOST_TERMS`` bytes at
most).  Document frequencies are counted over all documents, each task adding
up its own before the shuffle.

**Neighbours.**  :func:`compare_edited` deals the rows by ranges of the id, each
text packed for the way, and walks each part in order, holding a few texts at a time.  What crosses from one
part to the next are one text at each end of a part, which are matched in a
second, small step.

Defined cases: a null text is empty.  A text without a term in the band uses all its
terms instead, one without any term the hash of its characters, so every text
has a fingerprint and equal texts equal ones.  Repeated rows each count and
follow each other in order of a hash of their texts (xxhash64, seed 42, signed);
null ids come first.  A single
document is its own next one.  An empty table gives an empty result.  Texts
are read whole at any length.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import Scratch
from lectern.llm.importance import WORD_BYTES
from lectern.llm.shingles import mixed, word_hashes

LEAST_SHARE, LARGEST_SHARE = 1 / 2000, 1 / 10
MOST_TERMS = 1 << 22
GROUPS, LEVELS = 16, 12
STEP = np.uint64(0x9E3779B97F4A7C15)


def terms(text: bytes | None) -> np.ndarray:
    """Sorted hashes of the distinct words of a text (runs of letters, digits and signs beyond ASCII, A-Z lower-cased)."""
    return np.unique(word_hashes((text or b"").translate(WORD_BYTES)))


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df): documents that hold each term, by its hash."""
    def run(batches):
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for at in range(0, len(texts), 1024):
                found = [terms(t) for t in texts.slice(at, 1024).to_pylist()]
                term, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n, pa.int64())], names=["term", "df"])

    held = docs.select(F.col(text_col).cast("string").alias("t")).where("t is not null").mapInArrow(run, "term long, df long")
    return held.groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(docs: DataFrame, scratch: Scratch, text_col: str = "text", least: float = LEAST_SHARE, largest: float = LARGEST_SHARE,
            most_terms: int = MOST_TERMS) -> np.ndarray:
    """The sorted hashes of the terms in the band; at most ``most_terms``."""
    n = docs.count()
    counted = scratch.keep(document_frequencies(docs, text_col).where(F.col("df") >= least * n), "frequencies")
    pairs = counted.agg(F.sum("df")).first()[0] or 0  # of terms that reach the lower edge: these decide the size
    edge = max(least * n, pairs / most_terms)
    band = counted.where((F.col("df") >= edge) & (F.col("df") <= largest * n)).select("term").toArrow()
    return np.sort(np.asarray(band.column("term"), dtype=np.int64).view(np.uint64))


def kept_terms(text: bytes | None, held: np.ndarray) -> np.ndarray:
    """The text's terms in the lexicon; without any all its terms; without terms a hash of the text."""
    own = terms(text)
    if len(own) and len(held):
        place = np.minimum(np.searchsorted(held, own), len(held) - 1)
        inside = own[held[place] == own]
        if len(inside):
            return inside
    return own if len(own) else np.frombuffer(hashlib.sha256(text or b"").digest()[:8], dtype="<u8")


def _hashed(term: np.ndarray, doc: np.ndarray, n: int, seed: int) -> np.ndarray:
    """16 bits for each document from its terms in their order (``doc`` ascending); 0 where it has none."""
    out = np.zeros(n, dtype=np.uint64)
    if len(term):
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        place = np.arange(len(doc)) - np.repeat(first, np.diff(np.r_[first, len(doc)]))
        powers = np.multiply.accumulate(np.full(int(place.max()) + 1, STEP, dtype=np.uint64))
        whole = mixed(np.add.reduceat(mixed(term + np.uint64(seed)) * powers[place], first))
        out[doc[first]] = whole % np.uint64(0xFFFF) + np.uint64(1)
    return out.astype(np.uint16)


def signatures(texts: list[bytes | None], held: np.ndarray, groups: int = GROUPS, levels: int = LEVELS) -> np.ndarray:
    """A row of 1 + groups * levels signatures for each text; 0: the subset keeps no term of it."""
    kept = [kept_terms(t, held) for t in texts]
    term, doc = np.concatenate(kept), np.repeat(np.arange(len(kept)), [len(k) for k in kept])
    out = np.zeros((len(texts), 1 + groups * levels), dtype=np.uint16)
    out[:, 0] = _hashed(term, doc, len(texts), 0)
    for g, seed in enumerate(mixed(np.arange(1, groups + 1, dtype=np.uint64) * STEP)):
        dealt, t, d = mixed(term ^ seed), term, doc
        for j in range(1, levels + 1):
            stay = (dealt & np.uint64((1 << j) - 1)) == 0
            t, d, dealt = t[stay], d[stay], dealt[stay]
            out[:, (j - 1) * groups + g + 1] = _hashed(t, d, len(texts), j)
    return out


def written(row: np.ndarray) -> str:
    """A fingerprint as text."""
    return base64.b64encode(row.astype(">u2").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal signatures among the subsets that keep a term of either, row by row."""
    some = ((a != 0) | (b != 0)).sum(axis=1)
    return ((a == b) & (a != 0)).sum(axis=1) / np.maximum(some, 1)


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first as many characters of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


COLUMNS = "doc long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], held: np.ndarray) -> list[pa.Array]:
    """The result columns of the rows but the last, each with the row after it."""
    raw = [t.encode() for t in texts]
    changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:])]
    own, new = signatures(raw, held), signatures(changed, held)
    return [pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in changed]),
            pa.array([written(s) for s in own[:-1]]), pa.array([written(s) for s in new]), pa.array(likeness(own[:-1], new)), pa.array(likeness(own[:-1], own[1:]))]


def _packed(batches):
    """The rows with their texts packed."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            packed = [pack(t or b"") for t in part.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], names=["doc", "order", "packed"])


def _pieces(batches, rows: int = 512, chars: int = 1 << 22):
    """(ids, texts) of a few rows at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    ids, texts, held = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            for doc, packed in zip(batch.column(0).slice(at, rows).to_pylist(), batch.column(2).slice(at, rows).to_pylist()):
                ids.append(doc)
                texts.append(unpack(packed).decode())
                held += len(texts[-1])
                if len(ids) >= rows or held >= chars:
                    yield ids, texts
                    ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def compare_edited(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SHARE, largest: float = LARGEST_SHARE) -> DataFrame:
    """(doc, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    Each document is compared with its edited text and with the next document
    in order of the ids (the first one follows the last).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "imatch")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("t"))
    shared = spark.sparkContext.broadcast(lexicon(narrow, scratch, "t", least, largest))

    def inner(batches):
        """All rows of a part but its last one; then its first and its last text."""
        part, start, tail = TaskContext.get().partitionId(), None, None
        end = lambda which, row: [pa.array([row[0]], pa.int64()), *(pa.nulls(1, f.type) for f in schema[1:7]), pa.array([which]), pa.array([part], pa.int64()), pa.array([row[1]])]
        for ids, texts in _pieces(batches):
            start = start or (ids[0], texts[0])
            if tail is not None:
                ids, texts = [tail[0], *ids], [tail[1], *texts]
            tail = ids[-1], texts[-1]
            if len(ids) > 1:
                n = len(ids) - 1
                yield pa.RecordBatch.from_arrays([*_compared(ids, texts, shared.value), pa.array(["inner"] * n), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], schema=arrow)
        if start is not None:
            yield pa.RecordBatch.from_arrays(end("first", start), schema=arrow)
            yield pa.RecordBatch.from_arrays(end("last", tail), schema=arrow)

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    ddl = COLUMNS + ", which string, part long, text string"
    schema = [pa.field(*(lambda name, kind: (name, kinds[kind]))(*f.split())) for f in ddl.split(", ")]
    arrow = pa.schema(schema)
    packed = narrow.select("doc", F.xxhash64(F.coalesce("t", F.lit(""))).alias("order"), "t").mapInArrow(_packed, "doc long, order long, packed binary")
    ordered = packed.repartitionByRange("doc").sortWithinPartitions("doc", "order")
    walked = scratch.keep(ordered.mapInArrow(inner, ddl), "walked")

    # the parts that have rows, one number each: the first text of the next one follows a part's last text
    parts = walked.where("which = 'first'").select("part")
    order = Window.orderBy("part")
    after = parts.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())).alias("after"))
    ends = walked.where("which = 'last'").select("doc", "part", "text").join(after, "part")
    starts = walked.where("which = 'first'").select(F.col("part").alias("after"), F.col("doc").alias("next_doc"), F.col("text").alias("next_text"))
    met = ends.join(starts, "after").select("doc", "text", "next_doc", "next_text")

    def outer(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(_compared([row["doc"], row["next_doc"]], [row["text"], row["next_text"]], shared.value), schema=pa.schema(schema[:7]))

    columns = [f.split()[0] for f in COLUMNS.split(", ")]
    return walked.where("which = 'inner'").select(*columns).unionByName(met.mapInArrow(outer, COLUMNS))
