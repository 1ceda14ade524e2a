"""Benchmark decontamination by a broadcast hash set of n-grams.

The normalised windows of the benchmark items (``n`` consecutive words; an
item of fewer, but not none, is one window) are broadcast as a set of hashes;
each document's words are scanned window by window in one pass, hits are
verified word by word, and the hit words or whole documents are removed.

The set is broadcast only while the benchmark's words stay under
``max_words``; a larger benchmark is dealt into blocks of that size.  Each
block scans the documents and its hits are written before the next block is
read, so neither the driver nor a task ever holds more than one block (about
90 bytes a word, and its distinct words once), and no item is left out.

Defined cases: a null text or item has no words; repeated benchmark rows and
repeated item ids count once; a null item id is written as an empty string;
repeated documents are handled row by row; empty tables give no hits.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import Scratch

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")  # after lower-casing: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ as UTF-8 bytes
N, MAX_WORDS = 10, 2_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return WORDS.findall((text or b"").lower())


@dataclass
class Windows:
    """The windows of some items: word numbers, and per window length a :class:`Grams`."""

    numbers: dict[bytes, int]
    names: list[str]
    grams: dict[int, Grams]

    @classmethod
    def of(cls, items: list[tuple[str, bytes | None]], n: int) -> Windows:
        numbers: dict[bytes, int] = {}
        names: dict[str, int] = {}
        texts: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item, text in items:
            ids = np.array([numbers.setdefault(w, len(numbers)) for w in words_of(text)], dtype=np.int32)
            if len(ids):
                texts.setdefault(min(n, len(ids)), []).append((names.setdefault(item, len(names)), ids))
        return cls(numbers, list(names), {size: Grams.of(own, size) for size, own in texts.items()})

    def scan(self, numbers: np.ndarray) -> tuple[np.ndarray, set]:
        """Which words lie inside an occurrence, and the items that occur."""
        hit, items = np.zeros(len(numbers), dtype=bool), set()
        known = numbers >= 0
        for size, grams in self.grams.items():
            if len(numbers) < size:
                continue
            ahead = np.concatenate(([0], np.cumsum(known)))
            full = np.flatnonzero(ahead[size:] - ahead[:-size] == size)  # windows of known words only
            if not len(full):
                continue
            hashes = _hash(numbers, size)[full]
            first, last = np.searchsorted(grams.hashes, hashes, "left"), np.searchsorted(grams.hashes, hashes, "right")
            for k in np.flatnonzero(first < last).tolist():
                at = int(full[k])
                owners = grams.owners_of(numbers[at:at + size], first[k], last[k])
                if len(owners):
                    hit[at:at + size] = True
                    items.update(self.names[x] for x in owners.tolist())
        return hit, items


@dataclass
class Grams:
    """Windows of one length, a row for each window and item: sorted hashes, words and the item's number."""

    hashes: np.ndarray
    words: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, texts: list[tuple[int, np.ndarray]], size: int) -> Grams:
        hashes = np.concatenate([_hash(ids, size) for _, ids in texts])
        words = np.concatenate([np.lib.stride_tricks.sliding_window_view(ids, size) for _, ids in texts])
        owners = np.concatenate([np.full(len(ids) - size + 1, item, dtype=np.int32) for item, ids in texts])
        order = np.argsort(hashes, kind="stable")
        return cls(hashes[order], words[order], owners[order])

    def owners_of(self, window: np.ndarray, first: int, last: int) -> np.ndarray:
        """The items, among the rows of one hash, whose words are these."""
        same = (self.words[first:last] == window).all(axis=1)
        return np.unique(self.owners[first:last][same])


def _hash(numbers: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of ``size`` numbers."""
    x = numbers.astype(np.uint64) + np.uint64(1)
    out = np.zeros(len(x) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = out * ODD + (x[k:len(x) - size + 1 + k] ^ (x[k:len(x) - size + 1 + k] << np.uint64(31)))
    return out


def _block_number(items: DataFrame, max_words: int) -> int:
    """How many blocks of about ``max_words`` words the items make: a word and its gap take two characters at least."""
    return (items.agg(F.sum(F.length("t"))).first()[0] or 0) // (2 * max_words) + 1


def _block(items: DataFrame, b: int, n_blocks: int, n: int):
    """The broadcast windows of one block."""
    part = items if n_blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == b)
    rows = [(r["i"], None if r["t"] is None else r["t"].encode()) for r in part.collect()]
    return items.sparkSession.sparkContext.broadcast(Windows.of(rows, n))


def scan_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   item_col: str = "item_id", item_text: str = "text", n: int = N, max_words: int = MAX_WORDS,
                   remove_spans: bool = False) -> DataFrame:
    """``docs`` plus n_words, n_hit and items (array of ids, sorted as strings).

    With ``remove_spans`` the hit words are cut out of the text (again, if the
    cut makes a new window), which is then the text column's value.
    """
    own = [c for c in docs.columns if c not in ("n_words", "n_hit", "items")]
    packed = docs.select(F.struct(*own).alias("__row"), F.col(text_col).cast("string").alias("__text"), F.lit(None).cast("array<int>").alias("__hit"), F.array().cast("array<string>").alias("items"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"))
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in packed.schema["__row"].dataType)
    schema = f"__row struct<{fields}>, __text string, __hit array<int>, items array<string>, n_words long, n_hit long"
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(item_text).cast("string").alias("t")).distinct()
    n_blocks = _block_number(items, max_words)
    passes = [(b, False) for b in range(n_blocks - 1)] + [(n_blocks - 1, remove_spans)]
    if remove_spans:  # a cut may make a window of another block
        passes += [(b, None) for b in range(n_blocks - 1)]
    scratch, written = Scratch(docs.sparkSession, "benchmark"), None
    for k, (b, cut) in enumerate(passes):
        held = _block(items, b, n_blocks, n)
        packed = packed.mapInArrow(_cut_again(held) if cut is None else _scan(held, cut), schema)
        if k < len(passes) - 1:
            packed = scratch.keep(packed, "scanned")
            held.destroy()  # nothing reads it any more: its rows are written
            if written is not None:
                scratch.drop(written)
            written = packed
    columns = [F.col("__text").alias(c) if c == text_col else F.col("__row")[c].alias(c) for c in own]
    return packed.select(*columns, "n_words", "n_hit", "items")


def _numbers(words: list[bytes], windows: Windows) -> np.ndarray:
    get = windows.numbers.get
    return np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))


def _scan(held, cut: bool = False):
    def run(batches):
        windows: Windows = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("__text").cast(pa.binary()).to_pylist()
                n_words, n_hit, hits, items = [], [], [], []
                for k, (text, before, named) in enumerate(zip(texts, part.column("__hit").to_pylist(), part.column("items").to_pylist())):
                    words = words_of(text)
                    hit, found = windows.scan(_numbers(words, windows))
                    if before:
                        hit[before] = True
                    n_words.append(len(words))
                    where = np.flatnonzero(hit).tolist()
                    n_hit.append(len(where))
                    hits.append(where or None)
                    items.append(sorted({*named, *found}))
                    if cut and where:
                        texts[k] = _without(text, where, windows)
                said = pa.array(texts, pa.binary()).cast(pa.string()) if cut else part.column("__text")
                yield pa.RecordBatch.from_arrays([part.column("__row"), said, pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())], names=["__row", "__text", "__hit", "items", "n_words", "n_hit"])

    return run


def cut_words(text: bytes, hit: list[int]) -> bytes:
    """The text without the words at these places."""
    gone, out, last = set(hit), [], 0
    for k, m in enumerate(WORDS.finditer(text.lower())):
        if k in gone:
            out.append(text[last:m.start()])
            last = m.end()
    return b"".join((*out, text[last:]))


def _without(text: bytes, where: list[int], windows: Windows) -> bytes:
    """The text without these words, and without what their going turns into an occurrence."""
    while where:
        text = cut_words(text, where)
        where = np.flatnonzero(windows.scan(_numbers(words_of(text), windows))[0]).tolist()
    return text


def _cut_again(held):
    """Looks at cut texts for windows of another block."""
    def run(batches):
        windows: Windows = held.value
        for batch in batches:
            hits = batch.column("__hit").to_pylist()
            if any(hits):
                texts = batch.column("__text").cast(pa.binary()).to_pylist()
                for k, where in enumerate(hits):
                    if where:
                        texts[k] = _without(texts[k], [-1], windows)
                at = batch.schema.names.index("__text")
                batch = batch.set_column(at, "__text", pa.array(texts, pa.binary()).cast(pa.string()))
            yield batch

    return run
