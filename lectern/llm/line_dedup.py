"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends and with A-Z
lower-cased.  :class:`LineRuns` keeps what it knows of the keys as sorted runs
in levels.  Each new batch is reduced to one row per key and merge-joined with
the runs: a key that no run has (the anti-join) is inserted with its own
count, a key that is known is written with the total so far.  The batch's rows
are a run of level 0; ``fan`` runs of a level are compacted into one run of
the next, where the newest total of a key replaces the older ones.

:func:`dedup_lines` then drops every line whose key at least ``min_docs``
documents hold, except in the document with the largest id.  The keys to drop
are read off the runs: those with a total of ``min_docs``, a filter that goes
down to the Parquet scan.

Defined cases: a null or empty text is one empty line; a repeated row counts
as one more document; rows with a null id are kept whole and are not counted;
an empty table gives an empty result.  Other columns are ignored, so clashing
names do no harm.  A line that most documents hold is one row in a run, and
its holders meet it in a broadcast join (see :func:`_holders`).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import Scratch

SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5
KEY = ["k1", "k2"]
HOT = 4096


def keys_of(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """Per line its 128-bit key hash, or None where the key is shorter than ``min_chars``."""
    out = []
    for line in (text or b"").lower().split(b"\n"):
        line = line.strip(SPACE)
        long = len(line) >= min_chars and (line.isascii() or len(line.decode()) >= min_chars)
        out.append(xxhash.xxh3_128_digest(line) if long else None)
    return out


def _longs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc): each distinct key of each document."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("doc", pa.int64())])

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, len(ids), 512):
                digests, owners = [], []
                for doc, text in zip(ids[at:at + 512], texts.slice(at, 512).to_pylist()):
                    found = set(keys_of(text, min_chars))
                    found.discard(None)
                    digests += found
                    owners += [doc] * len(found)
                pairs = _longs(digests)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(owners, pa.int64())], schema=schema)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("t"))
    return narrow.where("doc is not null and t is not null").mapInArrow(run, "k1 long, k2 long, doc long")


class LineRuns:
    """Sorted runs of (k1, k2, n, last): how many documents had the key up to then, and their largest id.

    Both only grow, so of a key's records the newest is the one with the
    largest values.
    """

    def __init__(self, scratch: Scratch, fan: int = 2):
        self.scratch, self.fan = scratch, fan
        self.levels: list[list[DataFrame]] = [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds the (k1, k2, doc) rows of one batch; returns its run."""
        own = batch.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc").alias("last"))
        if self.runs():
            # a merge join, as the runs grow with the corpus; a key meets a record per run at most
            known = _union(self.runs()).select(*KEY, F.col("n").alias("had"), F.col("last").alias("before")).hint("merge")
            own = (own.join(known, KEY, "left").groupBy(*KEY)
                   .agg((F.max("n") + F.coalesce(F.max("had"), F.lit(0))).alias("n"), F.greatest(F.max("last"), F.max("before")).alias("last")))
        run = self.scratch.keep(own.sortWithinPartitions(*KEY), "run")
        self._place(run, 0)
        return run

    def _place(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan:
            old, self.levels[level] = self.levels[level], []
            merged = self.scratch.keep(_newest(_union(old)).sortWithinPartitions(*KEY), f"level{level + 1}")
            for one in old:
                self.scratch.drop(one)
            self._place(merged, level + 1)

    def held_by(self, least: int) -> DataFrame:
        """(k1, k2, n, last) of the keys that at least ``least`` documents hold."""
        # a key's newest total is its largest: older records may fall to the filter, the newest does not
        return _newest(_union([run.where(F.col("n") >= least) for run in self.runs()]))


def _union(runs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, runs)


def _newest(records: DataFrame) -> DataFrame:
    return records.groupBy(*KEY).agg(F.max("n").alias("n"), F.max("last").alias("last"))


def _holders(keys: DataFrame, common: DataFrame) -> DataFrame:
    """(k1, k2, doc, last): the rows of ``keys`` whose key is common.

    Keys with more than 1 / ``HOT`` of all rows are fewer than ``HOT``, at any
    size, and are broadcast; so no key with a larger share goes into the
    shuffle of the rest.
    """
    limit = keys.count() // HOT
    hot = common.where(F.col("n") > limit).select(*KEY, F.col("last").alias("hot_last"))
    rest = common.where(F.col("n") <= limit).select(*KEY, "last")
    told = keys.select(*KEY, "doc").join(F.broadcast(hot), KEY, "left")
    return (told.where("hot_last is not null").withColumnRenamed("hot_last", "last")
            .unionByName(told.where("hot_last is null").drop("hot_last").join(rest.hint("merge"), KEY)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, batches: int = 5, fan: int = 2) -> DataFrame:
    """``docs`` with ``text_col`` rewritten, plus n_lines and n_dropped.

    ``batches``: the table is dealt into so many batches by a hash of the id,
    as they would arrive over time; the result doesn't depend on it.  A fixed
    number, so that the runs are read equally often per row at every size;
    five batches at a fan of two are compacted into levels 1 and 2 and leave
    a run of level 0 beside them.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "lines")
    keys = line_keys(docs, id_col, text_col, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int"))
    keys = scratch.keep(keys, "keys")
    index = LineRuns(scratch, fan)
    for b in range(batches):
        index.add(keys.where(F.col("batch") == b).select(*KEY, "doc"))
    common = scratch.keep(index.held_by(min_docs), "common")
    gone = (_holders(keys, common).where("doc <> last")
            .groupBy("doc").agg(F.collect_set(F.struct(*KEY)).alias("gone")))
    gone = scratch.keep(gone, "gone")
    for done in (keys, common, *index.runs()):
        scratch.drop(done)
    return _rewrite(docs, gone, id_col, text_col, min_chars)


def _rewrite(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``docs`` without the lines whose keys ``gone`` lists for the document."""
    rest = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.col(id_col).cast("long").alias("__doc"), F.struct(*rest).alias("__rest"), F.col(text_col).cast("string").alias("__text"))
    # a merge join at every size: the lists grow with the documents, so they are never broadcast
    joined = packed.join(gone.select(F.col("doc").alias("__doc"), F.col("gone").alias("__gone")).hint("merge"), "__doc", "left")

    def run(batches):
        for batch in batches:
            lists = batch.column("__gone")
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, n_lines, n_dropped = [], [], []
                for text, drop in zip(part.column("__text").cast(pa.binary()).to_pylist(), lists.slice(at, 256).to_pylist()):
                    lines = (text or b"").split(b"\n")
                    n_lines.append(len(lines))
                    if drop:
                        drop = {_digest(x) for x in drop}
                        kept = [line for line, key in zip(lines, keys_of(text, min_chars)) if key is None or key not in drop]
                        n_dropped.append(len(lines) - len(kept))
                        text = b"\n".join(kept)
                    else:
                        n_dropped.append(0)
                    texts.append(text or b"")
                yield pa.RecordBatch.from_arrays(
                    [part.column("__rest"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                    names=["__rest", "__text", "n_lines", "n_dropped"])

    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in packed.schema["__rest"].dataType)
    out = joined.select("__rest", "__text", "__gone").mapInArrow(run, f"__rest struct<{fields}>, __text string, n_lines long, n_dropped long")
    columns = [F.col("__text").alias(c) if c == text_col else F.col("__rest")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*columns, "n_lines", "n_dropped")


def _digest(key: dict) -> bytes:
    return key["k1"].to_bytes(8, "little", signed=True) + key["k2"].to_bytes(8, "little", signed=True)
