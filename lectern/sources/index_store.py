"""Index tables on storage (Parquet), written once and appended in segments.

Layout under ``root``::

    postings/segment=<id>/bucket=<b>/   term, doc_id, tf, dl          sorted by term, doc_id
    terms/segment=<id>/bucket=<b>/      term, df, cf                  sorted by term, Bloom filter
    ordered/segment=<id>/               term, df                      dealt and sorted by term
    deletions/segment=<id>/bucket=<b>/  key, term, df                 sorted by key
    trigrams/segment=<id>/bucket=<b>/   gram, term, df                sorted by gram
    docs/segment=<id>/bucket=<b>/       doc_id, path, file_name, content   sorted by doc_id
    names/segment=<id>/bucket=<b>/      field, name, doc_id           sorted by field, name
    lengths/segment=<id>/               doc_id, dl
    list/version=<n>/                   one row per segment

**Lookups.**  A bucket is the CRC-32 of a key modulo the segment's number of
buckets, which follows the size of its input.  The values of a small batch of
queries become filters on folders and on the sorted columns inside them, so
a lookup reads the folders and pages of its keys.

**Commit.**  The list of segments is written as a new version, which counts
once its success marker stands; readers take the highest such version and open
the segments it lists.  Nothing is replaced in place: a writer that dies
leaves the version before it.  Two writers that add the same version at once: the
second fails.  What no version lists is deleted after the commit; a reader that opened it before has to open
the index again.

**Compaction.**  ``fan`` segments of a level are merged into one of the next
level, under a new version of the list, when an append completes them.
Statistics are merged by the compaction, and for the terms of a search across
the segments that are left.
"""

from __future__ import annotations

import math
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.analysis import Analyzer
from ..operators.index import Index, build_index, document_frequencies, names_of, totals_row
from ..operators.lookup import any_of, deletion_keys, either, put, sliced, slices_for, trigrams
from ..session import drop_folder, ensure_checkpoint_dir

LIST = "segment string, level int, buckets int, num_docs long, max_doc_id long, docs_with_terms long, sum_dl long"
#: Columns of each table; the key that deals it into buckets comes with it.
SCHEMAS = {
    "postings": "term string, doc_id long, tf int, dl long",
    "terms": "term string, df long, cf long",
    "ordered": "term string, df long",
    "deletions": "key string, term string, df long",
    "trigrams": "gram string, term string, df long",
    "docs": "doc_id long, path string, file_name string, content string",
    "names": "field string, name string, doc_id long",
    "lengths": "doc_id long, dl long",
}
KEYS = {"postings": "term", "terms": "term", "deletions": "key", "trigrams": "gram", "docs": "doc_id", "names": "name"}
LEAST_BUCKETS, MOST_BUCKETS, BUCKET_BYTES = 8, 8192, 64 << 20
FAN = 8


def scratch_root(spark: SparkSession, name: str = "index") -> str:
    """A fresh folder under the session's (shared) checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lectern-{name}-{uuid.uuid4().hex[:12]}"


def bucket_of(key: Column, buckets: int) -> Column:
    return (F.crc32(key.cast("string").cast("binary")) % buckets).cast("int")


def _bucket(key, buckets: int) -> int:
    """The same for a value on the driver."""
    return zlib.crc32(str(key).encode()) % buckets


def buckets_for(docs: DataFrame) -> int:
    """A number of buckets from the planner's size of the documents (no job)."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:  # not known
        return LEAST_BUCKETS
    return min(max(math.ceil(size / BUCKET_BYTES), LEAST_BUCKETS), MOST_BUCKETS)


# --- the list of segments ---------------------------------------------------------

def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """(version, committed), ascending."""
    jvm = spark._jvm.org.apache.hadoop.fs
    top = jvm.Path(f"{root}/list")
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    folders = [s.getPath() for s in fs.listStatus(top) if s.getPath().getName().startswith("version=")]
    return sorted((int(p.getName()[len("version="):]), fs.exists(jvm.Path(p, "_SUCCESS"))) for p in folders)


def segments(spark: SparkSession, root: str) -> list[dict]:
    """The segments of the last committed version of the list."""
    done = [v for v, ok in _versions(spark, root) if ok]
    if not done:
        return []
    return [r.asDict() for r in spark.read.schema(LIST).parquet(f"{root}/list/version={done[-1]:010d}").collect()]


def _commit(spark: SparkSession, root: str, rows: list[dict], keep: bool = False) -> None:
    """Writes the next version of the list; then deletes what it no longer names, unless ``keep``."""
    before = segments(spark, root)
    versions = _versions(spark, root)
    version = versions[-1][0] + 1 if versions else 0
    names = [f.split()[0] for f in LIST.split(", ")]
    table = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], LIST)
    table.coalesce(1).write.mode("error").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{root}/list/version={version:010d}")
    if keep:
        return
    listed = {r["segment"] for r in rows}
    for r in before:
        if r["segment"] not in listed:
            for table in SCHEMAS:
                drop_folder(spark, f"{root}/{table}/segment={r['segment']}")
    for old, _ in versions:
        drop_folder(spark, f"{root}/list/version={old:010d}")


# --- writing ----------------------------------------------------------------------

def _write(parts: DataFrame | list[DataFrame], root: str, table: str, segment: str, buckets: int) -> DataFrame:
    """Writes one table of a segment in its layout and gives it back as read.

    Parts are written one after the other, each as files of its own, so that
    the shuffles of one alone are on the disk."""
    path, columns = f"{root}/{table}/segment={segment}", [f.split()[0] for f in SCHEMAS[table].split(", ")]
    parts = [p.select(*columns) for p in (parts if isinstance(parts, list) else [parts])]
    spark = parts[0].sparkSession
    if table in KEYS:
        order = [KEYS[table], *(c for c in columns if c in ("field", "term", "doc_id") and c != KEYS[table])]
        order = ["field", "name"] if table == "names" else order
        for df in parts:
            placed = df.withColumn("bucket", bucket_of(F.col(KEYS[table]), buckets))
            out = placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", *order).write.mode("append").partitionBy("bucket")
            if table == "terms":
                out = out.option("parquet.bloom.filter.enabled#term", "true")
            put(out, path)
        return spark.read.schema(SCHEMAS[table] + ", bucket int").parquet(path)
    for df in parts:
        if table == "ordered":
            df = df.repartitionByRange("term").sortWithinPartitions("term")
        put(df.write.mode("append"), path)
    return spark.read.schema(SCHEMAS[table]).parquet(path)


def _write_segment(root: str, docs: DataFrame, postings: list[DataFrame], buckets: int, level: int, terms: DataFrame | None = None,
                   scratch: tuple[str, ...] = ()) -> dict:
    """Writes all tables of a new segment, the postings in parts; its row for the list.

    ``scratch``: folders that the postings rest on, deleted once they are written."""
    spark, segment, slices = docs.sparkSession, uuid.uuid4().hex[:12], slices_for(docs)
    own = _write(postings, root, "postings", segment, buckets)
    for folder in scratch:
        drop_folder(spark, folder)
    lengths = _write(own.groupBy("doc_id").agg(F.first("dl").alias("dl")), root, "lengths", segment, buckets)
    terms = _write(document_frequencies(own) if terms is None else terms, root, "terms", segment, buckets)
    _write(terms, root, "ordered", segment, buckets)
    some = sliced(terms, "term", slices)
    _write([t.select(F.explode(deletion_keys(F.col("term"))).alias("key"), "term", "df") for t in some], root, "deletions", segment, buckets)
    _write([t.select(F.explode(trigrams(F.col("term"))).alias("gram"), "term", "df") for t in some], root, "trigrams", segment, buckets)
    stored = _write(sliced(docs, "doc_id", slices), root, "docs", segment, buckets)
    _write(names_of(stored), root, "names", segment, buckets)
    counted = stored.agg(F.count("*"), F.max("doc_id")).first()
    sums = lengths.agg(F.count("*"), F.sum("dl")).first()
    return {"segment": segment, "level": level, "buckets": buckets, "num_docs": counted[0], "max_doc_id": counted[1], "docs_with_terms": sums[0], "sum_dl": sums[1] or 0}


def write_index(index: Index, root: str, mode: str = "overwrite", buckets: int | None = None, fan: int = FAN) -> None:
    """Write (``overwrite``) or add a segment (``append``) to an index folder.

    For an append the documents must carry ids not used before (see
    :func:`append_documents`); full levels are then compacted.  A stemmed index
    has then to be opened with :func:`read_index`: what it was made from is deleted."""
    spark = index.postings.sparkSession
    old = segments(spark, root) if mode == "append" else []
    parts = index.parts() if index.parts else [index.postings]
    row = _write_segment(root, index.docs, parts, buckets or buckets_for(index.docs), 0, scratch=index.scratch)
    _commit(spark, root, [*old, row])
    compact(spark, root, fan)


def compact(spark: SparkSession, root: str, fan: int = FAN) -> None:
    """Merges ``fan`` segments of a level into one of the next, as long as a level has so many."""
    while True:
        listed = segments(spark, root)
        full = next((level for level in sorted({r["level"] for r in listed}) if sum(r["level"] == level for r in listed) >= fan), None)
        if full is None:
            return
        old = [r for r in listed if r["level"] == full]
        store = Stored(spark, root, old)
        docs = store.table("docs")
        row = _write_segment(root, docs, sliced(store.table("postings"), "doc_id", slices_for(docs)), buckets_for(docs), full + 1, store.merged_terms())
        _commit(spark, root, [*(r for r in listed if r["level"] != full), row])


# --- reading ----------------------------------------------------------------------

class Stored:
    """The tables of the listed segments; one scan a table, however many segments there are."""

    def __init__(self, spark: SparkSession, root: str, listed: list[dict]):
        self.spark, self.root, self.listed = spark, root, listed

    def table(self, name: str) -> DataFrame:
        return self._scan(name).drop("segment", "bucket")

    def _scan(self, name: str) -> DataFrame:
        schema = SCHEMAS[name] + ", segment string" + (", bucket int" if name in KEYS else "")
        if not self.listed:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{name}/segment={r['segment']}" for r in self.listed]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths)

    def rows(self, name: str, keys: list) -> DataFrame:
        """The rows of a table that can have one of the keys: the folders of their
        buckets, and their pages in these (see :func:`any_of`)."""
        by_count: dict[int, list[str]] = {}
        for r in self.listed:
            by_count.setdefault(r["buckets"], []).append(r["segment"])
        folders = []
        for n, own in by_count.items():
            there = F.col("bucket").isin(sorted({_bucket(k, n) for k in keys}))
            folders.append(there if len(by_count) == 1 else there & F.col("segment").isin(own))
        return self._scan(name).where(either(folders)).where(any_of(F.col(KEYS[name]), keys)).drop("segment", "bucket")

    def merged(self, rows: DataFrame) -> DataFrame:
        """(term, df): summed over the segments."""
        return rows.groupBy("term").agg(F.sum("df").alias("df")) if len(self.listed) > 1 else rows.select("term", "df")

    def merged_terms(self) -> DataFrame:
        terms = self.table("terms")
        return terms.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")) if len(self.listed) > 1 else terms


def read_index(spark: SparkSession, root: str, analyzer: Analyzer, docs: DataFrame | None = None) -> Index:
    """Open an index folder: its committed segments, with their statistics merged."""
    listed = segments(spark, root)
    store = Stored(spark, root, listed)
    num, with_terms, sum_dl = (sum(r[c] for r in listed) for c in ("num_docs", "docs_with_terms", "sum_dl"))
    largest = max((r["max_doc_id"] for r in listed if r["max_doc_id"] is not None), default=None)
    totals = {"num_docs": num, "docs_with_terms": with_terms, "sum_dl": sum_dl, "avg_dl": sum_dl / with_terms if with_terms else None, "max_doc_id": largest}
    return Index(docs=store.table("docs") if docs is None else docs, postings=store.table("postings"), doc_stats=store.table("lengths"),
                 term_stats=store.merged_terms(), corpus=totals_row(spark, totals), analyzer=analyzer, store=store, totals=totals)


def next_doc_id(spark: SparkSession, root: str) -> int:
    """First free document id of an index (one row per segment is read)."""
    return max((r["max_doc_id"] + 1 for r in segments(spark, root) if r["max_doc_id"] is not None), default=0)


def append_documents(spark: SparkSession, root: str, docs: DataFrame, analyzer: Analyzer, fan: int = FAN) -> None:
    """Analyse new documents and add them as a segment; their ids are shifted
    past the index's largest id (new ids, as a restart would add)."""
    offset = next_doc_id(spark, root)
    shifted = docs.withColumn("doc_id", F.col("doc_id") + F.lit(offset))
    write_index(build_index(shifted, analyzer), root, mode="append", fan=fan)
