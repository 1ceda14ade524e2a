"""Document sources: tables, folders of files, web pages.

Every source yields the canonical document frame
``docs(doc_id LONG, path STRING, file_name STRING, content STRING)``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.html import decoded_bytes, html_to_text
from ..session import ensure_checkpoint_dir


def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` test table as docs: path = source/doc_id, file name =
    the id as text."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.concat_ws("/", F.col("source"), F.col("doc_id").cast("string")).alias("path"),
        F.col("doc_id").cast("string").alias("file_name"),
        F.coalesce(F.col("text"), F.lit("")).alias("content"),
    )


def conversations_table(spark: SparkSession, sf_dir: str, id_offset: int = 0) -> DataFrame:
    """Each conversation turn as a document; ids ``offset + conv_id * 2^32 + turn``."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    local = F.shiftleft(F.col("conv_id").cast("long"), 32) + F.col("turn").cast("long")
    return c.select(
        (F.lit(id_offset).cast("long") + local).alias("doc_id"),
        F.concat_ws("/", F.lit("conversations"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("path"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("file_name"),
        F.coalesce(F.col("text"), F.lit("")).alias("content"),
    )


def numbered(df: DataFrame, order_col: str, id_col: str) -> DataFrame:
    """``df`` with dense numbers from 0 in the order of a column.

    Rows are range-partitioned and written; the partitions' row counts (one
    number each) give every partition its first number.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lectern-numbered-{uuid.uuid4().hex[:12]}"
    ordered = df.repartitionByRange(F.col(order_col)).sortWithinPartitions(order_col)
    row = F.monotonically_increasing_id()
    ordered.select("*", F.shiftright(row, 33).cast("int").alias("_part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")).write.parquet(path)
    out = spark.read.parquet(path)
    counts = out.groupBy("_part").count()
    first = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_first"))
    return out.join(first, "_part").select(*df.columns, (F.col("_first") + F.col("_row")).alias(id_col))


def folder(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Every readable file below ``path`` (recursively) as a document.

    Bytes are read by their byte-order mark, as UTF-8, or as Latin-1 where the
    file declares it; any other file has the empty text.  Empty files and files
    that vanish between listing and reading are skipped.  Document ids number
    the files in the order of their paths."""
    reader = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("ignoreMissingFiles", "true"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.load(path)
    ids = numbered(raw.select("path"), "path", "doc_id")
    return raw.select("path", F.coalesce(decoded_bytes(F.col("content")), F.lit("")).alias("content")).join(ids, "path").select(
        "doc_id",
        "path",
        F.element_at(F.split(F.col("path"), "/"), -1).alias("file_name"),
        "content",
    )


def pages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``pages`` table as docs: text extracted from the HTML, file name =
    last segment of the URL path, path = the URL."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return p.select(
        F.col("page_id").cast("long").alias("doc_id"),
        F.col("url").alias("path"),
        url_file_name(F.col("url")).alias("file_name"),
        html_to_text(F.col("html")).alias("content"),
    )


def url_file_name(url):
    """Last path segment of a URL (query and fragment removed)."""
    no_q = F.regexp_replace(url, r"[?#].*$", "")
    no_host = F.regexp_replace(no_q, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    return F.element_at(F.split(no_host, "/"), -1)
