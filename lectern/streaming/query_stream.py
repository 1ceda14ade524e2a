"""Answer a stream of queries against a fixed index (Structured Streaming).

The original service answers requests one by one against an index opened
once at start-up and never refreshed.  Here queries arrive as files
``(query_id, query)`` in a folder; each micro-batch is answered with the same
batch plan as :func:`lectern.operators.rank.search_free_text` plus the status
and, optionally, the snippets, and written under ``<out>/batch=<id>``.  Each
batch's output folder is overwritten as a whole, so a batch replayed after a
failure gives the same files (the checkpoint records finished batches).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import highlight as hl
from ..operators import match as mt
from ..operators import rank as rk
from ..operators.index import Index
from ..functions.text import MAX_HITS

QUERY_SCHEMA = "query_id long, query string"


def answer_batch(queries: DataFrame, index: Index, k: int = MAX_HITS, snippets: bool = True) -> DataFrame:
    """(query_id, status, results_count, rank, doc_id, score, highlight) for a
    batch of free-text queries; queries without hits keep one row with nulls."""
    hits = hl.written(rk.search_free_text(queries, index, k), "stream-hits")
    status = rk.search_status(queries, hits)
    if snippets:
        clauses = hl.query_clauses(mt.free_text_clauses(queries, index.analyzer))
        h = hl.highlight_hits(hits, index, clauses, index.analyzer)
        hits = hits.join(h, ["query_id", "doc_id"], "left")
    else:
        hits = hits.withColumn("highlight", F.lit(None).cast("string"))
    return status.join(hits, "query_id", "left").select(
        "query_id", "status", "results_count", "rank", "doc_id", "score", "highlight")


def start(spark: SparkSession, index: Index, in_dir: str, out_dir: str, checkpoint: str,
          k: int = MAX_HITS, snippets: bool = True, available_now: bool = False, fmt: str = "parquet"):
    """Start the stream; returns the ``StreamingQuery``."""
    src = spark.readStream.schema(QUERY_SCHEMA).format(fmt).load(in_dir)

    def run(batch: DataFrame, batch_id: int) -> None:
        answer_batch(batch, index, k, snippets).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    w = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()
