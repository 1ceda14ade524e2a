"""The search answer per query, as the service returned it (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .index import Index
from .rank import display_order, search_status


def search_response(queries: DataFrame, hits: DataFrame, highlights: DataFrame, docs: DataFrame | Index) -> DataFrame:
    """(query_id, status, results_count, response): ``response`` is the JSON
    ``{"searchDetails": {"status", "resultsCount"}, "searchResults":
    [{"content": snippet, "fileName": name}, ...]}`` with results in display
    order.  Failed queries carry only their details."""
    status = search_status(queries, hits)
    order = display_order(hits).select("query_id", F.posexplode("hits").alias("pos", "h")) \
        .select("query_id", "pos", F.col("h.doc_id").alias("doc_id"))
    found = docs.documents(hits) if isinstance(docs, Index) else docs.join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    names = found.select("doc_id", "file_name")
    rows = order.join(highlights, ["query_id", "doc_id"], "left").join(names, "doc_id", "left")
    per_q = rows.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.create_map(F.lit("content"), F.coalesce("highlight", F.lit(" ")),
                            F.lit("fileName"), F.col("file_name")).alias("m"))),
        lambda a, b: a["pos"] - b["pos"]).alias("r"))
    per_q = per_q.select("query_id", F.transform("r", lambda x: x["m"]).alias("results"))
    out = status.join(per_q, "query_id", "left")
    details = F.create_map(F.lit("status"), F.col("status"),
                           F.lit("resultsCount"), F.col("results_count").cast("string"))
    results = F.coalesce(F.col("results"), F.array().cast("array<map<string,string>>"))
    body = F.struct(details.alias("searchDetails"), results.alias("searchResults"))
    return out.select("query_id", "status", "results_count", F.to_json(body).alias("response"))
