"""Benchmark: build the index once, then run the headline queries on it.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: total seconds over the query set, per-query seconds,
and the index build time (kept out of the total, as the original service
builds its index once at start-up).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lectern.operators import highlight as hl  # noqa: E402
from lectern.operators import index as ix  # noqa: E402
from lectern.operators import match as mt  # noqa: E402
from lectern.operators import rank as rk  # noqa: E402
from lectern.plans.fixtures import (benchmark_queries, fixture_analyzer, fixture_clauses,  # noqa: E402
                                    fixture_docs, fixture_queries)
from lectern.session import local_session  # noqa: E402
from lectern.sources import index_store as store  # noqa: E402


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app="lectern-bench", shuffle_partitions=max(2 * cpus, 8))
    analyzer = fixture_analyzer(spark)
    docs = fixture_docs(spark, sf_dir)
    root = store.scratch_root(spark, "bench")

    def build():
        store.write_index(ix.build_index(docs, analyzer), root)

    _, t_build = timed(build)
    idx = store.read_index(spark, root, analyzer)
    q = fixture_queries(spark)
    bq = benchmark_queries(spark, sf_dir)

    def topk():
        return rk.search_free_text(q, idx).collect()

    def topk_bench():
        return rk.search_free_text(bq, idx).collect()

    def tfidf():
        return rk.tfidf_report(q, rk.search_free_text(q, idx), idx).collect()

    def highlight():
        hits = rk.search_free_text(q, idx)
        clauses = hl.query_clauses(mt.free_text_clauses(q, analyzer))
        return hl.highlight_hits(hits, idx, clauses, analyzer).collect()

    def highlight_bench():
        hits = rk.search_free_text(bq, idx)
        clauses = hl.query_clauses(mt.free_text_clauses(bq, analyzer))
        return hl.highlight_hits(hits, idx, clauses, analyzer).collect()

    def boolean():
        return rk.search_clauses_top_k(fixture_clauses(spark, "boolean"), idx).collect()

    def fuzzy():
        return rk.search_clauses_top_k(fixture_clauses(spark, "fuzzy"), idx).collect()

    plan = {
        "search_topk": topk,
        "search_topk_benchmark": topk_bench,
        "tfidf_report": tfidf,
        "highlight": highlight,
        "highlight_benchmark": highlight_bench,
        "match_boolean": boolean,
        "match_fuzzy": fuzzy,
    }
    times: dict[str, float] = {}
    for name, fn in plan.items():
        _, t = timed(fn)
        times[name] = round(t, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "index_build_sec": round(t_build, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
