import uuid

from lectern.operators.index import build_index
from lectern.operators.analysis import Analyzer
from lectern.session import ensure_checkpoint_dir
from lectern.streaming import query_stream


def test_query_stream_answers_each_batch(spark):
    base = f"{ensure_checkpoint_dir(spark)}/stream-test-{uuid.uuid4().hex[:8]}"
    docs = spark.createDataFrame([(1, "d/1", "1", "alfa beta gama delta"), (2, "d/2", "2", "beta beta"),
                                  (3, "d/3", "3", "zeta")],
                                 "doc_id long, path string, file_name string, content string")
    idx = build_index(docs, Analyzer())
    spark.createDataFrame([(1, "beta"), (2, "zeta  x")], query_stream.QUERY_SCHEMA) \
        .write.parquet(f"{base}/in/part1")
    q = query_stream.start(spark, idx, f"{base}/in/part1", f"{base}/out", f"{base}/ckpt", available_now=True)
    q.awaitTermination(180)
    out = spark.read.parquet(f"{base}/out").collect()
    by_q = {}
    for r in out:
        by_q.setdefault(r.query_id, []).append(r)
    assert sorted(r.doc_id for r in by_q[1]) == [1, 2]
    assert by_q[1][0].status == "success"
    assert by_q[2][0].status == "error" and by_q[2][0].doc_id is None
    top = [r for r in by_q[1] if r.rank == 1][0]
    assert top.doc_id == 2 and "<b>beta</b>" in top.highlight
