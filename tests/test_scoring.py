import math

from pyspark.sql import functions as F

from lectern.functions.scoring import quantized_length
from lectern.operators.analysis import Analyzer
from lectern.operators.index import build_index
from lectern.operators.rank import display_order, search_free_text, tfidf_report


def _docs(spark, texts):
    return spark.createDataFrame([(i + 1, f"d/{i + 1}", str(i + 1), t) for i, t in enumerate(texts)],
                                 "doc_id long, path string, file_name string, content string")


def test_bm25_golden(spark):
    idx = build_index(_docs(spark, ["alfa beta", "alfa alfa gama", "delta"]), Analyzer())
    q = spark.createDataFrame([(1, "alfa")], "query_id long, query string")
    rows = search_free_text(q, idx).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == [2, 1]
    assert abs(rows[0].score - 0.566580) < 1e-6
    assert abs(rows[1].score - 0.470004) < 1e-6
    c = idx.corpus.first()
    assert (c.num_docs, c.docs_with_terms, c.avg_dl) == (3, 3, 2.0)


def test_tfidf_golden(spark):
    idx = build_index(_docs(spark, ["alfa alfa beta", "beta", "gama", "delta"]), Analyzer())
    q = spark.createDataFrame([(1, "alfa")], "query_id long, query string")
    hits = search_free_text(q, idx)
    an = tfidf_report(q, hits, idx, "analyzed").first()
    assert abs(an.idf - math.log10(4)) < 1e-9
    assert abs(an.tf - 1.301030) < 1e-6 and abs(an.tfidf - 0.783298) < 1e-6
    dl = tfidf_report(q, hits, idx, "drop_last_char").first()
    assert dl.tf == 0.0 and dl.tfidf == 0.0


def test_unknown_word_gives_infinite_idf_and_nan(spark):
    idx = build_index(_docs(spark, ["alfa beta", "beta"]), Analyzer())
    q = spark.createDataFrame([(1, "alfa zzz")], "query_id long, query string")
    rows = tfidf_report(q, search_free_text(q, idx), idx).collect()
    zzz = [r for r in rows if r.word == "zzz"][0]
    assert math.isinf(zzz.idf) and math.isnan(zzz.tfidf)


def test_quantized_length(spark):
    vals = [0, 10, 24, 39, 40, 41, 57, 1000]
    df = spark.createDataFrame([(v,) for v in vals], "dl long")
    got = [r.q for r in df.select(quantized_length(F.col("dl")).alias("q")).collect()]
    assert got == [0, 10, 24, 39, 40, 40, 56, 984]


def test_display_order_rounding_comparator(spark):
    scores = [3.9, 3.6, 3.5, 2.9, 1.2, 1.1]
    hits = spark.createDataFrame([(1, i + 1, 100 + i, s) for i, s in enumerate(scores)],
                                 "query_id long, rank int, doc_id long, score double")
    out = display_order(hits).first().hits
    assert [h.score for h in out] == [1.2, 1.1, 2.9, 3.9, 3.6, 3.5]
