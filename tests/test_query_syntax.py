from pyspark.sql import functions as F

from lectern.functions.querysyntax import query_is_valid


def test_validity(spark):
    cases = {"aiment": True, "aiment tion ": True, "aiment  tion": False, "": False, " a": False,
             "a && b": False, "a + b": False, "*ab": False, "*:*": True, "a(b": False, "(a)": True,
             'say "x': False, "a AND b": True, "[a": False}
    df = spark.createDataFrame([(q,) for q in cases], "q string")
    got = {r.q: r.v for r in df.select("q", query_is_valid(F.col("q")).alias("v")).collect()}
    assert got == cases
