import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SMALL = "/root/testdata/sf0.001"
PROSE = "the quick brown fox jumps over the lazy dog while seven tired owls watch from a crooked fence near the old stone mill"


def edge_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    texts = [None, "", " \n\t ", "x" * 300_000, "word " * 40_000, "a\nb\n" * 20_000, PROSE, PROSE, PROSE.upper(),
             "naïve façade — 日本語 ½ \U0001f600 " + PROSE, "1.2.3.4 " * 3000, "@" * 5000, "\x1c\x85  odd gaps"]
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [(100, PROSE, None, None, None), (100, PROSE, None, None, None), (101, "twice " + PROSE, "en", None, 5), (101, "twice " + PROSE, "en", None, 5),
             (None, PROSE, "en", "s", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def clashing(edge):
    """The edge rows with further columns named as the operators' own."""
    for name in ("n", "doc", "kept", "group", "key", "uid", "n_words", "n_hit", "items", "n_lines", "rep", "component_id", "node", "tree", "path", "file"):
        edge = edge.withColumn(name, edge["lang"])
    return edge


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def query(spark):
    """The rows of a registered query over the smallest tables."""
    from lectern.llm.queries import QUERIES

    return lambda name: QUERIES[name](spark, SMALL).collect()


@pytest.fixture(scope="session")
def oracle():
    """The rows of a query's DuckDB SQL over the smallest tables, as dicts."""
    import duckdb

    from lectern.llm.queries import SQL

    def run(name):
        con = duckdb.connect()
        for t in ("documents", "benchmark", "labels", "conversations", "embeddings"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
        out = con.sql(SQL[name])
        return [dict(zip(out.columns, r)) for r in out.fetchall()]

    return run


def same(got, want):
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    assert sorted(map(key, (r.asDict() for r in got))) == sorted(map(key, want))
