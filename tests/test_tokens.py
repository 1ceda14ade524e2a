"""Word breaks of scripts without blanks, and of the others as before."""
import duckdb
from pyspark.sql import functions as F

from lectern.functions.text import sql_str, token_array, token_array_sql
from lectern.operators import highlight as hl
from lectern.operators.analysis import Analyzer, read_stopwords, tokenize_offsets

CASES = [
    ("日本語の本", ["日", "本", "語", "の", "本"]), ("カタカナー と ﾊﾟｰﾄ", ["カタカナー", "と", "ﾊﾟｰﾄ"]), ("abcカタ漢d", ["abc", "カタ", "漢", "d"]),
    ("한국어 단어", ["한국어", "단어"]), ("ภาษาไทย", ["ภาษาไทย"]), ("がぎ が", ["が", "ぎ", "が"]), ("一二3.14三", ["一", "二", "3.14", "三"]), ("_カ_タ x_1", ["_カ_タ", "x_1"]),
    ("𠀀𠀁a", ["𠀀", "𠀁", "a"]), ("it's 3.14 foo-bar x. l’eau", ["it's", "3.14", "foo", "bar", "x", "l’eau"]), ("ţară Ünï", ["ţară", "Ünï"]), ("", []),
]


def test_tokens(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)], "k int, t string")
    assert [r.x for r in df.select("k", token_array(F.col("t")).alias("x")).orderBy("k").collect()] == [want for _, want in CASES]
    assert [duckdb.sql(f"SELECT {token_array_sql(sql_str(t))}").fetchall()[0][0] for t, _ in CASES] == [want for _, want in CASES]


def test_offsets(spark):
    docs = spark.createDataFrame([(0, "ab 日本x")], "doc_id long, content string")
    assert [tuple(r)[2:] for r in tokenize_offsets(docs, ["doc_id"]).orderBy("token_no").collect()] == [("ab", 0, 2), ("日", 3, 4), ("本", 4, 5), ("x", 5, 6)]


def test_stop_words_from_a_file(spark, tmp_path):
    words = ["şi", "că", "la", "înspre", "fără"] + [f"cuvânt{k}" for k in range(400)]
    (tmp_path / "stop.txt").write_text("\n".join(words) + "\n", encoding="utf-8")
    held = {r.word for r in read_stopwords(spark, str(tmp_path / "stop.txt")).collect()}
    assert held == set(words) | {"si", "ca", "inspre", "fara"} | {f"cuvant{k}" for k in range(400)}


def test_absolute_offsets(spark):
    """The second fragment's start is rewritten to 4; in the text it stands at 40."""
    text = "alfa " + "x " * 20 + "alfa a1 a2 alfa b1 beta"
    docs = spark.createDataFrame([(0, "p", "f", text)], "doc_id long, path string, file_name string, content string")
    hits, clauses = spark.createDataFrame([(0, 0)], "query_id long, doc_id long"), spark.createDataFrame([(0, ["alfa", "beta"])], "query_id long, clauses array<string>")
    for absolute in (False, True):
        got = hl.highlight_hits(hits, docs, clauses, Analyzer(), absolute_offsets=absolute).first().highlight
        assert got == " ... a1 a2 <b>alfa</b> b1  <b>beta</b> ", got
