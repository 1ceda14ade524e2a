from pyspark.sql import functions as F

from lectern.operators.analysis import Analyzer, analyze, first_term_of_words, read_stopwords, stopword_set, tokenize_offsets


def _docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, content string")


def _terms(spark, text, analyzer):
    rows = analyze(_docs(spark, [text]), analyzer).orderBy("token_no").collect()
    return [r.term for r in rows]


def test_word_breaks(spark):
    assert _terms(spark, "it's 3.14 foo-bar x. l’eau", Analyzer()) == ["it's", "3.14", "foo", "bar", "x", "l'eau"]


def test_folding_and_stop_words_through_folded_form(spark):
    assert _terms(spark, "Oraşele şi Țară", Analyzer()) == ["orasele", "si", "tara"]
    stop = stopword_set(spark.createDataFrame([("şi",)], "word string"))
    assert sorted(r.word for r in stop.collect()) == ["si", "şi"]
    assert _terms(spark, "Oraşele şi Țară", Analyzer(stopwords=stop)) == ["orasele", "tara"]


def test_ligatures_and_sharp_s(spark):
    assert _terms(spark, "Straße Æsir cœur", Analyzer()) == ["strasse", "aesir", "coeur"]


def test_offsets_point_at_tokens(spark):
    texts = ["Alfa, beta\ngama  delta", "  x y ", "", "é l’eau 3.14"]
    toks = tokenize_offsets(_docs(spark, texts), ["doc_id"]).collect()
    for r in toks:
        assert texts[r.doc_id][r.start:r.end] == r.token
    assert len(toks) == 4 + 2 + 0 + 3


def test_first_term_of_word(spark):
    stop = stopword_set(spark.createDataFrame([("la",)], "word string"))
    rows = first_term_of_words(_docs(spark, ["la Ora-şul  x."]), Analyzer(stopwords=stop)).orderBy("word_no").collect()
    assert [(r.word, r.term) for r in rows] == [("la", ""), ("Ora-şul", "ora"), ("", ""), ("x.", "x")]


def test_stopwords_of_a_file(spark, tmp_path):
    """One word per line, repeated ones once; the analyser drops each word with and without marks."""
    path = tmp_path / "stop.txt"
    path.write_text("și\nîn\nla\nla\npână\n", encoding="utf-8")
    words = read_stopwords(spark, str(path))
    assert sorted(r.word for r in words.collect()) == sorted({"și", "si", "în", "in", "la", "până", "pana"})
    docs = spark.createDataFrame([(1, "La noi ÎN sat, și Pana la râu")], "doc_id long, content string")
    assert [r.term for r in analyze(docs, Analyzer(stopwords=words)).orderBy("token_no").collect()] == ["noi", "sat", "rau"]
