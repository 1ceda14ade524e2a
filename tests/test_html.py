"""Text of HTML against Python's own parser rules and byte encodings."""
import html
import random

from pyspark.sql import functions as F

from lectern.functions.html import decoded_bytes, html_to_text, unescaped

REFERENCES = ["caf&eacute; x&#8217;y &#x41;", "&copy;&middot;&nbsp;", "&copy 2021 &amp;lt; &ampx &notit; &notin; &unknown; & &; &#; &#x;", "&#0;&#x80;&#150;&#xD800;&#x110000;&#99999999999;",
              "&#1;&#x7f;&#xfdd0;&#xfffe;&#13;", "&NotEqualTilde;&fjlig;&AMP&LT;", "&#128512;&#x1F600", "&lt;b&gt; a &lt b", "&ThisNameIsMuchTooLongToBeOneOfThoseThatAreKnown;", "x&#0000000000065;y", ""]


def texts(spark, values, f):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.x for r in df.select("k", f(F.col("v")).alias("x")).orderBy("k").collect()]


def test_references_as_the_standard_library(spark):
    rnd = random.Random(4)
    names = sorted(html.entities.html5)
    more = ["".join(rnd.choice(["&" + rnd.choice(names), f"&#{rnd.randrange(0, 0x3000)};", f"&#x{rnd.randrange(0x110100):x};", " text ", "a"]) for _ in range(12)) for _ in range(60)]
    assert texts(spark, REFERENCES + more, unescaped) == [html.unescape(v) for v in REFERENCES + more]


TAGS = [
    ("a < b and c > d", "a < b and c > d"), ("1<2, x<!-- c > d -->y", "1<2, x y"), ("<p title=\"a > b\">in</p>", "in"), ("<p title=it's>one</p> it's <b>two</b>", "one it's two"),
    ("<script>var a='</b>';</script >x", "x"), ("<SCRIPT src=x>never closed <b>", ""), ("keep <style>p{}</style> this", "keep this"), ("<scripture>seen</scripture>", "seen"),
    ("open <!-- comment", "open"), ("cut <a href=\"x", "cut"), ("<!DOCTYPE html><?xml version='1'?>t", "t"), ("</ >a</p>b", "a b"), ("a&nbsp;b\n\t c", "a b c"), ("5 <- 6 <3", "5 <- 6 <3"),
    ("<p " + "a='1' " * 20_000 + ">long</p>", "long"), ("<b>x</b>" * 3, "x x x"), (None, ""),
]


def test_tags(spark):
    assert texts(spark, [v for v, _ in TAGS], html_to_text) == [want for _, want in TAGS]


def test_pages_leave_no_reference_names(spark):
    from lectern.sources.documents import pages_table
    from tests.conftest import SF_SMALL

    held = pages_table(spark, SF_SMALL).select(F.sum(F.col("content").contains("&copy").cast("int")), F.sum(F.col("content").contains("©").cast("int"))).first()
    assert held[0] == 0 and held[1] > 0


def test_bytes(spark):
    cases = [("ţară".encode(), "ţară"), (b"\xef\xbb\xbfmark", "mark"), ("ţa".encode("utf-16"), "ţa"), (b"\xfe\xff\x00a\x00b", "ab"), (b"<meta charset=iso-8859-1>caf\xe9", "<meta charset=iso-8859-1>café"),
             (b"broken \xff", None), (b"", ""),
             (b"\xff\xfe odd number", None), ("\U0001f600é".encode("utf-16"), "\U0001f600é"), (b"\xfe\xff\xd8\x00\x00a", None), (b"\xff\xfe", "")]
    df = spark.createDataFrame([(k, bytearray(b)) for k, (b, _) in enumerate(cases)], "k int, v binary")
    assert [r.x for r in df.select("k", decoded_bytes(F.col("v")).alias("x")).orderBy("k").collect()] == [want for _, want in cases]
