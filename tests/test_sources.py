import os
import tempfile

from pyspark.sql import functions as F

from lectern.functions.html import html_to_text
from lectern.sources.documents import folder, url_file_name


def test_folder_reads_every_file_recursively(spark):
    root = tempfile.mkdtemp(prefix="lectern-folder-")
    os.makedirs(f"{root}/sub")
    with open(f"{root}/a.txt", "w", encoding="utf-8") as f:
        f.write("alfa beta\nţară")
    with open(f"{root}/sub/b.txt", "w", encoding="utf-8") as f:
        f.write("gama")
    rows = sorted(folder(spark, root).collect(), key=lambda r: r.file_name)
    assert [r.file_name for r in rows] == ["a.txt", "b.txt"]
    assert rows[0].content == "alfa beta\nţară" and rows[1].content == "gama"
    assert len({r.doc_id for r in rows}) == 2


def test_html_to_text_and_url_names(spark):
    html = ('<html><head><title>T&amp;x</title><style>p{}</style><script>var a="<p>";</script></head>'
            '<body><!-- c --><p>Alfa&nbsp;beta</p>\n<p>gama</p></body></html>')
    df = spark.createDataFrame([(html, "https://h.example.com/a/b/page.html?x=1#top")], "html string, url string")
    r = df.select(html_to_text(F.col("html")).alias("t"), url_file_name(F.col("url")).alias("n")).first()
    assert r.t == "T&x Alfa beta gama"
    assert r.n == "page.html"
