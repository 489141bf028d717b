"""Text of markup against a parser of the standard library, on whole pages and on odd pieces."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from lectern.functions.html import strip_html, unescape
from lectern.functions.text import stringify


class Texts(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.said = []

    def handle_data(self, data):
        self.said.append(data)

    def _apart(self, *_):
        self.said.append(" ")

    handle_starttag = handle_endtag = handle_startendtag = handle_comment = handle_decl = handle_pi = unknown_decl = _apart


def plain(markup):
    parser = Texts()
    parser.feed(markup)
    parser.close()
    return " ".join("".join(parser.said).split())


def stripped(spark, texts, **how):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.o for r in df.orderBy("i").select(strip_html(F.col("t"), **how).alias("o")).collect()]


def test_pages(spark, sf):
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert [t for t, page in zip(stripped(spark, pages), pages, strict=True) if t != plain(page or "")] == [] and len(pages) > 20


def test_random_markup(spark):
    rnd = random.Random(3)
    pieces = ["a", "b c", " ", "\n", "<b>", "</b>", "<br/>", '<a href="x>y">', "<i class='a>b'>", "<!-- c <b> -->", "&amp;", "&lt;p&gt;", "&#233;", "&#x1F600;", "<script>var a = '<b>' < 3;</script>", "<style>p > a {}</style>", "<!DOCTYPE html>", "é", "1 < 2", "<table><tr><td>x</td><td>y</td></tr></table>", "<?php x ?>", " "]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(0, 14))) for _ in range(1500)]
    assert [(t, s) for t, s in zip(texts, stripped(spark, texts), strict=True) if s != plain(t)] == []


def test_odd_pieces(spark):
    texts = {
        "<b>one</b>two <i>three</i>": "one two three", "a<!-- never closed": "a", "a<!-->b": "a b", "a<!--x--!>b": "a b", "a<b": "a", "5 < 6 & 7": "5 < 6 & 7", "<p title=\"a>b\" x='c>d'>t": "t", "a</>b</ x>c": "a b c", "<SCRIPT>x<b>y</script >z": "x<b>y z",
        "<script>a &amp; b</script>": "a &amp; b", "<title>a &amp; <b>b</title>c": "a & <b>b c", "<textarea>never": "never", "<scripty>a<b>b</scripty>": "a b", "<style>p{}": "p{}", "&nbsp;&copy;&unknown;&#0;&#xD800;&amp": "©&unknown;��&", "<![CDATA[x]]>y": "y", "": "", "\x00a": "�a",
    }
    assert dict(zip(texts, stripped(spark, list(texts)), strict=True)) == texts
    assert stripped(spark, [None, "<script>x</script>y<title>t</title>"], raw=False) == [None, "y t"]
    long = "<p " + "a=\"b\" " * 100_000 + ">" + "word " * 100_000 + "<!--" + "-" * 200_000 + "--><script>" + "x<y " * 50_000 + "</script>"
    assert stripped(spark, [long]) == [("word " * 100_000 + "x<y " * 50_000).strip()]
    df = spark.createDataFrame([(["<b>a</b>b", " c "],)], "x array<string>")
    assert tuple(df.select(stringify(F.col("x"), True), stringify(F.col("x")), unescape(F.lit("&#65;&gt;"))).first()) == ("[a b|c]", "[<b>a</b>b|c]", "A>")


def test_references_that_must_end(spark):
    texts = {"a&amp</h1>b&amp;": "a&amp b&", "&#65&#65;&quot": "&#65A&quot", "<title>x&lt;&lt</title>": "x<&lt"}
    assert dict(zip(texts, stripped(spark, list(texts), open_ended=False), strict=True)) == texts
    assert stripped(spark, ["a&amp</h1>b&amp;"]) == ["a& b&"]


def test_cut_references_of_pages_against_sql(spark, tmp_path):
    import duckdb

    from lectern.plans import text

    pages = [(1, "<title>a &quot;b&amp;&amp</title><h1>a &quot;b&amp;&amp</h1>", ""), (2, "<title>t &quot;x</title>c &amp", "")]
    spark.createDataFrame(pages, "page_id long, html string, url string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(map(tuple, text.QUERIES["strip_html"](spark, str(tmp_path)).collect())) == sorted(con.execute(text.ORACLES["strip_html"]).fetchall())
