"""Character references, in both engines, against the standard library's decoder."""

import html
from html.entities import html5

import duckdb
import pytest

from webloom.functions.dialect import Duck, Spark
from webloom.functions.entities import unescaped
from webloom.plans import pages

CASES = ["&copy; &eacute; &#233; &#x1F600; &notit;", "&notin;&not;&notx&NOT", "&amp;lt; &amplt; &ampamp;", "&#0;&#13;&#128;&#x80;&#129;&#150;&#x9f;&#160;", "&#xD800;&#55296;&#1114111;&#1114112;&#x110000;&#xFFFFFFFFFFFFFFFFFFFF;&#99999999999999999999;", "&#1;&#8;&#9;&#10;&#11;&#12;&#14;&#127;&#xFFFE;&#x1FFFF;&#xFDD0;", "&", "&&", "&;", "&#;", "&#x;", "&#xg;", "&unknown; &gt &gtx; &GT", "a&ltb&lt;c &nbsp;&nbsp d", "&NewLine;&Tab;&acE;&NotEqualTilde;", "&CounterClockwiseContourIntegral;" + "&" + "x" * 60 + ";", "&copyé &#65é &#x41g", "&#00065;&#x00041;", "日本 & 語 &hearts;", "", "x" * 100_000 + "&amp;", "&lt" * 2000, None, "'\\ &apos;&#39;\n"]


@pytest.fixture(scope="module")
def texts():
    return CASES + ["".join(f"&{n}|" for n in html5), "".join(f"&{n}x" for n in html5 if not n.endswith(";")), "".join(f"&#{n};|" for n in range(0, 700))]


def test_in_spark(spark, texts):
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").createOrReplaceTempView("told")
    got = dict(map(tuple, spark.sql(f"SELECT i, {unescaped(Spark(), 't')} FROM told").collect()))
    assert [got[i] for i in range(len(texts))] == [None if t is None else html.unescape(t) for t in texts]


def test_in_duckdb(texts):
    """Its lookups are slow: all but the long lists."""
    texts = [t for t in texts if t is None or len(t) < 5000]
    con = duckdb.connect()
    con.execute("CREATE TABLE told (i INT, t VARCHAR)")
    con.executemany("INSERT INTO told VALUES (?, ?)", list(enumerate(texts)))
    got = con.execute(f"SELECT {unescaped(Duck(), 't')} FROM told ORDER BY i").fetchall()
    assert [r[0] for r in got] == [None if t is None else html.unescape(t) for t in texts]


def test_titles_and_visible_texts(spark):
    page = "<title> A &amp; B&eacute;&nbsp;</title><meta name=description content='&copy; &quot;C&quot;'><p>&lt;x&gt; &#x1F600;&nbsp;&notit; &amp;copy;</p><script>&lt;</script>"
    spark.createDataFrame([(1, "https://a.com/", page), (2, "https://a.com/", None)], "page_id long, url string, html string").createOrReplaceTempView("pages")
    titles = dict((r.page_id, (r.title, r.description)) for r in spark.sql(pages.page_titles(Spark())).collect())
    texts = dict(map(tuple, spark.sql(pages.visible_text(Spark())).select("page_id", "text").collect()))
    assert titles == {1: ("A & Bé\xa0", '© "C"'), 2: (None, None)} and texts == {1: "A & Bé <x> 😀 ¬it; &copy;", 2: None}
