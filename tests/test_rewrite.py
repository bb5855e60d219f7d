from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from webloom.functions import urls
from webloom.operators import code, rewrite


def over(spark, function, *cases, **more):
    """What function makes of pages: markup, or (markup, url)."""
    rows = [(i, *(c if isinstance(c, tuple) else (c, "https://h.org/p/q"))) for i, c in enumerate(cases)]
    return [r.html for r in function(spark.createDataFrame(rows, "page_id long, html string, url string"), **more).orderBy("page_id").collect()]


IMAGES = [
    ("<div class=hero><img src=a.png></div>", '<div class=hero><img src="https://picsum.photos/1920/1080"></div>'),
    ("<img src=a.png width=100% height=50>", '<img src="https://picsum.photos/800/600" width="100%" height="50">'),
    ("<img src=a.png width=10 height=20 data-src=b>", '<img src="https://picsum.photos/10/20" width="10" height="20">'),
    ("<img class='site-LOGO' src=a.png width=9>", '<img class="site-LOGO" src="https://picsum.photos/64/64" width="9">'),
    ("<img src=https://picsum.photos/1/2 data-src=x><img>", "<img src=https://picsum.photos/1/2 data-src=x><img>"),
    ("<p style='background:url(x.png)'>", '<p style="background:url(&quot;https://picsum.photos/800/600&quot;)">'),
    ("<style>a{b:url('x.PNG')} c{d:url(x.woff)}</style>", '<style>a{b:url("https://picsum.photos/800/600")} c{d:url(x.woff)}</style>'),
    ("日本<img src=é.png alt='&amp;é'/>語<style>/* 語 */ a{b:url(é.png)}</style>é", '日本<img src="https://picsum.photos/800/600" alt="&amp;é"/>語<style>/* 語 */ a{b:url("https://picsum.photos/800/600")}</style>é'),
    ("", ""),
    (None, None),
]


def test_placeholder_images(spark):
    assert over(spark, rewrite.placeholder_images, *(html for html, _ in IMAGES)) == [new for _, new in IMAGES]


def test_placeholder_links(spark):
    cases = [
        ("https://x.com/p", "About us", "/about"), ("https://twitter.com/u", "News", "#"), ("https://x.com/a/b/", "", "/b"), ("https://x.com", "日本", "#"), ("https://x.com", "会社概要", "/about"),
        ("https://x.com/p", "Hello,  World!", "/hello-world"), ("/own", "About", "/own"), ("mailto:a@b", "x", "mailto:a@b"), ("#top", "x", "#top"),
    ]
    assert over(spark, rewrite.placeholder_links, *(f'<a href="{href}"><b>{label}</b></a>' for href, label, _ in cases)) == [f'<a href="{to}"><b>{label}</b></a>' for _, label, to in cases]
    assert over(spark, rewrite.placeholder_links, '<form action="https://a.b/c"><form action="/d">', '<a href="https://x.com/p">Our <b> fine </b> shop</a>') == ['<form action="#"><form action="/d">', '<a href="/ourfineshop">Our <b> fine </b> shop</a>']


def test_assets_of_the_own_host_are_local(spark):
    html = '<img srcset="/a/b.png 1x, https://o.org/c.png 2x"><link href="https://h.org/s.css"><p style="background:url(https://h.org/d?x)">'
    new = '<img srcset="assets/images/b.png 1x, https://o.org/c.png 2x"><link href="/s.css"><p style="background:url(assets/images/d.jpg)">'
    assert over(spark, rewrite.local_assets, (html, "https://h.org/p"), (html, "nowhere"), (html, None), (None, "https://h.org/p")) == [new, html, html, None]


FILES = [
    (
        '<link rel="stylesheet" href="/a/m.css"><link rel="stylesheet" href="b/m.css"><link rel="stylesheet" href="https://h.org/a/m.css"><link rel="icon" href="i.ico">',
        '<link rel="stylesheet" href="assets/m.css"><link rel="stylesheet" href="assets/m_1.css"><link rel="stylesheet" href="assets/m.css"><link rel="icon" href="i.ico">',
    ),
    ('a<script src="https://cdnjs.org/x.js">f()</script>b<script>g()</script>', "ab<script>g()</script>"),
    ('<script src="x/main?v=2"></script><script src="/"></script>', '<script src="assets/main.js"></script><script src="assets/script.js"></script>'),
    (
        '<img src="/x/y"><img src="https://www.h.org/x/z.PNG"><img src="https://o.org/a.png"><img src="data:,"><img src="#">',
        '<img src="assets/images/y.jpg"><img src="assets/images/z.PNG"><img src="https://o.org/a.png"><img src="data:,"><img src="#">',
    ),
    ('<p><script src="l.js"><b></script><link rel="stylesheet" href="l.css"><img src="l.png">', '<p><img src="l.png">'),
    (
        '<img src="a/x.png?1"><img src="b/x.png"><img src="x_1.png"><img src="a/x.png?1"><img src="c/x.png">',
        '<img src="assets/images/x.png"><img src="assets/images/x_1.png"><img src="assets/images/x_1_1.png"><img src="assets/images/x.png"><img src="assets/images/x_2.png">',
    ),
    ('<img src="http://[x" srcset="http://[x 1x"><script src="http://[x"></script>', '<img src="http://[x" srcset="http://[x 1x">'),
]


def test_files_of_a_page_are_local(spark):
    failed = spark.createDataFrame([(4, f"https://h.org/l.{k}") for k in ("js", "css", "png")], "page_id long, whole string")
    assert over(spark, rewrite.localized, *(html for html, _ in FILES), failed=failed) == [new for _, new in FILES]
    sheets = FILES[0][0]
    assert over(spark, rewrite.localized, *((sheets, url) for url in ("http://[x", "nowhere", None)), "", None) == [sheets] * 3 + ["", None]


def test_failed_files_keep_their_names(spark):
    html = '<html><link rel="stylesheet" href="/a/m.css"><link rel="stylesheet" href="/b/m.css"></html>'
    pages = spark.createDataFrame([(0, html, "https://h.jp/")], "page_id long, html string, url string")
    assert sorted((r.whole, r.name) for r in rewrite.named_files(pages).collect()) == [("https://h.jp/a/m.css", "assets/m.css"), ("https://h.jp/b/m.css", "assets/m_1.css")]
    failed = spark.createDataFrame([(0, "https://h.jp/a/m.css")], "page_id long, whole string")
    assert rewrite.localized(pages, failed).first().html == '<html><link rel="stylesheet" href="assets/m_1.css"></html>'


PRETTY = [
    ("<!DOCTYPE html><ul><li>a &amp; b<li><br>c</ul><!--d-->", "<!DOCTYPE html>\n<ul>\n <li>\n  a &amp; b\n </li>\n <li>\n  <br>\n  c\n </li>\n</ul>\n<!--d-->"),
    ("<svg><linearGradient/><clipPath>x</clipPath></svg>", "<svg>\n <linearGradient/>\n <clipPath>\n  x\n </clipPath>\n</svg>"),
    ("<textarea><b>&lt;x</textarea>é<script>a<b</script>", "<textarea>\n &lt;b&gt;&lt;x\n</textarea>\né\n<script>\n a<b\n</script>"),
    ("", ""),
    (None, None),
]


def test_pretty(spark):
    assert over(spark, rewrite.pretty, *(html for html, _ in PRETTY)) == [new for _, new in PRETTY]


def test_prepared(spark):
    html = "<!-- saved from url=x --><p><a href='https://x.com/a'>About</a><!-- kept --><img src=y><style>a{b:url(c.png)}</style>"
    new = '<p>\n <a href="/about">\n  About\n </a>\n <!-- kept -->\n <img src="https://picsum.photos/800/600">\n <style>\n  a{b:url("https://picsum.photos/800/600")}\n </style>\n</p>'
    assert over(spark, rewrite.prepared, html, None, "") == [new, None, ""]


def test_an_edit_within_another_goes_with_it(spark):
    pages = spark.createDataFrame([(0, "aébcdef"), (1, "x")], "page_id long, html string")
    edits = spark.createDataFrame([(0, 1, 5, "-"), (0, 3, 4, "lost"), (0, 5, 6, "+"), (0, 8, 8, "!")], "page_id long, start int, end int, text string")
    assert [r.html for r in rewrite.edited(rewrite.Elements(pages), edits).orderBy("page_id").collect()] == ["a-+ef!", "x"]


BASES = ["https://a.com", "https://a.com/", "http://a.com/x/y?q=1#f", "https://a.com/x/", "//h/p", ""]
LINKS = ["b", "/b", "../z", "./c", "a/../b", "a/./b/", "..", ".", "../..", "//h.org/a/../b", "?x=1", "#top", "", "mailto:a@b", "http://o.org/a/../b", "a//b", "/a//b/../c", "x/..", "javascript:f()", "HTTP://o.org/x", "https:foo", " /a\tb", "a?b=../c", "/../../a", "b/../.."]


def test_references_lead_where_urllib_says(spark):
    rows = [(base, link) for base in BASES for link in LINKS]
    out = spark.createDataFrame(rows, "b string, l string")
    out = urls.with_joined(out, "b", "l", "j").collect()
    assert [r for r in out if r.j != urljoin(r.b, r.l)] == []


def test_scripts_are_spaced(spark):
    cases = [("if(a){b();}", "if(a) {\n  b();\n}"), ("}}a,b", "}\n}\na, b"), ("", ""), ("}{a;{b}", "}\n{\n  a;\n  {\n    b}"), ("x\n\n y", "x\ny")]
    out = code.spaced_scripts(spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "id long, code string"), "id")
    assert [r.code for r in out.orderBy("id").collect()] == [new for _, new in cases]


@pytest.mark.parametrize(
    "css, new",
    [
        ("--c: red;\np{}", ":root {\n  --c: red;\n}\n\np{}"), (":root{\n--c: red;\n}", ":root{\n--c: red;\n}"), ("a{} /* ... cut ... */", "a{}"), ("header,\n.x\np", "p"), (".a,\n.b {\n}", ".a,\n.b {\n}"),
        ("/* x\n.a\n*/\nb{}", "/* x\n.a\n*/\nb{}"), ("... 3 more rules\np{}", "p{}"), ("", ""),
    ],
)
def test_css_repair(spark, css, new):
    assert spark.createDataFrame([(css,)], "css string").select(code.repaired_css(F.col("css"))).first()[0] == new


def test_minified_code_is_told_from_code_laid_out(spark):
    tight, plain = "p{color:red;margin:0}" * 30, "p {\n  margin: 0;\n}\n" * 30
    cases = [(tight, "css", True), (plain, "css", False), ("function a(){return b}" * 30, "js", True), ("const a = 1;\n" * 30, "js", False), ("x" * 40 + "eval(1)" + "y" * 20, "js", True), ("eval(1)", "js", False), ("/* webpack */ " + "w " * 150, "css", True), (None, "js", False)]
    for text, kind, want in cases:
        assert spark.createDataFrame([(text,)], "t string").select(code.obfuscated(F.col("t"), kind)).first()[0] == want, (text, kind)
