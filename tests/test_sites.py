import gzip
import json
import os

import pytest

from webloom.functions import encoding
from webloom.operators import html, numbering, sites
from webloom.plans import build
from webloom.sources import folders, paged

LIST = """<ul><li class="c-post-list__item"><a class="c-post-list__title-link" href="/d/1">x</a><a class="c-post-list__link" href="https://s.jp/"></a>
<h3 class="c-post-list__ttl"><a><span class="c-linelink__txt"> A shop </span></a></h3>
<div class="c-post-list__credit-detail"><dl><dt>URL</dt><dd><span>s.jp</span></dd><dt>著作権所有</dt><dt>制作者一覧</dt><dd>B, <b>C</b></dd></dl></div></li>
<li class="c-post-list__item"><a class="c-post-list__title-link" href="https://l.jp/d/2">y</a><a class="c-post-list__link" href="https://t.jp/"></a></li>
<li class="c-post-list__item"><a class="c-post-list__title-link" href="/d/3">no site</a></li></ul>"""
INFO = """<title>Shop</title><meta name="description" content=" Nice "><dl><dt>URL</dt><dd><a href="https://own.jp">own</a></dd>
<dt>CATEGORY</dt><dd><a>美容</a><a>web</a><a></a></dd><dt>制作者一覧</dt><dd>D</dd></dl>"""


def pages(spark, *texts):
    return spark.createDataFrame([(i, f"https://given/{i}", t) for i, t in enumerate(texts)], "page_id long, url string, html string")


def test_list_items(spark):
    rows = sites.list_items(html.Elements(pages(spark, LIST, None, "")), "https://l.jp/").orderBy("item_id").collect()
    assert [(r.detail_url, r.site_url, r.title) for r in rows] == [("https://l.jp/d/1", "https://s.jp/", "A shop"), ("https://l.jp/d/2", "https://t.jp/", "Unknown")]
    assert rows[0].credit_info.asDict() == {"url": "s.jp", "copyright": None, "creators": "B, C", "creator_source": None} and rows[1].credit_info is None


def test_site_metadata(spark):
    rows = {r.page_id: r for r in sites.site_metadata(pages(spark, INFO, None)).collect()}
    assert tuple(rows[0]) == (0, "https://own.jp", "Shop", ["美容", "web"], "Beauty", "D", "Nice")
    assert tuple(rows[1]) == (1, "https://given/1", "", [], "", "", "")


@pytest.mark.parametrize("name, url", [("httpsfoo.jp", "https://foo.jp"), ("httpfoo.jp", "http://foo.jp"), ("foo.jp", "https://foo.jp"), ("http://a.jp", "http://a.jp")])
def test_folder_urls(spark, name, url):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(sites.folder_url(df.n)).collect()[0][0] == url


@pytest.mark.parametrize(
    "raw, charset, packed, text",
    [
        ("<html><meta charset=Shift_JIS>日本".encode("shift_jis"), None, None, "<html><meta charset=Shift_JIS>日本"), ("<html>日本".encode("euc-jp"), "euc-jp", None, "<html>日本"), ("<html>日本".encode("shift_jis"), "ISO-8859-1", None, "<html>日本"),
        (gzip.compress(b"<html>x"), None, "gzip", "<html>x"), (b"<html>x", None, "gzip", "<html>x"), ("<html>é".encode(), None, None, "<html>é"), (b"\xff", "nonsense", None, "�"), (b"", None, None, ""), (None, None, None, None),
    ],
)
def test_charsets(raw, charset, packed, text):
    assert encoding.page_text(raw, charset, packed) == text


def test_numbers_have_no_gaps(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as k").repartition(7)
    assert all(r.number == r.k + 1 for r in numbering.numbered(df, "k").collect())
    assert numbering.resumed(df, 991, "k").count() == 10 and numbering.resumed(df, 1001, "k").count() == 1000 and numbering.numbered(df.limit(0), "k").count() == 0


def test_paging_stops():
    served = {0: "<li>a", 1: " ", 2: None, 3: "<li>b", 7: "<li>never"}
    fetch = lambda start, size: served.get(start)
    assert list(paged.pages(fetch, size=1)) == [(0, "<li>a"), (3, "<li>b")]
    assert list(paged.pages(lambda s, n: "nothing here")) == []


def test_attempts():
    calls = []

    def fails(start, size):
        calls.append(start)
        raise OSError

    assert paged.attempt(fails, 5, 1, pause=0) is None and calls == [5, 5, 5]


def test_shell(spark):
    df = spark.createDataFrame([("<p>x</p>",), ("<html>y",), ("a<HEAD>b<body>",)], "h string")
    first, second, third = (r[0] for r in df.select(folders.in_shell(df.h, df.h.isNotNull().cast("int"))).collect())
    assert "<title>Example 1</title>" in first and "<body>\n<p>x</p>\n</body>" in first and second == "<html>y" and third == "a<HEAD>b<body>"


def test_build_from_folders(spark, tmp_path):
    root = tmp_path / "sites"
    for name in ("httpsa.jp", "httpsb.jp"):
        (root / name / "assets").mkdir(parents=True)
        (root / name / "index.html").write_text(f'<html><head><link rel="stylesheet" href="/m.css"><link rel=stylesheet href="http://x/y.css"><script src="lib.js"></script></head><body><nav class="n">{name * 20}</nav></body></html>')
        (root / name / "assets" / "m.css").write_text(".n{color:red}")
        (root / name / "lib.js").write_text("x")
        (root / name / "assets" / "i.png").write_bytes(b"\x89\xff")  # no text
        (root / name / "metadata.json").write_text(json.dumps({"site_url": f"https://{name[5:]}", "title": "t"}, indent=2))
    (root / "httpsa.jp" / "info.html").write_text(INFO)
    (root / "empty").mkdir()
    assert sorted(r.site_url for r in folders.processed_sites(spark, str(root)).collect()) == ["https://a.jp", "https://b.jp"]
    rows = {r.site: r for r in build.site_table(spark, str(root)).collect()}
    assert rows["httpsa.jp"].url == "https://own.jp" and rows["httpsb.jp"].url == "https://b.jp" and rows["httpsb.jp"].html.endswith("<style>.n{color:red}</style>")
    jsonl, out = f"{tmp_path}/out", f"{tmp_path}/result"
    assert build.build(spark, str(root), jsonl, out) == {"component": 2, "full": 2}
    assert sorted(os.listdir(out)) == [f"example_{i:04d}" for i in range(1, 5)]
    texts = [open(f"{out}/{d}/instruction.txt").read() for d in sorted(os.listdir(out))]
    assert sum("Industry: Beauty" in t for t in texts) == 2 and all(".n" in open(f"{out}/{d}/style.css").read() for d in os.listdir(out))
    assert build.build(spark, str(root), jsonl) == {} and build.build(spark, str(root), jsonl, mode="overwrite", start=2) == {"component": 1, "full": 1}
