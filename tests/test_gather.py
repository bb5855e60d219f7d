import json
import os

from tests.list_pages import listing as fetch_list
from tests.list_pages import web

from webloom.plans import gather
from webloom.sources.paged import PagedList, pages


def test_sites_of_a_list(spark, tmp_path):
    listing = spark.createDataFrame(list(pages(fetch_list)), "page_id long, html string")
    target = str(tmp_path / "sites")
    assert gather.gather(spark, listing, target, web, "https://l.jp", most=2, pause=0) == {"processed": 1, "skipped": 1, "failed": 1}
    first = f"{target}/s1.jp"
    assert sorted(f for _, _, fs in os.walk(first) for f in fs if not f.startswith(".")) == sorted(["index.html", "info.html", "metadata.json", "inline_styles.css", "inline_styles_info.css", "inline_scripts.js", "inline_scripts_info.js", *["m_1.css", "a.js", "i.png"] * 2])
    html = open(f"{first}/index.html").read()
    assert 'href="assets/m_1.css"' in html and 'src="assets/a.js"' in html and 'src="assets/images/i.png"' in html and 'src="/t.png"' in html and "assets/m.css" not in html
    assert open(f"{first}/inline_styles.css").read() == "b{}\n\nc{}" and open(f"{first}/inline_scripts.js").read() == "run()" and open(f"{first}/assets/images/i.png", "rb").read() == b"\x89\xff"
    told = json.load(open(f"{first}/metadata.json"))
    assert told["site_url"] == "https://s1.jp/" and told["download_results"] == {"html": True, "css": True, "js": True} and told["title"] == "Unknown"
    assert json.load(open(f"{target}/s2.jp/metadata.json"))["download_results"] == {"html": False, "css": False, "js": False} and os.listdir(f"{target}/s2.jp").count("index.html") == 0
    os.remove(f"{first}/metadata.json")  # both pages are there
    assert gather.gather(spark, listing, target, web, "https://l.jp", pause=0) == {"processed": 1, "skipped": 2, "failed": 0}
    assert not os.path.exists(f"{target}/s3.jp/info.html") and os.path.exists(f"{target}/s3.jp/index.html")
    assert gather.gather(spark, listing, target, web, "https://l.jp", pause=0, fresh=True, most=1) == {"processed": 1, "skipped": 2, "failed": 0} and sorted(os.listdir(target)) == ["s1.jp"]


def test_empty_list(spark, tmp_path):
    listing = spark.createDataFrame([], "page_id long, html string")
    assert gather.gather(spark, listing, str(tmp_path / "none"), web, "https://l.jp") == {"processed": 0, "skipped": 0, "failed": 0}


def test_folders_stay_below_the_target(spark):
    df = spark.createDataFrame([("https://a.jp/../../b/",), ("http://x.jp/?q=1",), ("..",)], "u string")
    assert [r[0] for r in df.select(gather.site_folder(df.u)).collect()] == ["a.jp/_/_/b", "x.jp/_q=1", "_"]


def test_paged_list_through_spark(spark, monkeypatch):
    spark.dataSource.register(PagedList)
    found = spark.read.format("paged").option("fetch", "tests.list_pages:listing").option("pause", "0").load().collect()
    assert [r.page_id for r in found] == [0, 20]
