"""Every query with SQL gives what DuckDB gives on the same tables."""

import duckdb
import pytest

from webloom.functions.dialect import Duck, Spark
from webloom.plans import pages, registry

DATA = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("pages", "documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, con, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = con.execute(registry.SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert sorted(tuple(map(plain, r)) for r in df.select(*columns).collect()) == theirs


def test_native_queries_run_no_python(spark):
    for name in ("full_page_examples", "color_topk", "link_placeholders", "minified_flag"):
        plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_script_urls(spark):
    html = """<script src=x.js></script><script async SRC="//c.d/e.js"></script><script>x</script><script data-src="n.js"></script><script type='m' src='/r.js?v=1'>"""
    spark.createDataFrame([(1, "https://h.jp/a/b", html), (2, "https://h.jp/", None), (3, "https://h.jp/", "")], "page_id long, url string, html string").createOrReplaceTempView("pages")
    got = spark.sql(pages.script_urls(Spark())).orderBy("page_id", "nth").collect()
    assert [tuple(r) for r in got] == [(1, 1, "x.js", "https://h.jp/x.js"), (1, 2, "//c.d/e.js", "https://c.d/e.js"), (1, 3, "/r.js?v=1", "https://h.jp/r.js?v=1")]


def test_links_descriptions_and_pages_without_scripts(spark, con):
    links = {"../z": "https://a.com/z", "./c": "https://a.com/c", "a/../b/./c?x=../y": "https://a.com/b/c?x=../y", "/../../d": "https://a.com/d", "//o.org/x/../y": "https://o.org/x/../y", "?q": "https://a.com?q", "#t": "https://a.com#t", "x/..": "https://a.com/", "..": "https://a.com/", "b": "https://a.com/b"}
    heads = ["<title> A </title><meta name='description' content=\"D's page\">", "<title>T</title><meta content='say &quot;x&quot;' name=description>", '<meta property="x" content="no"><meta name="keywords" content="k">', "no tags", "", None]
    rows = [(i, "https://a.com/x/y?p=1", f'<a href="{h}">l</a>') for i, h in enumerate(links)] + [(100 + i, "https://a.com/", h) for i, h in enumerate(heads)]
    small = spark.createDataFrame(rows, "page_id long, url string, html string")
    small.createOrReplaceTempView("pages")
    duck = duckdb.connect()
    duck.register("pages", small.toPandas())
    run = lambda plan, sql: [tuple(r) for r in spark.sql(f"SELECT {sql} FROM ({plan(Spark())}) t ORDER BY page_id").collect()]
    same = lambda plan, sql: duck.execute(f"SELECT {sql} FROM ({plan(Duck())}) t ORDER BY page_id").fetchall()
    targets = run(pages.resolve_links, "target")
    assert [t for t, in targets] == list(links.values()) == [t for t, in same(pages.resolve_links, "target")]
    told = run(pages.page_titles, "title, description, page_id")[10:]
    assert [r[:2] for r in told] == [("A", "D's page"), ("T", 'say "x"'), ("", ""), ("", ""), ("", ""), (None, None)]
    assert {r[0] for r in run(pages.minified_flag, "minified, page_id")} <= {False, None}


def test_folder_names_of_hosts_that_begin_with_s_and_of_odd_urls(spark):
    told = {"http://sth.org/a": ("httpsth.org", "http://sth.org"), "https://sth.org?q#t": ("httpssth.org", "https://sth.org"), "http://s": ("https", "http://s")}
    odd = ["ftp://a.org/x", "HTTP://A.org", "a.org/x", "://a.org/x", "", "a:b://c/d", "http://a://b", "http:///x", "http://a\nb/c", "httpsa.org", "//a.org", "http://\U0001f600é.org/", None]
    small = spark.createDataFrame([(i, u, "") for i, u in enumerate([*told, *odd])], "page_id long, url string, html string")
    small.createOrReplaceTempView("pages")
    run = lambda plan: [tuple(r) for r in spark.sql(f"SELECT folder, target FROM ({plan}) t ORDER BY page_id").collect()]
    got = run(pages.folder_names(Spark()))
    assert got[: len(told)] == list(told.values())
    duck = duckdb.connect()
    duck.register("pages", small.toArrow())
    for sql in (registry.SQL["folder_names"], pages.folder_names(Duck())):
        assert got == duck.execute(f"SELECT folder, target FROM ({sql}) t ORDER BY page_id").fetchall()
