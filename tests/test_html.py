import random

from pyspark.sql import functions as F

from webloom.operators import html


def pages(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "page_id long, html string")


def test_elements_close_where_html_implies_it(spark):
    nodes = html.Elements(pages(spark, "<ul><li>a<li>b</ul><p>x<p>y<br>z", None, ""))
    rows = nodes.with_markup(nodes.with_text(nodes.nodes)).orderBy("page_id", "node_id").collect()
    assert [(r.tag, r.parent_id, r.text) for r in rows] == [("ul", None, "ab"), ("li", 0, "a"), ("li", 0, "b"), ("p", None, "x"), ("p", None, "yz"), ("br", 4, "")]
    assert rows[1].outer_html == "<li>a" and rows[0].outer_html == "<ul><li>a<li>b</ul>"


def test_card_sizes(spark):
    card = lambda n: f'<div class="card">{"x" * (n - len("<div class=\"card\"></div>"))}</div>'
    found = html.components(html.Elements(pages(spark, *map(card, (200, 201, 1999, 2000))))).where("type = 'cards'")
    assert sorted(r.page_id for r in found.collect()) == [1, 2]


def test_repeated_markup_counts_once_and_order_is_the_documents(spark):
    nav, other = (f"<nav>{c * 120}</nav>" for c in "ab")
    rows = html.components(html.Elements(pages(spark, nav + nav + other))).where("type = 'navigation'").orderBy("ord").collect()
    assert [(r.ord, r.html[5]) for r in rows] == [(1, "a"), (2, "b")]


def test_rules_keep_their_media_and_lose_comments():
    css = "@import url(x); .a{color:red} /* .b{} */ @media (max-width: 9px) { .c > p {x:y} } :root{--c: red} h1,.d{color:var(--c)}"
    assert html.rules_of(css) == [(".a", "", "color:red"), (".c > p", "@media (max-width: 9px)", "x:y"), (":root", "", "--c: red"), ("h1,.d", "", "color:var(--c)")]
    assert html.rules_of("a{b") == [("a", "", "b")] and html.rules_of("") == []


def test_component_css_matches_whole_tokens_and_brings_variables(spark):
    page = pages(spark, f'<nav class="nav">{"a" * 120}</nav>')
    nodes = html.Elements(page)
    sheets = spark.createDataFrame([(0, ".nav a{x:y} .navbar{z:w} :root{--c:red} nav{color:var(--c)} .other{}")], "page_id long, css string")
    rows = html.component_css(nodes.nodes, html.components(nodes), html.css_rules(sheets)).where("type = 'navigation'").collect()
    assert sorted(r.rule_ord for r in rows) == [0, 2, 3]


def test_deep_pages_stay_small(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    nodes = html.Elements(spark.range(90).coalesce(1).select(F.col("id").alias("page_id"), F.lit(deep).alias("html")))
    found = nodes.nodes.groupBy().agg(F.count("*").alias("n"), F.max("depth").alias("depth"), F.sum("text_size").alias("chars")).first()
    assert (found.n, found.depth, found.chars) == (270_000, 2999, 270_000)
    tops = nodes.nodes.where("page_id = 5 and node_id in (0, 2990)").select("page_id", F.col("node_id").alias("root_id"), F.col("last_id").alias("root_last"))
    assert html.below(nodes.nodes, tops).groupBy("root_id").count().sort("root_id").collect() == [(0, 3000), (2990, 10)]
    cut = nodes.with_markup(nodes.with_text(nodes.nodes.where("page_id = 7 and node_id = 2999"))).first()
    assert (cut.outer_html, cut.text) == ("<div>x</div>", "x")


def test_below_against_all_pairs(spark):
    rng = random.Random(3)
    parent = [None] + [rng.randrange(i) for i in range(1, 150)]
    order, at = [], {}

    def walk(n):
        at[n] = len(order)
        order.append(n)
        for child in (c for c in range(150) if parent[c] == n):
            walk(child)

    walk(0)
    last = {}
    for n in reversed(order):
        last[at[n]] = max([at[n], *(last[at[c]] for c in range(150) if parent[c] == n)])
    nodes = spark.createDataFrame([(0, i, 8) for i in range(150)], "page_id long, node_id int, levels int")
    tops = spark.createDataFrame([(0, i, last[i]) for i in range(150)], "page_id long, root_id int, root_last int")
    got = sorted((r.root_id, r.node_id) for r in html.below(nodes, tops).collect())
    assert got == [(i, j) for i in range(150) for j in range(i, last[i] + 1)]
