from webloom.operators import code, examples, html

DATA = "/root/testdata/sf0.001"
PAGE = (
    "<title>Beauty salon</title><meta name=viewport><style>.nav a{color:red} .hero{x:y} @media print{.card{z:w}}</style>"
    + f"<header id=top>{'h' * 120}</header><nav class=nav>{'n' * 120}</nav><section class=hero>{'s' * 220}</section><section>{'t' * 220}</section>"
    + "".join(f'<div class="card">{c * 300}</div>' for c in "abcde")
)


def folder(spark, tmp_path):
    spark.createDataFrame([(7, "http://a.b", PAGE), (8, None, None), (9, "http://c.d", "")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def test_component_examples(spark, tmp_path):
    rows = {(r.type, r.ord): r for r in examples.component_examples(spark, folder(spark, tmp_path)).collect()}
    assert {t for t, _ in rows} == {"headers", "navigation", "sections", "hero", "cards"} and ("cards", 5) in rows and all(r.page_id == 7 for r in rows.values())
    nav, card = rows["navigation", 1], rows["cards", 1]
    assert nav.instruction.startswith("Industry: Beauty\nBrand tone: Elegant, Refined, Aesthetic\nColor scheme: Mixed\nRequirements: Responsive")
    assert "- Design style: Elegant, Refined, Aesthetic design style\n" in nav.output and nav.output.endswith("```css\n/* inline */\n.nav a {\ncolor:red\n}\n```")
    assert "@media print {\n.card {\nz:w\n}\n}" in card.output and "```css" not in rows["headers", 1].output


def test_grouped_examples(spark, tmp_path):
    rows = {r["shape"]: r for r in examples.grouped_examples(spark, folder(spark, tmp_path)).collect()}
    assert set(rows) == {"header_hero", "header_navigation", "sections", "cards"}
    assert "combined Card + Card + Card + Card component group" in rows["cards"].instruction and "e" * 300 not in rows["cards"].output
    shown = rows["header_hero"].output
    assert shown.index("hhh") < shown.index("sss") and ".hero {\nx:y\n}" in shown and ".nav" not in shown
    assert "- Component group: Section + Section working" in rows["sections"].output


def test_examples_are_united(spark, tmp_path):
    path = folder(spark, tmp_path)
    kinds = {r.kind: r["count"] for r in examples.training_examples(spark, path).groupBy("kind").count().collect()}
    assert kinds == {"component": 10, "grouped": 4, "full": 1}
    assert examples.training_examples(spark, path, full_page=False).where("kind = 'full'").count() == 0


def test_component_scripts_match_whole_names(spark):
    page = spark.createDataFrame([(0, f'<nav id=top class=menu data-open=1>{"x" * 120}</nav>')], "page_id long, html string")
    nodes = html.Elements(page)
    texts = ['document.getElementById("top")', "getElementById('topper')", "x('#top')", "a.menu.classList", "a.menu", "el.dataset.open", "y"]
    found = code.component_js(nodes.nodes, html.components(nodes), spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "page_id long, script_ord int, code string"))
    assert sorted(r.script_ord for r in found.collect()) == [0, 2, 3, 5]


def test_rules_by_selector(spark):
    sheet = spark.createDataFrame([(0, ".Nav a{x:y} p{} nav{z:w}")], "page_id long, css string")
    assert code.rules_with(html.css_rules(sheet), "NAV").collect()[0].css == ".Nav a {\nx:y\n}\n\nnav {\nz:w\n}"


def test_examples_parse_each_page_once(spark, tmp_path, monkeypatch):
    parses, parsed = [], html.parsed
    monkeypatch.setattr(html, "parsed", lambda pages: parses.append(1) or parsed(pages))
    examples.training_examples(spark, folder(spark, tmp_path)).collect()
    assert len(parses) == 1
