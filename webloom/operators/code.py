"""Stylesheets and scripts: layout, repair, choice of rules, and the scripts that a component needs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import values as v
from ..sources.tables import table
from .html import below, css_rules

# fixed values: what a line of a selector may name, and how cut-off marks look
SELECTOR_TAGS = ("header", "footer", "nav", "div", "section", "button", "a", "ul", "li")
CUT_MARK = r"(?is)/[*]\s*[.][.][.]\s*.*?\s*[.][.][.]\s*[*]/"


def spaced_scripts(scripts: DataFrame, *keys: str) -> DataFrame:
    """keys, code: a statement a line, two spaces deeper in each brace, never below the margin; blank lines go. keys tell scripts apart.

    Lines are rows. The braces open before a line are a running sum, less the lowest that it came to below zero.
    """
    broken = F.regexp_replace(F.regexp_replace(F.regexp_replace("code", r"\{", " {"), r"([;{}])\s*", "$1\n"), r",\s*", ", ")
    lines = scripts.select(*keys, F.posexplode_outer(F.split(broken, "\n")).alias("at", "line")).withColumn("line", F.regexp_replace("line", r"^\s+|\s+$", ""))
    opens, closes = (F.col("line").endswith("{")).cast("int"), (F.col("line").startswith("}")).cast("int")
    so_far = Window.partitionBy(*keys).orderBy("at")
    lines = lines.withColumn("sum", F.sum(opens - closes).over(so_far) - opens)
    lines = lines.withColumn("depth", F.col("sum") - F.least(F.lit(0), F.min("sum").over(so_far)))
    shown = F.when(F.col("line") != "", F.concat(F.repeat(F.lit("  "), F.col("depth").cast("int")), "line"))
    return lines.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(shown.isNotNull(), F.struct("at", shown.alias("line"))))).alias("l")).select(*keys, F.array_join("l.line", "\n").alias("code"))


def repaired_css(css: Column) -> Column:
    """Without cut-off marks; bare variables gathered under :root if there is none, else dangling selectors left out.

    A line is dangling if it names a selector and neither it nor one of the four lines below has a brace. Lines within a
    comment of several lines stay, those that say that more was cut off go.
    """
    marked = F.regexp_replace(css, CUT_MARK, "")
    table = F.transform(F.split(marked, "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("line"), F.regexp_replace(x, r"^\s+|\s+$", "").alias("bare")))
    step = F.transform(F.array(F.struct(marked.alias("css"), table.alias("ls"))), lambda t: F.struct(t["css"].alias("css"), t["ls"].alias("ls"), F.transform(F.filter(t["ls"], lambda l: l["bare"].startswith("/*") & ~l["bare"].endswith("*/")), lambda l: l["at"]).alias("opened"), F.transform(F.filter(t["ls"], lambda l: F.contains(l["line"], F.lit("*/")) & ~(l["bare"].startswith("/*") & ~l["bare"].endswith("*/"))), lambda l: l["at"]).alias("closed"), F.transform(F.filter(t["ls"], lambda l: l["bare"].startswith("--") & F.contains(l["bare"], F.lit(":"))), lambda l: l["bare"]).alias("bare_variables")))
    return F.transform(step, settled)[0]


def settled(t: Column) -> Column:
    """The repaired sheet, from its lines (ls: at, line, bare), the places of lines that open and close comments, and its variables."""
    variables = t["bare_variables"]
    rest = F.transform(F.filter(t["ls"], lambda l: ~F.array_contains(variables, l["bare"])), lambda l: l["line"])
    rooted = F.concat(F.lit(":root {\n  "), F.array_join(variables, "\n  "), F.lit("\n}"), F.when(F.size(rest) > 0, F.concat(F.lit("\n\n"), F.array_join(rest, "\n"))).otherwise(""))

    def stays(l: Column) -> Column:
        last = lambda places, test: F.coalesce(F.array_max(F.filter(places, test)), F.lit(-1))
        commented = last(t["opened"], lambda o: o <= l["at"]) > last(t["closed"], lambda c: c < l["at"])
        names = l["bare"].endswith(",") | l["bare"].rlike("[.#@]") | F.lower(l["bare"]).rlike("|".join(SELECTOR_TAGS))
        braces = F.exists(F.slice(t["ls"], l["at"] + 2, F.lit(4)), lambda n: F.contains(n["line"], F.lit("{")))
        dangling = (l["bare"] != "") & ~l["bare"].startswith("--") & ~l["bare"].rlike("[:{}]") & names & ~braces
        cut_off = F.contains(l["bare"], F.lit("...")) & F.contains(F.lower(l["bare"]), F.lit("more"))
        return commented | ~(dangling | cut_off)

    kept = F.array_join(F.transform(F.filter(t["ls"], stays), lambda l: l["line"]), "\n")
    plain = F.regexp_replace(F.regexp_replace(kept, CUT_MARK, ""), r"^\s+|\s+$", "")
    return F.when((F.size(variables) > 0) & ~F.contains(t["css"], F.lit(":root")), rooted).otherwise(plain)


def obfuscated(code: Column, kind: str) -> Column:
    """Whether code ("js" or "css") is obfuscated or minified: by its patterns, or the lengths of its lines with what goes with them."""
    lines = F.filter(F.split(code, "\n"), lambda x: x.rlike(r"\S"))
    mean = F.length(F.array_join(lines, "")) / F.nullif(F.size(lines), F.lit(0))
    breaks = F.size(lines) / F.nullif(F.length(code), F.lit(0))
    longest, fewest, tight = {"js": (500, 0.01, r"[a-z]\{[a-z]|[a-z]\}[a-z]"), "css": (300, 0.005, ":[a-z]|;[a-z]")}[kind]
    marks = "|".join(re.escape(m) for m in v.BUILD_MARKS)
    odd = code.rlike("|".join(f"(?:{p})" for p in v.OBFUSCATED)) | ((mean > longest) & (breaks < fewest)) | ((mean > 200) & (code.rlike(tight) | F.lower(code).rlike(marks)))
    return F.coalesce((F.length(F.regexp_replace(code, r"^\s+|\s+$", "")) >= 50) & odd, F.lit(False))


def rules_with(rules: DataFrame, part: str) -> DataFrame:
    """page_id, css: the rules whose selector contains part (case aside), in order, a blank line between them."""
    rule = F.format_string("%s {\n%s\n}", "selector", "body")
    found = rules.where(F.contains(F.lower("selector"), F.lit(part.lower())))
    return found.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("rule_ord", rule.alias("rule")))).alias("r")).select("page_id", F.array_join("r.rule", "\n\n").alias("css"))


SCRIPTS = r"posexplode(regexp_extract_all(html, '(?is)<script(?![^>]*\\ssrc)[^>]*>(.*?)</script>', 1)) as (script_ord, code)"


def scripts(pages: DataFrame) -> DataFrame:
    """page_id, script_ord, code of the scripts that stand in the page."""
    return pages.select("page_id", F.expr(SCRIPTS))


def component_js(nodes: DataFrame, parts: DataFrame, code: DataFrame) -> DataFrame:
    """page_id, type, ord, script_ord of the scripts that name an id, class, data attribute or handler of a component.

    A script's names are whole tokens (#id, .class, a quoted id in getElementById or getElementsByClassName, dataset.x,
    a quoted data- name); they meet the component's in an equi-join. Classes by .name alone count in scripts with classList.
    """
    handlers = "array('onclick', 'onchange', 'onsubmit', 'onload', 'onerror')"
    named = F.expr(f"""array_compact(concat(
        array(if(attrs['id'] <> '', concat('#', lower(attrs['id'])), null)), transform(classes, c -> concat('.', lower(c))),
        transform(filter(map_keys(attrs), k -> startswith(k, 'data-')), k -> concat('@', k)),
        transform(filter(map_keys(attrs), k -> array_contains({handlers}, k)), k -> concat('#', k))))""")
    inside = below(nodes.select("page_id", "node_id", "levels", named.alias("names")), parts.select("page_id", "type", "ord", "root_id", "root_last")).select("page_id", "type", "ord", F.explode("names").alias("name")).distinct()
    find = lambda pattern: f"regexp_extract_all(lower(code), r'{pattern}', 1)"
    used = F.expr(f"""concat(
        transform({find(r'getelementbyid[(][\x22\x27]([^\x22\x27]+)')}, x -> concat('#', x)), transform({find(r'#([a-z_][\w-]*)')}, x -> concat('#', x)),
        transform({find(r'getelementsbyclassname[(][\x22\x27]([^\x22\x27]+)')}, x -> concat('.', x)), transform({find(r'queryselector[(][\x22\x27][.]([\w-]+)')}, x -> concat('.', x)),
        if(contains(lower(code), 'classlist'), transform({find(r'[.]([a-z_][\w-]*)')}, x -> concat('.', x)), array()),
        transform({find(r'dataset[.]([\w-]+)')}, x -> concat('@data-', x)), transform({find(r'getattribute[(][\x22\x27](data-[^\x22\x27]+)')}, x -> concat('@', x)))""")
    uses = code.select("page_id", "script_ord", F.explode(F.array_distinct(used)).alias("name"))
    return inside.join(uses, ["page_id", "name"]).select("page_id", "type", "ord", "script_ord").distinct()


def formatted_js(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_scripts(scripts(table(spark, sf_dir, "pages")), "page_id", "script_ord")


def css_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets(table(spark, sf_dir, "pages")).select("page_id", repaired_css(F.col("css")).alias("css"))


def sheets(pages: DataFrame) -> DataFrame:
    """page_id, css: the sheets that stand in a page, joined."""
    return pages.select("page_id", F.expr(r"array_join(regexp_extract_all(html, '(?is)<style[^>]*>(.*?)</style>', 1), '\n')").alias("css"))


def css_by_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_with(css_rules(sheets(table(spark, sf_dir, "pages"))), "p")


QUERIES = {"formatted_js": formatted_js, "css_repair": css_repair, "css_by_selector": css_by_selector}
