"""Training examples of components and of groups of them, beside those of full pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import values as v
from ..functions.dialect import Spark
from ..plans import pages as plans
from ..sources.tables import materialize, spread, table, views
from .code import component_js, scripts, sheets
from .html import Elements, component_css, components, css_rules
from .reasoning import reasoned

#: A group's markup is cut here.
GROUP_LIMIT = 200_000
#: name: the components it takes (type, at most, name shown) and how many it needs
GROUPS = {"header_hero": ((("headers", 1, "Header"), ("hero", 1, "Hero")), 2), "header_navigation": ((("headers", 1, "Header"), ("navigation", 1, "Navigation")), 2), "sections": ((("sections", 3, "Section"),), 2), "cards": ((("cards", 4, "Card"),), 2)}


def lines(*parts: Column) -> Column:
    return F.concat_ws("\n", *parts)


def said(label: str, column: str, test: Column | None = None) -> Column:
    """label and a value on a line; null where there is none."""
    return F.when(F.col(column) != "" if test is None else test, F.concat(F.lit(label), F.col(column)))


def lookup(values: dict[str, str], key: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[key]


def fenced(html: Column, css: Column) -> Column:
    return lines(F.lit("\nCode:\n```html"), html, F.lit("```"), F.when(css != "", lines(F.lit("\n```css"), css, F.lit("```"))))


def characteristics(spark: SparkSession, sf_dir: str, own: bool = False) -> DataFrame:
    """page_id and what is known of a page's design."""
    views(spark, sf_dir, ("pages",))
    return spark.sql(f"WITH {plans.characteristics(Spark(), own)} SELECT page_id, industry, tone, layout, photo_usage, responsive, scheme, css AS page_css FROM ch")


def rules_text(matched: DataFrame, rules: DataFrame, *keys: str) -> DataFrame:
    """keys, css: the matched rules in the order of the sheet, those of at-rules within them."""
    rule = F.when(F.col("media") != "", F.format_string("%s {\n%s {\n%s\n}\n}", "media", "selector", "body")).otherwise(F.format_string("%s {\n%s\n}", "selector", "body"))
    whole = matched.select("page_id", *keys, "rule_ord").distinct().join(rules.select("page_id", "rule_ord", rule.alias("rule")), ["page_id", "rule_ord"])
    listed = whole.groupBy("page_id", *keys).agg(F.array_sort(F.collect_list(F.struct("rule_ord", "rule"))).alias("r"))
    return listed.select("page_id", *keys, F.concat(F.lit("/* inline */\n"), F.array_join("r.rule", "\n\n")).alias("css"))


def with_keywords(shown: DataFrame) -> DataFrame:
    """Design keywords of the page's stylesheet and the markup shown."""
    words = F.expr(Spark().join(plans.keywords(Spark(), "combined"), ", "))
    return shown.withColumn("combined", F.lower(F.concat_ws(" ", "page_css", "html"))).withColumn("keywords", words).drop("combined")


def head(*more: Column) -> Column:
    return lines(said("Industry: ", "industry"), said("Brand tone: ", "tone"), said("Color scheme: ", "scheme"), F.when(F.col("responsive"), F.lit("Requirements: Responsive design (mobile-first)")), said("Design style: ", "keywords"), *more)


def valid(examples: DataFrame) -> DataFrame:
    return examples.where("length(instruction) >= 50 and length(output) >= 100 and contains(output, '```')")


def of_components(parts: DataFrame, css: DataFrame, traits: DataFrame) -> DataFrame:
    """page_id, type, ord, instruction, output of each component."""
    shown = with_keywords(parts.join(css, ["page_id", "type", "ord"], "left").join(traits, "page_id")).na.fill("", ["css"])
    reasoning = lines(
        F.concat(F.lit("- "), lookup(v.COMPONENT_REASONS, F.col("type"))), F.concat(F.lit("- Design style: "), F.coalesce(lookup(v.TONE_REASONS, F.col("tone")), F.concat("tone", F.lit(" design style")))), said("- Design features: ", "keywords"),
        F.when(F.col("layout") != "Standard", F.format_string("- Layout approach: %s layout structure for optimal content organization", "layout")),
        F.when(F.col("responsive"), F.lit("- Responsive design: Mobile-first approach with flexible grid system and breakpoints for all devices")),
        F.format_string("- Color palette: %s color scheme supporting brand identity and visual hierarchy", "scheme"), F.format_string("- Visual content: %s imagery to support brand message and user engagement", "photo_usage"),
    )
    instruction = head(F.concat(F.lit("Task: "), lookup(v.COMPONENT_TASKS, F.col("type"))), F.lit(v.PLACEHOLDER_NOTE))
    return valid(shown.select("page_id", "type", "ord", instruction.alias("instruction"), lines(F.lit("Design reasoning:"), reasoning, fenced(F.col("html"), F.col("css"))).alias("output")))


def groups(parts: DataFrame) -> DataFrame:
    """page_id, shape, names, html, members (type and ord) of each group that has enough components."""
    takes = F.array(*(F.struct(F.lit(i).alias("at"), F.lit(shape).alias("shape"), F.lit(kind).alias("kind"), F.lit(most).alias("most"), F.lit(name).alias("name"), F.lit(least).alias("least")) for shape, (members, least) in GROUPS.items() for i, (kind, most, name) in enumerate(members)))
    taken = parts.where(F.col("ord") <= max(m for ms, _ in GROUPS.values() for _, m, _ in ms)).withColumn("t", F.explode(takes)).where("t.kind = type and ord <= t.most")
    listed = taken.groupBy("page_id", "t.shape", "t.least").agg(F.array_sort(F.collect_list(F.struct("t.at", "ord", "t.name", "html", "type"))).alias("m")).where("size(m) >= least")
    joined = F.array_join("m.html", "\n")
    cut = F.when(F.length(joined) > GROUP_LIMIT, F.concat(F.substring(joined, 1, GROUP_LIMIT), F.lit("\n<!-- ... more components ... -->"))).otherwise(joined)
    return listed.select("page_id", "shape", F.array_join("m.name", " + ").alias("names"), cut.alias("html"), F.expr("transform(m, x -> struct(x.type, x.ord))").alias("members"))


def of_groups(found: DataFrame, css: DataFrame, traits: DataFrame) -> DataFrame:
    """page_id, shape, instruction, output of each group."""
    shown = with_keywords(found.join(css, ["page_id", "shape"], "left").join(traits, "page_id")).na.fill("", ["css"])
    reasoning = lines(
        F.format_string("- Component group: %s working together harmoniously", "names"), F.format_string("- Design style: %s brand tone with consistent visual language", "tone"), said("- Design features: ", "keywords"),
        F.when(F.col("responsive"), F.lit("- Responsive: Mobile-first approach with flexible layout system")), F.format_string("- Color palette: %s color scheme for visual cohesion", "scheme"),
    )
    instruction = head(F.format_string(v.GROUP_TASK.replace("{}", "%s"), "names"))
    return valid(shown.select("page_id", "shape", instruction.alias("instruction"), lines(F.lit("Design reasoning:"), reasoning, fenced(F.col("html"), F.col("css"))).alias("output")))


class Parts:
    """The element, component and rule tables that examples share, each made once and written."""

    def __init__(self, spark: SparkSession, sf_dir: str, own: bool = False):
        pages = table(spark, sf_dir, "pages").where(F.length("html") <= plans.LONGEST_PAGE)
        nodes = Elements(pages)
        self.components, self.rules = materialize(laid_out(nodes)), materialize(css_rules(sheets(spread(pages))))
        self.matched, self.traits = materialize(component_css(nodes.nodes, self.components, self.rules)), materialize(characteristics(spark, sf_dir, own))

    def component_examples(self) -> DataFrame:
        return of_components(self.components, rules_text(self.matched, self.rules, "type", "ord"), self.traits)

    def grouped_examples(self) -> DataFrame:
        found = groups(self.components)
        members = found.select("page_id", "shape", F.explode("members").alias("m")).select("page_id", "shape", "m.type", "m.ord")
        css = rules_text(members.join(self.matched, ["page_id", "type", "ord"]), self.rules, "shape")
        return of_groups(found, css, self.traits)


def laid_out(nodes: Elements) -> DataFrame:
    """Components with their markup laid out."""
    return components(nodes, layout=True)


def page_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laid_out(Elements(table(spark, sf_dir, "pages"))).drop("root_last")


def matched_css(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    nodes = Elements(pages)
    return component_css(nodes.nodes, laid_out(nodes), materialize(css_rules(sheets(spread(pages)))))


def matched_js(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    nodes = Elements(pages)
    return component_js(nodes.nodes, laid_out(nodes), scripts(spread(pages)))


def component_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Parts(spark, sf_dir).component_examples()


def grouped_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Parts(spark, sf_dir).grouped_examples()


def training_examples(spark: SparkSession, sf_dir: str, full_page: bool = True, own: bool = False, ask: Callable[[str], str | None] | None = None, pause: float = v.REASON_PAUSE, watch: Observation | None = None) -> DataFrame:
    """page_id, kind, part, instruction, output: examples of components, groups and (if asked for) full pages.

    own: pages have columns shown, told (the markup to show, the text that tells the industry), category and n_css.
    ask: a model whose answers are the reasoning of full pages, see `reasoned`.
    """
    parts = Parts(spark, sf_dir, own)
    single = parts.component_examples().select("page_id", F.lit("component").alias("kind"), F.concat_ws("_", "type", "ord").alias("part"), "instruction", "output")
    grouped = parts.grouped_examples().select("page_id", F.lit("grouped").alias("kind"), F.col("shape").alias("part"), "instruction", "output")
    both = single.unionByName(grouped)
    if not full_page:
        return both
    return both.unionByName(full_pages(spark, own, ask, pause, watch).select("page_id", F.lit("full").alias("kind"), F.lit("page").alias("part"), "instruction", "output"))


def full_pages(spark: SparkSession, own: bool, ask: Callable[[str], str | None] | None, pause: float, watch: Observation | None) -> DataFrame:
    """page_id, instruction, output of the full pages of the view pages."""
    if ask is None:
        return spark.sql(plans.full_page_examples(Spark(), own))
    parts = spark.sql(f"WITH {plans.page_parts(Spark(), own)} SELECT * FROM parts").withColumnRenamed("reasoning", "fallback")
    told = reasoned(parts, F.col("fallback"), ask, pause, watch)
    return valid(told.select("page_id", "instruction", lines(F.lit("Design reasoning:"), F.col("reasoning"), F.col("code")).alias("output")))


QUERIES = {"components": page_components, "component_css": matched_css, "component_js": matched_js, "component_examples": component_examples, "grouped_examples": grouped_examples, "training_examples": training_examples}
