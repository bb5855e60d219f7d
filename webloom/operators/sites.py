"""What list pages and detail pages say about sites, by joins of the element table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.pages import industry
from ..sources.tables import materialize, table
from .html import Elements, below

# fixed values: classes of a list page's items, and the labels of definitions
ITEM, DETAIL_LINK, SITE_LINK, TITLE, TITLE_TEXT, CREDITS = "c-post-list__item", "c-post-list__title-link", "c-post-list__link", "c-post-list__ttl", "c-linelink__txt", "c-post-list__credit-detail"
CREDIT_LABELS = {"url": "URL", "copyright": "著作権所有", "creators": "制作者一覧", "creator_source": "制作者情報引用元"}


def having(tag: str, name: str) -> Column:
    return (F.col("tag") == tag) & F.array_contains("classes", name)


def first(value: Column, test: Column) -> Column:
    """The value at the first element, in document order, that fits."""
    return F.min_by(F.when(test, value), F.when(test, F.col("node_id")))


def definitions(nodes: DataFrame) -> DataFrame:
    """page_id, node_id, levels, label, dd_id, dd_last, value: each dt beside the next dd among its siblings. nodes have texts."""
    after = Window.partitionBy("page_id", "parent_id").orderBy("node_id").rowsBetween(1, Window.unboundedFollowing)
    next_dd = F.first(F.when(F.col("tag") == "dd", F.struct(F.col("node_id").alias("dd_id"), F.col("last_id").alias("dd_last"), F.col("text").alias("value"))), ignorenulls=True).over(after)
    pairs = nodes.where("tag in ('dt', 'dd')").withColumn("dd", next_dd).where("tag = 'dt' and dd is not null")
    return pairs.select("page_id", "node_id", "levels", F.col("text").alias("label"), "dd.dd_id", "dd.dd_last", "dd.value")


def roots(found: DataFrame, node: str = "node_id", last: str = "last_id") -> DataFrame:
    return found.select("page_id", F.col(node).alias("root_id"), F.col(last).alias("root_last"))


def told_nodes(elements: Elements) -> DataFrame:
    """The elements whose text says something, with it."""
    return elements.with_text(elements.nodes.where("tag in ('title', 'dt', 'dd', 'span', 'a')"))


def list_items(elements: Elements, base: str) -> DataFrame:
    """page_id, item_id, detail_url, site_url, title, credit_info of each list item with both links.

    Relative detail urls are put on base; a missing title is "Unknown"; missing credits are null.
    """
    nodes, told = elements.nodes, materialize(told_nodes(elements))
    items = roots(nodes.where(having("li", ITEM)))
    links = below(nodes.where("tag = 'a'"), items).groupBy("page_id", "root_id").agg(first(F.col("attrs")["href"], having("a", DETAIL_LINK)).alias("detail_url"), first(F.col("attrs")["href"], having("a", SITE_LINK)).alias("site_url"))
    headings = nodes.where(having("h3", TITLE))
    titles = below(below(told.where(having("span", TITLE_TEXT)), roots(headings)).drop("root_id", "root_last"), items).groupBy("page_id", "root_id").agg(F.min_by("text", "node_id").alias("title"))
    credited = below(definitions(told), roots(nodes.where(having("div", CREDITS)))).drop("root_id", "root_last")
    spans = below(told.where("tag = 'span'"), roots(credited, "dd_id", "dd_last").distinct()).groupBy("page_id", F.col("root_id").alias("dd_id")).agg(F.min_by("text", "node_id").alias("span"))
    said = below(credited.join(spans, ["page_id", "dd_id"], "left"), items)
    credit = [first(F.col("value" if key == "creators" else "span"), F.contains("label", F.lit(label))).alias(key) for key, label in CREDIT_LABELS.items()]
    credits = said.groupBy("page_id", "root_id").agg(*credit).select("page_id", "root_id", F.struct(*CREDIT_LABELS).alias("credit_info"))
    whole = links.where("detail_url <> '' and site_url <> ''").join(titles, ["page_id", "root_id"], "left").join(credits, ["page_id", "root_id"], "left")
    home = F.lit(base.rstrip("/"))
    absolute = F.when(F.startswith("detail_url", F.lit("http")), F.col("detail_url")).when(F.startswith("detail_url", F.lit("/")), F.concat(home, "detail_url")).otherwise(F.concat(home, F.lit("/"), "detail_url"))
    return whole.select("page_id", F.col("root_id").alias("item_id"), absolute.alias("detail_url"), "site_url", F.coalesce("title", F.lit("Unknown")).alias("title"), "credit_info")


def folder_url(folder: Column) -> Column:
    """The url that a folder's name stands for: its scheme set apart, https if it has none."""
    scheme = F.regexp_extract(folder, "^(https?)", 1)
    return F.when(scheme == "", F.concat(F.lit("https://"), folder)).otherwise(F.concat(scheme, F.lit("://"), F.regexp_replace(folder, "^https?(://)?", "")))


def site_metadata(pages: DataFrame) -> DataFrame:
    """page_id, url, title, category, industry, creators, description of every detail page (page_id, url, html).

    The url is the page's own definition, else the one given. Missing texts are empty, categories an empty list.
    """
    elements = Elements(pages)
    texts = materialize(told_nodes(elements))
    heads = elements.nodes.where("tag = 'meta'").withColumn("text", F.lit(None).cast("string")).unionByName(texts.where("tag = 'title'"))
    heads = heads.groupBy("page_id").agg(first(F.col("text"), F.col("tag") == "title").alias("title"), first(F.trim(F.col("attrs")["content"]), (F.col("tag") == "meta") & (F.col("attrs")["name"] == "description")).alias("description"))
    told = definitions(texts).where(F.col("label").isin("URL", "CATEGORY", "制作者一覧"))
    links = below(texts.where("tag = 'a'"), told.select("page_id", F.col("dd_id").alias("root_id"), F.col("dd_last").alias("root_last"), F.col("node_id").alias("dt_id"), "label"))
    href = F.when(F.trim(F.col("attrs")["href"]) != "", F.trim(F.col("attrs")["href"])).when(F.startswith("text", F.lit("http")), F.col("text")).otherwise(F.concat(F.lit("https://"), "text"))
    # the first dt of a label counts
    counted = links.join(told.groupBy("page_id", "label").agg(F.min("node_id").alias("dt_id")), ["page_id", "label", "dt_id"])
    category = F.array_sort(F.collect_list(F.when((F.col("label") == "CATEGORY") & (F.col("text") != ""), F.struct("node_id", "text"))))["text"]
    linked = counted.groupBy("page_id").agg(first(href, F.col("label") == "URL").alias("told_url"), category.alias("category"))
    makers = told.groupBy("page_id").agg(first(F.col("value"), F.col("label") == "制作者一覧").alias("creators"))
    whole = pages.select("page_id", "url").join(heads, "page_id", "left").join(linked, "page_id", "left").join(makers, "page_id", "left").na.fill("", ["title", "description", "creators"])
    whole = whole.withColumn("category", F.coalesce("category", F.array().cast("array<string>"))).withColumn("all_text", F.concat_ws(" ", F.concat_ws(" ", "category"), "title"))
    return whole.select("page_id", F.coalesce("told_url", "url").alias("url"), "title", "category", F.expr(industry("all_text")).alias("industry"), "creators", "description")


def site_metadata_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_metadata(table(spark, sf_dir, "pages"))


def definition_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return definitions(told_nodes(Elements(table(spark, sf_dir, "pages")))).drop("levels", "dd_last")


def site_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_items(Elements(table(spark, sf_dir, "pages")), "https://example.org")


QUERIES = {"site_metadata": site_metadata_of_pages, "definition_pairs": definition_pairs, "site_list": site_list}
