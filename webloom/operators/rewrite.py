"""Markup with placeholders for its images and links, local asset paths, and one element a line.

Changes are edits: rows (page_id, start, end, text) that put a text in place of some bytes of a page. They come from the
element table by expressions over its attributes, and a page is put together from them and the slices between, so all other
markup stays as it is written. An edit within another (an element that goes) goes with it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..functions import values as v
from ..sources.tables import materialize, table
from .html import Elements, laid_out

ANY_URL = r"url\([\"']?([^\"')]+)[\"']?\)"
IMAGE_URL = r"(?i)url\([\"']?[^\"')]+\.(?:jpg|jpeg|png|gif|webp|svg)[\"']?\)"
IMAGE_NAME = r"(?i)\.(jpg|jpeg|png|gif|webp|svg)$"
BACKGROUND = f'url("{v.PLACEHOLDER}/{v.IMAGE_SIZE[0]}/{v.IMAGE_SIZE[1]}")'
SAVED_FROM = r"^<!-- saved from url=[^>]*-->$"
#: Attributes that keep an empty value.
VALUED = ("alt", "href", "src", "value")


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def escaped(text: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")), text)


def value(entries: Column, key: str) -> Column:
    """An attribute's value in an array of entries (key, value); empty without one."""
    return F.coalesce(F.get(F.filter(entries, lambda e: e["key"] == key), F.lit(0))["value"], F.lit(""))


def put(entries: Column, **new: Column) -> Column:
    """entries with other values of attributes that they have; where the new one is null, as they are."""

    def changed(e: Column) -> Column:
        other = reduce(lambda rest, k: F.when(e["key"] == k, new[k]).otherwise(rest), new, F.lit(None).cast("string"))
        return F.struct(e["key"].alias("key"), F.coalesce(other, e["value"]).alias("value"))

    return F.transform(entries, changed)


def start_tag(tag: Column, entries: Column, closed: Column) -> Column:
    shown = F.transform(entries, lambda e: F.when((e["value"] != "") | e["key"].isin(*VALUED), F.concat(F.lit(" "), e["key"], F.lit('="'), escaped(e["value"]), F.lit('"'))).otherwise(F.concat(F.lit(" "), e["key"])))
    return F.concat(F.lit("<"), tag, F.array_join(shown, ""), F.when(closed, F.lit("/>")).otherwise(F.lit(">")))


def image_size(entries: Column, parent_class: Column) -> Column:
    """width/height of an image: its own where both are given, else by its classes and its parent's."""
    width, height = (value(entries, k) for k in ("width", "height"))
    number = lambda x: F.when(x.rlike(r"^\s*[+-]?[0-9]{1,18}\s*$"), F.trim(x).cast("long").cast("string"))
    normal = F.lit("/".join(map(str, v.IMAGE_SIZE)))
    names = F.lower(F.concat_ws(" ", value(entries, "class"), parent_class))
    named = F.coalesce(*(F.when(any_of(names, words), F.lit("/".join(map(str, size)))) for words, size in v.IMAGE_SIZES), normal)
    given = F.concat(number(F.regexp_replace(width, r"\s", " ")), F.lit("/"), number(F.regexp_replace(height, r"\s", " ")))
    return F.when((width != "") & (height != ""), F.coalesce(given, normal)).otherwise(named)


def with_placeholder_images(found: DataFrame) -> DataFrame:
    """Sources of images, and backgrounds in style attributes, as placeholders, in entries; _class is the parent's."""
    found = found.withColumn("_src", value(F.col("entries"), "src")).withColumn("_style", value(F.col("entries"), "style")).withColumn("_size", image_size(F.col("entries"), F.coalesce("_class", F.lit(""))))
    found = found.withColumn("_goes", (F.col("tag") == "img") & (F.col("_src") != "") & ~F.startswith("_src", F.lit(v.PLACEHOLDER)))
    bare = F.filter("entries", lambda e: ~(F.col("_goes") & F.startswith(e["key"], F.lit("data-")) & F.contains(e["key"], F.lit("src"))))
    shown = F.when(F.col("_goes"), F.concat(F.lit(v.PLACEHOLDER + "/"), "_size"))
    style = F.when(any_of(F.col("_style"), ("background-image", "background:")), F.regexp_replace("_style", ANY_URL, BACKGROUND))
    return found.withColumn("entries", put(bare, src=shown, style=style)).drop("_src", "_style", "_size", "_goes")


def in_style(css: Column) -> Column:
    return F.regexp_replace(css, IMAGE_URL, BACKGROUND)


def link_target(href: Column, label: Column) -> Column:
    """The placeholder of an absolute link: by network, by label, by label's letters, or by the last part of its path."""
    label = F.lower(label)
    known = [F.when(any_of(label, words), F.lit(to)) for words, to in v.LINK_WORDS]
    slug = F.regexp_replace(F.regexp_replace(F.substring(label, 1, 30), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    by_label = F.coalesce(*known, F.when(slug != "", F.concat(F.lit("/"), slug)), F.lit("#"))
    parts = F.split(href, "/")
    last = F.when(F.try_element_at(parts, F.lit(-1)) != "", F.try_element_at(parts, F.lit(-1))).otherwise(F.try_element_at(parts, F.lit(-2)))
    by_path = F.when((last != "") & ~F.startswith(last, F.lit("http")), F.concat(F.lit("/"), last)).otherwise("#")
    return F.when(any_of(F.lower(href), v.SOCIAL_HOSTS), F.lit("#")).when(label != "", by_label).otherwise(by_path)


def on_the_web(url: Column) -> Column:
    return F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://"))


def with_placeholder_links(found: DataFrame) -> DataFrame:
    """Absolute links as placeholders, absolute form actions as #, in entries; label is the element's."""
    found = found.withColumn("_href", value(F.col("entries"), "href")).withColumn("_to", link_target(F.col("_href"), F.col("label")))
    href = F.when((F.col("tag") == "a") & on_the_web(F.col("_href")), F.col("_to"))
    action = F.when((F.col("tag") == "form") & on_the_web(value(F.col("entries"), "action")), F.lit("#"))
    return found.withColumn("entries", put(F.col("entries"), href=href, action=action)).drop("_href", "_to")


def placeholder_tags(elements: Elements, images: bool = True, links: bool = True) -> DataFrame:
    """page_id, node_id, at, head, new: the start tags that placeholders change."""
    found = elements.nodes.where("tag in ('img', 'a', 'form') or map_contains_key(attrs, 'style')").select("page_id", "node_id", "parent_id", "tag", F.map_entries("attrs").alias("old"), "at", "head", "closed", "label_at", "label_bytes")
    found = found.withColumn("entries", F.col("old"))
    if images:
        classes = elements.nodes.where("attrs['class'] <> ''").select("page_id", F.col("node_id").alias("parent_id"), F.col("attrs")["class"].alias("_class"))
        found = with_placeholder_images(found.join(classes, ["page_id", "parent_id"], "left"))
    if links:
        found = with_placeholder_links(elements.with_label(found))
    return changed(found)


def changed(found: DataFrame) -> DataFrame:
    """page_id, node_id, at, head, new: the start tags whose entries aren't the old ones.

    They are written before they are told apart: a filter on a column that several steps made would repeat all the steps.
    """
    new = F.when(F.col("entries") != F.col("old"), start_tag(F.col("tag"), F.col("entries"), F.col("closed")))
    return materialize(found.select("page_id", "node_id", "at", "head", new.alias("new"))).where("new is not null")


def of_tags(tags: DataFrame) -> DataFrame:
    """The edits that put new start tags (page_id, at, head, new) in place."""
    return tags.select("page_id", F.col("at").alias("start"), (F.col("at") + F.col("head")).alias("end"), F.col("new").alias("text"))


def of_styles(elements: Elements) -> DataFrame:
    """The edits of style contents whose images become placeholders."""
    styles = elements.nodes.where("tag = 'style' and inner > 0").select("page_id", (F.col("at") + F.col("head")).alias("start"), "inner")
    held = elements.with_markup(styles, "css", "start", "inner").withColumn("text", in_style(F.col("css")))
    return held.where("text <> css").select("page_id", "start", (F.col("start") + F.col("inner")).alias("end"), "text")


def edited(elements: Elements, edits: DataFrame) -> DataFrame:
    """page_id, html: every page with its edits. Of an edit within another only the outer one counts; null stays null."""
    before = Window.partitionBy("page_id").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    outer = edits.withColumn("_reach", F.max("end").over(before)).where(F.col("_reach").isNull() | (F.col("start") >= F.col("_reach")))
    listed = outer.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "text"))).alias("e"))
    pages = elements.pages.select("page_id", "html", F.col("html").cast("binary").alias("b")).join(listed, "page_id", "left")
    piece = lambda lo, size: F.substring(F.col("b"), lo + 1, size).cast("string")
    since = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("e", i - 1)["end"])
    parts = F.transform("e", lambda e, i: F.concat(piece(since(i), e["start"] - since(i)), e["text"]))
    end = F.try_element_at("e", F.lit(-1))["end"]
    whole = F.concat(F.array_join(parts, ""), piece(end, F.length("b") - end))
    return pages.select("page_id", F.when(F.col("e").isNull(), F.col("html")).otherwise(whole).alias("html"))


def placeholder_images(pages: DataFrame) -> DataFrame:
    """Sources of images, and backgrounds in style attributes and style elements, as placeholders."""
    elements = Elements(pages)
    return edited(elements, of_tags(placeholder_tags(elements, links=False)).unionByName(of_styles(elements)))


def placeholder_links(pages: DataFrame) -> DataFrame:
    """Absolute links as placeholders, absolute form actions as #."""
    elements = Elements(pages)
    return edited(elements, of_tags(placeholder_tags(elements, images=False)))


def with_lines(elements: Elements, lines: DataFrame) -> DataFrame:
    none = F.when(F.col("html").isNotNull(), F.lit(""))
    return elements.pages.join(lines, "page_id", "left").select("page_id", F.coalesce(laid_out(F.col("lines")), none).alias("html"))


def pretty(pages: DataFrame) -> DataFrame:
    """Indented markup, a tag or text a line; a run of blank lines becomes one. Void and self-closed elements have no end tag."""
    elements = Elements(pages)
    return with_lines(elements, elements.lines())


def prepared(pages: DataFrame, elements: Elements | None = None) -> DataFrame:
    """Pages as examples show them: with placeholders, without the mark of saved pages, laid out. elements: of the pages, if there are."""
    elements = elements or Elements(pages)
    return with_lines(elements, elements.lines(placeholder_tags(elements), in_style, SAVED_FROM))


def asset_name(name: Column, default: str) -> Column:
    """The file that holds an image: the last part of its url's path, with an image's ending."""
    return F.when(name == "", F.lit(default)).when(name.rlike(IMAGE_NAME), name).otherwise(F.concat(name, F.lit(".jpg")))


def local_values(found: DataFrame) -> DataFrame:
    """page_id, node_id, new_srcset, style_link, style_name: what images of the page's own host are called in these attributes."""
    bare = lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")
    entry = lambda slot, i, text, link, more: F.struct(F.lit(slot).alias("slot"), i.alias("i"), link.alias("link"), more.alias("more"))
    listed = F.filter(F.split(value(F.col("old"), "srcset"), ","), lambda p: p.rlike(r"\S"))
    of_parts = F.transform(listed, lambda p, i: entry("srcset", i, p, F.regexp_extract(bare(p), r"^\S+", 0), F.regexp_replace(F.regexp_extract(bare(p), r"(?s)^\S+(\s.*)?$", 1), r"^\s+", " ")))
    style = value(F.col("old"), "style")
    background = F.regexp_extract(style, ANY_URL, 1)
    outside = F.contains(style, F.lit("background")) & (F.startswith(background, F.lit("http")) | F.startswith(background, F.lit("//")))
    of_style = F.when(outside, F.array(entry("style", F.lit(0), style, background, F.lit(""))))
    named = found.select("page_id", "node_id", "base", "netloc", F.explode(F.concat(F.when(F.col("tag") == "img", of_parts).otherwise(F.slice(of_parts, 1, 0)), F.coalesce(of_style, F.slice(of_parts, 1, 0)))).alias("r")).select("page_id", "node_id", "base", "netloc", "r.*")
    led = urls.with_joined(named, "base", "link", "whole").withColumn("own", urls.host(F.col("whole")) == F.col("netloc")).withColumn("last", urls.last_name(F.col("whole")))
    name = F.when(F.col("own"), F.concat(F.lit("assets/images/"), F.when(F.col("slot") == "style", asset_name(F.col("last"), "bg.jpg")).otherwise(asset_name(F.col("last"), "image.jpg"))))
    led = led.withColumn("name", name)
    of = lambda slot, x: F.when(F.col("slot") == slot, x)
    shown = F.array_sort(F.collect_list(of("srcset", F.struct("i", F.concat(F.coalesce("name", "link"), "more").alias("t")))))
    return led.groupBy("page_id", "node_id").agg(shown.alias("s"), F.max(of("style", F.col("link"))).alias("style_link"), F.max(of("style", F.col("name"))).alias("style_name")).select("page_id", "node_id", F.when(F.size("s") > 0, F.array_join("s.t", ", ")).alias("new_srcset"), "style_link", "style_name")


def at_home(elements: Elements, pages: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Elements that name assets, of pages with a host: page_id, node_id, tag, at, head, bytes, closed, base, netloc, old, entries, and what more (page_id and others) says of their page.

    In entries srcset parts and backgrounds of the page's own host are assets/images/<name>, link hrefs without the page's host.
    """
    homes = pages.select("page_id", urls.parts(F.col("url"))["scheme"].alias("scheme"), urls.host(F.col("url")).alias("netloc")).where("netloc <> ''").select("page_id", F.concat(F.lower("scheme"), F.lit("://"), "netloc").alias("base"), "netloc")
    found = elements.nodes.where("tag in ('img', 'link', 'script') or map_contains_key(attrs, 'style')").select("page_id", "node_id", "tag", "at", "head", "bytes", "closed", F.map_entries("attrs").alias("old")).join(homes, "page_id")
    found = found if more is None else found.join(more, "page_id")
    met = found.join(local_values(found), ["page_id", "node_id"], "left").withColumn("_href", value(F.col("old"), "href")).withColumn("_style", value(F.col("old"), "style"))
    href = F.when((F.col("tag") == "link") & F.startswith("_href", F.col("base")), F.substr("_href", F.length("base") + 1))
    entries = put(F.col("old"), srcset=F.col("new_srcset"), style=F.replace(F.col("_style"), F.col("style_link"), F.col("style_name")), href=href)
    return met.withColumn("entries", entries).drop("new_srcset", "style_link", "style_name", "_href", "_style")


def local_assets(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) with assets of their own host as local ones, as `with_local_assets`; pages without a host as they are."""
    elements = Elements(pages)
    return edited(elements, of_tags(changed(at_home(elements, pages))))


def file_references(found: DataFrame, root: Column) -> DataFrame:
    """found with kind, link, whole, wanted, named of elements that stand for a file; kind is null for others, `gone` for those of libraries or without a host.

    wanted is the name that a file asks for, below root; named says whether it gets one: an image of another host doesn't.
    """
    rel = F.split(F.lower(value(F.col("entries"), "rel")), r"\s+")
    kind = F.when((F.col("tag") == "link") & F.array_contains(rel, "stylesheet"), "css").when(F.col("tag") == "script", "js").when(F.col("tag") == "img", "images")
    source = F.when(kind == "css", value(F.col("entries"), "href")).otherwise(value(F.col("entries"), "src"))
    found = found.withColumn("kind", kind).withColumn("link", F.regexp_replace(source, r"^\s+|\s+$", ""))
    asks = F.col("kind").isNotNull() & (F.col("link") != "") & ~F.startswith("link", F.lit("#")) & ~F.startswith("link", F.lit("data:"))
    found = urls.with_joined(found, "base", "link", "whole").withColumn("whole", F.when(asks, F.col("whole")))
    image, low = F.col("kind") == "images", F.lower("link")
    library = ((F.col("kind") == "css") & any_of(low, v.STYLE_CDN_WORDS)) | ((F.col("kind") == "js") & any_of(low, v.CDN_WORDS))
    found = found.withColumn("whole_host", urls.host(F.col("whole"))).withColumn("last", urls.last_name(F.col("whole")))
    hosted = F.col("whole_host") != ""
    bare = lambda x: F.regexp_replace(x, r"^www\.", "")
    ending = F.concat(F.lit("."), F.col("kind"))
    called = F.when(F.col("last") == "", F.when(F.col("kind") == "css", "style").otherwise("script")).otherwise(F.col("last"))
    name = F.when(image, asset_name(F.col("last"), "image.jpg")).when(F.endswith("last", ending), F.col("last")).otherwise(F.concat(called, ending))
    wanted = F.concat(root, F.when(image, "images/").otherwise(""), name)
    mine = hosted & (~image | (bare(F.col("whole_host")) == bare(F.col("netloc"))))
    return found.withColumn("named", F.coalesce(asks & ~library & mine, F.lit(False))).withColumn("gone", F.coalesce(asks & (library | (~hosted & ~image)), F.lit(False))).withColumn("wanted", wanted).drop("_l", "last", "whole_host")


def file_names(references: DataFrame) -> DataFrame:
    """page_id, whole, name: one name for each url of a page, in the order in which they first stand there.

    It is the wanted one, or the first of name_1, name_2, ... (before the ending) that no url before has.
    """
    first = references.where("named").groupBy("page_id", "whole").agg(F.min(F.struct("node_id", "wanted")).alias("f"))
    listed = first.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("f.node_id", "f.wanted", "whole"))).alias("r"))
    stem, ending = (lambda w, n=n: F.regexp_extract(w, r"(?s)^(.*?)(\.[^./]*)?$", n) for n in (1, 2))
    numbered = lambda w, taken: F.transform(F.sequence(F.lit(1), F.size(taken)), lambda k: F.concat(stem(w), F.lit("_"), k.cast("string"), ending(w)))
    free = lambda taken, w: F.get(F.filter(numbered(w, taken), lambda x: ~F.array_contains(taken, x)), F.lit(0))
    chosen = lambda taken, w: F.when(F.array_contains(taken, w), free(taken, w)).otherwise(w)
    names = F.aggregate("r", F.array().cast("array<string>"), lambda taken, x: F.concat(taken, F.array(chosen(taken, x["wanted"]))))
    return listed.withColumn("names", names).select("page_id", F.explode(F.expr("transform(r, (x, i) -> struct(x.whole, names[i] AS name))")).alias("n")).select("page_id", "n.whole", "n.name")


def named_files(pages: DataFrame, root: Column | None = None, elements: Elements | None = None, more: DataFrame | None = None) -> DataFrame:
    """page_id, whole (a file's url), name: the files that `localized` makes local."""
    return file_names(materialize(file_references(at_home(elements or Elements(pages), pages, more), F.lit("assets/") if root is None else root)))


def localized(pages: DataFrame, failed: DataFrame | None = None, root: Column | None = None, elements: Elements | None = None, more: DataFrame | None = None) -> DataFrame:
    """Pages (page_id, url, html) with stylesheets, scripts and images as <root><name>, on top of `local_assets`; elements of libraries' hosts go.

    A url has one name in a page; another url that would have the same gets a number. A stylesheet or script whose
    absolute url failed (page_id, whole: not downloaded) or has no host goes; an image stays as it is. So do empty, # and data:
    urls, and images of other hosts (but for www.). Relative urls start from the page's host; without a host the page stays.
    A url that failed keeps its name from others. root is an expression over what more (page_id and others) says of a page.
    """
    elements = elements or Elements(pages)
    root = F.lit("assets/") if root is None else root
    found = materialize(file_references(at_home(elements, pages, more), root))
    lost = (failed if failed is not None else found.select("page_id", "whole").limit(0)).select("page_id", "whole").distinct().withColumn("lost", F.lit(True))
    met = found.join(file_names(found), ["page_id", "whole"], "left").join(lost, ["page_id", "whole"], "left")
    name = F.when(F.col("named") & F.col("lost").isNull(), F.col("name"))
    shown = put(F.col("entries"), href=F.when(F.col("kind") == "css", name), src=F.when(F.col("kind").isin("js", "images"), name))
    goes = F.col("gone") | (F.col("named") & F.col("lost").isNotNull() & (F.col("kind") != "images"))
    met = materialize(met.withColumn("entries", shown).withColumn("goes", F.coalesce(goes, F.lit(False))))
    removed = met.where("goes").select("page_id", F.col("at").alias("start"), (F.col("at") + F.col("bytes")).alias("end"), F.lit("").alias("text"))
    return edited(elements, of_tags(changed(met.where("not goes"))).unionByName(removed))


def over_pages(function: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(table(spark, sf_dir, "pages"))

    query.__doc__ = function.__doc__
    return query


QUERIES = {"image_placeholders": over_pages(placeholder_images), "link_rewrite": over_pages(placeholder_links), "local_assets": over_pages(local_assets), "localized_pages": over_pages(localized), "pretty_html": over_pages(pretty), "prepared_html": over_pages(prepared)}
