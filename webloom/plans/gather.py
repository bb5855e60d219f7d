"""A list of sites to folders of sites: detail page, site page, their files, and what the list says of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import decoded, sound
from ..operators.html import Elements
from ..operators.rewrite import localized, named_files
from ..operators.sites import list_items
from ..sources.folders import metadata_json, processed_sites, write_folders
from ..sources.paged import ATTEMPTS, PAUSE
from ..sources.tables import discard, exists, materialize
from ..sources.web import Reply, fetched

#: Where the files of a page of each kind stand in its site's folder.
ASSETS = {"index": "assets/", "info": "assets/info/"}


def site_folder(url: Column) -> Column:
    """The folder of a site: its url without scheme and ending slashes; parts of dots alone lead nowhere else."""
    bare = F.regexp_replace(F.replace(F.replace(url, F.lit("https://")), F.lit("http://")), r'[<>:"|?*]', "_")
    return F.regexp_replace(F.regexp_replace(bare, r"(^|/)\.+(?=/|$)", "$1_"), "/+$", "")


def whole_folders(spark: SparkSession, target: str) -> DataFrame:
    """The folders that hold both pages; contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "{index,info}.html").load(target).select("path")
    own = F.regexp_replace(F.substring_index("path", target.rstrip("/") + "/", -1), "/[^/]*$", "")  # it may be several deep
    return found.select(own.alias("folder"), "path").groupBy("folder").agg(F.count_distinct("path").alias("n")).where("n = 2").select("folder")


def new_sites(spark: SparkSession, listing: DataFrame, target: str, base: str, most: int | None = None, again: bool = False) -> tuple[DataFrame, DataFrame]:
    """The list's sites (each once, as it first stands), and those of them to be fetched.

    Left out, unless again, are those that a metadata.json of target names and those whose folder has both pages; of the
    others the first `most` in the list's order stay (all if it is None or 0).
    """
    items = list_items(Elements(listing), base).withColumn("folder", site_folder(F.col("site_url"))).where("folder <> ''")
    sites = materialize(items.groupBy("folder").agg(F.min_by(F.struct("page_id", "item_id", "detail_url", "site_url", "title", "credit_info"), F.struct("page_id", "item_id")).alias("s")).select("folder", "s.*"))
    new = sites
    if not again and exists(spark, target):
        new = new.join(processed_sites(spark, target), "site_url", "left_anti").join(whole_folders(spark, target), "folder", "left_anti")
    return sites, new.orderBy("page_id", "item_id").limit(most) if most else new


def inline(html: Column, tag: str) -> Column:
    """The contents of a page's own styles or scripts, blank ones aside."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?![^>]*\bsrc\s*=)[^>]*>(.*?)</{tag}\s*>"), F.lit(1))
    return F.array_join(F.filter(found, lambda x: F.trim(x) != ""), "\n\n")


def gather(spark: SparkSession, listing: DataFrame, target: str, fetch: Callable[[str], Reply | None], base: str, *, most: int | None = None, again: bool = False, fresh: bool = False, pause: float = PAUSE) -> dict[str, int]:
    """Fetches the sites of listing (page_id, html: the pages of a list) into folders below target.

    A folder has info.html and index.html with their files as local ones, inline styles and scripts by themselves, and
    metadata.json. A detail page is tried three times and may fail; a site counts as processed if its own page came
    and is sound. Returns how many were processed, skipped and failed. fresh empties target first; `again` fetches
    what is there, too.
    """
    sites, new = new_sites(spark, listing, target, base, most, again or fresh)
    new = materialize(new)
    tasks = spark.sparkContext.defaultParallelism
    asked = new.withColumnRenamed("site_url", "site").repartition(tasks)
    info = fetched(asked.select("folder", F.lit("info").alias("kind"), F.col("detail_url").alias("url")), fetch, ATTEMPTS, pause)
    index = fetched(asked.select("folder", F.lit("index").alias("kind"), F.col("site").alias("url")), fetch)
    read = info.unionByName(index).select("folder", "kind", "url", decoded(F.col("reply.body"), F.col("reply.charset"), F.col("reply.encoding")).alias("html"))
    root = F.when(F.col("kind") == "info", F.lit(ASSETS["info"])).otherwise(F.lit(ASSETS["index"]))
    pages = materialize(read.where(sound(F.col("html"))).withColumn("page_id", F.xxhash64("folder", "kind")))
    elements, roots = Elements(pages), pages.select("page_id", root.alias("_root"))
    named = named_files(pages, F.col("_root"), elements, roots).join(pages.select("page_id", "folder", "kind"), "page_id").select("page_id", "folder", "kind", F.col("whole").alias("url"), F.col("name").alias("path"))
    files = materialize(fetched(named.repartition(tasks), fetch))
    told = F.lower("reply.content_type")
    came = F.col("reply").isNotNull() & (~F.contains("path", F.lit("assets/images/")) & ~F.contains("path", F.lit("/info/images/")) | told.isNull() | F.startswith(told, F.lit("image/")))
    lost = files.where(~F.coalesce(came, F.lit(False))).select("page_id", F.col("url").alias("whole"))
    shown = localized(pages, lost, F.col("_root"), elements, roots).withColumnRenamed("html", "shown")
    local = materialize(pages.join(shown, "page_id"))
    suffix = F.when(F.col("kind") == "info", "_info").otherwise("")
    parts = [(F.concat("kind", F.lit(".html")), F.col("shown")), (F.concat(F.lit("inline_styles"), suffix, F.lit(".css")), inline(F.col("html"), "style")), (F.concat(F.lit("inline_scripts"), suffix, F.lit(".js")), inline(F.col("html"), "script"))]
    texts = local.select("folder", "kind", F.explode(F.array(*(F.struct(k.alias("file"), x.alias("text")) for k, x in parts))).alias("p")).select("folder", "kind", "p.file", F.encode("p.text", "UTF-8").alias("text")).where("length(text) > 0")
    flags = texts.where("kind = 'index'").groupBy("folder").agg(*(F.bool_or(F.col("file").endswith(f".{k}")).alias(k) for k in ("html", "css", "js")))
    results = F.struct(*(F.coalesce(F.col(k), F.lit(False)).alias(k) for k in ("html", "css", "js"))).alias("download_results")
    told_of = new.join(flags, "folder", "left").select("folder", "title", "detail_url", "site_url", "credit_info", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), results)
    saved = files.where(came).select("folder", F.col("path").alias("file"), F.col("reply.body").alias("text"))
    whole = texts.drop("kind").unionByName(saved).unionByName(metadata_json(told_of).withColumn("text", F.encode("text", "UTF-8")))
    write_folders(whole, target, empty=fresh)
    asked_for, processed = new.count(), flags.where("html").count()
    out = {"processed": processed, "skipped": sites.count() - asked_for, "failed": asked_for - processed}
    for stored in (sites, new, pages, files, local):
        discard(stored)
    return out
