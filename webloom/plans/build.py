"""The whole build: folders of sites to training examples, as JSON lines and as folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import values as v
from ..operators.examples import training_examples
from ..operators.html import Elements
from ..operators.numbering import resumed
from ..operators.rewrite import prepared
from ..operators.sites import folder_url, site_metadata
from ..sources.commit import Place
from ..sources.folders import example_files, linked, site_files, site_pages, write_folders
from ..sources.jsonl import read_jsonl, write_jsonl
from ..sources.tables import exists, shared_dir
from .pages import LONGEST_PAGE

KINDS = ("component", "grouped", "full")
MODES = ("append", "overwrite", "incremental")


def site_table(spark: SparkSession, root: str) -> DataFrame:
    """page_id, url, site, html, shown, told, category, n_css of each site with an index.html.

    shown is its markup as examples show it, html the same with its linked sheets and scripts put at the end, told the
    categories and title of its info.html, n_css the number of its sheets, those within the page being one.
    """
    files = site_files(spark, root)
    found = site_pages(files)
    elements = Elements(found)
    nodes = elements.nodes

    def held(kind: str, tag: str) -> DataFrame:
        texts = linked(nodes, found, files, kind).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("node_id", "text"))).alias("t"))
        return texts.select("page_id", F.concat(F.lit(f"<{tag}>"), F.array_join("t.text", "\n\n"), F.lit(f"</{tag}>")).alias(kind), F.size("t").alias(f"n_{kind}"))

    whole = found.drop("url").join(held("css", "style"), "page_id", "left").join(held("js", "script"), "page_id", "left")
    told = site_metadata(site_pages(files, "info.html").withColumn("url", folder_url(F.col("site"))))
    whole = whole.join(told.select("page_id", "url", F.concat_ws(" ", F.concat_ws(" ", "category"), "title").alias("told"), "category"), "page_id", "left").join(prepared(found, elements).withColumnRenamed("html", "shown"), "page_id")
    none = F.lit("")
    n_css = F.coalesce("n_css", F.lit(0)) + F.col("shown").rlike("(?i)<style").cast("int")
    return whole.select("page_id", F.coalesce("url", folder_url(F.col("site"))).alias("url"), "site", F.concat("shown", F.coalesce("css", none), F.coalesce("js", none)).alias("html"), "shown", F.coalesce("told", none).alias("told"), "category", n_css.alias("n_css"))


class Counts(NamedTuple):
    """What a build did."""

    #: examples written, of each kind that has any
    written: dict[str, int]
    #: sites with an index.html of a byte or more (others have no row), from the start-th on
    sites: int
    #: sites with an example that was written, and those without
    processed: int
    skipped: int
    #: sites whose page is too long for examples; they count as skipped, too
    too_long: int
    #: examples made that weren't written, since jsonl or another example has the output
    repeated: int
    #: full pages that a model was asked about, and those of them that kept the fallback
    asked: int
    unanswered: int


def counted_build(spark: SparkSession, root: str, jsonl: str, folders: str | None = None, mode: str = "incremental", full_page: bool = True, start: int = 1, ask: Callable[[str], str | None] | None = None, pause: float = v.REASON_PAUSE) -> Counts:
    """Examples of root's sites into jsonl (and folders, whose place they take); what was written and what wasn't.

    mode: append adds all, overwrite starts anew, incremental adds the first of each output that jsonl lacks. Sites
    before the start-th, by name, are left out. ask: a model for the reasoning of full pages, which is asked once a page.

    Sites, examples made and answers are counted by the passes that write them, what was written by one over two narrow
    columns. Tasks that run again after an executor is lost may be counted twice in asked, unanswered and repeated.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    work = f"{shared_dir(spark)}/build-{uuid.uuid4().hex}"
    read, made, told = Observation("sites"), Observation("examples"), Observation("answers")
    sites = site_table(spark, root)
    sites = (resumed(sites, start, "site") if start > 1 else sites).observe(read, F.count("*").alias("sites"), F.count_if(F.length("html") > LONGEST_PAGE).alias("too_long"))
    try:
        sites.write.parquet(f"{work}/pages.parquet")
        examples = training_examples(spark, work, full_page, True, ask, pause, told).observe(made, F.count("*").alias("made"))
        if mode == "incremental":
            examples = firsts(examples)
            if exists(spark, jsonl):
                examples = examples.join(read_jsonl(spark, jsonl).select(F.md5("output").alias("h")), "h", "left_anti")
            examples = examples.drop("h")
        examples.write.parquet(f"{work}/examples")  # a model isn't asked again, nor jsonl read again once it has grown
        new = spark.read.parquet(f"{work}/examples")
        write_jsonl(new, jsonl, "overwrite" if mode == "overwrite" else "append")
        if folders:
            write_folders(example_files(new, "page_id", "kind", "part"), folders)
        kinds = new.groupBy("page_id", "kind").count().groupBy("page_id").pivot("kind", KINDS).sum("count")
        told_of = kinds.agg(F.count("*").alias("processed"), *(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in KINDS)).first()
    finally:
        Place(spark, work).delete()
    written = {k: told_of[k] for k in KINDS if told_of[k]}
    answers = told.get if ask and full_page else {"asked": 0, "unanswered": 0}
    return Counts(written, read.get["sites"], told_of.processed, read.get["sites"] - told_of.processed, read.get["too_long"], made.get["made"] - sum(written.values()), **answers)


def firsts(examples: DataFrame) -> DataFrame:
    """h, page_id, kind, part, instruction, output: the first example of each output that isn't empty, h its md5."""
    keyed = examples.where("output <> ''").withColumn("h", F.md5("output"))
    return keyed.groupBy("h").agg(F.min(F.struct("page_id", "kind", "part", "instruction", "output")).alias("e")).select("h", "e.*")


def build(spark: SparkSession, root: str, jsonl: str, folders: str | None = None, mode: str = "incremental", full_page: bool = True, start: int = 1) -> dict[str, int]:
    """The same without a model; the number written of each kind."""
    return counted_build(spark, root, jsonl, folders, mode, full_page, start).written
