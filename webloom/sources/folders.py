"""Sites as folders of files, and examples as folders of files."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as v
from ..functions.encoding import decoded
from ..operators.code import obfuscated, repaired_css, spaced_scripts
from ..operators.numbering import numbered
from .commit import Place, swapped

#: Longer files are skipped, at the scan.
LONGEST_FILE = 50 * 1024 * 1024


def site_files(spark: SparkSession, root: str) -> DataFrame:
    """site, path (in the site), length, content of every file in the folders below root, an absolute path or URI."""
    base = urlsplit(root).path.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(F.col("length") <= LONGEST_FILE)
    own = F.substr("path", F.locate(base, F.col("path")) + len(base))
    return files.select(own.alias("own"), "length", "content").where("contains(own, '/')").selectExpr("substring_index(own, '/', 1) AS site", "substring(own, locate('/', own) + 1) AS path", "length", "content")


def site_pages(files: DataFrame, name: str = "index.html") -> DataFrame:
    """page_id (a hash of the site), url (the site's folder), site, html of the sites that have the page."""
    return files.where(F.col("path") == name).select(F.xxhash64("site").alias("page_id"), F.col("site").alias("url"), "site", decoded(F.col("content")).alias("html"))


def resolved(ref: Column) -> Column:
    """Where a reference leads within a site: ./x beside the page, /x below assets, else beside the page."""
    return F.when(F.startswith(ref, F.lit("./")), F.substr(ref, F.lit(3))).when(F.startswith(ref, F.lit("/")), F.concat(F.lit("assets"), ref)).otherwise(ref)


def linked(nodes: DataFrame, pages: DataFrame, files: DataFrame, kind: str) -> DataFrame:
    """page_id, node_id, path, text of the stylesheets ("css") or scripts ("js") that a page names and its site holds.

    Absolute references are left out, scripts by the names of libraries, files that aren't UTF-8, and code that is
    obfuscated or minified.
    Scripts are laid out.
    """
    if kind == "css":
        refs = nodes.where("tag = 'link' and lower(attrs['rel']) rlike '(^|\\\\s)stylesheet(\\\\s|$)'").select("page_id", "node_id", F.col("attrs")["href"].alias("ref"))
    else:
        library = "|".join(name.replace(".", r"\.") for name in v.LIBRARY_NAMES)
        refs = nodes.where("tag = 'script'").select("page_id", "node_id", F.col("attrs")["src"].alias("ref")).where(~F.lower("ref").rlike(library))
    refs = refs.where("ref <> '' and not startswith(ref, 'http')").select("page_id", "node_id", resolved(F.col("ref")).alias("path"))
    held = files.select("site", "path", F.try_validate_utf8(F.col("content").cast("string")).alias("text"))
    found = refs.join(pages.select("page_id", "site"), "page_id").join(held, ["site", "path"]).where("text is not null").where(~obfuscated(F.col("text"), kind)).select("page_id", "node_id", "path", "text")
    if kind == "css":
        return found
    keys = ("page_id", "node_id", "path")
    return spaced_scripts(found.withColumnRenamed("text", "code"), *keys).withColumnRenamed("code", "text")


def processed_sites(spark: SparkSession, root: str) -> DataFrame:
    """The distinct site_url of the metadata.json files below root; files that can't be read have none."""
    found = spark.read.schema("site_url string").option("multiLine", "true").option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").option("pathGlobFilter", "metadata.json").json(root)
    return found.where("site_url is not null").distinct()


def in_shell(html: Column, number: Column) -> Column:
    """A fragment within a page; whole pages as they are."""
    whole = html.rlike("^(<!DOCTYPE|<!doctype|<html|<HTML)") | (F.contains(F.lower(html), F.lit("<head>")) & F.contains(F.lower(html), F.lit("<body>")))
    before, after = v.SHELL.split("{html}")
    return F.when(whole, html).otherwise(F.concat(F.lit(before.split("{number}")[0]), number.cast("string"), F.lit(before.split("{number}")[1]), html, F.lit(after)))


def example_files(examples: DataFrame, *keys: str) -> DataFrame:
    """number, folder, file, text of the folders of examples, numbered in the order of keys; empty parts have no file."""
    block = lambda kind: F.trim(F.regexp_extract("output", rf"(?s)```{kind}\s*\n(.*?)```", 1), F.lit(" \t\r\n"))
    reasoning = F.when(F.contains("output", F.lit("Code:")), F.trim(F.replace(F.substring_index("output", "Code:", 1), F.lit("Design reasoning:"), F.lit("")), F.lit(" \t\r\n"))).otherwise("")
    parts = numbered(examples, *keys).withColumn("html", block("html"))
    html = F.when(F.col("html") != "", in_shell(F.col("html"), F.col("number"))).otherwise("")
    texts = {"instruction.txt": F.col("instruction"), "reasoning.txt": reasoning, "index.html": html, "style.css": repaired_css(block("css")), "output.txt": F.col("output")}
    files = parts.select("number", F.format_string("example_%04d", "number").alias("folder"), F.explode(F.array(*(F.struct(F.lit(k).alias("file"), x.alias("text")) for k, x in texts.items()))).alias("f"))
    return files.select("number", "folder", "f.file", "f.text").where("text <> '' or file in ('instruction.txt', 'output.txt')")


def write_folders(files: DataFrame, target: str, empty: bool = True) -> int:
    """Writes (folder, file, text or bytes) rows below target, an absolute path or URI; the number of files written.

    empty: they take the place of what target holds, all at once, when all are written; a job that fails leaves target
    as it was. Otherwise files come beside those that are there, or replace them, each whole: it is written aside under the
    task attempt's name and moved. Files have fixed names, so a task that runs again writes the same ones.
    """
    spark = files.sparkSession
    if empty:
        with swapped(spark, target) as staging:
            return put(files, staging)
    return put(files, target.rstrip("/"))


def put(files: DataFrame, target: str) -> int:
    """Writes files below target, each by a rename."""
    aside = f"{target}._parts-{uuid.uuid4().hex}"

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(target)
        _, parts = fs.FileSystem.from_uri(aside)
        part = f"{parts}/{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            system.create_dir(parts, recursive=True)
            for folder, file, text in zip(*(c.to_pylist() for c in batch.columns)):
                path = f"{base}/{folder}/{file}"
                system.create_dir(path.rpartition("/")[0], recursive=True)
                with system.open_output_stream(part) as out:
                    out.write(text if isinstance(text, bytes) else (text or "").encode("utf-8", errors="replace"))
                if system.get_file_info(path).type != fs.FileType.NotFound:  # not every file system replaces
                    system.delete_file(path)
                system.move(part, path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    try:
        return files.select("folder", "file", "text").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
    finally:
        Place(files.sparkSession, aside).delete()


def metadata_json(rows: DataFrame) -> DataFrame:
    """folder, file, text: a site's metadata (all columns but folder) as indented JSON."""
    return rows.select("folder", F.lit("metadata.json").alias("file"), F.to_json(F.struct(*(c for c in rows.columns if c != "folder")), {"pretty": "true", "ignoreNullFields": "false"}).alias("text"))
