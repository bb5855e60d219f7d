"""Parts of urls and relative references, as columns: by RFC 3986, as Python's urllib reads them.

Each step is a column of its own, so that none is computed for each use of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: scheme, host (with //), path, query (with ?), fragment (with #)
PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
#: Schemes whose urls have a host and take relative references.
HIERARCHICAL = ("", "http", "https", "ftp", "file", "ws", "wss")


def parts(url: Column) -> Column:
    """scheme, host (with //), path, query (with ?) and fragment (with #) of a url without space before it and breaks in it."""
    bare = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    names = ("scheme", "host", "path", "query", "fragment")
    return F.struct(*(F.regexp_extract(bare, PARTS, n).alias(name) for n, name in enumerate(names, 1)))


def host(url: Column) -> Column:
    """What stands between // and the path; empty where brackets don't match."""
    found = F.substring(parts(url)["host"], 3, 1 << 30)
    return F.when(F.contains(found, F.lit("[")) != F.contains(found, F.lit("]")), "").otherwise(found)


def last_name(url: Column) -> Column:
    """What stands after the last slash of a url's path."""
    return F.substring_index(parts(url)["path"], "/", -1)


def without_dots(segments: Column) -> Column:
    """Path segments without . and .., which take the one before with them: a fold with a stack. A dot at the end leaves an empty one."""
    empty = F.array().cast("array<string>")
    kept = F.aggregate(segments, empty, lambda stack, s: F.when(s == "..", F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))).when(s == ".", stack).otherwise(F.concat(stack, F.array(s))))
    last = F.get(segments, F.size(segments) - 1)
    return F.concat(kept, F.when(last.isin(".", ".."), F.array(F.lit(""))).otherwise(empty))


def with_joined(rows: DataFrame, base: str, link: str, name: str) -> DataFrame:
    """rows with the column `name`: where a reference leads from a url, as urllib.parse.urljoin gives it for hierarchical schemes; others stay as they are."""
    step = rows.withColumn("_b", parts(F.col(base))).withColumn("_l", parts(F.col(link)))
    step = step.withColumn("_from", F.lower("_b.scheme")).withColumn("_own", F.when(F.col("_l.scheme") == "", F.col("_from")).otherwise(F.lower("_l.scheme")))
    step = step.withColumn("_at", F.split("_b.path", "/")).withColumn("_to", F.split("_l.path", "/"))
    beside = F.when(F.get("_at", F.size("_at") - 1) != "", F.slice("_at", 1, F.size("_at") - 1)).otherwise(F.col("_at"))
    step = step.withColumn("_all", F.concat(beside, "_to"))
    # a relative path loses the empty segments between its first and last
    filled = F.filter("_all", lambda s, i: (s != "") | (i == 0) | (i == F.size("_all") - 1))
    step = step.withColumn("_all", F.when(F.startswith("_l.path", F.lit("/")), F.col("_to")).otherwise(filled))
    step = step.withColumn("_path", F.array_join(without_dots(F.col("_all")), "/"))
    rooted = (F.col("_path") == "") | ((F.col("_b.host") != "") & ~F.startswith("_path", F.lit("/")))
    step = step.withColumn("_path", F.when(rooted, F.concat(F.lit("/"), "_path")).otherwise(F.col("_path")))
    same = F.concat("_b.host", "_b.path", F.when(F.col("_l.query") != "", F.col("_l.query")).otherwise(F.col("_b.query")), "_l.fragment")
    tail = F.concat("_l.query", "_l.fragment")
    led = F.when(F.col("_l.host") != "", F.concat("_l.host", "_l.path", tail)).when(F.col("_l.path") == "", same).otherwise(F.concat("_b.host", "_path", tail))
    whole = F.concat(F.when(F.col("_own") != "", F.concat("_own", F.lit(":"))).otherwise(""), led)
    stays = (F.col("_own") != F.col("_from")) | ~F.col("_own").isin(*HIERARCHICAL)
    found = F.when(F.col(base) == "", F.col(link)).when(F.col(link) == "", F.col(base)).when(stays, F.col(link)).otherwise(whole)
    return step.withColumn("_found", found).select(*(c for c in rows.columns if c != name), F.col("_found").alias(name))
