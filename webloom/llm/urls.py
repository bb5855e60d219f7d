"""URL filter: host and path rules, then a ratio of character language models (operator 8)."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attached, discard, materialize

#: rule, verdict
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: The longest context, in characters, and how often one must have been seen to be used.
ORDER, SUPPORT = 6, 2
#: Stand before a url's first character, and after its last.
START, END = "\x02", "\x03"
#: What a character is worth that a model has never seen: one of all code points.
FLOOR = 1 / 0x110000
#: One in so many hosts is kept from the models, for the threshold.
HELD = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple) -> Column:
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        found = F.when(fits, rule).otherwise(found)
    return found


def framed(url: Column) -> Column:
    """The url, as it is, with ORDER starts and an end, so that each character has a full context."""
    return F.concat(F.lit(START * ORDER), F.coalesce(url, F.lit("")), F.lit(END))


def grams(rows: DataFrame, *columns: str) -> DataFrame:
    """columns and gram: each character of the framed url behind its ORDER characters of context."""
    return rows.select(*columns, F.explode(F.expr(f"transform(sequence(1, length(framed) - {ORDER}), i -> substring(framed, i, {ORDER + 1}))")).alias("gram"))


def parts(urls: DataFrame, *columns: str) -> DataFrame:
    """columns, framed, n of the two parts of each url, equal ones as one: as far as its host goes, and the rest behind the last ORDER characters before it.

    Each character of a url is in one of them, in full context; hosts come up again and again and count once.
    """
    both = urls.select(*columns, "n", F.explode(F.array("head", "tail")).alias("framed")).where(F.length("framed") > ORDER)
    return both.groupBy(*columns, "framed").agg(F.sum("n").alias("n"))


def learned(urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Markov models of all orders up to ORDER, of the urls that rules allow and of those they block.

    The first table has how often each character (the last of key) has followed each context (the rest) in either kind
    (allow, block); the second, per context, how often it was seen (allow_n, block_n) and how many different
    characters followed it (allow_kinds, block_kinds). Both grow with the urls; they stay tables.
    """
    of = lambda kind: F.sum(F.when(F.col("ruled") == kind, F.col("n")).otherwise(0)).alias(kind)
    whole = grams(urls, "ruled", "n").groupBy("gram").agg(of("allow"), of("block"))
    cut = F.expr(f"transform(sequence(0, {ORDER}), k -> substring(gram, {ORDER + 1} - k))")
    follow = materialize(whole.select(F.explode(cut).alias("key"), "allow", "block").groupBy("key").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
    context = F.expr("left(key, length(key) - 1)").alias("context")
    seen = follow.groupBy(context).agg(*(x for kind in ("allow", "block") for x in (F.sum(kind).alias(f"{kind}_n"), F.count_if(F.col(kind) > 0).alias(f"{kind}_kinds"))))
    return follow, materialize(seen)


def gram_facts(asked: DataFrame, follow: DataFrame, seen: DataFrame) -> DataFrame:
    """For each gram asked (gram, n) and each of its ends, once: key, n (of whole grams, else null), and what follow and seen have of it, null where no context counts.

    Ends come from the next longer ones, which are ever fewer. A key or a context has as many rows as there are
    different characters at most, so that no task gets all.
    """
    keys = ends = asked.select(F.col("gram").alias("key"), "n")
    for _ in range(ORDER):
        ends = ends.select(F.expr("substring(key, 2)").alias("key")).distinct().withColumn("n", F.lit(None).cast("long"))
        keys = keys.unionByName(ends)
    counted = seen.where(f"allow_n >= {SUPPORT} or block_n >= {SUPPORT}")
    return keys.join(follow, "key", "left").withColumn("context", F.expr("left(key, length(key) - 1)")).join(counted, "context", "left").drop("context")


def gram_scores(facts: DataFrame) -> DataFrame:
    """gram, n, score: millionths of ln P(last character | the others), allowed less blocked, for each gram of gram_facts.

    A context counts if it was seen SUPPORT times. By how much a longer one counts against a shorter depends on how
    many different characters have followed it: that is how likely one escapes to the shorter context. So chances go
    from each key to those that are a character longer.
    """
    chance = lambda kind: F.expr(f"if(coalesce({kind}_n, 0) < {SUPPORT}, {kind}_p, (coalesce({kind}, 0) + {kind}_kinds * {kind}_p) / ({kind}_n + {kind}_kinds))").alias(f"{kind}_p")
    shorter = None
    for k in range(ORDER + 1):
        rows = facts.where(F.length("key") == k + 1)
        if k:
            rows = rows.withColumn("end", F.expr("substring(key, 2)")).join(shorter.withColumnRenamed("key", "end"), "end")
        else:
            rows = rows.withColumns({"allow_p": F.lit(FLOOR), "block_p": F.lit(FLOOR)})
        shorter = rows.select("key", *(["n"] if k == ORDER else []), chance("allow"), chance("block"))
    return shorter.select(F.col("key").alias("gram"), "n", F.round((F.log("allow_p") - F.log("block_p")) * 1e6).cast("long").alias("score"))


def scores(urls: DataFrame, fit: DataFrame) -> DataFrame:
    """urls with the score of each: the mean of its characters' scores, rounded down; models are learned on fit, some of urls."""
    follow, seen = learned(parts(fit, "ruled"))
    pieces = materialize(parts(urls).withColumn("piece", F.monotonically_increasing_id()))
    asked = materialize(grams(pieces).groupBy("gram").agg(F.count("*").alias("n")))
    facts = materialize(gram_facts(asked, follow, seen))
    for stored in (follow, seen, asked):
        discard(stored)
    scored = materialize(gram_scores(facts))
    discard(facts)
    total = scored.agg(F.sum("n")).first()[0] or 0
    places = attached(grams(pieces, "piece"), ["gram"], scored, total, ["score"], F.xxhash64("piece", "gram"))
    sums = places.groupBy("piece").agg(F.sum("score").alias("sum"))
    summed = materialize(pieces.withColumnRenamed("n", "urls").join(sums, "piece").select("framed", F.col("urls").alias("n"), "sum"))
    total = urls.agg(F.sum("n")).first()[0] or 0
    out = urls
    for part in ("head", "tail"):
        facts = summed.select(F.col("framed").alias(part), "n", F.col("sum").alias(f"{part}_sum"))
        out = attached(out, [part], facts, total, [f"{part}_sum"], F.col("uid"))
    none = F.lit(0).cast("long")
    out = out.withColumn("score", F.floor((F.coalesce("head_sum", none) + F.coalesce("tail_sum", none)) / (F.length("framed") - ORDER)).cast("long"))
    out = materialize(out.select("framed", "n", "ruled", "held", "score"))
    for stored in (pieces, scored, summed):
        discard(stored)
    return out


def judge(pages: DataFrame, *, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score (millionths of the mean log-likelihood difference a character).

    The longest rule that fits decides. Other urls are allowed if their characters are likelier, by the mean, under the
    model of the urls that rules allow than under that of those they block. The models are variable-order: contexts of
    up to ORDER characters, as long as they were seen. One in HELD hosts is kept from them; the threshold is the one
    that tells the ruled urls of these hosts apart best. If they lack one kind, all hosts teach and calibrate; if all
    do, urls without a rule are allowed.

    Null urls, and such without ://, have an empty host and path, no rule, and are scored as they are. Each row is
    judged by itself (repeated rows and null ids stay), other columns are ignored, an empty table gives no rows.
    """
    verdicts = F.create_map(*(F.lit(x) for rule in rules for x in rule))
    host, path = host_and_path(F.col("url"))
    parted = pages.select("page_id", host.alias("host"), path.alias("path"), framed(F.col("url")).alias("framed"))
    parted = parted.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules)).withColumn("ruled", verdicts[F.col("rule")])
    urls = parted.groupBy("framed", "host", "ruled").agg(F.count("*").alias("n"))
    length = F.when(F.col("host") != "", F.instr(F.col("framed"), "://") + 2 + F.length("host")).otherwise(ORDER)
    urls = urls.withColumn("head", F.left(F.col("framed"), length)).withColumn("tail", F.substr(F.col("framed"), length - ORDER + 1))
    urls = materialize(urls.withColumn("held", F.pmod(F.xxhash64("host"), F.lit(HELD)) == 0).withColumn("uid", F.monotonically_increasing_id()))
    ruled = urls.where("ruled is not null")
    kinds = ruled.agg(*(F.count_if((F.col("ruled") == kind) & test) for test in (F.lit(True), F.col("held"), ~F.col("held")) for kind in ("allow", "block"))).first()
    if not all(kinds[:2]):
        return parted.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(0).cast("long").alias("score"))
    apart = all(kinds)
    scored = scores(urls, ruled.where(~F.col("held")) if apart else ruled)
    level = calibrated(scored.where("ruled is not null and held" if apart else "ruled is not null"))
    by_url, total = scored.select("framed", "n", "score"), urls.agg(F.sum("n")).first()[0]
    numbered = parted.withColumn("row", F.monotonically_increasing_id())
    out = attached(numbered, ["framed"], by_url, total, ["score"], F.col("row"))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= level, "allow").otherwise("block"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def calibrated(scored: DataFrame, step: int = 1000) -> int:
    """The threshold, in steps, with the best mean of the shares of both kinds that it puts on their side; of equal ones, the middle."""
    limit = 20_000_000
    place = F.floor(F.greatest(F.least(F.col("score"), F.lit(limit)), F.lit(-limit)) / step).alias("place")
    of = lambda kind: F.sum(F.when(F.col("ruled") == kind, F.col("n")).otherwise(0)).alias(kind)
    rows = sorted(map(tuple, scored.groupBy(place).agg(of("allow"), of("block")).collect()))  # at most 40,001
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best, level, passed_good, passed_bad, before = -1.0, 0, 0, 0, rows[0][0]
    for at, g, b in rows:
        gain = (good - passed_good) / good + passed_bad / bad
        if gain > best + 1e-12:
            best, level = gain, (before + at + 1) // 2 * step
        passed_good, passed_bad, before = passed_good + g, passed_bad + b, at
    return level
