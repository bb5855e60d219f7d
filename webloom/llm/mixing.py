"""Mixing sources to target weights by systematic sampling (operator 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import boxed, materialize, ranked, unboxed, words_of


def seeded_offset(source: Column, seed: int) -> Column:
    """One number in [0, 1) for each source, the same in each run: 40 bits of a checksum."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("source "), source), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 10), 16, 10).cast("long") / F.lit(float(1 << 40))


def source_targets(sizes: DataFrame, *, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """source, source_size, target: shares of `share` times all sizes by weight, none above `limit` times the source.

    Sources take the weights in turn, by code point, null last. What a source's share has above its limit is shared
    again among the others by weight, until none is above. One row a source; each round is an aggregate of them.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int"))
    table = materialize(ranked(sources, [F.col("source").asc_nulls_last()], "turn").select("source", "source_size", turn.alias("weight"), (F.col("source_size") * limit).alias("most")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, F.lit(False)
    while True:
        used, weight = table.agg(F.sum(F.when(capped, F.col("most")).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        if not weight:
            break
        new = (share * total - used) / weight
        if new <= level:
            break
        level, capped = new, F.col("most") <= new * F.col("weight")
    return table.select("source", "source_size", F.when(capped, F.col("most")).otherwise(level * F.col("weight")).alias("target"))


def mix(docs: DataFrame, *, seed: int = 17, **shares) -> DataFrame:
    """How often each document is in the mix: doc_id, source, size, source_size, target, copies, taken.

    Within a source each document is expected target / source_size times. The documents stand in the order of their
    sizes, so that these expectations' prefix sums meet every size alike; after one random offset for the source, a
    document is emitted once for each whole number its interval crosses. So copies differ from the expectation by
    less than one, and the words taken from the target by about the largest document.

    A null text has size 0; null is a source of its own. A repeated row (or null doc_id) counts as a document of its
    own. Rows equal in source, size and doc_id are interchangeable. Other columns are ignored; an empty table gives
    no rows. A source of size 0 has target 0 and no copies.
    """
    sizes = materialize(docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size")))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")]
    placed = ranked(sizes, order, "at")
    starts = placed.groupBy("source").agg(F.min("at").alias("start"))
    facts = source_targets(sizes, **shares).withColumnRenamed("source", "_source").join(starts, F.col("_source").eqNullSafe(F.col("source"))).drop("source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    k, offset = F.col("at") - F.col("start"), seeded_offset(F.col("source"), seed)
    crossed = F.floor(offset + rate * (k + 1)) - F.floor(offset + rate * k)
    return (
        placed.join(facts, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("copies", crossed.cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: docs' rows, each as often as `mix` says.

    Rows are matched by doc_id, source and size; rows equal in all three take their copies in turn.
    """
    keys = ["doc_id", "source", "_size"]
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy("_copies"))
    plan = mix(docs, **options).select("doc_id", "source", F.col("size").alias("_size"), F.col("copies").alias("_copies"))
    plan = plan.withColumn("_turn", turn).where("_copies > 0").select(*(F.col(c).alias(f"{c}_p") for c in [*keys, "_turn"]), "_copies")
    by = Window.partitionBy(*keys).orderBy(F.lit(0))
    rows = boxed(docs, "doc_id", "source", "text").withColumn("_size", F.size(words_of(F.col("text"))).cast("long")).withColumn("_turn", F.row_number().over(by))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_p")) for c in [*keys, "_turn"]]
    out = rows.join(plan, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return unboxed(out, docs.columns)
