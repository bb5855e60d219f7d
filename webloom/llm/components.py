"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

#: Edges of one node that a task may take; those of a node with more are dealt to SALTS tasks.
HUB, SALTS = 1_000_000, 256


def with_least(edges: DataFrame, hubs: bool) -> DataFrame:
    """edges (u, v) with m, the least of u and all its v. Where there are hubs, their edges are split, and their minima by salt are few."""
    if not hubs:  # one exchange, and nothing that the driver holds
        return edges.select("u", "v", F.least("u", F.min("v").over(Window.partitionBy("u"))).alias("m"))
    salted = edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    some = salted.groupBy("u", "s").agg(F.min("v").alias("low"))
    least = some.groupBy("u").agg(F.min("low").alias("low")).select("u", F.least("u", "low").alias("m"))
    return salted.join(some.select("u", "s").join(least, "u"), ["u", "s"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) for every id that has an edge to another; edges: a, b.

    Each round links every node's larger neighbours to its smallest one, then the smaller ones. A round's table is
    written, and the one before deleted. A node with more than HUB edges doesn't have them all in one task.
    """
    star = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        degrees = both.groupBy("u").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("mark"))
        most, *now = degrees.agg(F.max("n"), F.sum("n"), F.bit_xor("mark")).first()
        if now == seen or not most:
            return star.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(star.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        large = with_least(both, most > HUB).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        found = with_least(large, most > HUB)
        small = found.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))
        before, star, seen = star, materialize(small.distinct()), now
        discard(before)


def forest(n: int, left, right) -> list[int]:
    """Places of pairs (left[i], right[i]) of 0..n-1 that suffice to connect what all of them connect: early ones first."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out: list[int] = []
    for i, (a, b) in enumerate(zip(left, right)):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append(i)
            if len(out) == n - 1:
                break
    return out
