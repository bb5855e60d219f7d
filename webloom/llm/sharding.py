"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (operator 10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ranked

#: Places on the ring: hashes are cut to this many bits.
RING_BITS = 52


def ring(spark: SparkSession, shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(place, shard) of the virtual nodes, by place. A shard's nodes don't depend on how many shards there are."""
    place = F.pmod(F.xxhash64(F.lit("vnode"), (F.col("id") / vnodes).cast("long"), F.col("id") % vnodes), F.lit(1 << RING_BITS))
    nodes = spark.range(shards * vnodes).select(place.alias("place"), (F.col("id") / vnodes).cast("int").alias("shard"))
    return sorted((r.place, r.shard) for r in nodes.collect())


def clockwise(owners: list[int], counts: list[int], room: list[int]) -> list[list[tuple[int, int, int, int]]]:
    """For each arc, which ranks of its keys go where: lists of (first rank, last rank + 1, shard, first slot).

    All keys first ask the shard whose node ends their arc. A shard takes what it has room for, arcs in ring order and
    keys in rank order; the rest continue to the next node clockwise, until a shard with room has taken them.
    """
    room, filled, n = list(room), [0] * len(room), len(owners)
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in owners]
    waiting = {arc: 0 for arc in range(n) if counts[arc]}
    for hop in range(n):
        left = {}
        for arc, rank in waiting.items():
            shard = owners[(arc + hop) % n]
            taken = min(room[shard], counts[arc] - rank)
            if taken:
                out[arc].append((rank, rank + taken, shard, filled[shard]))
                room[shard] -= taken
                filled[shard] += taken
            if rank + taken < counts[arc]:
                left[arc] = rank + taken
        waiting = left
        if not waiting:
            break
    return out


def shard(docs: DataFrame, *, shards: int = 16, vnodes: int = 64) -> DataFrame:
    """Places each document on the ring by the hash of its doc_id, and on the shard clockwise from there.

    Each shard's load is bounded by its exact share of the rows (shares differ by one at most), and keys that meet a
    full shard continue clockwise. So the counts differ by one at most, while a further shard moves little more than
    the keys it takes and those that overflow. Which of a node's keys overflow is decided by their place on the ring.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law ('rows'), shard, slot, grown_shard (null).

    A null text counts as empty, a null doc_id hashes as a key of its own; repeated rows each take a slot, and rows of
    one doc_id (or hash) are told apart by doc_id, size and checksum, so that those wholly equal are interchangeable.
    Other columns are ignored; an empty table gives no rows.

    To the driver come a count for each of the shards * vnodes arcs; rows are numbered along the ring by `ranked`.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64(F.lit("key"), F.col("doc_id")), F.lit(1 << RING_BITS)).alias("place"),
    )
    nodes = ring(spark, shards, vnodes)
    places = [p for p, _ in nodes]
    # the arc that ends at node i holds the places above node i-1; those above the last node belong to arc 0
    arcs = F.array(*map(F.lit, places))
    rows = ranked(keyed, [F.col(c) for c in ("place", "doc_id", "size", "text_crc32")], "at")
    by_arc = {r.arc: (r.n, r.first) for r in rows.groupBy(binary_search(arcs, F.col("place"), len(places)).alias("arc")).agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()}
    n = len(places)
    # arc 0 in ring order: the places above the last node, then those up to node 0
    tail, head = by_arc.get(n, (0, 0)), by_arc.get(0, (0, 0))
    counts = [by_arc.get(i, (0, 0))[0] for i in range(n)]
    counts[0] = tail[0] + head[0]
    total = sum(counts)
    room = [total // shards + (i < total % shards) for i in range(shards)]
    spans = []  # of ranks along the whole ring: (first, shard, first slot)
    for i, taken in enumerate(clockwise([s for _, s in nodes], counts, room)):
        for first, last, to, slot in taken:
            if i:
                spans.append((by_arc[i][1] + first, to, slot))
                continue
            if first < tail[0]:
                spans.append((tail[1] + first, to, slot))
            if last > tail[0]:
                skipped = max(0, tail[0] - first)
                spans.append((head[1] + max(0, first - tail[0]), to, slot + skipped))
    spans.sort()
    if not spans:
        spans = [(0, 0, 0)]
    firsts, tos, slots = (F.array(*(F.lit(x) for x in column)) for column in zip(*spans))
    span = binary_search(firsts, F.col("at") + 1, len(spans))  # 1-based: the last that starts at or before
    return rows.withColumn("_span", span.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.element_at(tos, F.col("_span")).alias("shard"),
        (F.element_at(slots, F.col("_span")) + F.col("at") - F.element_at(firsts, F.col("_span"))).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def binary_search(ascending: Column, value: Column, n: int) -> Column:
    """How many of the n entries of an ascending array are below value."""
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(n.bit_length()))))
    below = lambda at: F.coalesce(F.try_element_at(ascending, at) < value, F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(below(low + step), low + step).otherwise(low))
