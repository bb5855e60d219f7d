"""What the training-data operators share: words, shared tables, global ranks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..sources.tables import discard, materialize, table

#: Words are the runs of anything but these six characters.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds each row's 0-based place in the total order, without one task that sees all rows.

    Rows are range-partitioned and sorted, written, and numbered by their place in the partition plus the counts of
    the partitions before; the only table on one task has a row per partition. Rows equal in `order` get any of
    their places.
    """
    placed = materialize(
        df.repartitionByRange(shuffle_parts(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return (
        placed.join(F.broadcast(offsets), "_part")  # a row per partition
        .withColumn(name, F.col("_first") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_at", "_n", "_first")
    )


#: A key with more than one in so many of all rows is a hot one: there are fewer than this many, so that they can be broadcast.
HOT = 2000


def attached(rows: DataFrame, keys: list[str], facts: DataFrame, total: int, values: list[str], spread: Column) -> DataFrame:
    """rows with the values that facts have for their keys; null where there are none.

    facts: keys, n (how many rows have them), values; a row for each key. `total` is the number of rows. The facts of
    hot keys (fewer than HOT, of fixed size) are broadcast; rows of such keys, and those with a null key, go to any
    task in the join with the other facts, by `spread`, so that no task gets all rows of one key.
    """
    value = F.struct(*values)
    named = [F.col(k).alias(f"_{k}") for k in keys]
    is_hot = F.col("n") > F.lit(max(1, total // HOT))
    hot = facts.where(is_hot).select(*named, value.alias("_hot"))
    rest = facts.where(~is_hot).select(*(F.col(k).alias(f"__{k}") for k in keys), value.alias("_rest"))
    marked = rows.join(F.broadcast(hot), [F.col(k) == F.col(f"_{k}") for k in keys], "left").drop(*(f"_{k}" for k in keys))
    null = F.lit(False)
    for k in keys:
        null |= F.col(k).isNull()
    types = {f.name: f.dataType for f in rows.schema.fields}
    away = F.col("_hot").isNotNull() | null
    marked = marked.withColumn("_away", away)
    for i, k in enumerate(keys):
        marked = marked.withColumn(f"_{k}", F.when(F.col("_away"), (F.lit(0) if i else spread).cast(types[k])).otherwise(F.col(k)))
    met = marked.join(rest, [F.col(f"_{k}") == F.col(f"__{k}") for k in keys], "left")
    found = F.when(F.col("_hot").isNotNull(), F.col("_hot")).when(~F.col("_away"), F.col("_rest"))
    return met.withColumn("_found", found).select(*rows.columns, *(F.col(f"_found.{v}").alias(v) for v in values))


def units(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of one unit after the other; the input is sorted by its first `keys` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy() for i in range(keys)])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            this = tuple(key[:, lo])
            if held and this != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = this
    if held:
        yield pa.Table.from_batches(held)


def boxed(docs: DataFrame, *names: str) -> DataFrame:
    """docs' rows as one column, beside the columns named: what else docs has can't clash with an operator's own."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), *names)


def unboxed(rows: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    return rows.select(*((new[c] if c in new else F.col("_row").getField(c)).alias(c) for c in columns))
