"""Running numbers over a whole table, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize


def numbered(rows: DataFrame, *keys: str, name: str = "number") -> DataFrame:
    """rows with 1, 2, ... in the order of keys, which tell rows apart and hold no large share of equal values.

    Rows are sorted by range and written once, so that partitions stay as they are; each partition is numbered from the
    count of those before it. Only these counts (one per partition) come to the driver.
    """
    stored = materialize(rows.orderBy(*keys).withColumn("_part", F.spark_partition_id()))
    starts, total = {}, 0
    for part, n in sorted((r["_part"], r["count"]) for r in stored.groupBy("_part").count().collect()):
        starts[part] = total
        total += n
    before = rows.sparkSession.createDataFrame(list(starts.items()), "_part int, _before long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return stored.withColumn(name, place).join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")


def resumed(rows: DataFrame, start: int, *keys: str) -> DataFrame:
    """rows from the start-th on (counted from 1), or all where there are fewer."""
    marked = numbered(rows, *keys, name="_n")
    beyond = marked.where(F.col("_n") >= start).limit(1).count() == 0
    return (marked if beyond else marked.where(F.col("_n") >= start)).drop("_n")
