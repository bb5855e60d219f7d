"""Parquet tables of a folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a table that is read in fewer tasks than there are cores, dealt to as many tasks; other tables as they are.

    For scans ahead of costly parsing: a small table may be one file that can't be split.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def views(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> None:
    """Tables as views; pages, whose queries search whole markup, are spread."""
    for name in names:
        rows = table(spark, sf_dir, name)
        (spread(rows) if name == "pages" else rows).createOrReplaceTempView(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where it names none, one is made if all runs on this machine (local mode, as in tests); a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="webloom-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def materialize(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage is cut, and a lost executor costs no recomputation.

    The files go by `discard`, or when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/webloom/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(stored: DataFrame | None) -> None:
    """Deletes the files of a table that `materialize` returned; nothing may be computed from it any more."""
    if stored is None:
        return
    spark = stored.sparkSession
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(stored.stored_at)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
