"""Incremental ingest as a stream whose new texts alone reach the sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import exists, shared_dir, table

STATE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def append_new(batch: DataFrame, sink: str, key: str = "text_md5") -> None:
    """Appends a batch's rows whose key the sink lacks, the first of each. A batch that is run again adds nothing.

    For single batches: the sink's keys are read. A stream holds them as state, see `ingest`.
    """
    spark = batch.sparkSession
    new = batch.dropDuplicates([key])
    if exists(spark, sink):
        known = spark.read.schema(batch.schema).parquet(sink).select(F.col(key).alias("_known"))
        new = new.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")  # a null key is one key
    new.select(*batch.columns).write.mode("append").parquet(sink)


def ingest(stream: DataFrame, sink: str, checkpoint: str, key: str = "text_md5") -> int:
    """Writes the stream's rows with new keys to sink, as far as its input goes now; the number of rows read.

    The keys so far are state beside the checkpoint (RocksDB: it may be larger than memory), so a batch reads its own rows
    alone, however long the sink is. A null key is one key. What a batch that fails has written doesn't count: the sink's log
    names the files of whole batches, and Spark's readers go by it.
    """
    conf = stream.sparkSession.conf
    before = conf.get(STATE)
    conf.set(STATE, ROCKSDB)
    try:
        query = stream.dropDuplicates([key]).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).format("parquet").start(sink)
        query.awaitTermination()
    finally:
        conf.set(STATE, before)
    return sum(p["numInputRows"] for p in query.recentProgress)


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct texts of documents, as a stream that ends with its input, its keys held as state."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(docs.schema).parquet(f"{sf_dir}/documents.parquet*").select(F.md5("text").alias("text_md5"), F.length("text").alias("chars"))
    ingest(stream, f"{folder}/sink", f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/sink")


QUERIES = {"stream_dedupe": stream_dedupe}
SQL = {"stream_dedupe": "SELECT DISTINCT md5(text) AS text_md5, length(text) AS chars FROM documents"}
