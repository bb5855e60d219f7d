"""Outputs are whole: after tasks that die, after jobs that fail."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from webloom.sources import folders, jsonl

DYING = """
import os, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from webloom.sources import folders, jsonl

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def dies(batches):  # each task's first attempt, after rows that are written by then
    for n, batch in enumerate(batches):
        if n == 2 and TaskContext.get().attemptNumber() == 0:
            os._exit(1)
        yield batch

spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
rows = spark.range(0, 100, 1, 3).select(F.format_string("i%03d", "id").alias("instruction"), F.repeat(F.lit("x"), 5).alias("output")).mapInArrow(dies, jsonl.SCHEMA)
jsonl.write_jsonl(rows, sys.argv[1])
jsonl.write_jsonl(rows, sys.argv[1])
files = rows.select(F.col("instruction").alias("folder"), F.lit("a.txt").alias("file"), F.col("output").alias("text"))
print(folders.write_folders(files, sys.argv[2]))
"""


def test_tasks_that_die(tmp_path):
    run = subprocess.run([sys.executable, "-c", DYING, f"{tmp_path}/out", f"{tmp_path}/folders"], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=300)
    assert run.stdout.strip() == "100", run.stderr[-2000:]
    lines = sorted(x for run in os.listdir(tmp_path / "out") for f in (tmp_path / "out" / run).glob("part-*") for x in f.read_text().splitlines())
    assert len(os.listdir(tmp_path / "out")) == 2 and lines == sorted(2 * [f'{{"instruction":"i{i:03d}","output":"xxxxx"}}' for i in range(100)])
    assert sorted(os.listdir(tmp_path)) == ["folders", "out"] and sorted(os.listdir(tmp_path / "folders")) == [f"i{i:03d}" for i in range(100)]


def test_jobs_that_fail(spark, tmp_path):
    out, target = f"{tmp_path}/out", f"{tmp_path}/folders"
    good = spark.createDataFrame([("a", "b"), (None, "é")], jsonl.SCHEMA)
    bad = spark.range(100).select(F.col("id").cast("string").alias("instruction"), F.when(F.col("id") < 99, "x").otherwise(F.raise_error(F.lit("no"))).alias("output"))
    files = lambda df: df.select(F.coalesce("instruction", F.lit("none")).alias("folder"), F.lit("f").alias("file"), F.col("output").alias("text"))
    jsonl.write_jsonl(good, out)
    folders.write_folders(files(good), target)
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="no"):
            jsonl.write_jsonl(bad, out, mode)
    with pytest.raises(Exception, match="no"):
        folders.write_folders(files(bad), target)
    assert sorted(map(str, jsonl.read_jsonl(spark, out).collect())) == sorted(map(str, good.collect()))
    assert sorted(os.listdir(tmp_path)) == ["folders", "out"] and sorted(os.listdir(target)) == ["a", "none"] and open(f"{target}/a/f").read() == "b"
    folders.write_folders(files(good.where("instruction = 'a'")), target, empty=False)
    assert sorted(os.listdir(target)) == ["a", "none"]
    jsonl.write_jsonl(good.limit(1), out, "overwrite")
    folders.write_folders(files(good.limit(0)), target)
    assert jsonl.read_jsonl(spark, out).count() == 1 and len(os.listdir(out)) == 1 and os.listdir(target) == []
