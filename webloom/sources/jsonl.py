"""Training examples as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .commit import staged_run

SCHEMA = "instruction string, output string"


def write_jsonl(examples: DataFrame, path: str, mode: str = "append") -> None:
    """One object a line, non-ASCII text as it is; mode is append or overwrite.

    Each call is a run of its own, a folder below path that is there with all its lines or not at all: tasks that run
    twice add nothing, and a call that fails leaves path as it was.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"{mode} is neither append nor overwrite")
    with staged_run(examples.sparkSession, path, mode == "overwrite") as staging:
        examples.select(F.to_json(F.struct("instruction", "output"), {"ignoreNullFields": "false"}).alias("value")).write.text(staging)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Examples of a JSONL folder, or file, of one run or many; malformed and blank lines are left out."""
    return spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").json(path)
