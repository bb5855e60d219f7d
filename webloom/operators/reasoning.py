"""Design reasoning by a model: the prompt as an expression, the call as a parameter, something else where it fails."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import values as v

#: Lines of the context: label, column, and the value that says nothing.
LINES = (("Industry", "industry", ""), ("Categories", "category", ""), ("Tone", "tone", ""), ("Layout", "layout", ""), ("Photo usage", "photo_usage", ""), ("Motion", "motion", "None"), ("Color scheme", "scheme", "Unknown"), ("Tech stack", "stack", ""))
#: Categories that a prompt names.
CATEGORIES = 5


def prompt(rows: DataFrame) -> Column:
    """The prompt for rows with some of the columns of LINES (category an array), n_css and keywords; what is null or says nothing has no line."""
    told = []
    for label, name, nothing in LINES:
        if name in rows.columns:
            value = F.array_join(F.slice(name, 1, CATEGORIES), ", ") if name == "category" else F.col(name)
            told.append(F.when((value != "") & (value != nothing), F.concat(F.lit(f"{label}: "), value)))
    if "n_css" in rows.columns:
        told.append(F.when(F.col("n_css") > 0, F.format_string("CSS files: %d file(s)", "n_css")))
    keywords = F.coalesce(F.when(F.col("keywords") != "", F.col("keywords")), F.lit(v.NO_KEYWORDS)) if "keywords" in rows.columns else F.lit(v.NO_KEYWORDS)
    first, second, third, last = (F.lit(x) for x in v.REASON_PROMPT.replace("{context}", "{keywords}").split("{keywords}"))
    return F.concat(first, F.concat_ws("\n", *told), second, keywords, third, keywords, last)


def answered(rows: DataFrame, ask: Callable[[str], str | None], pause: float = v.REASON_PAUSE, asked: str = "prompt", name: str = "reasoning") -> DataFrame:
    """rows with a model's answer, stripped; null where the call fails in any way, and for a null prompt.

    ask gets the prompt; system text, temperature, limit of tokens and timeout stand in `values`. A task asks one after
    the other and waits `pause` seconds after each answer. Asking twice may give two answers: write the result before using it twice.
    """
    at = rows.columns.index(asked)

    def told(text: str | None) -> str | None:
        try:
            found = ask(text).strip() if text is not None else None
        except Exception:  # whatever the model's client raises, the rest of the rows go on
            return None
        if found is not None:
            time.sleep(pause)
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([told(x) for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, rows.withColumn(name, F.lit(None).cast("string")).schema)


def reasoned(rows: DataFrame, fallback: Column, ask: Callable[[str], str | None] | None = None, pause: float = v.REASON_PAUSE, watch: Observation | None = None) -> DataFrame:
    """rows with reasoning: a model's, else the fallback; without a model to ask, the fallback alone.

    watch: gets asked and unanswered, counted as the rows pass.
    """
    if ask is None:
        return rows.withColumn("reasoning", fallback)
    told = answered(rows.withColumn("_fallback", fallback).withColumn("_prompt", prompt(rows)), ask, pause, "_prompt", "_told")
    if watch is not None:
        told = told.observe(watch, F.count("*").alias("asked"), F.count_if(F.col("_told").isNull()).alias("unanswered"))
    return told.withColumn("reasoning", F.coalesce("_told", "_fallback")).drop("_told", "_fallback", "_prompt")
