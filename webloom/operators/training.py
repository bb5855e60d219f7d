"""Training examples as token ids and labels."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as v
from ..plans import corpus
from ..sources.tables import table, views
from .numbering import numbered

#: Longer examples are cut; a label that doesn't count.
LONGEST, MASKED = 2048, -100
IDS = "input_ids array<int>, labels array<int>"


def hashed_words(text: str) -> list[int]:
    """An id for each word, for those who name no tokenizer: 31 bits of its checksum."""
    return [zlib.crc32(w.encode()) & 0x7FFFFFFF for w in text.split()]


def from_file(path: str) -> Callable[[str], list[int]]:
    """The ids of a tokenizer file, loaded once by each worker."""
    loaded: list = []

    def ids(text: str) -> list[int]:
        if not loaded:
            from tokenizers import Tokenizer

            loaded.append(Tokenizer.from_file(path))
        return loaded[0].encode(text).ids

    return ids


def with_labels(prompt: Column, answer: Column, ids: Callable[[str], list[int]] = hashed_words, longest: int = LONGEST) -> Column:
    """input_ids and labels of prompt + answer + end mark, cut at `longest`; the prompt's labels are masked. Null where either is null.

    Prompt and whole are tokenized each by themselves, so that a mask is as long as the prompt alone.
    """

    @F.pandas_udf(IDS)
    def run(prompts: pd.Series, answers: pd.Series) -> pd.DataFrame:
        out = []
        for p, a in zip(prompts, answers):
            if p is None or a is None:
                out.append((None, None))
                continue
            whole, n = ids(f"{p}{a}\n<|EOT|>")[:longest], len(ids(p)[:longest])
            out.append((whole, [MASKED] * min(n, len(whole)) + whole[n:]))
        return pd.DataFrame(out, columns=["input_ids", "labels"])

    return run(prompt, answer)


def examples_of(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """conv_id, turn, t (input_ids, labels) of each instruction and answer in the training prompt.

    tokenizer is the path of a tokenizer file, else that of the installed public byte-level BPE.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    views(spark, sf_dir, ("conversations",))
    pairs = spark.sql(f"SELECT conv_id, turn, trim(instruction) AS instruction, answer FROM {corpus.pairs()} p")
    prompt = F.concat(F.lit(v.TRAIN_PROMPT), "instruction", F.lit(v.RESPONSE))
    return pairs.repartition(spark.sparkContext.defaultParallelism).select("conv_id", "turn", with_labels(prompt, F.col("answer"), from_file(tokenizer)).alias("t"))


def token_ids(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """conv_id, turn, n_tokens, n_labels, ids_crc32 of each instruction and answer in the training prompt."""
    made = examples_of(spark, sf_dir, tokenizer)
    counted = F.size(F.filter("t.labels", lambda x: x != MASKED))
    return made.select("conv_id", "turn", F.size("t.input_ids").alias("n_tokens"), counted.alias("n_labels"), F.crc32(F.array_join("t.input_ids", ",").cast("binary")).alias("ids_crc32"))


class ChatTemplate(NamedTuple):
    """What stands before and after a message; {role} is its role. The default is a widespread plain form."""

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    start: str = ""

    def text(self, messages: Column, prompted: bool = True) -> Column:
        """The text of an array of (role, content); prompted: the answer's opening comes last. Null for null.

        A message without content is empty, one without role a user's.
        """
        head, _, tail = self.before.partition("{role}")
        role = F.lit("{role}" in self.before)
        opened = lambda r: F.concat(F.lit(head), F.when(role, r).otherwise(""), F.lit(tail))
        said = F.transform(messages, lambda m: F.concat(opened(F.coalesce(m["role"], F.lit("user"))), F.coalesce(m["content"], F.lit("")), F.lit(self.after)))
        return F.concat(F.lit(self.start), F.array_join(said, ""), opened(F.lit("assistant")) if prompted else F.lit(""))


def chat_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, prompt of each user line: alone, as a chat's one message, the answer opened."""
    said = table(spark, sf_dir, "conversations").where("role = 'user'")
    return said.select("conv_id", "turn", ChatTemplate().text(F.array(F.struct("role", F.col("text").alias("content")))).alias("prompt"))


def collated(rows: DataFrame, size: int, *keys: str, pad: int = 0) -> DataFrame:
    """batch, width, input_ids, attention_mask, labels (arrays of arrays): rows of input_ids and labels, `size` at a time.

    Rows are taken by length, then by keys (columns that tell them apart), so a batch is padded by little; it ends in ids
    `pad`, in a mask of 0 and in labels that don't count. Rows without ids are left out. All but the last batch are full. No
    task holds more than a batch at once, however many rows have one length: numbers come from `numbered`.
    """
    if size < 1:
        raise ValueError("a batch has one row at least")
    long = rows.where("input_ids is not null").withColumn("_width", F.size("input_ids"))
    dealt = numbered(long, "_width", *keys).withColumn("batch", F.floor((F.col("number") - 1) / size).cast("long"))
    batches = dealt.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("number", "input_ids", "labels"))).alias("r"), F.max("_width").alias("width"))

    def padded(name: str, filler: int) -> Column:
        return F.transform("r", lambda x: F.concat(x[name], F.array_repeat(F.lit(filler), F.col("width") - F.size(x[name])))).alias(name)

    mask = F.transform("r", lambda x: F.concat(F.array_repeat(F.lit(1), F.size(x["input_ids"])), F.array_repeat(F.lit(0), F.col("width") - F.size(x["input_ids"]))))
    return batches.select("batch", "width", padded("input_ids", pad), mask.alias("attention_mask"), padded("labels", MASKED))


#: Rows of a batch in the query.
BATCH = 8


def collated_batches(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """batch, width, n_rows, n_tokens, n_labels, ids_crc32 of the examples' batches."""
    batches = collated(examples_of(spark, sf_dir, tokenizer).select("conv_id", "turn", "t.*"), BATCH, "conv_id", "turn")
    total = lambda name, test: F.aggregate(name, F.lit(0).cast("long"), lambda n, x: n + F.size(F.filter(x, test)))
    ids = F.array_join(F.transform("input_ids", lambda x: F.array_join(x, ",")), ";")
    return batches.select("batch", "width", F.size("input_ids").alias("n_rows"), total("attention_mask", lambda x: x == 1).alias("n_tokens"), total("labels", lambda x: x != MASKED).alias("n_labels"), F.crc32(ids.cast("binary")).alias("ids_crc32"))


QUERIES = {"token_ids": token_ids, "chat_prompts": chat_prompts, "collated_batches": collated_batches}
