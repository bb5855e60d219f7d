"""Quality rules as a short-circuit cascade, ordered by rejection per cost (operator 9)."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES

SYMBOLS = "#*$%&|<>"
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


class Doc:
    """A text whose statistics are computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.known: dict[str, int] = {}

    def __getitem__(self, name: str) -> int:
        if name not in self.known:
            self.known[name] = getattr(self, name)()
        return self.known[name]

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # of bytes, split() parts at the six spaces alone

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.encode().split(b"\n") if line.strip()]

    def n_words(self) -> int:
        return len(self.words)

    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    def n_lines(self) -> int:
        return len(self.lines)

    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def n_repeat_words(self) -> int:
        """Words in a window of three that the text holds twice or more."""
        n = len(self.words)
        if n < 4:
            return 0
        codes: dict[bytes, int] = {}
        ids = np.fromiter((codes.setdefault(w, len(codes)) for w in self.words), dtype=np.int64, count=n)
        pairs = np.unique(ids[:-1] * len(codes) + ids[1:], return_inverse=True)[1].astype(np.int64)
        _, window, times = np.unique(pairs[:-1] * len(codes) + ids[2:], return_inverse=True, return_counts=True)
        twice = times[window] > 1
        covered = np.zeros(n, dtype=bool)
        for i in range(3):
            covered[i : n - 2 + i] |= twice
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    """A document fails if `fails` says so of its statistics."""

    name: str
    fails: Callable[[Doc], bool]


#: The base: too short, or mostly made of windows that repeat.
BASE = (
    Rule("short", lambda d: d["n_words"] < 50),
    Rule("repeats", lambda d: 100 * d["n_repeat_words"] > 50 * d["n_words"]),
)
#: The cascade's own rules. Thresholds are whole-number ratios, so that every engine agrees on the edge.
RULES = (
    *BASE,
    Rule("symbols", lambda d: 10 * d["n_symbols"] > d["n_words"]),
    Rule("dup_lines", lambda d: 100 * d["n_dup_lines"] > 30 * d["n_lines"]),
    Rule("short_words", lambda d: d["word_chars"] < 2 * d["n_words"]),
    Rule("long_words", lambda d: d["word_chars"] > 15 * d["n_words"]),
)


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, sample_rows: int = 400, seed: int = 7) -> list[tuple[Rule, float, float]]:
    """The rules in the order in which to ask them, each with its cost (seconds a document) and its rejection rate.

    Both are measured on a sample of about `sample_rows` documents, on the executors, where each document meets every
    rule by itself. Rules stand by rejection per cost. What a document's verdict is doesn't depend on the order.
    """

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, failed, n = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                for i, rule in enumerate(rules):
                    began = time.perf_counter()
                    failed[i] += rule.fails(Doc(text))
                    spent[i] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": pa.array(range(len(rules)), pa.int32()), "s": spent, "failed": pa.array(failed, pa.int64()), "n": pa.array([n] * len(rules), pa.int64())})

    total = docs.count()
    sample = docs.select("text").sample(min(1.0, sample_rows / max(1, total)), seed)
    found = sample.mapInArrow(measure, "rule int, s double, failed long, n long").groupBy("rule").agg(F.sum("s").alias("s"), F.sum("failed").alias("failed"), F.sum("n").alias("n")).collect()
    known = {r["rule"]: (r["s"] / max(1, r["n"]), (r["failed"] + 0.5) / (r["n"] + 1)) for r in found}
    cost = {i: known.get(i, (1.0, 0.0)) for i in range(len(rules))}
    order = sorted(cost, key=lambda i: (-cost[i][1] / max(cost[i][0], 1e-9), i))
    return [(rules[i], *cost[i]) for i in order]


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, **sampling) -> DataFrame:
    """Per document: doc_id, the base statistics, base_failed, kept.

    kept is false if any rule fails; the rules are asked in the order of `cascade` until one does. A null or empty
    text has no words and fails. Each row is judged alone: repeated rows and null ids stay as they are, columns
    besides doc_id and text are ignored, and an empty table gives no rows.
    """
    order = [rule for rule, _, _ in cascade(docs, rules, **sampling)]

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Doc(t) for t in batch.column(1).to_pylist()]
            kept = [not any(rule.fails(d) for rule in order) for d in found]
            base = [any(rule.fails(d) for rule in BASE) for d in found]
            arrays = [pa.array([d[c] for d in found], pa.int64()) for c in COLUMNS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, pa.array(base, pa.bool_()), pa.array([k and not b for k, b in zip(kept, base)], pa.bool_())], names=["doc_id", *COLUMNS, "base_failed", "kept"])

    return docs.select("doc_id", "text").mapInArrow(judged, SCHEMA)


def accepted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, **sampling) -> DataFrame:
    """docs without those that a rule rejects: here a document meets no further rule after the first that it fails."""
    order = [rule for rule, _, _ in cascade(docs, rules, **sampling)]

    def passed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            keep = []
            for text in batch.column(at).to_pylist():
                doc = Doc(text)
                keep.append(not any(rule.fails(doc) for rule in order))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(passed, docs.schema)
