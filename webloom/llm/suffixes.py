"""Benchmark items found in documents through suffix arrays of the documents (operator 12).

Each shard of whole documents is laid out as one array of word ids and its suffixes are sorted; every suffix of every item
searches its place by bisection, all of them at once, a word further in each round. So a suffix knows where its window occurs
and how far the longest verbatim match goes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Bytes that end a word as spaces, A-Z as a-z, all else as it is: words are runs of ASCII digits and letters and of what isn't ASCII.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Words of a suffix array, about; bytes of items that are searched at a time (they are sent to every task).
SHARD, ITEMS = 1 << 20, 1 << 25
FOUND = "n_words long, edges array<long>, item_ids array<string>, size long, at long, item_id string, item_at long"
FOUND_NAMES = [f.split()[0] for f in FOUND.split(", ")]
FOUND_TYPES = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string(), pa.int64()]


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def expanded(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges lo..hi-1, and which range each is of."""
    size = hi - lo
    which = np.repeat(np.arange(len(lo)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + lo[which], which


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places whose id isn't 0, ordered by the ids from there to the next 0, by the first `depth` of them at least; ids end with a 0.

    The first few ids make one number. Suffixes that are still equal are ranked by the suffixes further on, twice as far each time.
    """
    n = len(ids)
    bits = max(1, int(ids.max(initial=0)).bit_length())
    known = min(63 // bits, depth)
    key = np.zeros(n, dtype=np.int64)
    for k in range(known):
        key <<= bits
        key[: max(0, n - k)] |= ids[k:]
    order = np.flatnonzero(ids)
    key = key[order]
    by = np.argsort(key, kind="stable")
    order, key = order[by], key[by]
    slots, rank, follow = np.arange(len(order)), np.zeros(n, dtype=np.int64), np.ones(len(order), dtype=bool)
    while len(slots):
        new = np.r_[True, key[1:] != key[:-1]]
        rank[order[slots]] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]] + 1  # the place of the first of its equals
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = slots[tied & follow]  # those that go on with a 0 stay equal
        if known >= depth:
            break
        at = order[slots]
        key = rank[at] * (n + 1) + rank[np.minimum(at + known, n - 1)]
        by = np.argsort(key, kind="stable")
        key = key[by]
        order[slots], follow = at[by], key % (n + 1) > 0
        known *= 2
    return order


class Items:
    """Benchmark items as one array of word ids, a 0 after each; 0 is also each word that no item has."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        texts = [words_of(text) for _, text in items]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.ids = np.zeros(int(sizes.sum()) + len(texts) + 1, dtype=np.int32)
        self.first = np.cumsum(sizes + 1) - sizes - 1
        for first, text in zip(self.first.tolist(), texts):
            self.ids[first : first + len(text)] = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text]
        self.longest = int(sizes.max(initial=0))
        # suffixes that begin with a whole window: of fewer words, an item is one
        per_item = np.where(sizes > 0, np.maximum(sizes - window, 0) + 1, 0)
        place, self.item = expanded(np.zeros(len(texts), np.int64), per_item)
        self.start, self.need = place + self.first[self.item], np.minimum(sizes, window)[self.item]

    def ids_of(self, text: bytes | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int32, count=len(words))


@dataclass
class Finding:
    """What is found in a document: runs of hit words, the items, and the longest match (size, at, item, place in the item)."""

    edges: list[tuple[int, int]] = field(default_factory=list)
    items: set = field(default_factory=set)
    longest: tuple = (0, None, None, None)

    def merge(self, other: Finding) -> None:
        merged: list[list[int]] = []
        for lo, hi in sorted(self.edges + other.edges):
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        self.edges = [(lo, hi) for lo, hi in merged]
        self.items |= other.items
        if other.longest[0] > self.longest[0]:
            self.longest = other.longest


def bisected(ids: np.ndarray, order: np.ndarray, k: int, lo: np.ndarray, hi: np.ndarray, word: np.ndarray) -> np.ndarray:
    """For each range lo..hi of the suffixes the first whose k-th id is `word` or more."""
    lo, hi, last = lo.copy(), hi.copy(), len(ids) - 1
    for _ in range(int((hi - lo).max(initial=0)).bit_length()):
        middle = (lo + hi) >> 1
        less = (lo < hi) & (ids[np.minimum(order[np.minimum(middle, len(order) - 1)] + k, last)] < word)
        hi = np.where(less | (lo >= hi), hi, middle)
        lo = np.where(less, middle + 1, lo)
    return lo


def search(items: Items, parts: list[tuple[int, int, np.ndarray, int]]) -> dict[int, Finding]:
    """What a shard holds of the items, by document.

    parts: document, where in it the part starts, its ids, and how many of its places may start a match.
    """
    sizes = np.array([len(ids) for _, _, ids, _ in parts], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    ids = np.zeros(int(sizes.sum()) + len(parts) + 1, dtype=np.int32)
    own = np.zeros(len(ids), dtype=bool)
    for at, (_, _, part, n) in zip(begin.tolist(), parts):
        ids[at : at + len(part)] = part
        own[at : at + n] = True
    order = suffix_array(ids, items.longest)
    if not len(order):
        return {}
    firsts = np.searchsorted(ids[order], np.arange(len(items.vocabulary) + 2))
    word = items.ids[items.start]
    lo, hi, live, k = firsts[word], firsts[word + 1], np.arange(len(word)), 1
    edge, best, by = np.zeros(len(ids) + 1, dtype=np.int64), np.zeros(len(ids), dtype=np.int32), np.zeros(len(ids), dtype=np.int64)
    hits: list[tuple[np.ndarray, np.ndarray]] = []  # places and windows
    windows: list[np.ndarray] = []  # the suffixes that begin with a window
    while len(live):
        some = lo < hi
        lo, hi, live = lo[some], hi[some], live[some]
        whole = items.need[live] <= k
        head, group = np.unique(lo[whole], return_inverse=True)  # equal suffixes have the same range
        if len(head):
            first = np.full(len(head), len(items.start))
            np.minimum.at(first, group, live[whole])
            place, which = expanded(head, hi[whole][np.unique(group, return_index=True)[1]])
            place = order[place]
            best[place], by[place] = k, first[which]
            now = items.need[live[whole]] == k
            if now.any():
                mine = np.isin(which, group[now])
                hits.append((place[mine], which[mine] + len(windows)))
                np.add.at(edge, place[mine & own[place]], 1)
                np.add.at(edge, place[mine & own[place]] + k, -1)
                groups = np.split(live[whole][now][np.argsort(group[now], kind="stable")], np.flatnonzero(np.diff(np.sort(group[now]))) + 1)
                named = dict(zip(np.unique(group[now]).tolist(), groups))
                windows += [items.item[named[g]] if g in named else None for g in range(len(head))]
        more = items.ids[items.start[live] + k]
        lo, hi, live, more = (x[more > 0] for x in (lo, hi, live, more))
        lo, hi = bisected(ids, order, k, lo, hi, more), bisected(ids, order, k, lo, hi, more + 1)
        k += 1
    if not hits:
        return {}
    return findings(items, parts, begin, own, edge, best, by, np.concatenate([p for p, _ in hits]), np.concatenate([w for _, w in hits]), windows)


def findings(items: Items, parts: list, begin: np.ndarray, own: np.ndarray, edge: np.ndarray, best: np.ndarray, by: np.ndarray, place: np.ndarray, window: np.ndarray, windows: list) -> dict[int, Finding]:
    """A shard's matches by document: edge holds +1 and -1 where hit words begin and end, best and by the longest match at a place."""
    mine = own[place]
    part = np.searchsorted(begin, place[mine], side="right") - 1
    pairs = np.unique(part * len(windows) + window[mine])
    covered = np.cumsum(edge[:-1]) > 0
    out: dict[int, Finding] = {}
    for p in np.unique(pairs // len(windows)).tolist():
        doc, offset, ids, n = parts[p]
        at = int(begin[p])
        change = np.flatnonzero(np.diff(np.r_[False, covered[at : at + len(ids)], False]))
        found = Finding([(offset + lo, offset + hi) for lo, hi in change.reshape(-1, 2).tolist()])
        lo, hi = np.searchsorted(pairs, [p * len(windows), (p + 1) * len(windows)])
        found.items = {items.names[i] for w in (pairs[lo:hi] % len(windows)).tolist() for i in np.unique(windows[w]).tolist()} - {None}
        top = int(best[at : at + n].argmax())
        start = int(by[at + top])
        i = int(items.item[start])
        found.longest = (int(best[at + top]), offset + top, items.names[i], int(items.start[start] - items.first[i]))
        out.setdefault(doc, Finding()).merge(found)
    return out


def searched(items: Items, texts: Iterable[bytes | None]) -> tuple[list[int], dict[int, Finding]]:
    """The number of words of each text, and what is found in those where anything is.

    Texts are put in shards of about SHARD words; a longer text is cut into parts that overlap by the longest item.
    """
    counts, out, held, size = [], {}, [], 0

    def flush() -> None:
        for doc, found in search(items, held).items():
            out.setdefault(doc, Finding()).merge(found)
        held.clear()

    for doc, text in enumerate(texts):
        ids = items.ids_of(text)
        counts.append(len(ids))
        for lo in range(0, len(ids), SHARD):
            part = ids[lo : lo + SHARD + items.longest]
            if not part.any():
                continue
            if size + len(part) > SHARD and held:
                flush()
                size = 0
            held.append((doc, lo, part, min(SHARD, len(ids) - lo)))
            size += len(part)
    if held:
        flush()
    return counts, out


def blocks(benchmark: DataFrame, window: int) -> Iterator[Callable[[], Items]]:
    """The items, in blocks of about ITEMS bytes, each a broadcast that a task unpacks once."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(16)), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // ITEMS) if total > ITEMS else 1)
    for b in range(n):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else rows
        sent = spark.sparkContext.broadcast(sorted(((r[0], bytes(r[1] or b"")) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or "", r[1])))
        yield lambda sent=sent: Items(sent.value, window)


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, spans, item_ids, longest: what it holds of the items, verbatim.

    A word is hit if it lies in an occurrence of `window` consecutive words of an item, or of a whole item of fewer; spans are
    the runs of hit words (start, end, in words), item_ids the items of the windows (sorted), longest the longest match that
    begins with a window: size, at, item_id, item_at.

    Items are searched in blocks of about 32 MB, a pass over the documents for each; their results are merged. Null and empty
    texts have no words, a null or empty item no windows. Rows of one item_id are one item; one without an item_id
    is searched but not named. Repeated and null doc_ids are documents of their own. Other columns are ignored; an empty
    table of documents gives no rows, one of items no hits.
    """
    none = [F.lit(None).cast(f.split(" ", 1)[1]).alias(name) for f, name in zip(FOUND.split(", "), FOUND_NAMES)]
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), *none)
    schema = rows.schema
    for i, load in enumerate(blocks(benchmark, window)):
        if i:
            rows = materialize(rows)

        def run(batches: Iterable[pa.RecordBatch], load=load) -> Iterator[pa.RecordBatch]:
            items = load()
            for batch in batches:
                counts, found = searched(items, batch.column(1).to_pylist())
                columns = [c.to_pylist() for c in batch.columns[2:]]
                columns[0] = counts
                for doc, new in found.items():
                    edges, names, *longest = (c[doc] for c in columns[1:])
                    new.merge(Finding(list(zip(edges[::2], edges[1::2])) if edges else [], set(names or []), (longest[0] or 0, *longest[1:])))
                    for c, value in zip(columns[1:], ([x for e in new.edges for x in e], sorted(new.items), *new.longest)):
                        c[doc] = value
                arrays = [pa.array(c, t) for c, t in zip(columns, FOUND_TYPES)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["doc_id", "text", *FOUND_NAMES])

        rows = rows.mapInArrow(run, schema)
    spans = F.coalesce(F.expr("transform(sequence(1, size(edges) div 2), i -> struct(edges[2 * i - 2] AS start, edges[2 * i - 1] AS end))"), F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    longest = F.when(F.col("size") > 0, F.struct("size", "at", "item_id", "item_at"))
    return rows.select("doc_id", "n_words", spans.alias("spans"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), longest.alias("longest")).withColumn("n_hit", n_hit)


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = 10) -> DataFrame:
    """docs without those that hold a window of an item. All columns stay as they are; cases as in `contamination`."""
    at = docs.columns.index("text")
    for load in blocks(benchmark, window):

        def run(batches: Iterable[pa.RecordBatch], load=load) -> Iterator[pa.RecordBatch]:
            items = load()
            for batch in batches:
                _, found = searched(items, batch.column(at).cast(pa.binary()).to_pylist())
                yield batch.filter(pa.array([i not in found for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def digests(found: DataFrame) -> DataFrame:
    ids: Column = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), ids.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
