"""Substring deduplication against a log-structured index of window fingerprints (operator 4)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, shuffle_parts
from .shingles import WordHashes, mixed

#: span: first and last window that a row is about, as (first << 32) | last.
ROWS = "anchor long, doc_id long, span long, digests binary"
NAMES = ["anchor", "doc_id", "span", "digests"]
#: Bytes of a window's digest. Windows around one frequent run of words differ in the digest alone, so it must be
#: wide: n of them give about n^2 / 2^49 false matches.
WIDTH = 6
#: Words whose windows a task holds at a time.
HELD = 1 << 20


def windows(hashes: np.ndarray, window: int, gram: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """For each window of words: its anchor's place, and a digest of the whole window; and the anchors' hashes.

    A window's anchor is the run of `gram` words in it with the least hash, the first of equals. So equal windows
    have equal anchors at equal places, while neighbours mostly share one: fingerprints are kept by anchor, a short
    digest for each window that the anchor stands for.
    """
    n = len(hashes) - window + 1
    odd = np.uint64(0x9E3779B97F4A7C15)
    grams = hashes
    for step in (1 << i for i in range(gram.bit_length() - 1)):
        grams = mixed(grams[:-step] * odd + grams[step:])
    low, at = grams[:n].copy(), np.zeros(n, dtype=np.int64)
    for i in range(1, window - gram + 1):
        less = grams[i : n + i] < low
        low[less], at[less] = grams[i : n + i][less], i
    last = window - gram
    whole = grams[:n] * np.uint64(0xD6E8FEB86659FD93)
    for i in [*range(gram, last, gram), last]:
        whole = mixed(whole + grams[i : n + i])
    return low, np.arange(n) + at, whole >> np.uint64(64 - 8 * WIDTH)


def to_bytes(digests: np.ndarray) -> bytes:
    return digests.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // WIDTH, 8), dtype=np.uint8)
    wide[:, :WIDTH] = np.frombuffer(data, dtype=np.uint8).reshape(-1, WIDTH)
    return wide.view("<u8").ravel()


def spanning(first: np.ndarray, last: np.ndarray) -> pa.Array:
    return pa.array((first.astype(np.int64) << 32) | last)


def ranges(docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive starts in one document."""
    new = np.r_[True, (docs[1:] != docs[:-1]) | (starts[1:] != starts[:-1] + 1)] if len(docs) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return first, np.r_[first[1:], len(docs)][: len(first)] - 1


def earlier(keys: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows' key occurs at an earlier (document, start), and which are the first of their key.

    Among windows of one key the input is ordered by document and start.
    """
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.r_[True, sorted_keys[1:] != sorted_keys[:-1]] if len(keys) else np.zeros(0, bool)
    head = order[new][np.cumsum(new) - 1] if len(keys) else order
    later = np.zeros(len(keys), dtype=bool)
    later[order] = (docs[order] != docs[head]) | (starts[order] != starts[head])
    first = np.zeros(len(keys), dtype=bool)
    first[order[new]] = True
    return later, first


def fingerprints(docs: DataFrame, window: int) -> DataFrame:
    """Rows of the anchors of docs: hash, doc_id, first window, and a digest for each window it stands for.

    Windows that an earlier document of the same piece of a task's input holds too are resolved there: their ranges
    go out as rows without digests, and an anchor all of whose windows are such isn't sent on. So a passage that many
    documents share is sent once by each piece.
    """

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size = WordHashes(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            held.sort(key=lambda x: x[0])
            doc = np.repeat(np.array([h[0] for h in held], dtype=np.int64), [len(h[1]) for h in held])
            start = np.concatenate([np.arange(len(h[1]), dtype=np.int64) for h in held])
            low, place, digest = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
            later, _ = earlier(mixed(low) ^ (digest * np.uint64(0xFF51AFD7ED558CCD)), doc, start)
            head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])])
            end = np.r_[head[1:], len(doc)]
            sent = np.add.reduceat(~later, head) > 0
            data = to_bytes(digest)
            known = later & ~np.repeat(sent, end - head)
            first, last = ranges(doc[known], start[known])
            head, end = head[sent], end[sent]
            ends = pa.array(np.r_[0, np.cumsum((end - head) * WIDTH)].astype(np.int32))
            parts = b"".join(data[WIDTH * a : WIDTH * b] for a, b in zip(head.tolist(), end.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(low[head].view(np.int64)), pa.array(doc[head]), spanning(start[head], start[end - 1]), pa.Array.from_buffers(pa.binary(), len(head), [None, ends.buffers()[1], pa.py_buffer(parts)])],
                names=NAMES,
            )
            d, s = doc[known], start[known]
            yield pa.RecordBatch.from_arrays([pa.array(mixed(d[first].view(np.uint64)).view(np.int64)), pa.array(d[first]), spanning(s[first], s[last]), pa.nulls(len(first), pa.binary())], names=NAMES)
            held, size = [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = (text or "").encode().split()  # of bytes, split() parts at the six spaces alone
                if doc_id is None or len(parts) < window:
                    continue
                held.append((doc_id, *windows(memo.of(parts), window)))
                size += len(parts)
                if size >= HELD:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(emit, ROWS)


def resolve(rows: DataFrame, since: int | None, keep: bool, compact: bool = False) -> DataFrame:
    """Merges the rows of runs and batch, by anchor: rows of covered windows, without digests, for documents from `since` on.

    With `keep`, the batch's rows that hold a window seen for the first time follow, in the order of their anchors:
    the run to be added to the index. With `compact`, the runs' own rows follow among them: the run that replaces all.
    """

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))  # first windows of the anchor that may go on
        anchor_before = None
        for batch in batches:
            table = batch.column("digests").is_null().to_numpy(zero_copy_only=False)
            if table.any():
                yield batch.filter(pa.array(table))
                batch = batch.filter(pa.array(~table))
            if not batch.num_rows:
                continue
            anchor, doc, span = (batch.column(c).to_numpy() for c in NAMES[:3])
            start = span >> 32
            count = (span & 0xFFFFFFFF) - start + 1
            digest = from_bytes(b"".join(batch.column("digests").to_pylist()))
            row = np.repeat(np.arange(len(anchor)), count)
            at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            keys = mixed(anchor.view(np.uint64)[row] + mixed(digest))
            old = carry if anchor_before == anchor[0] else tuple(c[:0] for c in carry)
            n = len(old[0])
            keys, docs, at = np.r_[old[0], keys], np.r_[old[1], doc[row]], np.r_[old[2], at]
            later, first = earlier(keys, docs, at)
            tail = np.r_[np.full(n, anchor[0] == anchor[-1]), anchor[row] == anchor[-1]] & first
            carry, anchor_before = (keys[tail], docs[tail], at[tail]), anchor[-1]
            later, docs, at, first = later[n:], docs[n:], at[n:], first[n:]
            if since is not None:
                later &= docs >= since
            d, s = docs[later], at[later]
            head, last = ranges(d, s)
            yield pa.RecordBatch.from_arrays([pa.array(d[head]), pa.array(d[head]), spanning(s[head], s[last]), pa.nulls(len(head), pa.binary())], names=NAMES)
            if keep:
                new = np.bincount(row[first], minlength=len(anchor)) > 0
                if since is not None and not compact:
                    new &= doc >= since
                yield batch.filter(pa.array(new))

    parts = shuffle_parts(rows.sparkSession)
    return rows.repartition(parts, "anchor").sortWithinPartitions("anchor", "doc_id", "span").mapInArrow(merge, ROWS)


class FingerprintIndex:
    """Sorted immutable runs of the windows of all documents so far.

    Batches come in the order of their doc_ids: all of a batch's are larger than those before. Each adds a run; where
    there would be `fan` runs, the merge with the batch, which has all their rows at hand in order, writes one instead.

    Runs lie in `folder`, a shared one, where a later session finds them again; without it they go with the session.
    A run is whole once its _SUCCESS is there. Those that a merged run replaces go after it is whole; where a session
    ends between, windows are in two runs, which changes no result.
    """

    def __init__(self, window: int = 20, fan: int = 2, folder: str | None = None, spark: SparkSession | None = None):
        self.window, self.fan, self.folder, self.runs = window, fan, folder and folder.rstrip("/"), []
        if self.folder:
            spark = spark or SparkSession.active()
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/run-*/_SUCCESS")
            found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
            self.runs = [self.stored(spark, str(f.getPath().getParent())) for f in found]

    @staticmethod
    def stored(spark: SparkSession, path: str) -> DataFrame:
        run = spark.read.schema(ROWS).parquet(path)
        run.stored_at = path
        return run

    def write(self, run: DataFrame) -> DataFrame:
        if not self.folder:
            return run
        path = f"{self.folder}/run-{uuid.uuid4().hex}"
        run.write.option("compression", "zstd").parquet(path)
        return self.stored(run.sparkSession, path)

    def dedupe(self, batch: DataFrame, since: int | None, add: bool = True) -> DataFrame:
        """doc_id, span: the batch's windows that the index or an earlier place of the batch holds."""
        rows = fingerprints(batch, self.window)
        for run in self.runs:
            rows = rows.unionByName(run)
        compact = add and len(self.runs) + 1 >= self.fan
        found = resolve(rows, since, add, compact)
        if add:
            found = materialize(found)
            run, old = self.write(found.where("digests is not null")), self.runs
            self.runs = [run] if compact else [*old, run]
            if compact and self.folder:
                for replaced in old:
                    discard(replaced)
        return found.where("digests is null").select("doc_id", "span")


def covered_windows(docs: DataFrame, *, window: int = 20, shares: tuple[float, ...] = (1 / 32, 1 / 8), index: FingerprintIndex | None = None) -> DataFrame:
    """doc_id, span of all windows that also start earlier: docs go through an index, in batches of doc_ids cut at `shares`.

    Without `index` the last batch isn't added, since nothing would be merged with it; with one, all are, and windows
    that the index holds already count as earlier: docs' ids are then larger than all in it.
    """
    named = docs.where("doc_id is not null")
    cuts = sorted(set(named.approxQuantile("doc_id", list(shares), 0.01))) if shares else []
    since, out, keep = None, None, index is not None
    if keep and index.runs:
        since = named.agg(F.min("doc_id")).first()[0]
    index = index or FingerprintIndex(window)
    for cut in [*map(int, cuts), None]:
        batch = named if since is None else named.where(F.col("doc_id") >= since)
        batch = batch if cut is None else batch.where(F.col("doc_id") < cut)
        found = index.dedupe(batch, since, add=keep or cut is not None)
        out = found if out is None else out.unionByName(found)
        since = cut
    return out


def trimmed(docs: DataFrame, *, window: int = 20, **batches) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (the words left, joined by one space).

    A word goes if a window of `window` words that covers it also starts earlier: in a document of a smaller doc_id,
    or before in the same one. Windows are judged on the input. Fingerprints are 64 bits of the anchor and, to verify
    it, 48 other bits of the whole window.

    Null texts have no words. A null doc_id is left whole and is no source for others. Rows of one doc_id are one
    document's: a window at the same start isn't earlier. Columns besides doc_id and text are ignored; an empty table
    gives no rows.
    """
    spans = covered_windows(docs, window=window, **batches)
    per_doc = spans.groupBy("doc_id").agg(F.collect_list("span").alias("spans"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts = (text or "").encode().split()
                n.append(len(parts))
                if not spans:
                    gone.append(0), kept.append(b" ".join(parts).decode())
                    continue
                edge = np.zeros(len(parts) + 1, dtype=np.int64)
                np.add.at(edge, [s >> 32 for s in spans], 1)
                np.add.at(edge, [(s & 0xFFFFFFFF) + window for s in spans], -1)
                stay = np.cumsum(edge[:-1]) == 0
                gone.append(len(parts) - int(stay.sum()))
                kept.append(b" ".join([parts[i] for i in np.flatnonzero(stay).tolist()]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return docs.select("doc_id", "text").join(per_doc, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def digests(trimmed_docs: DataFrame) -> DataFrame:
    return trimmed_docs.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
