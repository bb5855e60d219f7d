"""Best-fit-decreasing packing (operators 2 and 6)."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, ranked, shuffle_parts
from .tokens import byte_bpe


class CapacityTree:
    """Segment tree over remaining capacities 0..cap: which of them some open bin has."""

    def __init__(self, cap: int):
        self.leaves = 1 << cap.bit_length()
        self.open = np.zeros(2 * self.leaves, dtype=np.int64)

    def add(self, capacity: int, runs: int) -> None:
        node = self.leaves + capacity
        while node:
            self.open[node] += runs
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The least open capacity that holds `need`, in logarithmic time."""
        node = self.leaves + need
        if self.open[node]:
            return need
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


class Move(NamedTuple):
    """Items first..last-1 of one length go to bins from `bin` on, `per` to a bin, from place `offset` of each."""

    length: int
    first: int
    last: int
    bin: int
    per: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], cap: int) -> list[Move]:
    """Best-fit decreasing of counts[length] items of each length into bins of `cap`.

    Items of one length are interchangeable, and so are bins of one remaining capacity. So runs of equal items meet
    runs of equal bins, and the plan is as long as there are such runs: it depends on the lengths there are (at most
    `cap`), not on the number of items. The bins that come out are those of one-by-one best-fit decreasing.
    """
    tree, runs, moves, bins = CapacityTree(cap), {}, [], 0

    def put(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            runs.setdefault(capacity, []).append((first, n))
            tree.add(capacity, 1)

    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        if not 0 < length <= cap:
            raise ValueError(f"length {length} outside 1..{cap}")
        while done < total:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first, n = cap, bins, -(-(total - done) // (cap // length))
                bins += n
            else:
                first, n = runs[capacity].pop()
                tree.add(capacity, -1)
            per = capacity // length
            taken = min(total - done, n * per)
            moves.append(Move(length, done, done + taken, first, per, cap - capacity))
            full, rest = divmod(taken, per)
            put(capacity - per * length, first, full)
            if rest:
                put(capacity - rest * length, first + full, 1)
            put(capacity, first + full + (rest > 0), n - full - (rest > 0))
            done += taken
    return moves


class Places:
    """Bin and offset of item k of a length, by the moves of a plan."""

    def __init__(self, moves: list[Move]):
        self.cols = np.array(sorted(moves), dtype=np.int64).reshape(-1, 6)
        self.keys = self.key(self.cols[:, 0], self.cols[:, 1])

    @staticmethod
    def key(length: np.ndarray, k: np.ndarray) -> np.ndarray:
        return (length.astype(np.int64) << 44) | k

    def of(self, length: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.cols[np.searchsorted(self.keys, self.key(length, k), side="right") - 1]
        n = k - at[:, 1]
        return at[:, 3] + n // at[:, 4], at[:, 5] + n % at[:, 4] * length


def cut(n: int, cap: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of n ids: all of `cap`, but the first may be shorter."""
    start = 0
    for length in ([n % cap] if n % cap else []) + [cap] * (n // cap):
        yield start, length
        start += length


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def tokenized(doc_ids: pa.Array, texts: pa.Array, end_id: int, paths: tuple) -> Iterator[tuple[int | None, np.ndarray]]:
    bpe = byte_bpe(*paths)
    for doc_id, text in zip(doc_ids.to_pylist(), texts.to_pylist()):
        yield doc_id, np.append(bpe.ids(text or ""), np.uint32(end_id))


def packing(docs: DataFrame, cap: int, end_id: int, tokenizer: tuple, id_bytes: int | None = None) -> DataFrame:
    """A row per piece with its sequence_id and offset, by best-fit decreasing over the whole table. With id_bytes, pieces carry their ids, each in as many bytes.

    The lengths' histogram (at most `cap` rows) is all that comes to the driver; each piece finds its place by its
    rank among the pieces of its length, which go by doc_id, piece, start and checksum: so the plan doesn't depend on
    how rows are dealt to tasks.
    """
    kind = None if id_bytes is None else np.dtype(f"<u{id_bytes}")
    schema = PIECES if kind is None else PIECES.append(pa.field("ids", pa.binary()))
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long" + ("" if kind is None else ", ids binary")

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, ids in tokenized(*batch.columns, end_id, tokenizer):
                if kind is not None and len(ids) and int(ids.max()) > np.iinfo(kind).max:
                    raise ValueError(f"id {ids.max()} doesn't fit into {id_bytes} bytes")
                for i, (start, length) in enumerate(cut(len(ids), cap)):
                    part = ids[start : start + length]
                    row = (doc_id, i, start, length, zlib.crc32(part.astype("<u4").tobytes()))
                    out.append(row if kind is None else (*row, part.astype(kind).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(schema), schema.types)], schema=schema)

    cut_up = materialize(docs.select("doc_id", "text").mapInArrow(pieces, columns))
    counts = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most cap rows
    lengths = sorted(counts)
    first = np.cumsum([0] + [counts[n] for n in lengths])
    before = np.zeros(cap + 1, dtype=np.int64)
    before[lengths] = first[:-1]
    places = Places(best_fit_decreasing(counts, cap))

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            bins, offsets = places.of(length, rank - before[length]) if batch.num_rows else (np.array([], np.int64),) * 2
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(schema)], pa.array(bins), pa.array(offsets)], names=[*schema.names, "sequence_id", "offset"])

    by_length = ranked(cut_up, [F.col(c) for c in ("length", "doc_id", "piece", "start", "ids_crc32")])
    discard(cut_up)
    columns += ", sequence_id long, offset long"
    return by_length.mapInArrow(placed, columns)


def pack(docs: DataFrame, *, cap: int = 1024, end_id: int = 2, tokenizer: tuple = ()) -> DataFrame:
    """Packs all documents into as few sequences of `cap` tokens as best-fit decreasing finds, over the whole table.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece that holds `end_id` alone. Each row is packed on its own, so a repeated row (or a
    null doc_id) is packed as often as it occurs; columns besides doc_id and text are ignored, and an empty table gives
    no rows. Pieces of equal length go by doc_id, piece, start.
    """
    return packing(docs, cap, end_id, tokenizer)


MATRIX = "sequence_id long, n_tokens long, input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, starts array<long>"


def pack_matrices(docs: DataFrame, *, cap: int = 1024, end_id: int = 50256, pad_id: int = 50256, tokenizer: tuple = (), id_bytes: int = 2) -> DataFrame:
    """Rows of packed id matrices, by the plan of `pack`: over the whole table, whatever the partitions.

    A document over `cap` ids is cut into pieces as in `pack`, losslessly: doc_ids, starts and cu_seqlens say which ids
    of which document each segment holds. Pieces come together by their sequence, in one shuffle of the ids.

    Returns a row per sequence: sequence_id, n_tokens, input_ids (cap little-endian numbers of id_bytes each, padded with
    pad_id), position_ids (the same, from 0 anew in each segment and in the padding), cu_seqlens (from 0, one more entry
    than segments), doc_ids and starts of the segments. Ids or places that id_bytes can't hold raise an error. Null
    texts, repeated rows, clashing columns and empty tables are treated as in `pack`.
    """
    kind = np.dtype(f"<u{id_bytes}")
    if max(pad_id, end_id, cap - 1) > np.iinfo(kind).max:
        raise ValueError(f"id_bytes = {id_bytes} can't hold pad_id, end_id or cap")

    steps, names = np.arange(cap), [f.split()[0] for f in MATRIX.split(", ")]
    most = max(1, (1 << 20) // cap)  # sequences at once

    def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # the last sequence so far, which the next batch may go on with
        for batch in batches:
            if batch.num_rows:
                rows = pa.concat_batches([*rest, batch])
                keys = rows.column("sequence_id").to_numpy()
                whole = int(np.searchsorted(keys, keys[-1]))
                yield from parts(rows.slice(0, whole))
                rest = [rows.slice(whole)]
        for rows in rest:
            yield from parts(rows)

    def parts(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = rows.column("sequence_id").to_numpy()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        for lo in range(0, len(first), most):
            cuts = np.append(first, len(keys))[lo : lo + most + 1]
            yield laid_out(rows.slice(cuts[0], cuts[-1] - cuts[0]), cuts - cuts[0])

    def laid_out(rows: pa.RecordBatch, cuts: np.ndarray) -> pa.RecordBatch:
        """A row per sequence, of the pieces between two cuts. These leave no gaps, so that their ids follow each other in the matrix, too."""
        length, offset = (rows.column(c).to_numpy() for c in ("length", "offset"))
        full = np.add.reduceat(length, cuts[:-1])
        used = steps < full[:, None]
        ids = np.full(used.shape, pad_id, dtype=kind)
        ids[used] = np.frombuffer(b"".join(rows.column("ids").to_pylist()), dtype=kind)
        places = (steps - full[:, None]).astype(kind)
        places[used] = np.arange(full.sum()) - np.repeat(np.cumsum(length) - length, length)
        binary = (pa.array([row.tobytes() for row in m], pa.binary()) for m in (ids, places))
        bounds = pa.array(np.insert(offset, cuts[1:], full), pa.int32())
        lists = ((cuts + np.arange(len(cuts)), bounds), (cuts, rows.column("doc_id")), (cuts, rows.column("start")))
        arrays = (pa.ListArray.from_arrays(pa.array(at, pa.int32()), values) for at, values in lists)
        return pa.RecordBatch.from_arrays([rows.column("sequence_id").take(pa.array(cuts[:-1])), pa.array(full), *binary, *arrays], names=names)

    placed = packing(docs, cap, end_id, tokenizer, id_bytes).select("sequence_id", "offset", "length", "doc_id", "start", "ids")
    return placed.repartition(shuffle_parts(docs.sparkSession), "sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(matrices, MATRIX)


def write_packed(packed: DataFrame, path: str) -> None:
    """Writes the matrices' rows; a reader views each binary column of a file as an array of cap columns."""
    packed.write.option("compression", "zstd").parquet(path)
