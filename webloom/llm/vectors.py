"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables (operator 3)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attached, materialize, shuffle_parts, units
from .components import components, forest
from .minhash import blocked

#: Bits of a rotation's code, and those that one Hamming table indexes.
BITS, SUB = 64, 16


def unit(vector: list | None) -> np.ndarray | None:
    """The vector at length 1; None for those that link with nothing."""
    if not vector or None in vector:
        return None
    v = np.asarray(vector, dtype=np.float64)
    top = np.abs(v).max()
    if not (np.isfinite(top) and top > 0):
        return None
    v = v / top  # so that squares neither overflow nor vanish
    return v / np.linalg.norm(v)


class Codes:
    """Binary codes under several learned rotations.

    Each rotation starts from BITS random directions (orthogonal where there is room) and is refined in turns: codes are the
    signs of the rotated vectors, and the rotation becomes the one that brings the vectors closest to their codes. It is learned
    on vectors centred by the sample's mean, so that bits are balanced, and that the mean itself pulls no bit to one side.

    Codes are signs of the vectors as they are: a bit is a plane through the origin, as the angle that is asked for is one at the
    origin. Two vectors at an angle t differ in a bit with a probability of about t / pi, wherever the others lie: at a cosine of
    0.98 they agree in a table of 16 bits with 0.35, and in none of 24 tables with 0.00003. That holds as long as planes differ: vectors
    that spread in fewer than SUB directions keep the rotations as drawn, since turns would bring all to the same planes.
    """

    def __init__(self, sample: np.ndarray, rotations: int, rounds: int = 20, seed: int = 3):
        rng = np.random.default_rng(seed)
        centred = sample - sample.mean(axis=0)
        n = centred.shape[1]
        variances = np.linalg.svd(centred, compute_uv=False) ** 2
        directions = variances.sum() ** 2 / max((variances**2).sum(), 1e-300)
        planes = []
        for _ in range(rotations):
            start = rng.standard_normal((n, BITS))
            start = np.linalg.qr(start)[0] if n >= BITS else np.linalg.qr(start.T)[0].T
            flat, turn = centred @ start, np.linalg.qr(rng.standard_normal((BITS, BITS)))[0]
            for _ in range(rounds if directions >= SUB else 0):
                u, _, v = np.linalg.svd(flat.T @ np.where(flat @ turn >= 0, 1.0, -1.0))
                turn = u @ v
            planes.append(start @ turn)
        self.planes = np.concatenate(planes, axis=1)

    def of(self, unit: np.ndarray) -> np.ndarray:
        """A code of SUB bits for each table: rows by tables."""
        bits = (unit @ self.planes >= 0).reshape(len(unit), -1, SUB)
        return (bits @ (1 << np.arange(SUB))).astype(np.int32)


def learned(vectors: DataFrame, rotations: int, sample_rows: int) -> dict[int, Codes]:
    """Codes for each length of vectors, fitted on those among the `sample_rows` vectors of the lowest hashes."""
    rows = vectors.where("embedding is not null").orderBy(F.xxhash64("vec_id", "embedding")).select("embedding").limit(sample_rows).collect()
    by_length: dict[int, list[np.ndarray]] = {}
    for r in rows:
        if (v := unit(r[0])) is not None:
            by_length.setdefault(len(v), []).append(v)
    return {n: Codes(np.array(sample), rotations) for n, sample in by_length.items()}


def codes_for(codes: dict[int, Codes], n: int, rotations: int) -> Codes:
    """The codes of a length; of one that the sample lacks, under rotations learned on made-up directions, the same everywhere."""
    if n not in codes:
        codes[n] = Codes(np.random.default_rng(n).standard_normal((256, n)), rotations)
    return codes[n]


def near_vectors(vectors: DataFrame, *, cosine: float = 0.98, rotations: int = 6, sample_rows: int = 4096) -> DataFrame:
    """vec_id, n_links, component_id, kept: links between vectors of one label with a cosine of `cosine` or more.

    Rotations are learned on at most `sample_rows` vectors; every vector is indexed. Vectors that agree in a whole table
    (16 bits of one rotation's code) are compared as originals, in double precision and in blocks; a pair counts in
    the first table that both share. Equal vectors are one class, so that copies cost nothing.

    Null labels and vectors that are null, empty, zero, or with null or non-finite components link with nothing
    (n_links 0, a component of their own). Vectors of different lengths don't link. Repeated rows of one vec_id count
    as other vectors, in one component. A null vec_id links with nothing; its component_id is null and it is kept. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    codes = learned(vectors, rotations, sample_rows)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, a, b, keys, labels = [], [], [], [], []
            for i, label, v in zip(*(c.to_pylist() for c in batch.columns)):
                x = unit(v) if i is not None and label is not None else None
                h = None if x is None else xxhash.xxh3_128_intdigest((np.asarray(v, dtype=np.float64) + 0.0).tobytes())
                vec.append(None if x is None else x.tobytes())
                labels.append(None if x is None else label)
                a.append(None if x is None else (h >> 64) - (1 << 63)), b.append(None if x is None else (h & ((1 << 64) - 1)) - (1 << 63))
                keys.append(None if x is None else codes_for(codes, len(x), rotations).of(x[None])[0])
            arrays = [batch.column(0), pa.array(labels, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(vec, pa.binary()), pa.array(keys, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "vec_a", "vec_b", "vec", "keys"])

    label = F.when(F.col("label").isNotNull(), F.xxhash64("label")).alias("label")  # of any type
    coded = materialize(vectors.select("vec_id", label, "embedding").mapInArrow(encode, "vec_id long, label long, vec_a long, vec_b long, vec binary, keys array<int>").withColumn("row", F.monotonically_increasing_id()))
    same = ["label", "vec_a", "vec_b"]
    kinds = coded.where("vec is not null").groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vec").alias("vec"), F.first("keys").alias("keys"))
    reps = materialize(kinds.withColumn("doc_id", F.monotonically_increasing_id()))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in units(batches, 3):
            if group.num_rows < 2:
                continue
            ids, rep, mine, copies = (group.column(c).to_numpy() for c in ("doc_id", "rep", "mine", "copies"))
            i, j, at = (group.column(c)[0].as_py() for c in ("i", "j", "at"))
            keys = np.array(group.column("keys").to_pylist())
            x = np.frombuffer(b"".join(group.column("vec").to_pylist())).reshape(len(ids), -1)
            left, right = (np.flatnonzero(mine == m) for m in (i, j))
            links, found = np.zeros(len(ids), dtype=np.int64), []
            for lo in range(0, len(left), 256):
                part = left[lo : lo + 256]
                near = x[part] @ x[right].T >= cosine
                if i == j:
                    near &= part[:, None] < right[None, :]
                p, q = np.nonzero(near)
                p, q = part[p], right[q]
                once = (keys[p] == keys[q]).argmax(axis=1) == at
                p, q = p[once], q[once]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                keep = forest(len(ids), p.tolist(), q.tolist())
                found.append(np.stack([p[keep], q[keep]]))
            pair, has = np.concatenate(found, axis=1), np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[rep[pair[0]], ids[has]]), pa.array(np.r_[rep[pair[1]], ids[has]]), pa.array(np.r_[np.zeros(pair.shape[1], np.int64), links[has]])], names=["a", "b", "n"])

    inside = reps.select("doc_id", "label", "vec", F.posexplode("keys").alias("at", "key")).select("doc_id", "at", F.xxhash64("label", F.length("vec"), "at", "key").alias("bucket"))
    shared = inside.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    dealt = blocked(inside.join(shared, "bucket"), "bucket", "members").join(reps.select("doc_id", "rep", "copies", "vec", "keys"), "doc_id")
    dealt = dealt.select("bucket", "i", "j", "at", "mine", "doc_id", "rep", "copies", "vec", "keys").repartition(shuffle_parts(spark), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found = materialize(dealt.mapInArrow(compare, "a long, b long, n long"))
    counts = found.where("n > 0").groupBy(F.col("a").alias("doc_id")).agg(F.sum("n").alias("near"))
    parts = components(found.where("n = 0").select("a", "b").distinct())
    total = reps.agg(F.sum("copies")).first()[0] or 0
    per_class = reps.select(*same, "doc_id", "rep", "copies", F.col("copies").alias("n")).join(counts, "doc_id", "left").join(parts.select(F.col("id").alias("rep"), "component"), "rep", "left")
    per_class = materialize(per_class.withColumn("_near", F.coalesce("near", F.lit(0))).withColumn("_component", F.coalesce("component", "rep")))
    out = attached(coded.select("row", "vec_id", *same), same, per_class, total, ["_near", "_component", "copies"], F.col("row"))
    component = F.when(F.col("vec_id").isNull(), None).otherwise(F.coalesce("_component", "vec_id"))
    links = F.coalesce(F.col("_near") + F.col("copies") - 1, F.lit(0)).cast("long")
    return out.select("vec_id", links.alias("n_links"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
