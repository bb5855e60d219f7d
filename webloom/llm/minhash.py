"""MinHash near-duplicates with b-bit signatures (operator 7)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attached, boxed, discard, materialize, shuffle_parts, unboxed, units
from .components import components, forest
from .shingles import WordHashes, mixed, shingle_set

BANDS, ROWS, BITS = 32, 5, 2
K = BANDS * ROWS
#: Members of a bucket that a task compares at a time.
BLOCK = 1024
#: Members of a large bucket, about, that are compared with all of its parts.
LEADERS = 32
#: Rows of one text that meet it in one task.
MEETING = 64
#: Members of a candidate group up to which it is one unit, instead of one in each bucket that they share.
GROUP = 256
#: Hashes whose owners are counted at a time.
AT_ONCE = 1 << 20


class Signer:
    """Minima of K hash orders of a set, their bands, and their low bits packed."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 1 << 32, (K, 1), dtype=np.uint32)
        self.odd = rng.integers(0, 1 << 32, (K, 1), dtype=np.uint32) | np.uint32(1)
        self.weights = rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
        self.salt = rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        low = np.full(K, 0xFFFFFFFF, dtype=np.uint32)
        for i in range(0, len(short), 2048):
            np.minimum(low, ((short[i : i + 2048] ^ self.flip) * self.odd).min(axis=1), out=low)
        return low

    def bands(self, minima: np.ndarray) -> np.ndarray:
        return mixed((minima.reshape(BANDS, ROWS).astype(np.uint64) * self.weights).sum(axis=1) + self.salt).view(np.int64)

    @staticmethod
    def packed(minima: np.ndarray) -> bytes:
        bits = np.stack([(minima >> np.uint32(i)) & np.uint32(1) for i in range(BITS)], axis=1).astype(np.uint8)
        return np.packbits(bits.ravel()).tobytes()


def similarity_floor(threshold: float, deviations: float = 5.0) -> int:
    """The most mismatches of the K low-bit pairs at which a pair may still reach the threshold.

    Low bits also agree by chance, once in 2^b, so a similarity of j shows as a match rate of j + (1 - j) / 2^b. A pair at
    the threshold falls under the floor only if it is `deviations` standard deviations off.
    """
    rate = threshold + (1 - threshold) / 2**BITS
    return int(np.ceil(K * (1 - rate) + deviations * np.sqrt(K * rate * (1 - rate))))


def mismatches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many minima's low bits differ, for each row of a and each of b: packed signatures, compared by bit counts."""
    low = np.uint64(0x5555555555555555)
    out = np.zeros((len(a), len(b)), dtype=np.int32)
    for w in range(a.shape[1]):
        x = a[:, w, None] ^ b[None, :, w]
        out += np.bitwise_count((x | (x >> np.uint64(1))) & low)
    return out


def blocked(members: DataFrame, group: str, count: str, block: int = BLOCK) -> DataFrame:
    """Adds i, j, mine: a group of more than `block` members is dealt to blocks, and each pair of blocks is a unit.

    mine says in which of the two blocks the member is. Every two members of a group meet in one unit at least; a
    unit holds about two blocks, however large the group.
    """
    n = F.ceil(F.col(count) / block).cast("int")
    mine = F.pmod(F.xxhash64("doc_id", F.lit("block")), n).cast("int")
    other = F.explode(F.sequence(F.lit(0), n - 1))
    dealt = members.withColumn("mine", mine).withColumn("_other", other)
    return dealt.withColumn("i", F.least("mine", "_other")).withColumn("j", F.greatest("mine", "_other")).drop("_other")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: A-Z alone, and the six spaces alone


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_a, set_b (a hash of the whole set; null for none), sig, bands of each row."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, memo = Signer(), WordHashes()
        for batch in batches:
            n, a, b, sigs, bands = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                hashes = shingle_set(words(text), k, memo)
                n.append(len(hashes))
                if not len(hashes):
                    a.append(None), b.append(None), sigs.append(None), bands.append(None)
                    continue
                whole = xxhash.xxh3_128_intdigest(hashes.tobytes())
                a.append((whole >> 64) - (1 << 63)), b.append((whole & ((1 << 64) - 1)) - (1 << 63))
                low = signer.minima(hashes)
                sigs.append(signer.packed(low)), bands.append(signer.bands(low))
            arrays = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "sig", "bands"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(sign, "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, sig binary, bands array<long>")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """bucket, cls, members, part_of, parts: the members of each bucket that has several, dealt to parts of about BLOCK.

    About LEADERS members of a large bucket, those whose hashes come out low, are in each of its parts.
    """
    inside = classes.select("cls", F.explode("bands").alias("bucket"))
    counted = inside.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    return inside.join(counted, "bucket").select("bucket", "cls", "members", parts.alias("parts"), F.pmod(F.xxhash64("cls", "bucket"), parts).cast("int").alias("part_of"))


def candidate_edges(shared: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """a, b: the most similar pairs, by estimate, that connect what pairs of one part of a bucket may link."""
    parts, floor = shuffle_parts(shared.sparkSession), similarity_floor(threshold)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches, 2):
            if unit.num_rows < 2:
                continue
            ids, n = (unit.column(c).to_numpy() for c in ("cls", "n_shingles"))
            sig = np.frombuffer(b"".join(unit.column("sig").to_pylist()), dtype=np.uint64).reshape(len(ids), -1)
            left, right = ranked_pairs(sig, n, floor, threshold)
            keep = forest(len(ids), left, right)
            yield pa.RecordBatch.from_arrays([pa.array(ids[[left[i] for i in keep]]), pa.array(ids[[right[i] for i in keep]])], names=["a", "b"])

    low = F.pmod(F.xxhash64("cls", F.lit("leader")), F.col("members")) < LEADERS
    leading = F.when((F.col("parts") > 1) & low, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part_of"))
    dealt = shared.select("bucket", F.explode(leading).alias("part"), "cls").join(classes.select("cls", "n_shingles", "sig"), "cls")
    dealt = dealt.select("bucket", "part", "cls", "n_shingles", "sig").repartition(parts, "bucket", "part").sortWithinPartitions("bucket", "part")
    return dealt.mapInArrow(compare, "a long, b long")


def near_pairs(sig: np.ndarray, n: np.ndarray, rows: np.ndarray, columns: np.ndarray, floor: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Mismatches of rows and columns, and which pairs may reach the threshold by them and by their sizes."""
    miss = mismatches(sig[rows], sig[columns])
    low, high = np.minimum.outer(n[rows], n[columns]), np.maximum.outer(n[rows], n[columns])
    return miss, (miss <= floor) & (low >= threshold * high - 1e-6)


def ranked_pairs(sig: np.ndarray, n: np.ndarray, floor: int, threshold: float) -> tuple[list[int], list[int]]:
    """The pairs that may reach the threshold, the most similar by estimate first."""
    at, found, order = np.arange(len(n)), [], []
    for lo in range(0, len(n), 256):
        rows = at[lo : lo + 256]
        miss, near = near_pairs(sig, n, rows, at, floor, threshold)
        x, y = np.nonzero(near & (rows[:, None] < at[None, :]))
        found.append(np.stack([rows[x], y]))
        order.append(miss[x, y])
    pairs = np.concatenate(found, axis=1)[:, np.argsort(np.concatenate(order), kind="stable")]
    return pairs[0].tolist(), pairs[1].tolist()


def with_texts(rows: DataFrame, texts: DataFrame, salt: Column) -> DataFrame:
    """rows (cls and more) beside the texts (cls, text). A text that many rows ask for meets MEETING of them at a time."""
    rows = materialize(rows)
    asked = rows.groupBy("cls").agg(F.count("*").alias("n"))
    times = F.ceil(F.col("n") / MEETING).cast("int")
    asked = materialize(asked.select("cls", "n", times.alias("_times")))
    total = asked.agg(F.sum("n")).first()[0] or 0
    dealt = attached(rows, ["cls"], asked, total, ["_times"], salt).withColumn("_salt", F.pmod(salt, F.col("_times")).cast("int"))
    dealt = dealt.repartition(shuffle_parts(rows.sparkSession), "cls", "_salt")
    copies = texts.join(asked, "cls").select("cls", "text", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)).alias("_salt"))
    return dealt.join(copies, ["cls", "_salt"]).select(*rows.columns, "text")


def verified_edges(edges: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the edges (a, b) whose full sets are similar enough. The edges of one a, MEETING at a time, are checked together."""

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for unit in units(batches, 2):
            a, ids = unit.column("a")[0].as_py(), unit.column("cls").to_pylist()
            sets = [shingle_set(words(t), k, memo) for t in unit.column("text").to_pylist()]
            x, out = sets[ids.index(a)], []
            for other, y in zip(ids, sets):
                both = len(np.intersect1d(x, y, assume_unique=True)) if other != a else 0
                if other != a and 100 * both >= percent * (len(x) + len(y) - both):
                    out.append(other)
            yield pa.RecordBatch.from_arrays([pa.array([a] * len(out), pa.int64()), pa.array(out, pa.int64())], names=["a", "b"])

    degrees = edges.groupBy("a").agg(F.count("*").alias("n")).withColumn("times", F.ceil(F.col("n") / MEETING).cast("int"))
    salted = materialize(attached(edges.select("a", "b"), ["a"], degrees, edges.count(), ["times"], F.col("b")).select("a", F.pmod(F.xxhash64("b"), F.col("times")).cast("int").alias("s"), "b"))
    ends = salted.select("a", "s", F.col("b").alias("cls")).unionByName(salted.select("a", "s", F.col("a").alias("cls")).distinct())
    ready = with_texts(ends, texts, F.xxhash64("a", "s"))
    return ready.repartition(shuffle_parts(edges.sparkSession), "a", "s").sortWithinPartitions("a", "s").mapInArrow(confirm, "a long, b long")


def cross_edges(open_: DataFrame, texts: DataFrame, k: int, percent: int, block: int = 256) -> DataFrame:
    """Edges between the parts that the members of a bucket are still in: every pair of different parts is looked at.

    open_: bucket, cls, part, n_shingles, sig. The largest part of a bucket is dealt to blocks, and so are the other
    members, who meet each block: so the work grows with a large part's members, times the blocks of the others. Signatures
    go first; only members with a similar one of another part come with their texts. A unit yields edges that connect
    what its links connect.
    """
    spark, threshold, floor = open_.sparkSession, percent / 100, similarity_floor(percent / 100)

    def active(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches, 3):
            ids, n, part, side = (unit.column(c).to_numpy() for c in ("cls", "n_shingles", "part", "side"))
            first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            second = second if len(second) else first
            sig = np.frombuffer(b"".join(unit.column("sig").to_pylist()), dtype=np.uint64).reshape(len(ids), -1)
            hit = np.zeros(len(ids), dtype=bool)
            for lo in range(0, len(first), 256):
                rows = first[lo : lo + 256]
                near = near_pairs(sig, n, rows, second, floor, threshold)[1] & (part[rows][:, None] != part[second][None, :])
                hit[rows] |= near.any(axis=1)
                hit[second] |= near.any(axis=0)
            if hit.any():
                yield pa.RecordBatch.from_arrays([unit.column(c).combine_chunks().filter(pa.array(hit)) for c in ("bucket", "i", "j", "side", "cls", "part")], names=["bucket", "i", "j", "side", "cls", "part"])

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for unit in units(batches, 3):
            ids, side, part = (unit.column(c).to_numpy() for c in ("cls", "side", "part"))
            sets = [shingle_set(words(t), k, memo) for t in unit.column("text").to_pylist()]
            size = np.array([len(s) for s in sets])
            both = intersections(sets, size)
            near = (100 * both >= percent * (size[:, None] + size[None, :] - both)) & (part[:, None] != part[None, :])
            near &= (side == 0)[:, None]
            if (side == 1).any():
                near &= (side == 1)[None, :]
            x, y = np.nonzero(near)
            keep = forest(len(ids), x.tolist(), y.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(ids[x[keep]]), pa.array(ids[y[keep]])], names=["a", "b"])

    sizes = open_.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("bucket").agg(F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("total"), F.count("*").alias("parts")).where("parts > 1")
    sizes = sizes.select("bucket", F.col("most.part").alias("most"), F.ceil(F.col("most.n") / block).cast("int").alias("blocks"), F.ceil((F.col("total") - F.col("most.n")) / block).cast("int").alias("others"))
    hashed = lambda count: F.pmod(F.xxhash64("cls", "bucket"), F.col(count)).cast("int")
    # units: i a block of the others (side 0); j one of the largest part (from 0) or of the others (-1 - block), side 1
    inner = F.col("part") == F.col("most")
    met = F.when(inner, F.expr("transform(sequence(0, others - 1), x -> named_struct('i', x, 'j', own, 'side', 1))"))
    met = met.otherwise(F.expr("""concat(transform(sequence(0, blocks - 1), x -> named_struct('i', own, 'j', x, 'side', 0)),
        transform(sequence(0, others - 1), x -> named_struct('i', least(x, own), 'j', -1 - greatest(x, own), 'side', int(own > x))))"""))
    dealt = open_.join(sizes, "bucket").withColumn("own", F.when(inner, hashed("blocks")).otherwise(hashed("others")))
    dealt = dealt.withColumn("u", F.explode(met)).select("bucket", "u.i", "u.j", "u.side", "cls", "part", "n_shingles", "sig")
    parts = shuffle_parts(spark)
    found = dealt.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(active, "bucket long, i int, j int, side int, cls long, part long")
    ready = with_texts(found, texts, F.xxhash64("bucket", "i", "j", "cls"))
    return ready.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(confirm, "a long, b long")


def intersections(sets: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """How many elements each two of the sets share. The sets are sorted hashes; a range of about AT_ONCE of them is counted at a time."""
    common = np.zeros((len(sets), len(sets)), dtype=np.int64)
    ranges = int(size.sum()) // AT_ONCE + 1
    ends = np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=np.uint64)
    cuts = [np.r_[0, np.searchsorted(s, ends), len(s)] for s in sets]
    for i in range(ranges):
        common += shared_in([s[c[i] : c[i + 1]] for s, c in zip(sets, cuts)])
    return common


def shared_in(sets: list[np.ndarray]) -> np.ndarray:
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    multi = np.bincount(code)[code] > 1  # an element of one set alone is in no intersection
    code, owner = code[multi], owner[multi]
    column = np.cumsum(np.r_[0, code[1:] != code[:-1]]) if len(code) else code
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        here = slice(*np.searchsorted(column, [lo, lo + 4096]))
        dense = np.zeros((len(sets), 4096), dtype=np.float32)
        dense[owner[here], column[here] - lo] = 1
        common += dense @ dense.T
    return np.rint(common).astype(np.int64)


def linked(docs: DataFrame, k: int, percent: int, null_ids: bool) -> DataFrame:
    """doc_id, text_hash, n_shingles, group_id, least of each row: its component, and the smallest doc_id in it.

    Documents of one shingle set are one class. Classes that share a band of their minima are compared by b-bit
    signatures: all within a part of a bucket, of which a large one has several, with some members in each. The best
    pairs that connect the others are verified on full sets. Wherever members of a bucket that may be linked are then
    still in different components, all pairs of different ones are compared, on full sets where signatures are similar.

    A candidate group of up to GROUP members is compared as one, instead of in each of the buckets that they share.

    Classes that share a doc_id are in one component. group_id is null for what nothing links: wordless texts and,
    unless null_ids, rows without a doc_id.
    """
    threshold = percent / 100
    signed = materialize(signatures(docs, k).withColumn("row", F.monotonically_increasing_id()))
    linkable = signed.where("n_shingles > 0" if null_ids else "n_shingles > 0 and doc_id is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = linkable.groupBy("set_a", "set_b").agg(F.count("*").alias("n"), first.alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()))
    total = classes.agg(F.sum("n")).first()[0] or 0
    light = signed.select("row", "doc_id", "text_hash", "n_shingles", *(F.when(F.col("doc_id").isNotNull() | F.lit(null_ids), F.col(c)).alias(c) for c in ("set_a", "set_b")))
    rows = materialize(attached(light, ["set_a", "set_b"], classes, total, ["cls"], F.col("row")).drop("set_a", "set_b"))
    discard(signed)
    owned = rows.where("doc_id is not null and cls is not null").select("doc_id", "cls").distinct()
    several = owned.groupBy("doc_id").agg(F.min("cls").alias("a"), F.count("*").alias("n")).where("n > 1")
    same_id = owned.join(several, "doc_id").where("cls <> a").select("a", F.col("cls").alias("b"))

    shared = materialize(shared_buckets(classes))
    edges = materialize(candidate_edges(shared, classes, threshold).distinct())
    groups = materialize(components(edges))
    large = shared.where("parts > 1").select("cls").distinct()
    asked = groups.select(F.col("id").alias("cls")).unionByName(large).distinct().join(classes.select("cls", "n", "rep.doc_id", "rep.text_hash"), "cls")
    texts = materialize(class_texts(docs, materialize(asked), total))
    links = materialize(verified_edges(edges, texts, k, percent))
    parts = components(links)
    parted = materialize(classes.select("cls", "n_shingles", "sig").join(groups.select(F.col("id").alias("cls"), F.col("component").alias("grp")), "cls", "left").join(parts.select(F.col("id").alias("cls"), "component"), "cls", "left").select("cls", "n_shingles", "sig", "grp", F.coalesce("component", "cls").alias("part")))
    split = parted.groupBy("grp").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("size")).where("lo <> hi and grp is not null").select("grp", (F.col("size") <= GROUP).alias("whole"))
    still = parted.join(split, "grp")
    whole = still.where("whole").select(F.xxhash64("grp", F.lit("whole")).alias("bucket"), "cls", "part", "n_shingles", "sig")
    small = shared.where("parts = 1").select("bucket", "cls").join(still.where("not whole"), "cls").select(F.xxhash64("bucket", "grp").alias("bucket"), "cls", "part", "n_shingles", "sig")
    big = shared.where("parts > 1").select("bucket", "cls").join(parted, "cls").select("bucket", "cls", "part", "n_shingles", "sig")
    more = materialize(cross_edges(materialize(whole.unionByName(small).unionByName(big)), texts, k, percent))

    found = components(links.unionByName(more).unionByName(same_id))
    grouped = materialize(classes.select("cls", "n", "rep.doc_id").join(found.select(F.col("id").alias("cls"), "component"), "cls", "left").select("cls", "n", "doc_id", F.coalesce("component", "cls").alias("group_id")))
    least = grouped.groupBy("group_id").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    per_class = materialize(attached(grouped.withColumnRenamed("n", "rows_of"), ["group_id"], least, grouped.count(), ["least"], F.col("cls")).select("cls", F.col("rows_of").alias("n"), "group_id", "least"))
    out = attached(rows, ["cls"], per_class, total, ["group_id", "least"], F.col("row"))
    for stored in (shared, edges, groups, texts, links, parted, more, grouped):
        discard(stored)
    return out.select("doc_id", "text_hash", "n_shingles", "group_id", "least")


def class_texts(docs: DataFrame, asked: DataFrame, total: int) -> DataFrame:
    """cls, text of the classes asked (cls, n, doc_id, text_hash): the text of the row that stands for a class."""
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    is_hot = F.col("n") > max(1, total // 2000)
    same = [F.col("doc_id").eqNullSafe(F.col("_doc_id")), F.col("text_hash") == F.col("_hash")]
    keys = asked.select("cls", F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_hash"), is_hot.alias("hot"))
    hot = F.broadcast(keys.where("hot"))  # fewer than 2,000
    found = hashed.join(hot, same).select("cls", "text")
    rest = hashed.join(hot, same, "left_anti").join(keys.where("not hot").hint("merge"), same).select("cls", "text")  # alike at every size
    found = found.unionByName(rest)
    return found.dropDuplicates(["cls"])


def near_duplicates(docs: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: components of documents whose sets of k-word shingles have a Jaccard similarity of `percent` or more.

    Links are confirmed on full sets. A pair at exactly the threshold shares no band of minima with a probability of
    (1 - 0.8^5)^32, 3 in a million.

    Nothing links a null or wordless text (n_shingles 0). A null doc_id links with nothing: its component_id is null
    and it is kept. Repeated rows of one doc_id, whether or not their texts are equal, are in one component and have
    the same verdict, but for wordless ones. Columns besides doc_id and text are ignored; an empty table gives no rows.
    """
    rows = linked(docs, k, percent, null_ids=False)
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("least", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each group of near-duplicates: that of the smallest doc_id (null last), by text hash where several have it.

    Rows without a doc_id are compared like others. Rows equal in doc_id and text are one document, of which one row
    stays. Wordless texts are in no group: all stay. An empty table gives no rows.
    """
    rows = materialize(linked(docs, k, percent, null_ids=True).where("group_id is not null"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = rows.groupBy("group_id").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    keys = rows.groupBy("group_id", "doc_id", "text_hash").agg(F.count("*").alias("times"))
    keys = materialize(attached(keys, ["group_id"], first, rows.count(), ["first"], F.xxhash64("doc_id", "text_hash")).withColumn("stays", F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_hash") == F.col("text_hash"))))
    named = keys.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_hash"), "stays", "times")
    same = [F.col("doc_id").eqNullSafe(F.col("_doc_id")), F.col("_text") == F.col("_hash")]
    boxes = boxed(docs, "doc_id").withColumn("_text", F.xxhash64("_row.text"))
    kept = boxes.join(named.where("not stays"), same, "left_anti")
    repeated = materialize(named.where("stays and times > 1"))
    if repeated.limit(1).count():
        once = boxes.join(repeated, same, "left_semi").groupBy("doc_id", "_text").agg(F.first("_row").alias("_row"))
        kept = kept.join(repeated, same, "left_anti").select("_row").unionByName(once.select("_row"))
    return unboxed(kept, docs.columns)
