"""A Merkle manifest of a dataset: a tree for each source, one over the sources, and a proof for each row (operator 13).

Trees are reduced by superblocks: the nodes of a tree are dealt to buckets of fanout^levels by their index, a task collapses
a bucket to its root, and the buckets' roots are the nodes of the next, far smaller, reduction. Proofs come back the same way,
from the top: a bucket's nodes get what they have in the bucket, followed by what its root has above.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import attached, discard, materialize, ranked

FANOUT = 16
#: Levels of a tree that one task collapses: a bucket has FANOUT ** LEVELS nodes at most.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A step of a proof: the digests of the other nodes of the run, joined, before and after one's own.
STEP = pa.struct([("before", pa.string()), ("after", pa.string())])
PROOF = "array<struct<before: string, after: string>>"


def digest_of(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def above(nodes: list[str], fanout: int) -> list[str]:
    """The nodes a level up: each run of `fanout` consecutive ones is one, the last run may be shorter."""
    return [digest_of(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]


def collapsed(nodes: list[str], whole: bool, fanout: int, levels: int) -> list[list[str]]:
    """The levels of a bucket, its nodes first and its root last.

    Of a tree of several buckets each collapses `levels` levels, a lone node too; a bucket that is the whole tree as
    many as it takes to one node.
    """
    out = [nodes]
    while len(out) <= levels and not (whole and len(out[-1]) == 1):
        out.append(above(out[-1], fanout))
    return out


def encoded(value: Column) -> Column:
    """A value as a leaf holds it: - for null, else its length in UTF-8 bytes, a colon, and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row: of its fields in their order, some of them `changed`."""
    return F.sha2(F.concat(*(encoded(changed.get(c, F.col(c))) for c in FIELDS)), 256)


def folded(start: Column, proof: Column) -> Column:
    """The root to which a leaf and a proof lead."""
    return F.aggregate(proof, start, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, joined from left to right, level by level."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def bucket_roots(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The nodes above nodes (tree, idx, n, digest; n: how many the tree has): one for each bucket, in the same columns."""
    size = fanout**levels

    def collapse(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        n = int(rows["n"].iloc[0])
        root = collapsed(rows["digest"].tolist(), n <= size, fanout, levels)[-1]
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "n": [-(-n // size)], "digest": root})

    dealt = nodes.select("tree", "idx", "n", "digest", F.expr(f"idx div {size}").alias("bucket"))
    return dealt.groupBy("tree", "bucket").applyInPandas(collapse, "tree long, idx long, n long, digest string")


def with_proofs(nodes: DataFrame, parents: DataFrame, fanout: int, levels: int) -> DataFrame:
    """nodes (tree, idx, n, digest and more) with proof: their steps within the bucket, then those of its root.

    parents: tree, idx (of the bucket), proof, and what else its nodes get from it.
    """
    size = fanout**levels
    own = [f for f in nodes.schema.fields if f.name not in ("tree", "idx", "n", "digest")]
    passed = [f for f in parents.schema.fields if f.name not in ("tree", "idx", "proof")]
    fields = {f.name: f for f in (*nodes.schema.fields, *parents.schema.fields)}
    schema = StructType([fields["tree"], fields["idx"], *own, *passed, StructField("proof", fields["proof"].dataType)])

    def prove(lower: pa.Table, upper: pa.Table) -> pa.Table:
        lower = lower.sort_by("idx")
        first, n = lower["idx"][0].as_py(), lower["n"][0].as_py()
        rows = collapsed(lower["digest"].to_pylist(), n <= size, fanout, levels)[:-1]
        rest = upper["proof"][0].as_py()
        proofs = []
        for i in range(lower.num_rows):
            steps, at = [], i
            for level in rows:
                lo = at - at % fanout
                steps.append({"before": "".join(level[lo:at]), "after": "".join(level[at + 1 : lo + fanout])})
                at //= fanout
            proofs.append(steps + rest)
        made = {"tree": lower["tree"], "idx": pa.array(range(first, first + lower.num_rows), pa.int64())}
        made |= {f.name: lower[f.name] for f in own} | {f.name: upper[f.name].take([0] * lower.num_rows) for f in passed}
        return pa.table(made | {"proof": pa.array(proofs, pa.list_(STEP))})

    dealt = nodes.withColumn("_bucket", F.expr(f"idx div {size}"))
    of_bucket = parents.withColumnRenamed("idx", "_bucket")
    return dealt.groupBy("tree", "_bucket").cogroup(of_bucket.groupBy("tree", "_bucket")).applyInArrow(prove, schema)


def reduced(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """nodes and the written tables above them, up to the one with a node for each tree."""
    out = [nodes]
    while len(out) == 1 or out[-1].where("n > 1").limit(1).count():
        out.append(materialize(bucket_roots(out[-1], fanout, levels)))
    return out


def proven(tables: list[DataFrame], tops: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The first of the tables that `reduced` gives with proofs; tops: tree, idx (0), the proof of its root, and what else all of the tree get."""
    proofs = tops
    for i, nodes in enumerate(reversed(tables[:-1]), 2):
        proofs = with_proofs(nodes, proofs, fanout, levels)
        if i < len(tables):
            proofs = materialize(proofs)
    return proofs


def manifest(rows: DataFrame, *, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """rows (doc_id, source, leaf and whatever else) with subroot, root and proof.

    Leaves of a source ascend by doc_id, those of one doc_id by digest; null ids come first. While several nodes of a
    source remain, each run of `fanout` becomes one; what remains is its subroot. Subroots, by source (null first, then
    by bytes), lead to the root in the same way. proof is an array of steps, from the leaf up, each with the digests
    before and after the node's own in its run: `folded(leaf, proof)` gives the root, of a changed leaf another one.

    No task holds more than fanout ** levels nodes, however large a source is. Repeated rows are leaves of their own,
    with proofs of their own. An empty table gives no rows. Columns are kept as they are; subroot, root and proof of the
    rows themselves are replaced.
    """
    kept = [c for c in rows.columns if c not in ("subroot", "root", "proof")]
    source = F.coalesce(F.concat(F.lit("+"), "source"), F.lit("-"))
    boxed = rows.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), F.col("source").alias("_by"), F.col("doc_id").alias("_id"), source.alias("_source"), F.col("leaf").alias("digest"))
    stored = materialize(boxed)
    order = [F.col("_by").asc_nulls_first(), F.col("_id").asc_nulls_first(), F.col("digest")]
    placed = ranked(stored, order, "_rank")
    sources = placed.groupBy("_source").agg(F.min("_rank").alias("first"), F.count("*").alias("n"), F.first("_by").alias("_by"))
    sources = materialize(ranked(sources, [F.col("_by").asc_nulls_first()], "tree").select("_source", "first", "n", "tree"))
    total = stored.count()
    leaves = attached(placed.select("_row", "_source", "digest", "_rank"), ["_source"], sources, total, ["first", "n", "tree"], F.col("_rank"))
    leaves = materialize(leaves.select("tree", (F.col("_rank") - F.col("first")).alias("idx"), "n", "digest", "_row"))
    by_source = reduced(leaves, fanout, levels)
    n_sources = sources.count()
    subroots = materialize(by_source[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_sources).cast("long").alias("n"), "digest", F.col("digest").alias("subroot")))
    over = reduced(subroots, fanout, levels)
    root = over[-1].select("digest").first()  # one row
    none = F.array().cast(PROOF)
    of_subroots = proven(over, over[-1].select("tree", "idx", none.alias("proof")), fanout, levels)
    tops = materialize(of_subroots.select(F.col("idx").alias("tree"), F.lit(0).cast("long").alias("idx"), "proof", "subroot"))
    out = proven(by_source, tops, fanout, levels)
    discard(stored)
    return out.select(*(F.col("_row").getField(c).alias(c) for c in kept), "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), "proof")


def tampered_text() -> Column:
    """The text as a tampering hand leaves it: A-Z in lower case in the rows whose id's checksum is a multiple of five."""
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(hit, lower).otherwise(F.col("text"))


def audited(docs: DataFrame, changed_text: Column, **shape) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The manifest is made of docs as they are; folded_root is what a row with `changed_text` and the row's own proof lead to,
    verified whether that is the root. Null ids, texts and sources are leaves like others.
    """
    leaves = docs.select("doc_id", "source", leaf().alias("leaf"), leaf(text=changed_text).alias("found"))
    proofs = manifest(leaves, **shape)
    told = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), folded(F.col("found"), F.col("proof")).alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
