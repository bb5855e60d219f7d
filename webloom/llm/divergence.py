"""How far the sources of a language differ in their words: exact differences of smoothed term shares (operator 11).

Counts become tiles: dense matrices of groups by terms, one for each block of a language's terms and pair of blocks of its sources.
A tile gives partial sums for all its pairs of sources, and the heap of each source's most typical terms; sums add up, heaps merge.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_parts

#: Bytes that end a term as spaces, A-Z as a-z, all else as it is: terms are runs of ASCII letters and of what isn't ASCII.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Entries of counts that a task holds before it sends them on.
HELD = 1 << 20
#: Terms and sources of a tile.
TERMS, SOURCES = 4096, 64
SHARE = 1_000_000_000


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents that have it): a row or more for each; term is null in a row of each group.

    Counts are added up within a task before they are sent on.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[bytes, list[int]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in held.items():
                k = len(terms) + 1
                both = np.array([*terms.values(), [0, 0]], dtype=np.int64)
                arrays = [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array([*terms, None], pa.binary()), pa.array(both[:, 0]), pa.array(both[:, 1])]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "df"])

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                terms = held.setdefault((lang, source), {})
                before = len(terms)
                own: dict[bytes, int] = {}
                for term in text.translate(FOLD).split():
                    own[term] = own.get(term, 0) + 1
                for term, n in own.items():
                    if (so_far := terms.get(term)) is None:
                        terms[term] = [n, 1]
                    else:
                        so_far[0] += n
                        so_far[1] += 1
                size += len(terms) - before
                if size >= HELD:
                    yield from flush()
                    held.clear()
                    size = 0
        yield from flush()

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    read = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    return read.mapInArrow(count, "lang string, source string, term binary, n long, df long")


def shares(counts: np.ndarray, total: np.ndarray, terms: int, smooth: int) -> np.ndarray:
    """1 + floor(SHARE * (count + smooth) / (total + smooth * terms)) of each row's counts, exact: by long division, three digits at a time."""
    above, below = counts + smooth, total[:, None] + smooth * terms
    out, rest = above // below, above % below
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest %= below
    return out + 1


def tile(rows: pa.Table, smooth: int, top: int) -> pa.Table:
    """What a tile says: rows without term are partial sums of pairs of sources, the others its sources' most typical terms.

    rows: lang, block, i, j (blocks of sources), idx (a source's number), total (its kept occurrences), lang_total, n_terms,
    term, n, lang_n; a row without term for each source. A source's terms are told by the tile of its own block.
    """
    rows = rows.sort_by([("idx", "ascending"), ("term", "ascending")])
    lang, i, j, lang_total, n_terms = (rows[c][0].as_py() for c in ("lang", "i", "j", "lang_total", "n_terms"))
    idx, term = rows["idx"].to_numpy(), rows["term"].combine_chunks()
    ids, group = np.unique(idx, return_inverse=True)
    counted = np.flatnonzero(~term.is_null().to_numpy(zero_copy_only=False))
    known = term.take(pa.array(counted)).dictionary_encode()
    column = known.indices.to_numpy().astype(np.int64) if len(counted) else np.zeros(0, np.int64)
    counts = np.zeros((len(ids), len(known.dictionary)), dtype=np.int64)
    counts[group[counted], column] = rows["n"].to_numpy()[counted]
    total = np.zeros(len(ids), dtype=np.int64)
    total[group] = rows["total"].to_numpy()
    p = shares(counts, total, n_terms, smooth)
    left, right = (np.flatnonzero(ids // SOURCES == b) for b in (i, j))
    out: list[tuple] = []
    for a in left.tolist():  # against all of the other block at a time: SOURCES x TERMS numbers
        others = right[right > a] if i == j else right
        for b, value in zip(others.tolist(), np.abs(p[a][None, :] - p[others]).sum(axis=1).tolist()):
            out.append((int(ids[a]), int(ids[b]), None, value))
    if i == j:
        lang_n = np.zeros((1, counts.shape[1]), dtype=np.int64)
        lang_n[0, column] = rows["lang_n"].to_numpy()[counted]
        over = p - shares(lang_n, np.array([lang_total]), n_terms, smooth)
        names = np.array(known.dictionary.to_pylist(), dtype=object)
        for a in left.tolist():
            high = np.flatnonzero((counts[a] > 0) & (over[a] > 0))
            if len(high) > top:  # all that reach the top-th value
                high = high[over[a][high] >= np.partition(over[a][high], -top)[-top]]
            best = sorted(high.tolist(), key=lambda t: (-over[a][t], names[t]))[:top]
            out += [(int(ids[a]), int(ids[a]), names[t], int(over[a][t])) for t in best]
    a, b, t, value = zip(*out) if out else ([], [], [], [])
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "term": pa.array(t, pa.binary()), "value": pa.array(value, pa.int64())})


def divergence(docs: DataFrame, *, least: int = 30, smooth: int = 5, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: how a source differs from the others of its language.

    A language keeps the terms of `least` documents or more. A term's share in a group is 1 + floor(10^9 (count + smooth) /
    (N + smooth V)), N the group's occurrences of kept terms, V how many terms are kept. Part `pair`: the sum of the
    absolute differences from each other source, all ranks. Part `term`: the source's terms whose share is above the
    language's, with the difference, the `top` of them. Ranks go by value, then by bytes.

    Null text, lang and source are empty strings. Repeated rows are documents of their own. A language without kept terms has
    pairs of value 0; one with a single source has no pairs. Other columns are ignored; an empty table gives no rows. All is
    exact while counts are below 9 x 10^15.
    """
    parts = shuffle_parts(docs.sparkSession)
    # one exchange: what a language has of a term lies together, a row for each source and task
    dealt = term_counts(docs).repartition(parts, "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    of_term = Window.partitionBy("lang", "term")
    counted = dealt.withColumn("lang_df", F.sum("df").over(of_term)).withColumn("lang_n", F.sum("n").over(of_term))
    kept = materialize(counted.where((F.col("lang_df") >= least) | F.col("term").isNull()).select("lang", "source", "term", "n", "lang_n"))
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.where("term is not null").groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("n").alias("lang_total"))
    # as many rows as there are sources: the result has their square
    groups = groups.withColumn("idx", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")).withColumn("n_sources", F.count("*").over(Window.partitionBy("lang")))
    groups = groups.join(langs, "lang", "left").na.fill(0, ["n_terms", "lang_total"])
    last = F.floor((F.col("n_sources") - 1) / SOURCES).cast("int")
    groups = materialize(groups.withColumn("own", F.floor(F.col("idx") / SOURCES).cast("int")).withColumn("last", last).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("n_terms") / TERMS)).cast("int")))

    # a source's rows go to the tiles of its block with each
    facing = F.explode(F.transform(F.sequence(F.lit(0), F.col("last")), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j"))))
    facts = ["idx", "total", "lang_total", "n_terms"]
    keys = ["lang", "block", "i", "j"]
    none = [F.lit(None).cast("binary").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("lang_n")]
    heads = groups.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("to", facing).select("lang", "block", "to.i", "to.j", *facts, *none)
    cells = kept.where("term is not null").join(groups, ["lang", "source"]).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    cells = cells.withColumn("to", facing).select("lang", "block", "to.i", "to.j", *facts, "term", "n", "lang_n")
    told = materialize(heads.unionByName(cells).groupBy(*keys).applyInArrow(lambda rows: tile(rows, smooth, top), "lang string, a long, b long, term binary, value long"))

    names = groups.select("lang", F.col("idx").alias("a"), "source")
    others = groups.select("lang", F.col("idx").alias("b"), F.col("source").alias("item"))
    sums = told.where("term is null").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = both.join(names, ["lang", "a"]).join(others, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = told.where("term is not null").join(names, ["lang", "a"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    typical = terms.withColumn("rank", rank).where(F.col("rank") <= top)  # a heap of `top` for each block
    return pairs.withColumn("rank", rank).unionByName(typical)
