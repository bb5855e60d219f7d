"""Source divergence, benchmark decontamination and the Merkle manifest: odd rows, and plain loops beside them."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.llm import divergence, merkle, queries, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["idx", "tree", "digest", "leaf", "proof", "n", "term", "rank", "edges", "size", "at", "total", "block", "_row", "n_words"]
DATA = "/root/testdata/sf0.001"


def odd_docs(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=4)) for _ in range(60)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows = [(i, text(40).title() + "; 12x", rng.choice(["en", "de", None]), rng.choice(["a", "b", "", None, "ß"]), i) for i in range(90)]
    rows += [(7, rows[7][1], "en", "a", 1), (7, rows[7][1], "en", "a", 1), (None, "No id", "en", None, None), (None, None, None, None, None), (100, "", "xx", "alone", 0), (101, text(6000), "en", "b", 1), (-3, "\t \n", "fr", "a", 2), (-4, None, "fr", "c", 2)]
    return spark.createDataFrame(rows, SCHEMA)


def benchmark(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    cut = lambda i, lo, n: " ".join(re.findall(r"\w+", texts[i])[lo : lo + n])
    rows = [("1", cut(3, 2, 14).upper()), ("10", cut(3, 2, 14)), ("2", cut(101, 5000, 30) + " other"), ("3", "No id"), ("4", None), ("5", "!!"), (None, cut(9, 1, 11)), ("2", "more of it that none has in any document at all"), ("6", "xyzzy")]
    return spark.createDataFrame(rows, "item_id string, text string")


def plain_contamination(docs, items, w=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for name, text in items:
        words = split(text)
        for i in range(max(1, len(words) - w + 1) if words else 0):
            windows[tuple(words[i : i + w])].add(name)
    out = []
    for doc_id, text in docs:
        words, hit, names = split(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(words) - size + 1):
                if found := windows.get(tuple(words[i : i + size])):
                    hit |= set(range(i, i + size))
                    names |= found
        ids = sorted(names - {None})
        out.append((doc_id, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def columns_of(df, *names):
    return Counter(tuple(r) for r in df.select(*names).collect())


FIELDS12 = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_contamination_is_that_of_plain_windows(spark, monkeypatch):
    docs = odd_docs(spark)
    items = benchmark(spark, docs)
    want = plain_contamination([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert columns_of(suffixes.digests(suffixes.contamination(docs, items)), *FIELDS12) == want
    wide = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH)))
    assert columns_of(suffixes.digests(suffixes.contamination(wide, items)), *FIELDS12) == want
    left = suffixes.decontaminated(wide, items)
    assert left.columns == wide.columns and Counter(r.doc_id for r in left.collect()) == Counter(k[0] for k, n in want.items() for _ in range(n) if not k[-1])
    assert suffixes.contamination(docs.limit(0), items).collect() == []
    assert not suffixes.contamination(docs, items.limit(0)).where("n_hit > 0 or size(item_ids) > 0 or longest is not null").count()
    monkeypatch.setattr(suffixes, "ITEMS", 150)  # several blocks
    assert columns_of(suffixes.digests(suffixes.contamination(docs, items)), *FIELDS12) == want
    assert suffixes.decontaminated(docs, items).count() == left.count()


def test_longest_match_and_its_place(spark):
    words = [f"w{i}" for i in range(200)]
    doc = " ".join(["x", *words[20:90], "y", *words[100:112], "z"])
    found = suffixes.contamination(spark.createDataFrame([(1, doc)], "doc_id long, text string"), spark.createDataFrame([("i", " ".join(words))], "item_id string, text string")).first()
    assert found.longest.asDict() == {"size": 70, "at": 1, "item_id": "i", "item_at": 20}
    assert [tuple(s) for s in found.spans] == [(1, 71), (72, 84)] and found.n_hit == 82


def test_parts_of_long_texts_and_shards(monkeypatch):
    rng = random.Random(3)
    words = [f"a{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 50, 400])))) for i in range(30)]
    items = [(str(i), " ".join(docs[i % 30][1].split()[i : i + rng.choice([2, 9, 10, 25])])) for i in range(40)]
    want = plain_contamination(docs, items)
    for shard in (7, 64, 1 << 20):
        monkeypatch.setattr(suffixes, "SHARD", shard)
        counts, found = suffixes.searched(suffixes.Items([(n, t.encode()) for n, t in items], 10), [t.encode() for _, t in docs])
        got = Counter()
        for (doc_id, _), n in zip(docs, counts):
            f = found.get(doc_id, suffixes.Finding())
            ids = sorted(f.items)
            got[(doc_id, n, sum(hi - lo for lo, hi in f.edges), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(f.edges))] += 1
        assert got == want


@pytest.mark.parametrize("seed", range(20))
def test_suffix_array_is_sorted(seed):
    rng = np.random.default_rng(seed)
    ids = np.r_[rng.integers(0, rng.choice([2, 3, 1000]), rng.integers(0, 300)), 0].astype(np.int32)
    order = suffixes.suffix_array(ids, 64)
    suffix = lambda i: ids[i : i + int((ids[i:] == 0).argmax())].tolist()
    assert sorted(order.tolist()) == np.flatnonzero(ids).tolist()
    cut = [suffix(i)[:64] + [0] * (len(suffix(i)) < 64) for i in order]
    assert cut == sorted(cut)


def plain_divergence(rows, least, smooth=5, top=50):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    df, n, groups = Counter(), Counter(), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        for t in terms(text):
            n[lang, source, t] += 1
        for t in set(terms(text)):
            df[lang, t] += 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (l, t), k in df.items() if l == lang and k >= least]
        total = {s: sum(n[lang, s, t] for t in kept) for s in sources}
        p = {(s, t): 1 + 10**9 * (n[lang, s, t] + smooth) // (total[s] + smooth * len(kept)) for s in sources for t in kept}
        q = {t: 1 + 10**9 * (sum(n[lang, s, t] for s in sources) + smooth) // (sum(total.values()) + smooth * len(kept)) for t in kept}
        for s in sources:
            pairs = sorted((-sum(abs(p[s, t] - p[o, t]) for t in kept), o.encode()) for o in sources if o != s)
            typical = sorted((q[t] - p[s, t], t.encode()) for t in kept if n[lang, s, t] and p[s, t] > q[t])[:top]
            out += [(lang, s, part, item.decode(), -v, r) for part, found in (("pair", pairs), ("term", typical)) for r, (v, item) in enumerate(found, 1)]
    return Counter(out)


FIELDS11 = ("lang", "source", "part", "item", "value", "rank")


def test_divergence_is_that_of_plain_counts(spark):
    docs = odd_docs(spark)
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    for least in (1, 30, 10_000):
        assert columns_of(divergence.divergence(docs, least=least), *FIELDS11) == plain_divergence(rows, least)
    assert divergence.divergence(docs.limit(0)).collect() == []
    wide = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH)))
    assert columns_of(divergence.divergence(wide, least=3, top=4), *FIELDS11) == plain_divergence(rows, 3, top=4)


def test_divergence_of_more_sources_than_a_tile_has(spark):
    rng = random.Random(8)
    rows = [("en", f"s{i % 150}", " ".join(rng.choices("abcdefghijkl", k=9))) for i in range(400)]
    assert columns_of(divergence.divergence(spark.createDataFrame(rows, "lang string, source string, text string"), least=30), *FIELDS11) == plain_divergence(rows, 30)


def test_shares_are_exact():
    for count, total, terms in ((10**15, 4 * 10**15, 10**6), (0, 0, 3), (7, 9, 1), (2**40, 2**41, 2**20)):
        assert divergence.shares(np.array([[count]]), np.array([total]), terms, 5)[0, 0] == 1 + 10**9 * (count + 5) // (total + 5 * terms)


def plain_manifest(rows, fanout):
    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
        return levels

    def steps(levels, at):
        for level in levels[:-1]:
            lo = at - at % fanout
            yield level[lo:at], level[at + 1 : lo + fanout]
            at //= fanout

    held = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda r, text: h(*map(held, (r.doc_id, r.source, r.lang, r.n_chars, text)))
    by = defaultdict(list)
    for r in rows:
        by[(r.source is not None, (r.source or "").encode())].append(r)
    trees = []
    for source in sorted(by):
        own = sorted(by[source], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees.append((own, tree([leaf(r, r.text) for r in own])))
    top = tree([levels[-1][0] for _, levels in trees])
    out = []
    for s, (own, levels) in enumerate(trees):
        for i, r in enumerate(own):
            proof = [*steps(levels, i), *steps(top, s)]
            hit = r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            node = leaf(r, re.sub("[A-Z]", lambda m: m[0].lower(), r.text) if hit else r.text)
            for before, after in proof:
                node = h(*before, node, *after)
            out.append((r.doc_id, levels[0][i], levels[-1][0], top[-1][0], h(*(x for b, a in proof for x in b + a)), node, node == top[-1][0]))
    return Counter(out)


FIELDS13 = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("fanout, levels", [(16, 3), (2, 2), (3, 1)])
def test_manifest_is_that_of_plain_trees(spark, fanout, levels):
    docs = odd_docs(spark)
    want = plain_manifest(docs.collect(), fanout)
    assert {k[-1] for k in want} == {True, False}
    assert columns_of(merkle.audited(docs, merkle.tampered_text(), fanout=fanout, levels=levels), *FIELDS13) == want


def test_manifest_of_odd_tables(spark):
    docs = odd_docs(spark)
    assert merkle.audited(docs.limit(0), merkle.tampered_text()).collect() == []
    one = docs.limit(1)
    assert columns_of(merkle.audited(one, merkle.tampered_text()), *FIELDS13) == plain_manifest(one.collect(), 16)
    wide = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH) if c != "leaf")).withColumn("leaf", merkle.leaf())
    out = merkle.manifest(wide)
    assert set(out.columns) - {"subroot", "root", "proof"} == set(wide.columns) - {"proof"} and out.count() == docs.count()
    assert out.where(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert out.where(merkle.folded(F.sha2(F.lit("other"), 256), F.col("proof")) == F.col("root")).count() == 0


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_benchmark_decontamination", "op13_merkle_manifest"])
def test_queries_agree_with_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = con.execute(queries.SQL[name])
    names = [c[0] for c in found.description]
    theirs = Counter(tuple(map(str, r)) for r in found.fetchall())
    assert Counter(tuple(map(str, r)) for r in queries.QUERIES[name](spark, DATA).select(*names).collect()) == theirs
