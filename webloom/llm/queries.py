"""One query per training-data operator, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, merkle, minhash, mixing, packing, quality, secrets, sharding, substrings, suffixes, urls, vectors
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


def op2_packed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrices themselves stay in the operator's output; the query returns checksums of their rows."""
    packed = packing.pack_matrices(table(spark, sf_dir, "documents"))
    return packed.select("sequence_id", "n_tokens", F.crc32("input_ids").alias("ids_crc32"), F.crc32("position_ids").alias("positions_crc32"), "cu_seqlens", "doc_ids", "starts")


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(substrings.trimmed(table(spark, sf_dir, "documents")))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=16)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"), merkle.tampered_text())


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_secret_scan, op2_packed_matrices, op3_near_vectors, op4_substring_dedup, op5_mix_sources, op6_best_fit_packing, op7_minhash_dedup, op8_url_filter, op9_quality_rules, op10_ring_sharding, op11_source_divergence, op12_benchmark_decontamination, op13_merkle_manifest)}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def merkle_levels(leaves: str, levels: int) -> tuple[str, list[str]]:
    """CTEs that reduce `leaves` (tree, idx, h) level by level, as far as 16^levels nodes need, and the names of the levels."""
    names, parts = [leaves], []
    for k in range(1, levels + 1):
        below, name = names[-1], f"{leaves}_{k}"
        parts.append(f"""{name} AS (SELECT tree, CASE WHEN size = 1 THEN idx ELSE idx // 16 END AS idx, CASE WHEN any_value(size) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
                FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {below}) GROUP BY tree, CASE WHEN size = 1 THEN idx ELSE idx // 16 END)""")
        names.append(name)
    return ", ".join(parts), names


def merkle_fold(rows: str, names: list[str], start: int) -> tuple[str, str]:
    """CTEs that take each of rows (r, tree, at, sibs, fold) up through the levels, and the name of the last."""
    parts, last = [], rows
    for k, level in enumerate(names[:-1], start):
        name = f"up_{k}"
        parts.append(f"""run_{k} AS (SELECT tree, idx // 16 AS run, list(h ORDER BY idx) AS hs, any_value(size) AS size FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {level}) GROUP BY tree, idx // 16),
            {name} AS (SELECT r, tree, CASE WHEN size = 1 THEN pos ELSE pos // 16 END AS pos,
                CASE WHEN size = 1 THEN sibs ELSE sibs || array_to_string(hs[1:pos % 16], '') || array_to_string(hs[pos % 16 + 2:], '') END AS sibs,
                CASE WHEN size = 1 THEN fold ELSE sha256(array_to_string(hs[1:pos % 16], '') || fold || array_to_string(hs[pos % 16 + 2:], '')) END AS fold
                FROM {last} JOIN run_{k} USING (tree) WHERE run = pos // 16)""")
        last = name
    return ", ".join(parts), last


def merkle_sql() -> str:
    held = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda text: f"sha256({' || '.join([*map(held, ('doc_id', 'source', 'lang', 'n_chars')), held(text)])})"
    crc = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)])), 4294967295)"
    lower, names = merkle_levels("node", 5)
    upper, tops = merkle_levels("top", 3)
    one, low = merkle_fold("start", names, 0)
    two, high = merkle_fold("mid", tops, 10)
    return f"""WITH crc AS (SELECT list(list_reduce(list_concat([b::BIGINT], [1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY b) AS crcs FROM range(256) AS r(b)),
        d AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(f'CASE WHEN {crc} % 5 = 0 THEN translate(text, {LOWER}) ELSE text END')} AS found FROM documents, crc),
        s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM d)),
        n AS (SELECT row_number() OVER () AS r, d.*, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
        node AS (SELECT tree, idx, leaf AS h FROM n), {lower}, top AS (SELECT 0 AS tree, tree AS idx, h FROM {names[-1]}), {upper},
        start AS (SELECT r, tree, idx AS pos, '' AS sibs, found AS fold FROM n), {one}, mid AS (SELECT r, 0 AS tree, tree AS pos, sibs, fold FROM {low}), {two}
        SELECT doc_id, leaf, top.h AS subroot, root.h AS root, sha256(sibs) AS proof_sha256, fold AS folded_root, fold = root.h AS verified
        FROM n JOIN {high} u USING (r) JOIN top ON top.idx = n.tree, {tops[-1]} root"""


SQL = {
    "op13_merkle_manifest": merkle_sql(),
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        w AS (SELECT lang, source, r, unnest(terms) AS term FROM d),
        vocabulary AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN vocabulary USING (lang, term) GROUP BY ALL),
        cell AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN vocabulary v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
        p AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM cell),
        l AS (SELECT lang, term, sum(n) AS n FROM cell GROUP BY lang, term),
        q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM l),
        gaps AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        facts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source AND gaps.item = b.source
            UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        ranks AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM facts)
        SELECT * FROM ranks WHERE part = 'pair' OR rank <= 50""",
    "op12_benchmark_decontamination": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS s FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0),
        occ AS (SELECT r, i, ks.k, array_to_string(w[i:i + ks.k - 1], ' ') AS s FROM d, (SELECT DISTINCT k FROM win) ks, unnest(range(1, len(w) - ks.k + 2)) AS t(i)),
        met AS (SELECT DISTINCT r, i, k, item_id FROM occ JOIN win USING (k, s)),
        hit AS (SELECT r, count(DISTINCT i + j) AS n FROM met, unnest(range(0, k)) AS t(j) GROUP BY r),
        named AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM met GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
    "op3_near_vectors": """
        WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
        part AS (SELECT v.vec_id, least(v.vec_id, coalesce(min(r.b), v.vec_id)) AS component_id FROM v LEFT JOIN reach r ON r.a = v.vec_id GROUP BY v.vec_id)
        SELECT p.vec_id, (SELECT count(*) FROM link WHERE a = p.vec_id) AS n_links, component_id, p.vec_id = component_id AS kept FROM part p""",
    "op4_substring_dedup": rf"""
        WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
        win AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS turn
                FROM d, unnest(range(1, len(w) - 18)) AS r(i)),
        gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM win, range(0, 20) AS s(k) WHERE turn > 1),
        word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op5_mix_sources": rf"""
        WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0::DOUBLE * sum(size) AS most, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM d GROUP BY source),
        o AS (SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(source_size) OVER () AS total FROM s),
        level AS (SELECT (1.5::DOUBLE * total - before) / rest AS level FROM o WHERE most / weight > (1.5::DOUBLE * total - before) / rest ORDER BY most / weight, source LIMIT 1),
        t AS (SELECT source, source_size, CASE WHEN most <= level * weight THEN most ELSE level * weight END AS target FROM s, level),
        r AS (SELECT d.*, source_size, target, row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) - 1 AS k, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                     ('0x' || substr(md5('17:' || coalesce('source ' || d.source, 'null')), 1, 10))::BIGINT / 1099511627776::DOUBLE AS u FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target, CAST(floor(u + rate * (k + 1)) - floor(u + rate * k) AS BIGINT) * size AS taken FROM r""",
    "op7_minhash_dedup": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle FROM d, unnest(range(1, greatest(len(w) - 2, 2))) AS r(i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
        low AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
        SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(low, doc_id)) AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)""",
    "op9_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
        line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
        lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times FROM d, unnest(range(1, len(w) - 1)) AS r(i)),
        rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM win, range(0, 3) AS s(k) WHERE times > 1 GROUP BY doc_id),
        f AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                     coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept FROM f""",
}
