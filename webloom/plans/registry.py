"""All queries of the library by name, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import entities
from ..functions.dialect import Duck, Spark
from ..operators import code, examples, html, numbering, rewrite, sites, training
from ..functions.encoding import decoded, sound
from ..sources.folders import example_files
from ..sources.tables import table, views
from ..streaming import dedupe
from . import corpus, pages


def in_spark(plan):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        views(spark, sf_dir, ("pages", "documents", "conversations"))
        return spark.sql(plan(Spark()))

    query.__doc__ = plan.__doc__
    return query


def example_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.numbered(table(spark, sf_dir, "pages").select("page_id"), "page_id").select("page_id", F.format_string("example_%04d", "number").alias("folder"))


def resume_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.resumed(table(spark, sf_dir, "pages").select("page_id"), 101, "page_id")


def export_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the folders that full-page examples are written to."""
    return example_files(QUERIES["full_page_examples"](spark, sf_dir), "page_id")


def decoded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages from their bytes, and whether each is sound."""
    text = table(spark, sf_dir, "pages").select("page_id", decoded(F.encode("html", "UTF-8")).alias("html"))
    return text.select("page_id", "html", sound(F.col("html")).alias("sound"))


PLANS = (*pages.QUERIES, *corpus.QUERIES)
OWN = {f.__name__: f for f in (example_numbering, resume_offset, export_files, decoded_pages)}
QUERIES: dict = {p.__name__: in_spark(p) for p in PLANS} | html.QUERIES | rewrite.QUERIES | code.QUERIES | examples.QUERIES | sites.QUERIES | training.QUERIES | dedupe.QUERIES | OWN
#: Names of characters as a relation: DuckDB looks up joins faster than maps.
NAMES = f"(SELECT split_part(e, chr(2), 1) AS k, split_part(e, chr(2), 2) AS v FROM (SELECT unnest(string_split({Duck().text(entities.names())}, chr(1))) AS e))"
NUMBER = "coalesce(try_cast(regexp_extract(x, '^&#0*([0-9]{1,9});?$', 1) AS BIGINT), try_cast('0x' || nullif(regexp_extract(x, '^&#[xX]0*([0-9a-fA-F]{1,7});?$', 1), '') AS BIGINT))"
#: SQL of queries that aren't plans: written apart from them.
APART = {
    "decoded_pages": r"SELECT page_id, html, length(trim(html, E' \t\r\n')) >= 100 AND (contains(lower(html), '<html') OR contains(lower(html), '<!doctype') OR contains(lower(html), '<body')) AS sound FROM pages",
    "page_outline": r"""WITH bare AS (SELECT page_id, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(<(script|style)[^>]*>).*?</(script|style)>', '\1', 'gis') AS html FROM pages),
        tags AS (SELECT page_id, regexp_extract_all(html, '<([A-Za-z][A-Za-z0-9-]*)', 1) AS names FROM bare)
        SELECT page_id, CAST(len(names) AS BIGINT) AS n_elements, lower(array_to_string(names[1:10], ' ')) AS first_tags FROM tags WHERE len(names) > 0""",
    "visible_text": rf"""WITH names AS {NAMES},
        bare AS (SELECT page_id, regexp_replace(regexp_replace(html, '<script(\s[^>]*)?>.*?</script>', ' ', 'gis'), '<style(\s[^>]*)?>.*?</style>', ' ', 'gis') AS html FROM pages),
        told AS (SELECT page_id, regexp_replace(regexp_replace(html, '<noscript(\s[^>]*)?>.*?</noscript>', ' ', 'gis'), '<!--.*?-->|<[^>]*>', ' ', 'gs') AS t FROM bare),
        tokens AS (SELECT page_id, unnest(range(len(x))) AS place, unnest(x) AS x FROM (SELECT page_id, regexp_extract_all(t, '{entities.TOKEN}') AS x FROM told)),
        decoded AS (SELECT page_id, place, CASE WHEN x LIKE '&#_%' THEN {entities.numeric(Duck(), NUMBER)} ELSE coalesce(w.v, p.v || substring(x, length(p.k) + 2), x) END AS c
            FROM tokens LEFT JOIN names w ON x = '&' || w.k LEFT JOIN names p ON p.k = regexp_extract(x, '^&({'|'.join(entities.BARE)})', 1)),
        joined AS (SELECT page_id, trim(regexp_replace(replace(string_agg(c, '' ORDER BY place), chr(160), ' '), '\s+', ' ', 'g')) AS t FROM decoded GROUP BY page_id)
        SELECT told.page_id, CASE WHEN length(joined.t) > 5000 THEN joined.t[1:5000] || '...' ELSE coalesce(joined.t, told.t) END AS text FROM told LEFT JOIN joined USING (page_id)""",
    "example_numbering": "SELECT page_id, format('example_{:04d}', (SELECT count(*) FROM pages q WHERE q.page_id <= p.page_id)) AS folder FROM pages p",
    "resume_offset": "SELECT page_id FROM pages WHERE (SELECT count(*) FROM pages) < 101 OR page_id NOT IN (SELECT page_id FROM pages ORDER BY page_id LIMIT 100)",
    "md5_dedupe": "SELECT DISTINCT ON (text) doc_id, md5(text) AS text_md5, count(*) OVER (PARTITION BY text) AS copies FROM documents ORDER BY text, doc_id",
    "history_length": "SELECT u.conv_id, u.turn, (SELECT count(*) FROM conversations e WHERE e.conv_id = u.conv_id AND e.turn < u.turn) AS before FROM conversations u WHERE role = 'user'",
    "turn_pairs": "SELECT a.conv_id, a.turn, a.text AS instruction, b.text AS answer FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.role = 'assistant' AND b.turn = (SELECT min(turn) FROM conversations c WHERE c.conv_id = a.conv_id AND c.turn > a.turn) WHERE a.role = 'user'",
    "truncate_text": "SELECT doc_id, text[1:5000] || CASE WHEN len(text) > 5000 THEN '...' ELSE '' END AS text FROM documents",
    "incremental_antijoin": "SELECT min(doc_id) FILTER (doc_id >= mid) AS doc_id, md5(text) AS text_md5 FROM documents, (SELECT max(doc_id) / 2 AS mid FROM documents) WHERE text <> '' GROUP BY text HAVING min(doc_id) >= any_value(mid)",
    "processed_sites_antijoin": "SELECT min(page_id) AS page_id, arg_min(url, page_id) AS url FROM pages GROUP BY split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)",
    "folder_names": "SELECT page_id, split_part(url, '://', 1) || h AS folder, split_part(url, '://', 1) || '://' || h AS target FROM (SELECT page_id, url, split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1) AS h FROM pages)",
    "chat_inputs": "SELECT conv_id, turn, coalesce(map {'': 'skip', 'quit': 'end', 'exit': 'end', 'clear': 'clear'}[lower(trim(text, E' \\t\\r\\n'))], 'answer') AS action FROM conversations WHERE role = 'user'",
    "line_stats": "SELECT doc_id, count(*) FILTER (full_) AS n_lines, sum(len(line)) FILTER (full_)::DOUBLE / nullif(count(*) FILTER (full_), 0) AS mean_length, count(*) FILTER (full_)::DOUBLE / nullif(any_value(size), 0) AS break_ratio FROM (SELECT doc_id, line, size, len(trim(line, E' \\t\\r\\n')) > 0 AS full_ FROM (SELECT doc_id, len(text) AS size, unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY doc_id",
    "same_domain_links": r"WITH a AS (SELECT page_id, split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1) AS home, unnest(string_split_regex(html, '(?i)<a\s')[2:]) AS rest FROM pages WHERE regexp_matches(html, '(?is)<a\s.*</a>')), l AS (SELECT page_id, home, regexp_extract(rest, '(?i)^[^>]*href=[\x22\x27]?([^\x22\x27\s>]*)', 1) AS href FROM a) SELECT page_id, count(*) AS n_links, CAST(count(*) FILTER (NOT regexp_matches(href, '^([A-Za-z][A-Za-z0-9+.-]*:|//)') OR regexp_replace(regexp_extract(href, '//([^/?#]*)', 1), '^www\.', '') = regexp_replace(home, '^www\.', '')) AS HUGEINT) AS n_same FROM l GROUP BY page_id",
}
SQL: dict = {p.__name__: p(Duck()) for p in PLANS} | dedupe.SQL | APART | {
    "chat_prompts": r"SELECT conv_id, turn, format(E'<|im_start|>{}\n{}<|im_end|>\n<|im_start|>assistant\n', role, text) AS prompt FROM conversations WHERE role = 'user'",
}
