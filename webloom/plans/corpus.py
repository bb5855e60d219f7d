"""Queries over documents and conversations: cleaning, validation, deduplication, prompts, labels."""

from __future__ import annotations

from ..functions import values as v
from ..functions.dialect import Spark, strip


def validate_docs(d: Spark) -> str:
    return "SELECT doc_id, length(text) >= 100 AS long_enough, contains(text, '```') AS fenced FROM documents"


def line_stats(d: Spark) -> str:
    lines = d.keep(d.split("text", "\n"), d.matches("x", r"[^ \t\r\n]"))
    size = "size" if d.name == "spark" else "len"
    return f"SELECT doc_id, CAST({size}({lines}) AS BIGINT) AS n_lines, CAST(length({d.join(lines, '')}) AS DOUBLE) / nullif({size}({lines}), 0) AS mean_length, CAST({size}({lines}) AS DOUBLE) / nullif(length(text), 0) AS break_ratio FROM documents"


def blank_compaction(d: Spark) -> str:
    return f"SELECT doc_id, md5({strip(d, d.sub('text', r'\n\s*\n', chr(10) * 2))}) AS text_md5 FROM documents"


def truncate_text(d: Spark) -> str:
    return "SELECT doc_id, CASE WHEN length(text) > 5000 THEN concat(substring(text, 1, 5000), '...') ELSE text END AS text FROM documents"


def md5_dedupe(d: Spark) -> str:
    """The first document of each text."""
    return "SELECT min(doc_id) AS doc_id, h AS text_md5, count(*) AS copies FROM (SELECT doc_id, md5(text) AS h FROM documents) t GROUP BY h"


def incremental_antijoin(d: Spark) -> str:
    """The later half's new texts, against what the earlier half holds."""
    return """WITH h AS (SELECT doc_id, md5(text) AS h FROM documents WHERE text <> ''), cut AS (SELECT max(doc_id) / 2 AS mid FROM documents),
        stored AS (SELECT DISTINCT h FROM h, cut WHERE doc_id < mid), fresh AS (SELECT min(doc_id) AS doc_id, h FROM h, cut WHERE doc_id >= mid GROUP BY h)
        SELECT doc_id, h AS text_md5 FROM fresh WHERE NOT EXISTS (SELECT 1 FROM stored WHERE stored.h = fresh.h)"""


def prompt(d: Spark, start: str) -> str:
    return f"SELECT conv_id, turn, concat({d.text(start)}, {strip(d, 'text')}, {d.text(v.RESPONSE)}) AS prompt FROM conversations WHERE role = 'user'"


def prompt_train(d: Spark) -> str:
    return prompt(d, v.TRAIN_PROMPT)


def prompt_chat(d: Spark) -> str:
    return prompt(d, v.CHAT_PROMPT)


def pairs() -> str:
    return "(SELECT conv_id, turn, text AS instruction, answer FROM (SELECT conv_id, turn, role, text, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations) t WHERE role = 'user' AND next_role = 'assistant')"


def turn_pairs(d: Spark) -> str:
    return f"SELECT conv_id, turn, instruction, answer FROM {pairs()} p"


def response_postprocess(d: Spark) -> str:
    said = f"concat({d.text(v.CHAT_PROMPT)}, instruction, {d.text(v.RESPONSE)}, answer, '\n<|EOT|> ', instruction)"
    cut = strip(d, d.first_part(d.last_part(said, "### Response:\n"), "<|EOT|>"))
    return f"SELECT conv_id, turn, {cut} AS response FROM {pairs()} p"


def token_labels(d: Spark) -> str:
    """Token counts by whitespace, and how many labels stay after the prompt is masked and all is cut at 2048."""
    count = lambda x: ("size" if d.name == "spark" else "len") + f"({d.keep(d.split(x, '[ ' + chr(92) + 't' + chr(92) + 'n' + chr(92) + 'r]+'), chr(120) + ' <> ' + chr(39) * 2)})"
    return f"SELECT conv_id, turn, CAST(least(2048, p + a + 1) AS BIGINT) AS n_tokens, CAST(greatest(0, least(2048, p + a + 1) - p) AS BIGINT) AS n_labels FROM (SELECT conv_id, turn, {count('instruction')} AS p, {count('answer')} AS a FROM {pairs()} q) t"


def training_steps(d: Spark) -> str:
    accumulation = "least(4, greatest(1, n))"
    return f"SELECT n AS n_examples, CAST({accumulation} AS BIGINT) AS accumulation, CAST(least(50, n) AS BIGINT) AS warmup, CAST(greatest(1, {d.div('n', accumulation)}) AS BIGINT) AS steps FROM (SELECT count(*) AS n FROM {pairs()} p) t"


def prompt_notebook(d: Spark) -> str:
    """The prompt of a tokenizer without a chat template."""
    return f"SELECT conv_id, turn, concat({d.text('User: ')}, text, {d.text(chr(10) * 2 + 'Assistant:')}) AS prompt FROM conversations WHERE role = 'user'"


def chat_inputs(d: Spark) -> str:
    """What a chat loop does with each user line: blanks are passed over, quit and exit end it, clear forgets the history."""
    said = f"lower({strip(d, 'text')})"
    return f"SELECT conv_id, turn, CASE WHEN {said} = '' THEN 'skip' WHEN {said} IN ('quit', 'exit') THEN 'end' WHEN {said} = 'clear' THEN 'clear' ELSE 'answer' END AS action FROM conversations WHERE role = 'user'"


def history_length(d: Spark) -> str:
    """Turns that stand before each user line of a conversation."""
    return "SELECT conv_id, turn, before FROM (SELECT conv_id, turn, role, count(*) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS before FROM conversations) t WHERE role = 'user'"


QUERIES = (validate_docs, line_stats, blank_compaction, truncate_text, md5_dedupe, incremental_antijoin, prompt_train, prompt_chat, prompt_notebook, chat_inputs, history_length, turn_pairs, response_postprocess, token_labels, training_steps)
