"""Queries of this subpackage and the SQL to hold them against, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import encoding, leakage, lookalikes, near_duplicates, pairs, repetition, sentences, shared_spans, truncation


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": near_duplicates.p1_found,
        "p2_found": sentences.p2_found,
        "p3_found": pairs.p3_found,
        "p4_found": lookalikes.p4_found,
        "p4_spellings": lookalikes.p4_spellings,
        "p5_found": truncation.p5_found,
        "p5_rates": truncation.p5_rates,
        "p6_found": repetition.p6_found,
        "p6_lines": repetition.p6_lines,
        "p6_measures": repetition.p6_measures,
        "p7_ids": encoding.p7_ids,
        "p8_found": leakage.p8_found,
        "p8_paraphrased": leakage.p8_paraphrased,
        "p8_reworded": leakage.p8_reworded,
        "p9_found": shared_spans.p9_found,
        "p9_share": shared_spans.p9_share,
    }


#: All occurrences of 200-character pieces, without the tree: what p9 must give, by plain SQL.
_P9 = """
WITH d AS (SELECT doc_id, text FROM documents WHERE length(text) >= 200),
pieces AS (SELECT doc_id, s, md5(substr(text, (s + 1)::INT, 200)) AS h FROM (SELECT doc_id, text, unnest(range(0, length(text) - 199)) AS s FROM d)),
shared AS (SELECT h FROM pieces GROUP BY h HAVING min(doc_id) <> max(doc_id)),
hit AS (SELECT doc_id, s, s - row_number() OVER (PARTITION BY doc_id ORDER BY s) AS run, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM pieces WHERE h IN (SELECT h FROM shared)),
island AS (SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM hit),
found AS (SELECT doc_id, min(s)::BIGINT AS span_start, (max(s) + 200)::BIGINT AS span_end FROM island GROUP BY doc_id, k)
"""


_P6 = r"""
WITH t AS (SELECT 'predictions' AS src, pred_id AS rec_id, prediction AS text FROM predictions
    UNION ALL SELECT 'chats', chat_id, unnest(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: m.content)) FROM chats),
l AS (SELECT src, rec_id, list_filter(list_transform(string_split(text, chr(10)), lambda s: regexp_replace(s, '^[\s\x0b\x{85}\p{Z}]+|[\s\x0b\x{85}\p{Z}]+$', '', 'g')), lambda s: s <> '') AS lines FROM t WHERE text IS NOT NULL),
n AS (SELECT src, rec_id, coalesce(list_sum(list_transform(lines, lambda s: length(s))), 0)::BIGINT AS line_chars, coalesce(list_sum(list_transform(list_distinct(lines), lambda s: length(s))), 0)::BIGINT AS once FROM l)
SELECT DISTINCT src, rec_id, line_chars - once AS rep_line_chars, line_chars FROM n
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p6_lines": _P6,
        "p9_found": _P9 + "SELECT doc_id, span_start, span_end FROM found",
        "p9_share": _P9 + """SELECT f.doc_id, sum(span_end - span_start)::BIGINT AS shared_chars, d.n_chars,
            round(sum(span_end - span_start)::DOUBLE / d.n_chars, 6) AS share FROM found f JOIN documents d ON d.doc_id = f.doc_id GROUP BY f.doc_id, d.n_chars""",
    }
