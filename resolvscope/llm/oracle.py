"""SQL twins (DuckDB) of the corpus queries that SQL can express."""

from __future__ import annotations

import re

from resolvscope.llm.chat import CONTROLS, END, HEAD, JOINER, START

_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# Windows of each length that items have are looked up at every place of a document.
OP4 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS id, {_WORDS} AS w FROM benchmark),
places AS (SELECT id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
wins AS MATERIALIZED (SELECT DISTINCT id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS g FROM places),
sizes AS (SELECT DISTINCT k FROM wins),
spots AS (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN sizes ON len(w) >= k),
hits AS MATERIALIZED (
    SELECT s.rid, s.i, s.k, wins.id
    FROM (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM spots) s JOIN wins ON s.k = wins.k AND s.g = wins.g
),
hit_words AS (
    SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, unnest(range(i, i + k)) AS at FROM hits) GROUP BY rid
),
hit_items AS (
    SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, id FROM hits) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(a.n, 0) AS n_hit, coalesce(b.n, 0) AS n_items,
    sha256(coalesce(b.ids, '')) AS items_sha256, coalesce(a.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words a USING (rid) LEFT JOIN hit_items b USING (rid)
"""

_REST = "|".join(re.escape(c[1:]) for c in sorted(CONTROLS, key=len, reverse=True))
# Marks of a turn, and a joiner for each control string in its role or text.
_MARKS = len(START + HEAD + END)


def _escapes(column: str) -> str:
    return f"len(regexp_extract_all({column}, '[<\\[]{JOINER}*(?:{_REST})'))"


OP7 = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum({_MARKS} + length(role) + length(text) + {_escapes("role")} + {_escapes("text")}) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""

ORACLE = {"op4_decontaminate": OP4, "op7_chat": OP7}
