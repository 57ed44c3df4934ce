"""Statements that DuckDB runs on the same tables, for the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), s AS (
    SELECT *, row_number() OVER w AS n, lag(role, 1, '') OVER w AS before, lead(role) OVER w AS after
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY n)) AS loss_sha256,
    sum(15 + length(CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
            WHEN 'System' THEN '\rSystem' WHEN 'User' THEN '\rUser' WHEN 'Assistant' THEN '\rAssistant'
            ELSE replace(replace(replace(replace(role, '\', '\s'), '</turn>', '\e'), '###', '\h'), ':', '\c') END)
        + length(replace(replace(replace(text, '\', '\s'), '</turn>', '\e'), '###', '\h')))::BIGINT AS formatted_chars,
    bool_and(CASE before WHEN '' THEN n = 1 AND role IN ('system', 'user') WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant'
            WHEN 'assistant' THEN role = 'user' ELSE false END) AND bool_or(after IS NULL AND role = 'assistant') AS valid
FROM s GROUP BY conv_id
"""

OP3 = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""

OP8 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

SQL: dict[str, str] = {"op2_chat_formatting": OP2, "op3_embedding_near_dedup": OP3, "op8_warc_transactions": OP8}
