"""Plain SQL for the queries that SQL can express, in the dialect of the checking engine."""

from __future__ import annotations

ORACLE = {
    "op2_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
    "op6_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        o AS (
            SELECT *, row_number() OVER w AS place, coalesce(lag(role) OVER w = role, false) AS merged,
                   length(replace(replace(text, '\', '\b'), '<|', '\l')) AS text_chars,
                   length(replace(replace(replace(role, '\', '\b'), '<|', '\l'), chr(10), '\n')) AS role_chars
            FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(text_chars + CASE WHEN merged THEN length('<|next|>')
                        ELSE length('<|turn|>') + role_chars + 1 + length('<|end|>') END) AS BIGINT) AS formatted_chars
        FROM o GROUP BY conv_id
    """,
    "op12_url_filter": r"""
        WITH p AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ),
        h AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM p
        ),
        rules (rule_host, rule_path, action) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        )
        SELECT page_id, host, path, hit.rule AS rule, coalesce(hit.action, 'allow') AS verdict
        FROM h LEFT JOIN LATERAL (
            SELECT rule_host || rule_path AS rule, action FROM rules
            WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC LIMIT 1
        ) AS hit ON true
    """,
    "op13_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
            FROM documents
        ),
        h AS (
            SELECT *, len(w) AS n, CAST('0x' || x[1:8] AS BIGINT) % (len(w) + 1) AS i, CAST('0x' || x[9:16] AS BIGINT) % (len(w) + 1) AS j,
                   t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || x[17:24] AS BIGINT) % 100 >= 90 AS plain,
                   CAST('0x' || x[25:32] AS BIGINT) % 100 < 20 AS spm
            FROM d
        ),
        c AS (
            SELECT *, array_to_string(w[1:least(i, j)], '') AS p, array_to_string(w[least(i, j) + 1:greatest(i, j)], '') AS m,
                   array_to_string(w[greatest(i, j) + 1:], '') AS s
            FROM h
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
               sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m
                      ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM c
    """,
}
