"""The queries of this package that DuckDB can express."""

from __future__ import annotations

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

STATEMENTS: dict[str, str] = {
    "op7_line_dedup": f"""
        WITH l AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
          FROM documents),
        k AS (
          SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM l),
        c AS (
          SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 40
          GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        m AS (
          SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keep_id AS dropped FROM k LEFT JOIN c ON k.key = c.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        WINDOW g AS (PARTITION BY t)""",
}
