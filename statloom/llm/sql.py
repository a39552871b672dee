"""DuckDB SQL for the operators that SQL can express, by plain enumeration."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Every window of every item looked up among all windows of its length.
HITS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS s FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT doc_id, k, dw.n, item FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string, one bit a step."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda k: list_concat([ascii({text}[k])], [-1, -1, -1, -1, -1, -1, -1, -1])))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"
