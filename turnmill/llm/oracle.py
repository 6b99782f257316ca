"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _FOLD.format("text") + ", '{}')"

# A window of every length from 1 to 13 that starts at a word.
_GROWN = ", ".join(
    " || ' ' || ".join(["word", *(f"lead(word, {j}) OVER place" for j in range(1, k))]) + f" AS w{k}"
    for k in range(2, 14)
)
_LENGTHS = ", ".join(str(k) for k in range(1, 14))
_COLUMNS = ", ".join(f"w{k}" for k in range(1, 14))

_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP6 = f"""
WITH docs AS (
  SELECT doc_id, {_WORDS.format(_PLAIN)} AS ws FROM documents
), doc_words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM docs
), grown AS (
  SELECT doc_id, pos, word AS w1, {_GROWN}
  FROM doc_words WINDOW place AS (PARTITION BY doc_id ORDER BY pos)
), items AS (
  SELECT item_id, {_WORDS.format(_PLAIN)} AS ws
  FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[k : k + 12], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS k
        FROM items WHERE len(ws) > 0)
), lengths AS (
  SELECT DISTINCT n FROM windows
), found AS (
  SELECT g.doc_id, g.pos, w.n, w.item_id
  FROM (SELECT doc_id, pos, unnest([{_LENGTHS}]) AS n, unnest([{_COLUMNS}]) AS win FROM grown) g
  JOIN windows w ON g.n = w.n AND g.win = w.win
), hits AS (
  SELECT doc_id, count(DISTINCT word_at) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word_at FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id,
       coalesce(len(d.ws), 0) AS n_words,
       coalesce(h.n_hit, 0) AS n_hit,
       coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= coalesce(len(d.ws), 0) AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN named m USING (doc_id)
"""

_SPACED = r"[^\x20\x09-\x0D]+"

def _components(width: int, percent: int, more: str = "") -> str:
    """Components of documents whose sets of `width`-word shingles are similar enough."""
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce({_WORDS.format(_SPACED)}, []) AS ws FROM documents
), doc_words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos, len(ws) AS n FROM docs
), shingles AS (
  SELECT DISTINCT doc_id, md5(shingle) AS shingle FROM (
    SELECT doc_id, pos, n, string_agg(word, ' ') OVER (
      PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {width - 1} FOLLOWING
    ) AS shingle FROM doc_words
  ) WHERE pos <= greatest(1, n - {width - 1})
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_n
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY 1, 2
  ) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * both_n >= {percent} * (p.n + q.n - both_n)
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.least AS component_id{more}
FROM documents d
LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT node AS doc_id, min(seen) AS least FROM reach GROUP BY node) c USING (doc_id)
"""


OP2 = _components(5, 75, ", d.doc_id = c.least AS kept")
OP12 = _components(3, 90)

ORACLE = {"op2_minmax_dedup": OP2, "op6_decontaminate": OP6, "op12_ngram_join": OP12}
