"""Near-duplicates and repeated strings as plain SQL, by their definitions."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def near_duplicates_sql(shingle: int = 4, percent: int = 80) -> str:
    """All pairs that share a shingle, and what is reachable over their links."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}',
        '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(words) >= {shingle} THEN list_distinct(list_transform(
          range(1, len(words) - {shingle - 2}),
          lambda i: array_to_string(list_slice(words, i, i + {shingle - 1}), ' ')))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * k >= {percent} * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS start, doc_id AS reached FROM documents
      UNION SELECT r.start, e.b FROM r JOIN e ON e.a = r.reached),
m AS (SELECT start AS doc_id, min(reached) AS component_id FROM r GROUP BY start)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
  doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""


def repeats_sql(length: int = 50) -> str:
    """Every start of every text; the kept bytes are joined as hexadecimal digits."""
    return rf"""
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
u AS (SELECT doc_id, raw, hex(raw) AS h, octet_length(raw) AS n FROM t),
w AS (SELECT doc_id, p, array_slice(raw, p + 1, p + {length}) AS g
      FROM (SELECT doc_id, raw, unnest(range(n - {length - 1})) AS p FROM u WHERE n >= {length})),
m AS (SELECT g, min(doc_id) AS first_doc FROM w GROUP BY g),
c AS (SELECT doc_id, p FROM w JOIN m USING (g) WHERE doc_id > first_doc),
o AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {length}
        THEN 0 ELSE 1 END AS new FROM c),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM o),
sp AS (SELECT doc_id, min(p) AS start, max(p) + {length} AS stop FROM i GROUP BY doc_id, island),
bounds AS (SELECT doc_id, coalesce(lag(stop) OVER x, 0) AS a, start AS b FROM sp
           WINDOW x AS (PARTITION BY doc_id ORDER BY start)
  UNION ALL SELECT doc_id, coalesce(max(stop), 0), any_value(n)
            FROM u LEFT JOIN sp USING (doc_id) GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept
      FROM bounds JOIN u USING (doc_id) GROUP BY doc_id),
z AS (SELECT doc_id, sum(stop - start) AS removed, count(*) AS spans FROM sp GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM u JOIN k USING (doc_id) LEFT JOIN z USING (doc_id)
"""
