"""The same document queries as ANSI SQL over the given tables."""

from __future__ import annotations

from riskspark import schema as S
from riskspark.functions.text import ENGLISH_STOP_WORDS
from riskspark.operators.answers import EVIDENCE_LEAD, NO_EVIDENCE, PROMPT_RULES
from riskspark.plans.site_oracle import report_ctes
from riskspark.plans.site_oracle import half_up

SPACES = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
TOKEN = r"([\p{L}\p{N}_]{2,})"


def chunk_ctes(size: int = S.CHUNK_SIZE, overlap: int = S.CHUNK_OVERLAP) -> str:
    """Chunks by recursion over the start of each chunk; needs WITH RECURSIVE."""
    beyond = int(size * S.PERIOD_SHARE)
    window = f"substr(t, s + 1, {size})"
    stop = f"s + length({window}) - strpos(reverse({window}), ' .') - 1"
    end = f"""CASE WHEN s + {size} >= n THEN n
      WHEN strpos(reverse({window}), ' .') > 0 AND {stop} > s + {beyond} THEN {stop} + 1
      ELSE s + {size} END"""
    return f"""
norm AS (
  SELECT doc_id, source, trim(regexp_replace(text, '{SPACES}', ' ', 'g')) AS t FROM documents),
sized AS (SELECT doc_id, source, t, length(t) AS n FROM norm WHERE t <> ''),
cut AS (
  SELECT doc_id, source, t, n, CAST(0 AS BIGINT) AS s, CAST({end.replace('s +', '0 +')} AS BIGINT) AS e
  FROM sized
  UNION ALL
  SELECT doc_id, source, t, n, s, CAST({end} AS BIGINT) FROM (
    SELECT doc_id, source, t, n, greatest(s + 1, e - {overlap}) AS s FROM cut WHERE e < n)),
pieces AS (
  SELECT doc_id, source, s, trim(substr(t, s + 1, e - s)) AS text FROM cut),
numbered AS (
  SELECT doc_id, source, text,
         row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS chunk_index
  FROM pieces WHERE text <> ''),
chunks AS (
  SELECT printf('%012d-%06d', doc_id, chunk_index) AS chunk_id, doc_id, source, doc_id AS page,
         chunk_index, text FROM numbered)"""


def term_ctes(source: str, key: str, out: str) -> str:
    words = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)
    return f"""
{out}_words AS (
  SELECT {key}, list_filter(regexp_extract_all(lower(text), '{TOKEN}', 1),
         lambda w: w NOT IN ({words})) AS u FROM {source}),
{out}_grams AS (
  SELECT {key}, unnest(list_concat(u, list_transform(generate_series(1, len(u) - 1),
         lambda i: u[i] || ' ' || u[i + 1]))) AS term FROM {out}_words),
{out} AS (SELECT {key}, term, count(*) AS tf FROM {out}_grams GROUP BY ALL)"""


def weight_ctes(counts: str, key: str, out: str) -> str:
    return f"""
{out}_raw AS (SELECT {key}, term, tf * idf AS w FROM {counts} JOIN vocab USING (term)),
{out} AS (
  SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM {out}_raw)"""


VOCAB = f"""
vocab AS (
  SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df,
         ln((1.0 + (SELECT count(*) FROM chunks)) / (1.0 + count(*))) + 1.0 AS idf
  FROM counts GROUP BY term ORDER BY total DESC, term LIMIT {S.MAX_TERMS})"""
INDEX = f"""{chunk_ctes()}, {term_ctes('chunks', 'chunk_id', 'counts')}, {VOCAB},
{weight_ctes('counts', 'chunk_id', 'postings')}"""
PLAIN_QUESTIONS = "questions AS (SELECT item_id AS query_id, text AS question FROM benchmark)"
QUESTIONS = """questions AS (
  SELECT item_id AS query_id, text AS question FROM benchmark
  UNION ALL SELECT item_id + 1000000000, '   ' FROM benchmark
  UNION ALL SELECT item_id + 2000000000, 'qqqzzz vvvxxx' FROM benchmark)"""


def hits(questions: str) -> str:
    return f"""{INDEX}, {questions},
asked AS (SELECT query_id, question AS text FROM questions WHERE trim(question) <> ''),
{term_ctes('asked', 'query_id', 'asked_counts')},
{weight_ctes('asked_counts', 'query_id', 'query_weights')},
scored AS (
  SELECT query_id, chunk_id, {half_up('sum(p.weight * q.weight)', 8)} AS score
  FROM postings p JOIN query_weights q USING (term) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id DESC) AS rank
  FROM scored WHERE score > 0),
hits AS (
  SELECT query_id, rank, chunk_id, score, source, page, text,
         '[' || rank || ']' AS citation_id, source || ', page ' || page AS label
  FROM ranked JOIN chunks USING (chunk_id) WHERE rank <= {S.DEFAULT_TOP_K})"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def report_sql(snippet: str) -> str:
    """The report of every site, put together from scenarios, drivers and answers."""
    band = " ".join(f"WHEN '{label}' THEN {quoted(text)}" for _, label, text in S.RISK_BANDS)
    urgent = ", ".join(quoted(label) for _, label, _ in S.RISK_BANDS[-2:])
    return f"""WITH RECURSIVE {hits(PLAIN_QUESTIONS)}, {report_ctes()},
      a AS (SELECT query_id, string_agg(citation_id, ', ' ORDER BY rank) AS cited,
        string_agg({snippet}, ' ' ORDER BY rank) FILTER (WHERE rank <= {S.SNIPPETS}) AS found
        FROM hits GROUP BY query_id),
      answered AS (SELECT query_id, coalesce(cited, '') AS cited,
        coalesce({quoted(EVIDENCE_LEAD)} || found, {quoted(NO_EVIDENCE)}) AS answer
        FROM questions LEFT JOIN a USING (query_id)),
      parts AS (SELECT t.site_id, level, drivers, lines, answer, cited,
        CASE WHEN level IS NULL THEN 'Level: unknown.' ELSE 'Level: **' || level || '** at '
          || printf('%.3f', floor(dose * 1000 + 0.5) / 1000) || ' uSv/h. '
          || CASE level {band} END END AS head,
        CASE WHEN level IS NULL THEN '- Complete the record; it has no dose rate.'
          WHEN level IN ({urgent}) THEN '- Have the site reviewed before the next survey.' END AS step1,
        '- Measure ' || strongest || ' again; it weighs most.' AS step2,
        CASE WHEN coalesce(cited, '') = '' THEN
          '- Store a document that covers the question.' END AS step3
        FROM told t LEFT JOIN why USING (site_id)
        LEFT JOIN answered ON query_id = t.site_id % (SELECT count(*) FROM benchmark))
      SELECT site_id, '# Site ' || site_id || chr(10) || chr(10) || head
        || chr(10) || chr(10) || '## Drivers' || chr(10) || coalesce(drivers, 'Not explained.')
        || chr(10) || chr(10) || '## What if' || chr(10) || coalesce(lines, '')
        || chr(10) || chr(10) || '## Documents' || chr(10) || coalesce(answer
          || CASE WHEN cited <> '' THEN ' Sources: ' || cited ELSE '' END, 'Not asked.')
        || chr(10) || chr(10) || '## To do' || chr(10)
        || coalesce(nullif(concat_ws(chr(10), step1, step2, step3), ''), '- None.') || chr(10)
        AS report_markdown FROM parts"""


def oracle_sql() -> dict[str, str]:
    snippet = f"""citation_id || ' ' || CASE WHEN length(text) > {S.SNIPPET_CHARS}
      THEN rtrim(substr(text, 1, {S.SNIPPET_CHARS - 3})) || '...' ELSE text END"""
    return {
        "doc_chunks": f"""WITH RECURSIVE {chunk_ctes()}
            SELECT chunk_id, source, page, chunk_index, md5(text) AS text_md5,
              length(text) AS n_chars FROM chunks""",
        "chunk_dedup": f"""WITH RECURSIVE {chunk_ctes()},
            r AS (SELECT *, row_number() OVER (PARTITION BY source, text
              ORDER BY doc_id % 2, doc_id, chunk_index) AS k FROM chunks)
            SELECT chunk_id, source, md5(text) AS text_md5 FROM r WHERE k = 1""",
        "term_stats": f"""WITH RECURSIVE {chunk_ctes()},
            {term_ctes('chunks', 'chunk_id', 'counts')}, {VOCAB}
            SELECT term, total, df, {half_up('idf')} AS idf FROM vocab""",
        "tfidf_weights": f"""WITH RECURSIVE {INDEX}
            SELECT chunk_id, term, {half_up('weight')} AS weight FROM postings""",
        "search_topk": f"""WITH RECURSIVE {hits(PLAIN_QUESTIONS)}
            SELECT query_id, rank, chunk_id, {half_up('score')} AS score FROM hits""",
        "risk_report": report_sql(snippet),
        "search_stored_index": f"""WITH RECURSIVE {hits(PLAIN_QUESTIONS)}
            SELECT query_id, rank, chunk_id, {half_up('score')} AS score FROM hits""",
        "search_topk_per_question": f"""WITH RECURSIVE {hits(PLAIN_QUESTIONS)}
            SELECT query_id, rank, chunk_id, {half_up('score')} AS score FROM hits
            WHERE rank <= 1 + query_id % 4""",
        "citations": f"""WITH RECURSIVE {hits(PLAIN_QUESTIONS)}
            SELECT query_id, rank, citation_id, source, page, {half_up('score', 4)} AS score, label
            FROM hits""",
        "prompt_build": f"""WITH RECURSIVE {hits(QUESTIONS)},
            blocks AS (SELECT query_id, string_agg(citation_id || ' ' || label || chr(10) || text,
              chr(10) || chr(10) ORDER BY rank) AS passages FROM hits GROUP BY query_id)
            SELECT query_id, substr('Question: ' || question || chr(10) || chr(10) || 'Passages:'
              || chr(10) || coalesce(passages, '') || chr(10) || chr(10) || {quoted(PROMPT_RULES)},
              1, {S.PROMPT_CHARS}) AS prompt
            FROM questions LEFT JOIN blocks USING (query_id)""",
        "evidence_answer": f"""WITH RECURSIVE {hits(QUESTIONS)},
            a AS (SELECT query_id,
              string_agg({snippet}, ' ' ORDER BY rank) FILTER (WHERE rank <= {S.SNIPPETS}) AS found,
              string_agg(label, '; ' ORDER BY rank) AS cited, count(*) AS n
              FROM hits GROUP BY query_id)
            SELECT query_id, coalesce({quoted(EVIDENCE_LEAD)} || found, {quoted(NO_EVIDENCE)})
              AS answer, coalesce(cited, '') AS cited, coalesce(n, 0) AS n_context
            FROM questions LEFT JOIN a USING (query_id)""",
    }
