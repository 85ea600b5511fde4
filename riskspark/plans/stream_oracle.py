"""The streaming queries as ANSI SQL over the given tables."""

from __future__ import annotations

from riskspark.plans.site_oracle import SCORED, band, half_up
from riskspark.plans.text_oracle import chunk_ctes

def verdicts(source: str) -> str:
    """CTEs that judge the rows of ``source``."""
    return f"""log AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS client, event_type AS path, ts,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM {source}),
w AS (
  SELECT event_id, client, path, k, true AS accepted,
    CAST(NULL AS TIMESTAMP) AS older, CAST(ts AS TIMESTAMP) AS newer FROM log WHERE k = 1
  UNION ALL
  SELECT event_id, client, path, k, ok, CASE WHEN ok THEN newer ELSE older END,
    CASE WHEN ok THEN ts ELSE newer END FROM (
    SELECT l.event_id, l.client, l.path, l.k, CAST(l.ts AS TIMESTAMP) AS ts, w.older, w.newer,
      w.older IS NULL OR w.older < l.ts - INTERVAL 1 DAY AS ok
    FROM w JOIN log l ON l.client = w.client AND l.path = w.path AND l.k = w.k + 1))"""


RATE = f"""WITH RECURSIVE {verdicts('events')}
SELECT event_id AS request_id, client, path, accepted FROM w"""

LATE = f"""WITH RECURSIVE late AS (
  SELECT * FROM events WHERE event_id % 50 = 0
    AND ts < (SELECT max(ts) FROM events) - INTERVAL 2 DAY),
timely AS (SELECT * FROM events WHERE event_id NOT IN (SELECT event_id FROM late)),
{verdicts('timely')}
SELECT event_id AS request_id, client, path, accepted, CAST(NULL AS VARCHAR) AS reason FROM w
UNION ALL SELECT event_id, CAST(user_id AS VARCHAR), event_type, NULL, 'late' FROM late"""


INGESTED = f"""WITH RECURSIVE {chunk_ctes()},
    r AS (SELECT *, row_number() OVER (PARTITION BY source, text
      ORDER BY doc_id % 3, doc_id, chunk_index) AS k FROM chunks)
    SELECT chunk_id, source, md5(text) AS text_md5 FROM r WHERE k = 1"""


def oracle_sql() -> dict[str, str]:
    return {
        "stream_scoring": f"""WITH {SCORED}
            SELECT site_id, {half_up('dose', 4)} AS dose_rate_usv_h, {band(1)} AS risk_level,
              {band(2)} AS advisory FROM scored""",
        "stream_ingest": INGESTED,
        "stream_ingest_restart": INGESTED,
        "rate_limit_audit": RATE,
        "rate_limit_stream": RATE,
        "rate_limit_late": LATE,
    }
