"""DuckDB SQL stating what each registered query must return.

They mirror the query parameters and the fixed delivery faults of the
events-derived topic (see ``tickwise.plans.events``): offsets advance by
2 per event, every 10th event is delivered twice, every 7th message is cut
in half, ``partition = user_id % 3``.
"""

from __future__ import annotations

from tickwise.plans.events import CORRUPT_EVERY, OFFSET_STRIDE, REPLAY_EVERY, TOPIC_PARTITIONS, field_sql
from tickwise.schemas import ENUMS, QUOTE_FIELDS

_TOPIC = f"""
payloads AS (
  SELECT event_id, ts, user_id, event_type, value,
         '{{"id":"' || event_type || '","price":' || CAST(CAST(value AS FLOAT) AS VARCHAR)
           || ',"time":"' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '"}}' AS j
  FROM events
),
deliveries AS (
  SELECT *, 0 AS copy FROM payloads
  UNION ALL
  SELECT *, 1 AS copy FROM payloads WHERE event_id % {REPLAY_EVERY} = 0
),
topic AS (
  SELECT
    CASE WHEN event_id % {CORRUPT_EVERY} = 0 THEN substr(j, 1, length(j) // 2) ELSE j END AS value,
    CAST(user_id % {TOPIC_PARTITIONS} AS INTEGER) AS "partition",
    event_id * {OFFSET_STRIDE} + copy AS "offset",
    ts AS "timestamp",
    event_id % {CORRUPT_EVERY} = 0 AS broken,
    event_type, CAST(value AS FLOAT) AS price
  FROM deliveries
),
parsed AS (
  SELECT
    CASE WHEN broken THEN NULL ELSE event_type END AS stock_ticker,
    CASE WHEN broken THEN NULL ELSE date_trunc('millisecond', "timestamp") END AS "timestamp",
    CASE WHEN broken THEN NULL ELSE price END AS price,
    "partition", "offset",
    CASE WHEN broken THEN 'malformed' ELSE NULL END AS reason
  FROM topic
),
valid AS (
  SELECT stock_ticker, "timestamp", price, "partition", "offset" FROM parsed WHERE reason IS NULL
),
ticks AS (
  SELECT stock_ticker, "timestamp",
         arg_min(price, "offset") AS price,
         arg_min("partition", "offset") AS "partition",
         min("offset") AS "offset"
  FROM valid GROUP BY stock_ticker, "timestamp"
)"""


def _with(*extra: str) -> str:
    parts = [_TOPIC.strip()] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(parts) + "\n"


def _tumbling(src: str) -> str:
    return (
        "SELECT stock_ticker, time_bucket(INTERVAL '5 minutes', \"timestamp\") + INTERVAL '5 minutes' AS \"timestamp\", "
        f"round(avg(CAST(price AS DOUBLE)), 6) AS price FROM {src} GROUP BY 1, 2"
    )


_UPSERT_CTES = (
    """split AS (SELECT max("timestamp") - INTERVAL 10 DAYS AS s FROM ticks)""",
    """target AS (""" + _tumbling("""(SELECT * FROM ticks WHERE "timestamp" < (SELECT s FROM split))""") + ")",
    """updates AS (""" + _tumbling(
        """(SELECT * FROM ticks WHERE "timestamp" >= (SELECT s FROM split) - INTERVAL 7 MINUTES)"""
    ) + ")",
)

_LAG_CTES = (
    """ends AS (SELECT "partition", max("offset") + 1 AS end_offset FROM topic GROUP BY 1)""",
    """committed AS (
  SELECT "partition", max("offset") + 1 AS committed_offset FROM topic
  WHERE "timestamp" < (SELECT max("timestamp") FROM topic) - INTERVAL 12 HOURS GROUP BY 1)""",
    """lag AS (
  SELECT e."partition", coalesce(c.committed_offset, 0) AS committed_offset, e.end_offset,
         greatest(e.end_offset - coalesce(c.committed_offset, 0), 0) AS lag
  FROM ends e LEFT JOIN committed c ON e."partition" = c."partition")""",
)

TUMBLING_SQL = _with() + _tumbling("ticks")

_MARKET_HOURS = """
quotes AS (
  SELECT event_id, event_type, CAST(value AS FLOAT) AS price, epoch_us(ts) // 1000 AS ms, code,
         CASE code WHEN 0 THEN 'PRE_MARKET' WHEN 1 THEN 'REGULAR_MARKET' WHEN 2 THEN 'POST_MARKET'
                   WHEN 3 THEN 'EXTENDED_HOURS_MARKET' END AS market_hours
  FROM (
    SELECT *, CASE WHEN m < 60 THEN 2 WHEN m < 540 THEN 3 WHEN m < 870 THEN 0 WHEN m < 1260 THEN 1 ELSE 2 END AS code
    FROM (SELECT *, hour(ts) * 60 + minute(ts) AS m FROM events)
  )
)"""

_SQL_TYPE = {"string": "varchar", "float": "float", "double": "double", "sint64": "bigint"}


def _present(name: str, number: int, kind: str) -> str:
    """A field's value, null where it is absent or holds the default."""
    value = f"({field_sql(number, kind)})::{_SQL_TYPE.get(kind, 'varchar')}"
    if kind == "string":
        return f"nullif({value}, '')"
    if kind.startswith("enum:"):
        first = ENUMS[kind[5:]].get(0)
        return f"nullif({value}, '{first}')" if first else value
    return f"nullif({value}, 0)"


def _json_part(name: str, number: int, kind: str) -> str:
    parts = name.split("_")
    key = parts[0] + "".join(p[:1].upper() + p[1:] for p in parts[1:])
    quote = '"' if kind in ("string", "sint64") or kind.startswith("enum:") else ""
    return f"""case when "{name}" is not null then '"{key}":{quote}' || "{name}"::varchar || '{quote}' end"""


_ALL_FIELDS = "SELECT event_id, " + ", ".join(f'{_present(*f)} AS "{f[0]}"' for f in QUOTE_FIELDS) + " FROM events"


def _enum_case(enum: str) -> str:
    whens = " ".join(f"WHEN {c} THEN '{n}'" for c, n in sorted(ENUMS[enum].items()))
    return f"CASE code {whens} END AS \"{enum}\""


ORACLE_SQL: dict[str, str] = {
    "decode_frames_all": "SELECT event_id, "
    + ", ".join(f'"{name}"' + ("::varchar" if kind == "sint64" else "") + f' AS "{name}"' for name, _, kind in QUOTE_FIELDS)
    + f" FROM ({_ALL_FIELDS})",
    "encode_quotes_all": "SELECT event_id, '{' || concat_ws(',', " + ", ".join(_json_part(*f) for f in QUOTE_FIELDS)
    + f") || '}}' AS json FROM ({_ALL_FIELDS})",
    "enum_names_all": "SELECT code, count(*) AS events, " + ", ".join(_enum_case(e) for e in ENUMS)
    + " FROM (SELECT CAST(event_id % 1100 AS INTEGER) AS code FROM events) GROUP BY code",
    "encode_quotes": "WITH " + _MARKET_HOURS.strip() + """
SELECT event_id,
  '{"id":"' || event_type || '"'
  || CASE WHEN price = 0 THEN '' ELSE ',"price":' || CAST(price AS VARCHAR) END
  || ',"time":"' || CAST(ms AS VARCHAR) || '"'
  || CASE WHEN code = 0 THEN '' ELSE ',"marketHours":"' || market_hours || '"' END
  || '}' AS json
FROM quotes""",
    "decode_frames": "WITH " + _MARKET_HOURS.strip() + """
SELECT event_id, event_type AS id, nullif(price, 0) AS price, ms AS "time",
       CASE WHEN code = 0 THEN NULL ELSE market_hours END AS market_hours
FROM quotes""",
    "enum_names": "WITH " + _MARKET_HOURS.strip() + """
SELECT CAST(code AS INTEGER) AS market_hours_code, market_hours, count(*) AS ticks FROM quotes GROUP BY 1, 2""",
    "batch_topic_read": _with(*_LAG_CTES) + """SELECT t."partition", t."offset", t.value, t."timestamp"
FROM topic t JOIN lag l ON t."partition" = l."partition"
WHERE t."offset" >= l.committed_offset AND t."offset" < l.end_offset""",
    "parse_ticks": _with() + "SELECT * FROM parsed",
    "valid_ticks": _with() + "SELECT * FROM valid",
    "rejected_ticks": _with() + "SELECT * FROM parsed WHERE reason IS NOT NULL",
    "dedup_ticks": _with() + "SELECT * FROM ticks",
    "tumbling_mean": TUMBLING_SQL,
    "mean_per_key": _with() + "SELECT stock_ticker, round(avg(CAST(price AS DOUBLE)), 6) AS price FROM ticks GROUP BY 1",
    "watchlist": _with() + "SELECT * FROM ticks WHERE stock_ticker IN ('click', 'purchase', 'view')",
    "message_rate": _with()
    + """SELECT time_bucket(INTERVAL '60 seconds', "timestamp") AS interval_start,
       count(*) AS messages,
       array_to_string(list(CAST("offset" AS VARCHAR) ORDER BY "timestamp", "partition", "offset")[1:4], ',') AS example_offsets,
       array_to_string(list(value ORDER BY "timestamp", "partition", "offset")[1:4], chr(10)) AS example_messages
FROM topic GROUP BY 1""",
    "message_rate_all": _with("""rates AS (
  SELECT time_bucket(INTERVAL '60 seconds', "timestamp") AS interval_start, count(*) AS messages,
    array_to_string(list(CAST("offset" AS VARCHAR) ORDER BY "timestamp", "partition", "offset")[1:4], ',') AS example_offsets
  FROM topic GROUP BY 1)""")
    + """SELECT e.interval_start, coalesce(messages, 0) AS messages, coalesce(example_offsets, '') AS example_offsets
FROM (SELECT unnest(generate_series(min(interval_start), max(interval_start), INTERVAL '60 seconds')) AS interval_start FROM rates) e
LEFT JOIN rates r ON r.interval_start = e.interval_start""",
    "topic_extent": _with() + """SELECT "partition", count(*) AS records, min("offset") AS first_offset,
       max("offset") + 1 AS end_offset FROM topic GROUP BY 1""",
    "topic_end_offsets": _with() + """SELECT "partition", max("offset") + 1 AS end_offset FROM topic GROUP BY 1""",
    "topic_lag": _with(*_LAG_CTES) + "SELECT *, lag >= 25 AS ready FROM lag",
    "topic_ready": _with(*_LAG_CTES)
    + """SELECT coalesce(bool_or(lag >= 25), false) AS ready, CAST(coalesce(sum(lag), 0) AS BIGINT) AS total_lag,
       CAST(count_if(lag >= 25) AS BIGINT) AS partitions_ready, count(*) AS partitions FROM lag""",
    "latest_offsets": _with()
    + """SELECT "partition", max("offset") AS "offset", max("timestamp") AS "timestamp" FROM topic t
WHERE "timestamp" = (SELECT max("timestamp") FROM topic t2 WHERE t2."partition" = t."partition")
GROUP BY 1""",
    "upsert_latest": _with(*_UPSERT_CTES)
    + """SELECT * FROM updates
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM updates u WHERE u.stock_ticker = t.stock_ticker AND u."timestamp" = t."timestamp")""",
    "upsert_frames": _with(*_UPSERT_CTES)
    + """SELECT * FROM updates
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM updates u WHERE u.stock_ticker = t.stock_ticker AND u."timestamp" = t."timestamp")""",
    "target_key_violations": _with(*_UPSERT_CTES)
    + """SELECT stock_ticker, "timestamp", count(*) AS copies,
       stock_ticker IS NULL OR "timestamp" IS NULL AS null_key,
       CAST(count_if(price IS NULL) AS BIGINT) AS null_values
FROM (SELECT * FROM target UNION ALL SELECT * FROM updates)
GROUP BY 1, 2
HAVING count(*) > 1 OR stock_ticker IS NULL OR "timestamp" IS NULL OR count_if(price IS NULL) > 0""",
    "stage_counts": _with()
    + """SELECT * FROM (
  SELECT 0 AS step, 'records' AS stage, (SELECT count(*) FROM topic) AS rows
  UNION ALL SELECT 1, 'valid', (SELECT count(*) FROM valid)
  UNION ALL SELECT 2, 'deduplicated', (SELECT count(*) FROM ticks)
  UNION ALL SELECT 3, 'windows', (SELECT count(*) FROM (""" + _tumbling("ticks") + """)))""",
}
