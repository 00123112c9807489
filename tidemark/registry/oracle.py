"""The same results in ANSI SQL, straight from the tables. No JSON is built or parsed on the way."""

from __future__ import annotations


def _window(seconds: int, time: str = "ts") -> str:
    micros = seconds * 1_000_000
    return f"make_timestamp((epoch_us({time}) // {micros}) * {micros})"


def _text(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%d %H:%M:%S')"


_TEN_MINUTES, _DAY = 600, 86_400

_KEPT = """
kept AS (
  SELECT event_id, ts, user_id, event_type,
         upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS event_name,
         CAST(props->>'$.k' AS BIGINT) % 10 AS digit,
         CASE user_id % 5 WHEN 0 THEN 'us' WHEN 1 THEN 'gb' WHEN 2 THEN 'fr'
                          WHEN 3 THEN 'de' ELSE 'es' END AS country
  FROM events WHERE user_id % 4 <> 0
)"""

_MENTIONS = f"""{_KEPT},
mentions AS (
  SELECT event_id, ts, country, event_type AS topic_key, event_name AS topic_name FROM kept
  UNION ALL
  SELECT event_id, ts, country, 'k' || digit, 'Topic ' || digit FROM kept
)"""


def _scores(seconds: int) -> str:
    start = _window(seconds)
    return f"""{_MENTIONS},
scores AS (
  SELECT {start} AS window_start, {start} + INTERVAL {seconds} SECOND AS window_end,
         topic_key, topic_name, CAST(count(*) AS BIGINT) AS score
  FROM mentions GROUP BY ALL
)"""


def _ranked(seconds: int, where: str = "") -> str:
    return f"""{_scores(seconds)},
ranked AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
             PARTITION BY window_start ORDER BY score DESC, topic_key, topic_name) AS rank
    FROM scores {where})
  WHERE rank <= 10
)"""


_RANKED_ROWS = f"""
SELECT {_text("window_start")} AS window_start, {_text("window_end")} AS window_end,
       topic_key, topic_name, score, CAST(rank AS BIGINT) AS rank,
       CAST(epoch(window_end) AS BIGINT) + 999 AS record_timestamp
FROM ranked"""


def _hot_topics(seconds: int) -> str:
    return f"WITH {_ranked(seconds)} {_RANKED_ROWS}"


_TOPIC_JSON = """'{"topic_key":"' || topic_key || '","topic_name":"' || topic_name
                  || '","score":' || score || '}'"""


def _documents(seconds: int) -> str:
    return f"""{_ranked(seconds)},
documents AS (
  SELECT CAST(epoch(window_end) AS BIGINT) + 999 AS timestamp, window_end,
         {_text("window_start")} AS window_start, {_text("window_end")} AS window_end_text,
         '[' || string_agg({_TOPIC_JSON}, ',' ORDER BY rank) || ']' AS topics
  FROM ranked GROUP BY ranked.window_start, ranked.window_end
)"""


_DOCUMENT_MESSAGE = """'{"category":"HOT_TOPICS","output":{"topics":' || topics
       || ',"timestamp":' || timestamp || ',"window":{"start":"' || window_start
       || '","end":"' || window_end_text || '"}}}'"""

_PANES = f"""{_MENTIONS},
numbered AS (
  SELECT event_id, {_window(_DAY)} AS window_start, topic_key, topic_name,
         row_number() OVER (PARTITION BY {_window(_DAY)}, topic_key, topic_name
                            ORDER BY ts, event_id) AS running_count
  FROM mentions
),
panes AS (
  SELECT {_text("window_start")} AS window_start,
         {_text("window_start + INTERVAL 1 DAY")} AS window_end, topic_key, topic_name,
         event_id, CAST(running_count // 5 AS BIGINT) AS pane,
         CAST(running_count AS BIGINT) AS running_count
  FROM numbered WHERE running_count % 5 = 0
)"""

_COUNTER_PANES = """
numbered AS (
  SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS running_count
  FROM events WHERE user_id % 4 <> 0
)
SELECT {columns} CAST(running_count // 2 AS BIGINT) AS pane,
       CAST(running_count AS BIGINT) AS running_count
FROM numbered WHERE running_count % 2 = 0"""


def _top(source: str, columns: str, order: str, n: int, per: str = "") -> str:
    partition = f"PARTITION BY {per}" if per else ""
    return f"""
SELECT {columns}, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER ({partition} ORDER BY {order}) AS rank FROM {source})
WHERE rank <= {n}"""


_COUNT = "SELECT CAST(count(*) AS BIGINT) AS events FROM events WHERE user_id % 4 <> 0"

_SHOWN_TOPICS = f"""WITH {_scores(_DAY)},
shown AS (SELECT * REPLACE (score - score % 5 AS score) FROM scores WHERE score >= 5),
ranked AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
             PARTITION BY window_start ORDER BY score DESC, topic_key, topic_name) AS rank
    FROM shown)
  WHERE rank <= 10
) {_RANKED_ROWS}"""

def _either(rows: str, keys: str, every: int, seconds: int) -> str:
    """Panes as a chain: each opens where the one before ended."""
    per = f"PARTITION BY {keys}" if keys else ""
    listed, same = (f"{keys}, ", f"USING ({keys}, i)") if keys else ("", "USING (i)")
    firing = f"USING ({keys}, i)" if keys else "USING (i)"
    last = f"JOIN (SELECT {listed}count(*) AS total FROM sequence GROUP BY ALL) " + (f"USING ({keys})" if keys else "ON true")
    return f"""{rows},
sequence AS (SELECT {listed}ts, row_number() OVER ({per} ORDER BY ts) AS i FROM source),
jumps AS (
  SELECT *, least(i + {every}, coalesce(due, total + 1)) AS next, i + {every} <= coalesce(due, total + 1) AS counted
  FROM (SELECT *, min(i) OVER ({per} ORDER BY ts RANGE BETWEEN INTERVAL {seconds} SECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS due
        FROM sequence) {last}
),
chain AS (
  SELECT {listed}i, next FROM jumps WHERE i = 1
  UNION ALL
  SELECT {", ".join(f"jumps.{k.strip()}" for k in keys.split(",")) + ", " if keys else ""}jumps.i, jumps.next FROM chain
  JOIN jumps ON jumps.i = chain.next{"".join(f" AND jumps.{k.strip()} = chain.{k.strip()}" for k in keys.split(",")) if keys else ""}
),
panes AS (
  SELECT {listed}CAST(jumps.next - 1 AS BIGINT) AS running_count, CASE WHEN counted THEN 'count' ELSE 'time' END AS fired_by,
         CASE WHEN counted THEN ended.ts ELSE jumps.ts + INTERVAL {seconds} SECOND END AS fired
  FROM chain JOIN jumps {same}
  LEFT JOIN (SELECT {listed}i - {every} + 1 AS i, ts FROM sequence) ended {firing}
)"""


_COUNTER_EITHER = _either("WITH RECURSIVE source AS (SELECT ts FROM events WHERE user_id % 4 <> 0)", "", 2, 30)

ORACLE: dict[str, str] = {
    "venue_events_count": f"{_COUNT} HAVING count(*) > 0",
    "hot_topics_10min": _hot_topics(_TEN_MINUTES),
    "hot_topics_1day": _hot_topics(_DAY),
    "hot_topics_strict": _hot_topics(_DAY),
    "hot_topics_event_time": _hot_topics(_DAY),
    "topic_scores": f"""WITH {_scores(_TEN_MINUTES)}
SELECT {_text("window_start")} AS window_start, {_text("window_end")} AS window_end,
       topic_key, topic_name, score FROM scores""",
    "topics_per_country": f"""WITH {_MENTIONS},
scores AS (
  SELECT {_window(_DAY)} AS window_start, country, topic_key, topic_name,
         CAST(count(*) AS BIGINT) AS score
  FROM mentions GROUP BY ALL
)
SELECT {_text("window_start")} AS window_start,
       {_text("window_start + INTERVAL 1 DAY")} AS window_end,
       country, topic_key, topic_name, score, CAST(rank AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY window_start, country
                                   ORDER BY score DESC, topic_key, topic_name) AS rank
      FROM scores)
WHERE rank <= 10""",
    "event_time_windows": f"""
SELECT {_text("window_start")} AS window_start,
       {_text("window_start + INTERVAL 10 MINUTE")} AS window_end,
       CAST(count(*) AS BIGINT) AS events
FROM (SELECT {_window(_TEN_MINUTES)} AS window_start FROM events WHERE user_id % 4 <> 0)
GROUP BY window_start""",
    "topic_count_panes": f"""WITH {_PANES}
SELECT window_start, window_end, topic_key, topic_name, pane, running_count FROM panes""",
    "topic_panes_fired": f"WITH {_PANES} SELECT * FROM panes",
    "hot_topics_from_panes": _SHOWN_TOPICS,
    "latest_pane_per_topic": f"""WITH {_PANES}
SELECT window_start, window_end, topic_key, topic_name,
       max(pane) AS pane, max(running_count) AS running_count
FROM panes GROUP BY ALL""",
    "counter_panes": "WITH " + _COUNTER_PANES.format(columns=""),
    "counter_panes_fired": "WITH " + _COUNTER_PANES.format(columns="event_id,"),
    "counter_panes_either": f"{_COUNTER_EITHER} SELECT running_count, fired_by, {_text('fired')} AS fired_at FROM panes",
    "stream_counter_either": f"""{_COUNTER_EITHER} SELECT running_count, fired_by, {_text("fired")} AS fired_at FROM panes
WHERE fired <= (SELECT max(ts) FROM source)""",
    "topic_panes_either": _either(
        f"""WITH RECURSIVE {_MENTIONS.strip()},
source AS (SELECT {_window(_DAY)} AS window_start, topic_key, topic_name, ts FROM mentions)""",
        "window_start, topic_key, topic_name", 5, 3600,
    )
    + f"""
SELECT {_text("window_start")} AS window_start, {_text("window_start + INTERVAL 1 DAY")} AS window_end, topic_key, topic_name,
       running_count, fired_by, {_text("fired")} AS fired_at
FROM panes""",
    "envelope_projection": """
SELECT event_id, epoch_us(ts) // 1000 AS timestamp,
       '{"event_id":' || event_id || ',"timestamp":' || (epoch_us(ts) // 1000)
       || ',"group":{"group_country":"'
       || CASE user_id % 5 WHEN 0 THEN 'us' WHEN 1 THEN 'gb' WHEN 2 THEN 'fr'
                           WHEN 3 THEN 'de' ELSE 'es' END
       || '","group_topics":[{"topic_name":"'
       || upper(substr(event_type, 1, 1)) || substr(event_type, 2)
       || '","urlkey":"' || event_type || '"},{"topic_name":"Topic '
       || CAST(props->>'$.k' AS BIGINT) % 10 || '","urlkey":"k'
       || CAST(props->>'$.k' AS BIGINT) % 10 || '"}]},"event":{"name":"' || event_type
       || '"},"response":"yes"'
       || CASE user_id % 4 WHEN 0 THEN '' WHEN 1 THEN ',"venue":null'
                           ELSE ',"venue":{"venue_id":' || user_id || '}' END
       || '}' AS value,
       CAST(event_id AS VARCHAR) AS id_attribute,
       CAST(epoch_us(ts) // 1000 AS VARCHAR) AS time_attribute
FROM events""",
    "parsed_messages": f"""WITH {_KEPT}
SELECT event_id, epoch_us(ts) // 1000 AS timestamp, country,
       '[{{"urlkey":"' || event_type || '","topic_name":"' || event_name
       || '"}},{{"urlkey":"k' || digit || '","topic_name":"Topic ' || digit || '"}}]' AS topics,
       'yes' AS response,
       CASE WHEN user_id % 4 > 1 THEN '{{"venue_id":' || user_id || '}}' END AS venue
FROM kept""",
    "venue_paths": """
SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'absent' WHEN 1 THEN 'null' ELSE 'object' END AS venue,
       CASE WHEN user_id % 4 > 1 THEN user_id END AS venue_id
FROM events""",
    "stream_tapped_windows": f"""
SELECT {_text("window_start")} AS window_start, {_text("window_start + INTERVAL 1 DAY")} AS window_end,
       CAST(count(*) AS BIGINT) AS rows, {_text("min(ts)")} AS first, {_text("max(ts)")} AS last
FROM (SELECT ts, {_window(_DAY)} AS window_start FROM events WHERE user_id % 4 <> 0) GROUP BY window_start""",
    "dedup_events": f"""
SELECT event_id, {_text("ts")} AS published FROM events WHERE user_id % 4 <> 0""",
    "quarantined_messages": """
SELECT event_id, CAST(user_id % 5 = 1 AS BIGINT) AS undecodable
FROM events WHERE user_id % 5 < 2""",
    "tapped_messages": f"""
SELECT CAST(count(*) AS BIGINT) AS rows, {_text("min(ts)")} AS first, {_text("max(ts)")} AS last
FROM events WHERE user_id % 4 <> 0""",
    "top_n_global": _top("orders", "o_orderkey, o_totalprice", "o_totalprice DESC, o_orderkey", 25),
    "smallest_n_global": _top("orders", "o_orderkey, o_totalprice", "o_totalprice, o_orderkey", 25),
    "top_n_derived_key": _top(
        "lineitem",
        "l_orderkey, l_linenumber, l_partkey, l_extendedprice",
        "abs(l_extendedprice - (SELECT max(p_retailprice) FROM part)), l_orderkey, l_linenumber",
        40,
    ),
    "top_n_large": _top("orders", "o_orderkey, o_totalprice", "o_totalprice DESC, o_orderkey", 5000),
    "top_n_large_per_key": _top(
        "lineitem",
        "l_returnflag, l_orderkey, l_linenumber, l_extendedprice",
        "l_extendedprice DESC, l_orderkey, l_linenumber",
        2000,
        "l_returnflag",
    ),
    "top_n_per_key": _top(
        "orders", "o_custkey, o_orderkey, o_totalprice", "o_totalprice DESC, o_orderkey", 3, "o_custkey"
    ),
    "smallest_n_per_key": _top(
        "lineitem",
        "l_partkey, l_orderkey, l_linenumber, l_extendedprice",
        "l_extendedprice, l_orderkey, l_linenumber",
        3,
        "l_partkey",
    ),
    "top_n_distinct": _top(
        """(SELECT * FROM (
              SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                           ORDER BY o_orderdate DESC, o_orderkey DESC) AS age
              FROM orders) WHERE age = 1)""",
        "o_custkey, o_orderpriority, o_orderkey, o_totalprice",
        "o_totalprice DESC, o_orderkey",
        2,
        "o_custkey",
    ),
    "top_n_list": f"""
SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY rank) AS orders
FROM ({_top("orders", "o_custkey, o_orderkey", "o_totalprice DESC, o_orderkey", 3, "o_custkey")})
GROUP BY o_custkey""",
    "top_n_comparator": """
WITH told AS (SELECT o_custkey, o_orderkey, CAST(o_orderkey AS VARCHAR) AS name FROM orders)
SELECT a.o_custkey, a.o_orderkey, CAST(1 + count(b.o_orderkey) AS BIGINT) AS rank
FROM told a LEFT JOIN told b ON a.o_custkey = b.o_custkey
  AND (b.name || a.name > a.name || b.name OR (b.name || a.name = a.name || b.name AND b.o_orderkey < a.o_orderkey))
GROUP BY a.o_custkey, a.o_orderkey HAVING count(b.o_orderkey) < 3""",
    "latest_by_key": """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS age FROM orders)
WHERE age = 1""",
    "hot_topics_documents": f"""WITH {_documents(_TEN_MINUTES)}
SELECT timestamp, window_start, window_end_text AS window_end, topics FROM documents""",
    "hot_topics_messages": f"""WITH {_documents(_TEN_MINUTES)}
SELECT {_DOCUMENT_MESSAGE} AS value FROM documents""",
    "counter_message": f"""
SELECT '{{"category":"GLOBAL_EVENTS","output":' || events || '}}' AS value
FROM ({_COUNT} HAVING count(*) > 0)""",
    "category_envelope_roundtrip": f"""WITH {_ranked(_DAY)}
SELECT 'HOT_TOPICS' AS category, CAST(epoch(window_end) AS BIGINT) + 999 AS timestamp,
       {_text("window_start")} AS window_start, CAST(rank AS BIGINT) AS rank,
       topic_key, topic_name, score
FROM ranked
UNION ALL
SELECT 'GLOBAL_EVENTS', 0, NULL, 0, NULL, NULL, events FROM ({_COUNT})""",
    "table_sink_roundtrip": """
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
       'c_custkey:INTEGER, c_nationkey:INTEGER, c_acctbal:FLOAT' AS declared
FROM customer""",
    "table_batches_once": """
SELECT o_orderkey, o_totalprice, o_orderpriority AS batch, CAST(0 AS BIGINT) AS differing FROM orders""",
    "stream_counter": _COUNT,
    "stream_hot_topics": _hot_topics(_TEN_MINUTES),
    "stream_hot_topics_from_panes": _SHOWN_TOPICS,
    "stream_store": f"""WITH {_documents(_DAY)}
SELECT timestamp, window_start, topics, CAST(0 AS BIGINT) AS events FROM documents
UNION ALL
SELECT 0, NULL, NULL, events FROM ({_COUNT})""",
    "stream_falling_rankings": f"""
WITH latest AS (
  SELECT {_window(_DAY)} AS window_start, 'k' || CAST(props->>'$.k' AS BIGINT) % 10 AS topic_key, CAST(props->>'$.k' AS BIGINT) AS score
  FROM events QUALIFY row_number() OVER (PARTITION BY {_window(_DAY)}, CAST(props->>'$.k' AS BIGINT) % 10 ORDER BY ts DESC) = 1
)
SELECT {_text("window_start")} AS window_start, topic_key, score,
       CAST(row_number() OVER (PARTITION BY window_start ORDER BY score DESC, topic_key) AS BIGINT) AS rank
FROM latest QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY score DESC, topic_key) <= 3""",
    "stream_store_aside": """
SELECT ['unknown category', 'unreadable output', 'not a JSON object', 'not UTF-8', 'not base64'][user_id % 6] AS reason, count(*) AS value
FROM events WHERE user_id % 6 > 0 GROUP BY reason
UNION ALL
SELECT 'stored', event_id FROM events WHERE user_id % 6 = 0 QUALIFY row_number() OVER (ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_final_hot_topics": f"""WITH {_documents(_DAY)}
SELECT {_DOCUMENT_MESSAGE} AS value FROM documents
WHERE window_end <= (SELECT max(ts) FROM kept) - INTERVAL 1 HOUR""",
    "stream_late_rows": f"""WITH {_MENTIONS},
closed AS (SELECT epoch_ms(max(ts)) - 3600000 AS until FROM mentions WHERE event_id % 10 <> 0),
days AS (SELECT *, {_window(_DAY)} AS window_start, {_window(_DAY)} + INTERVAL 1 DAY AS window_end FROM mentions)
SELECT {_text("window_start")} AS window_start, {_text("window_end")} AS window_end, topic_key, topic_name,
       count(*) FILTER (event_id % 10 <> 0 OR epoch_ms(window_end) > until) AS kept,
       count(*) FILTER (event_id % 10 = 0 AND epoch_ms(window_end) <= until) AS late
FROM days CROSS JOIN closed GROUP BY ALL""",
    "stream_topic_panes": f"""WITH {_PANES}
SELECT window_start, window_end, topic_key, topic_name, running_count, 'count' AS fired_by
FROM panes""",
    "stream_counter_panes": f"""
SELECT running_count, 'count' AS fired_by FROM (WITH {_COUNTER_PANES.format(columns="")})""",
    "stream_dedup": "SELECT event_id FROM events WHERE user_id % 4 <> 0",
    "stream_dedup_exact": f"SELECT event_id, {_text('ts')} AS published FROM events WHERE user_id % 4 <> 0",
    "stream_message_log": "SELECT event_id FROM events WHERE user_id % 4 <> 0",
    "stream_counter_timed": "SELECT CAST(count(*) AS BIGINT) AS events FROM events WHERE user_id % 4 <> 0",
    "stream_table_sink": """
SELECT CAST(event_id AS BIGINT) AS event_id, CASE user_id % 5 WHEN 0 THEN 'us' WHEN 1 THEN 'gb' WHEN 2 THEN 'fr'
       WHEN 3 THEN 'de' ELSE 'es' END AS country
FROM events WHERE user_id % 4 <> 0""",
    "quarantined_groups": "SELECT event_id FROM events WHERE user_id % 5 < 3",
    "dedup_by_attribute": f"""
SELECT event_id, epoch_us(ts) // 1000 AS sent, {_text("ts")} AS published FROM events WHERE user_id % 4 <> 0""",
    "dedup_without_ids": """
SELECT event_id, CAST(CASE WHEN user_id % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS times FROM events""",
    "resorted_list": """
SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey % 10 DESC, o_orderkey DESC) AS orders
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders)
WHERE n <= 3 GROUP BY o_custkey""",
}
