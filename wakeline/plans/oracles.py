"""ANSI SQL for every catalog query, to be run by another engine on the same tables."""

from __future__ import annotations

from wakeline.schema import CLEAN_RECORD, DETAIL, MINUTE, REJECTED, SENSORS
from wakeline.sources.wire import PAYLOAD

# Kinds and look-ups of the reports, stated here again so that a wrong one shows.
KINDS = (
    ("E-%33", "edge"),
    ("E-%13", "late"),
    ("E-%53", "late"),
    ("E-%73", "late"),
    ("E-%091", "replayed"),
    ("E-%1", "copied"),
)
FLIGHT = "AC-7-click"
PREFIXES = ("E-9", "E-47")

FEED = """
bounds AS (
  SELECT max(event_id) AS newest, min(epoch_us(ts) // 1000) AS first_ms, max(epoch_us(ts) // 1000) AS last_ms
  FROM events
),
base AS (
  SELECT event_id AS n, event_id % 100 AS k, user_id, event_type, value,
         'AC-' || (user_id % 50) AS aircraft,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS prop,
         ((epoch_us(ts) // 1000) - (SELECT first_ms FROM bounds)) * (SELECT newest FROM bounds)
           // (SELECT greatest(1, (last_ms - first_ms) // 1000) FROM bounds) AS event_ms
  FROM events
),
copies AS (
  SELECT *, 0 AS copy, 10 * n AS arrival_seq FROM base
  UNION ALL
  SELECT *, 1, 10 * n + CASE WHEN k = 51 THEN 305 ELSE 35 END FROM base WHERE n % 20 = 11
  UNION ALL
  SELECT * REPLACE (n - 3700 AS n), 2, 10 * n + 1 FROM base
  WHERE n % 1000 = 791 AND n > 3700 AND n < (SELECT newest FROM bounds)
),
shifted AS (
  SELECT *, CASE WHEN copy > 0 THEN 0
    WHEN k IN (7, 24, 27) THEN 3 WHEN k IN (13, 53, 73) THEN 12 WHEN k = 93 THEN 6
    WHEN k = 33 THEN 21 WHEN k = 83 THEN 22 WHEN k = 47 THEN 60 WHEN k = 23 THEN -4
    ELSE 0 END AS shift
  FROM copies
),
feed AS (
  SELECT arrival_seq, copy, n, k,
    CASE WHEN k IN (17, 43) THEN '' WHEN k = 37 THEN '   ' ELSE 'E-' || n END AS event_id,
    CASE WHEN k <> 57 THEN aircraft END AS aircraft_id,
    CASE WHEN k <> 77 THEN aircraft || '-' || event_type END AS flight_id,
    CASE WHEN k <> 97 THEN TIMESTAMP '2024-01-01' + to_milliseconds(event_ms - 1000 * shift) END AS event_time,
    (prop - 50)::DOUBLE AS latitude, (user_id % 360 - 180)::DOUBLE AS longitude,
    (400 * prop)::DOUBLE AS altitude_ft, (150 + 3 * prop)::DOUBLE AS ground_speed_kts,
    10 * value AS vertical_speed_fpm, (3 * prop)::DOUBLE AS heading_deg,
    CASE WHEN k NOT IN (3, 23, 43) THEN 600 + 2 * value END AS engine_temp_c,
    (40 + prop % 25)::DOUBLE AS oil_pressure_psi, (600 + 20 * prop)::DOUBLE AS fuel_flow_kg_h,
    (16800 - 160 * prop)::DOUBLE AS fuel_remaining_kg, -value AS outside_air_temp_c,
    (user_id % 12)::INTEGER AS kafka_partition,
    TIMESTAMP '2024-01-01' + to_milliseconds(arrival_seq * 100) AS proc_time
  FROM shifted
)"""

# Rows as they come back from the wire: broken texts are gone, a wrong type is NULL.
WIRE = """
wire AS (
  SELECT * REPLACE (CASE WHEN n % 100 <> 63 THEN engine_temp_c END AS engine_temp_c)
  FROM feed WHERE n % 100 NOT IN (31, 71)
)"""


def _tagged(source: str = "feed") -> str:
    return f"""
marks AS (
  SELECT *, max(event_time) OVER (ORDER BY arrival_seq ROWS UNBOUNDED PRECEDING)
            - INTERVAL 5 SECOND AS watermark
  FROM {source}
),
tagged AS (
  SELECT *,
    coalesce(engine_temp_c > 1000, FALSE) AS overheat,
    coalesce(event_time < watermark, FALSE) AS late,
    nullif(concat_ws(',',
      CASE WHEN event_id IS NULL OR trim(event_id) = '' THEN 'blank_event_id' END,
      CASE WHEN aircraft_id IS NULL OR trim(aircraft_id) = '' THEN 'missing_aircraft_id' END,
      CASE WHEN flight_id IS NULL OR trim(flight_id) = '' THEN 'missing_flight_id' END,
      CASE WHEN event_time IS NULL THEN 'missing_event_time' END,
      CASE WHEN engine_temp_c IS NULL THEN 'missing_engine_temp' END,
      CASE WHEN event_time < watermark - INTERVAL 15 SECOND THEN 'too_late' END), '')
      AS reject_reason
  FROM marks
)"""


def _dedup(source: str = "feed") -> str:
    return f"""{_tagged(source)},
clean AS (SELECT * FROM tagged WHERE reject_reason IS NULL),
chain AS (
  SELECT event_id, min(arrival_seq) AS seq FROM clean GROUP BY event_id
  UNION ALL
  SELECT c.event_id, min(x.arrival_seq) AS seq
  FROM chain c JOIN clean x ON x.event_id = c.event_id AND x.arrival_seq >= c.seq + 36000
  GROUP BY c.event_id, c.seq
),
accepted AS (SELECT DISTINCT seq FROM chain),
marked AS (
  SELECT t.*, coalesce(reject_reason, CASE WHEN a.seq IS NULL THEN 'duplicate' END) AS reason
  FROM tagged t LEFT JOIN accepted a ON a.seq = t.arrival_seq
),
first AS (SELECT * FROM marked WHERE reason IS NULL),
rejected AS (
  SELECT m.*, proc_time AS ingest_time, proc_time AS kafka_timestamp,
         count(*) OVER (PARTITION BY kafka_partition ORDER BY arrival_seq
                        ROWS UNBOUNDED PRECEDING) - 1 AS kafka_offset
  FROM marked m QUALIFY reason IS NOT NULL
),
minutes AS (
  SELECT aircraft_id, flight_id, date_trunc('minute', event_time) AS window_start,
    date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
    count(*) AS event_count,
    round(avg(ground_speed_kts), 6) AS avg_ground_speed_kts,
    max(ground_speed_kts) AS max_ground_speed_kts,
    round(avg(altitude_ft), 6) AS avg_altitude_ft, max(altitude_ft) AS max_altitude_ft,
    round(avg(engine_temp_c), 6) AS avg_engine_temp_c, max(engine_temp_c) AS max_engine_temp_c,
    round(avg(fuel_flow_kg_h), 6) AS avg_fuel_flow_kg_h,
    min(fuel_remaining_kg) AS min_fuel_remaining_kg,
    max(fuel_remaining_kg) AS max_fuel_remaining_kg,
    count(*) FILTER (WHERE late) AS late_count
  FROM first
  WHERE date_trunc('minute', event_time) + INTERVAL 1 MINUTE > watermark
  GROUP BY 1, 2, 3, 4
  HAVING window_end <= (SELECT max(event_time) - INTERVAL 5 SECOND FROM {source})
)"""


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def _over_feed(body: str) -> str:
    return f"WITH {FEED}\n{body}"


def _over_tagged(body: str) -> str:
    return f"WITH {FEED},{_tagged()}\n{body}"


def _over_replay(body: str) -> str:
    return f"WITH RECURSIVE {FEED},{_dedup()}\n{body}"


def _list(names) -> str:
    return ", ".join(names)


def _kinds() -> str:
    cases = " ".join(f"WHEN event_id LIKE '{like}' THEN '{kind}'" for like, kind in KINDS)
    return f"CASE {cases} ELSE 'other' END"


_LATE_DROP = "coalesce(reason LIKE '%too_late%', FALSE)"

ORACLES: dict[str, str] = {
    "minute_agg": _over_replay(f"SELECT {_list(MINUTE.fieldNames())} FROM minutes"),
    "detail_rows": _over_replay(
        f"SELECT {_list(DETAIL.fieldNames())} FROM (SELECT *, proc_time AS ingest_time FROM first)"
    ),
    "rejected_rows": f"""WITH RECURSIVE {FEED},
offsets AS (
  SELECT arrival_seq AS seq, row_number() OVER (PARTITION BY kafka_partition
    ORDER BY arrival_seq) - 1 AS kafka_offset FROM feed
),{_dedup()}
SELECT {_list(name if name != 'kafka_offset' else 'o.kafka_offset AS kafka_offset'
              for name in REJECTED.fieldNames())}
FROM (SELECT *, proc_time AS ingest_time, proc_time AS kafka_timestamp FROM marked) m
JOIN offsets o ON o.seq = m.arrival_seq
WHERE reason IS NOT NULL""",
    "clean_record": _over_replay(
        f"""SELECT {_list(CLEAN_RECORD)} FROM (
  SELECT * REPLACE ({_iso('event_time')} AS event_time,
                    strftime(watermark, '%H:%M:%S.%g') || 'Z' AS watermark),
         {_iso('proc_time')} AS ingest_time FROM first)"""
    ),
    "publish_records": _over_feed(
        f"""SELECT aircraft_id AS key, to_json({{{', '.join(
            f"'{name}': {_iso(name) if name == 'event_time' else name}" for name in PAYLOAD
        )}}})::VARCHAR AS value FROM feed"""
    ),
    "json_decode": _over_feed(f", {WIRE} SELECT arrival_seq, {_list(PAYLOAD)} FROM wire"),
    "overheat_flag": _over_feed(
        "SELECT arrival_seq, engine_temp_c, coalesce(engine_temp_c > 1000, FALSE) AS overheat"
        " FROM feed"
    ),
    "reject_reasons": _over_tagged("SELECT arrival_seq, event_id, reject_reason FROM tagged"),
    "clean_rows": _over_tagged(
        "SELECT arrival_seq, event_id, overheat, late FROM tagged WHERE reject_reason IS NULL"
    ),
    "rejected_lookup": _over_replay(
        f"""SELECT event_id, flight_id, event_time, proc_time AS ingest_time, reason FROM marked
WHERE reason IS NOT NULL AND (flight_id = '{FLIGHT}'
  OR {' OR '.join(f"event_id LIKE '{prefix}%'" for prefix in PREFIXES)})"""
    ),
    "stored_lookup": _over_replay(
        f"""SELECT event_id, flight_id, event_time, proc_time AS ingest_time, reason FROM marked
WHERE reason IS NOT NULL AND (flight_id = '{FLIGHT}'
  OR {' OR '.join(f"event_id LIKE '{prefix}%'" for prefix in PREFIXES)})"""
    ),
    "iso_format": _over_feed(
        f"""SELECT arrival_seq, {_iso('event_time')} AS event_text, {_iso('proc_time')} AS proc_text,
  proc_time FROM feed"""
    ),
    "running_watermark": _over_tagged("SELECT arrival_seq, event_time, watermark FROM marks"),
    "lateness_class": _over_tagged(
        """SELECT arrival_seq, CASE WHEN event_time < watermark - INTERVAL 15 SECOND THEN 'too_late'
  WHEN event_time < watermark THEN 'late'
  WHEN event_time < watermark + INTERVAL 5 SECOND THEN 'out_of_order'
  WHEN event_time IS NOT NULL THEN 'on_time' END AS lateness FROM marks"""
    ),
    "post_close_rows": _over_replay(
        """SELECT arrival_seq, event_id, event_time, watermark, late FROM first
WHERE date_trunc('minute', event_time) + INTERVAL 1 MINUTE <= watermark"""
    ),
    "first_copy": _over_replay("SELECT event_id, arrival_seq, proc_time FROM first"),
    "duplicate_copies": _over_replay(
        "SELECT event_id, arrival_seq, proc_time FROM marked WHERE reason = 'duplicate'"
    ),
    "dedup_ttl": _over_replay(
        """SELECT event_id, count(*) AS accepted, min(proc_time) AS first_at,
  max(proc_time) AS last_at FROM first GROUP BY event_id HAVING count(*) > 1"""
    ),
    "too_late_replay": _over_replay(
        """SELECT arrival_seq, event_id, reason FROM marked
WHERE copy > 0 AND reason LIKE '%too_late%'"""
    ),
    "replay_check": _over_replay(
        """, entered AS (
  SELECT event_id, aircraft_id, flight_id, date_trunc('minute', event_time) AS window_start
  FROM first WHERE date_trunc('minute', event_time) + INTERVAL 1 MINUTE > watermark
),
ids AS (
  SELECT aircraft_id, flight_id, window_start, count(DISTINCT event_id) AS ids
  FROM entered GROUP BY 1, 2, 3
),
counts AS (
  SELECT e.event_id, sum(i.ids)::BIGINT AS minute_before,
    sum(m.event_count)::BIGINT AS minute_after
  FROM entered e JOIN ids i USING (aircraft_id, flight_id, window_start)
  JOIN minutes m USING (aircraft_id, flight_id, window_start) GROUP BY 1
),
copies_of AS (
  SELECT event_id, count(*) FILTER (WHERE reason IS NULL) AS detail_rows,
    count(*) FILTER (WHERE reason = 'duplicate') AS duplicate_rows
  FROM marked WHERE reject_reason IS NULL GROUP BY event_id
  HAVING count(*) FILTER (WHERE reason = 'duplicate') > 0
)
SELECT event_id, detail_rows, duplicate_rows, coalesce(minute_before, 0) AS minute_before,
  coalesce(minute_after, 0) AS minute_after
FROM copies_of LEFT JOIN counts USING (event_id)"""
    ),
    "kind_report": _over_replay(
        f"""SELECT {_kinds()} AS kind, count(*) AS cnt,
  count(*) FILTER (WHERE overheat) AS overheat_true, count(*) FILTER (WHERE late) AS late_true
FROM first GROUP BY 1"""
    ),
    "reason_report": _over_replay(
        "SELECT reason, count(*) AS cnt FROM marked WHERE reason IS NOT NULL GROUP BY reason"
    ),
    "run_reasons": _over_replay(
        """SELECT reason, count(*) AS cnt FROM marked
WHERE reason IS NOT NULL AND (event_id LIKE 'E-1%'
  OR (aircraft_id = 'AC-7' AND (event_id IS NULL OR trim(event_id) = '')))
GROUP BY reason"""
    ),
    "flight_counts": _over_replay(
        "SELECT flight_id, count(*) AS cnt FROM first GROUP BY flight_id"
    ),
    "job_counters": f"""WITH RECURSIVE {FEED},{WIRE},{_dedup('wire')}
SELECT (SELECT count(*) FROM feed) AS ingested,
  (SELECT count(*) FROM feed) - count(*) AS parse_failed,
  count(*) AS decoded, count(*) FILTER (WHERE {_LATE_DROP}) AS late_dropped,
  count(*) FILTER (WHERE late AND NOT {_LATE_DROP}) AS late_accepted,
  count(*) FILTER (WHERE reason = 'duplicate') AS dedup_dropped,
  count(*) FILTER (WHERE reason IS NOT NULL AND NOT {_LATE_DROP} AND reason <> 'duplicate')
    AS defect_dropped,
  count(*) FILTER (WHERE reason IS NULL AND overheat) AS overheat_kept,
  count(*) FILTER (WHERE reason IS NULL) AS written
FROM marked""",
    "feed_counters": _over_tagged(
        """, told AS (SELECT aircraft_id, copy, overheat,
  copy = 0 AND coalesce(event_time < watermark + INTERVAL 5 SECOND, FALSE) AS behind FROM tagged)
SELECT aircraft_id, count(*) AS total,
  count(*) FILTER (WHERE copy = 0 AND NOT behind) AS normal,
  count(*) FILTER (WHERE behind) AS late,
  count(*) FILTER (WHERE copy > 0 AND NOT overheat) AS duplicate,
  count(*) FILTER (WHERE overheat) AS overheat
FROM told GROUP BY aircraft_id"""
    ),
    "latest_rows": _over_replay(
        f"""SELECT {_list(DETAIL.fieldNames())} FROM (SELECT *, proc_time AS ingest_time FROM first)
ORDER BY ingest_time DESC, event_id LIMIT 20"""
    ),
    "latest_rejected": _over_replay(
        """SELECT event_id, reason, proc_time AS ingest_time FROM marked WHERE reason IS NOT NULL
ORDER BY ingest_time DESC, event_id, reason LIMIT 20"""
    ),
    "latest_minutes": _over_replay(
        """SELECT aircraft_id, flight_id, window_start, event_count, late_count FROM minutes
ORDER BY window_start DESC, aircraft_id, flight_id LIMIT 20"""
    ),
    "reconcile_ids": _over_replay(
        """, sent AS (SELECT event_id, count(*) AS s FROM feed
  WHERE copy = 0 AND trim(event_id) <> '' GROUP BY event_id),
kept AS (SELECT event_id, count(*) AS c FROM first GROUP BY event_id)
SELECT count(s) AS produced, sum(c)::BIGINT AS rows, count(c) AS distinct_ids,
  count(*) FILTER (WHERE c IS NULL) AS missing, count(*) FILTER (WHERE s IS NULL) AS unexpected,
  (sum(c) - count(c))::BIGINT AS duplicate_rows,
  count(c) = count(*) AND count(s) = count(*) AND sum(c) = count(c) AS ok
FROM sent FULL JOIN kept USING (event_id)"""
    ),
    "lost_ids": _over_replay(
        """SELECT event_id FROM feed WHERE copy = 0 AND trim(event_id) <> ''
EXCEPT SELECT event_id FROM first"""
    ),
    "partition_skew": _over_feed(
        """SELECT kafka_partition, count(*) AS rows, count(*) / sum(count(*)) OVER () AS share,
  max(count(*)) OVER () / sum(count(*)) OVER () AS busiest_share
FROM feed GROUP BY kafka_partition"""
    ),
    "subtask_skew": _over_feed(
        """SELECT kafka_partition % 3 AS subtask, count(*) AS rows,
  count(*) / sum(count(*)) OVER () AS share,
  max(count(*)) OVER () / sum(count(*)) OVER () AS busiest_share
FROM feed GROUP BY 1"""
    ),
    "hot_key": _over_feed(
        """SELECT aircraft_id, count(*) AS rows, (SELECT count(*) FROM feed) AS total,
  count(*) / (SELECT count(*) FROM feed) AS share
FROM feed GROUP BY aircraft_id ORDER BY rows DESC, aircraft_id DESC NULLS LAST LIMIT 1"""
    ),
    "offset_progress": _over_feed(
        """, numbered AS (SELECT kafka_partition, row_number() OVER (PARTITION BY kafka_partition
  ORDER BY arrival_seq) - 1 AS o FROM feed)
SELECT kafka_partition, min(o) AS first_offset, max(o) AS last_offset,
  max(o) - min(o) + 1 AS delta, count(*) AS rows, count(*) = max(o) - min(o) + 1 AS complete
FROM numbered GROUP BY kafka_partition"""
    ),
    "throughput": _over_feed(
        """, t AS (SELECT count(*) AS rows,
  (epoch_ms(max(proc_time)) - epoch_ms(min(proc_time))) / 1000.0::DOUBLE AS elapsed_s FROM feed)
SELECT rows, elapsed_s, rows / elapsed_s AS rows_per_s FROM t"""
    ),
}
