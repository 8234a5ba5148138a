"""Shared CTEs: fixture adapter, stored events, enrichment, state tables."""

# --- fixed values: fixture parameters (same as fleetline.sources.fixture) ---
BASE_US = 1704067200000000
NOW_US = BASE_US + 6 * 3600 * 1000000
CUTOFF_US = BASE_US + 3 * 3600 * 1000000

ADAPTER = f"""
a AS (
  SELECT event_id AS eid, user_id, event_type, value,
    CAST(json_extract_string(props, '$.k') AS INT) AS k,
    {BASE_US} + ((epoch_us(ts) - {BASE_US}) // 120) AS t_us
  FROM events),
d AS (
  SELECT *, CAST(eid AS VARCHAR) AS event_id,
    concat('sensor-', lpad(CAST(user_id AS VARCHAR), 5, '0')) AS device_id,
    t_us + CASE WHEN eid % 20 = 0 THEN (30 + (eid * 7919) % 571) * 1000000 ELSE 200000 END AS recv_us,
    CASE WHEN event_type = 'error' THEN (CASE WHEN k % 2 = 0 THEN 'FAILED' ELSE 'WARNING' END) ELSE 'OK' END AS status,
    round(value - 45e0, 2) AS temperature,
    (960 + 5 * k) / 1e2 AS voltage,
    CASE (user_id + CASE WHEN eid % 97 = 0 THEN 1 ELSE 0 END) % 4
      WHEN 0 THEN 'us-east' WHEN 1 THEN 'us-west' WHEN 2 THEN 'eu-central' ELSE 'ap-south' END AS region
  FROM a),
adapter0 AS (
  SELECT *, recv_us AS arr_us, 0 AS attempt FROM d
  UNION ALL
  SELECT *, recv_us + 60000000, 1 FROM d WHERE eid % 50 = 7),
adapter AS (
  SELECT *, CAST(user_id % 3 AS INTEGER) AS src_partition,
    row_number() OVER (PARTITION BY user_id % 3 ORDER BY arr_us, eid, attempt) - 1 AS src_offset,
    arr_us + 50000 + CASE WHEN eid % 500 IN (11, 17) THEN 0 ELSE (eid % 97) * 70000 END AS proc_us
  FROM adapter0),
valid AS (
  SELECT * FROM adapter
  WHERE temperature BETWEEN -100 AND 250 AND eid % 200 <> 3 AND eid % 500 NOT IN (11, 13, 17)),
stored AS (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY arr_us, eid) AS seq,
    arr_us + 50000 + (eid % 97) * 70000 AS processed_us
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arr_us, attempt) AS rn FROM valid) x
  WHERE rn = 1),
enriched AS (
  SELECT s.*,
    coalesce((SELECT avg(p.temperature) FROM stored p
              WHERE p.device_id = s.device_id AND p.seq < s.seq
                AND p.t_us BETWEEN s.t_us - 300000000 AND s.t_us), s.temperature) AS avg5,
    coalesce((SELECT p.voltage FROM stored p
              WHERE p.device_id = s.device_id AND p.seq < s.seq
              ORDER BY p.t_us DESC, p.seq DESC LIMIT 1) - s.voltage >= 2.5, false) AS vdrop,
    (s.processed_us - s.t_us) // 1000 AS lag_ms,
    (s.temperature < -40 OR s.temperature > 140) AS outlier
  FROM stored s),
touch AS (
  SELECT event_id, max(arr_us) AS touch_us FROM valid GROUP BY event_id),
recent AS (
  SELECT s.device_id, s.event_id, s.t_us, s.temperature, s.voltage,
    row_number() OVER (PARTITION BY s.device_id ORDER BY t.touch_us DESC, s.event_id DESC) AS position
  FROM stored s JOIN touch t USING (event_id)),
status_state AS (
  SELECT device_id, region, t_us AS last_seen_us, status, temperature, voltage FROM (
    SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY t_us DESC, seq DESC) AS r FROM stored) x
  WHERE r = 1),
dead AS (
  SELECT 'raw-telemetry' AS source_topic, src_partition AS source_partition, src_offset AS source_offset,
    eid, arr_us, proc_us,
    CASE WHEN eid % 500 = 11 THEN 'invalid JSON: document is not well-formed JSON'
         WHEN eid % 500 = 17 THEN 'payload must be a JSON object'
         WHEN eid % 500 = 13 THEN 'unsupported schema_version: 999'
         ELSE 'validation failed: ' || concat_ws('; ',
           CASE WHEN eid % 200 = 3 AND (eid // 200) % 3 = 0 THEN 'event.device_id: field required' END,
           CASE WHEN eid % 200 = 3 AND (eid // 200) % 3 = 1 THEN 'event.timestamp: field required' END,
           CASE WHEN eid % 200 = 3 AND (eid // 200) % 3 = 2 THEN 'event.temperature: field required' END,
           CASE WHEN NOT (eid % 200 = 3 AND (eid // 200) % 3 = 2) AND NOT temperature BETWEEN -100 AND 250
                THEN 'event.temperature: input should be between -100 and 250' END)
    END AS reason,
    CASE WHEN eid % 500 = 17 OR (eid % 200 = 3 AND (eid // 200) % 3 = 0) THEN NULL ELSE device_id END AS replay_key
  FROM adapter
  WHERE NOT (temperature BETWEEN -100 AND 250 AND eid % 200 <> 3 AND eid % 500 NOT IN (11, 13, 17))),
replays AS (
  SELECT source_topic, source_partition, source_offset, {NOW_US} AS replayed_us FROM dead
  WHERE source_offset % 3 IN (0, 1)
  UNION ALL
  SELECT source_topic, source_partition, source_offset, {NOW_US} + 60000000 FROM dead
  WHERE source_offset % 3 = 1),
ledger AS (
  SELECT event_id, eid, device_id, processed_us AS created_us,
    CASE WHEN eid % 7 <> 0 THEN processed_us + 1000000 END AS published_us
  FROM stored)
"""

ENRICHED_COLUMNS = """event_id, device_id, t_us AS "timestamp", recv_us AS received_at,
  processed_us AS processed_at, round(temperature, 6) AS temperature, round(voltage, 6) AS voltage,
  status, region, (round(avg5, 6) + 0.0) AS avg_temperature_5m, vdrop AS voltage_drop_detected,
  lag_ms AS event_lag_ms, outlier AS outlier_detected"""


def with_base(body: str) -> str:
    """``WITH <fixture CTEs> <body>``; ``body`` may start with more CTEs (``, x AS (...)``)."""
    return f"WITH {ADAPTER}{body}"
