"""The queries of the catalog as DuckDB SQL over the same tables, for checking results.

Every statement starts from ``events`` alone and states the views it needs itself. Sums
are cast, as DuckDB widens sums of whole numbers.
"""

SENSOR_DATA = """
sensor_data AS (
  SELECT id, gateway_id, device_id, temperature, humidity, "timestamp",
         CASE WHEN temperature >= 70 THEN 'ANOMALY' ELSE 'NORMAL' END AS classification
  FROM (
    SELECT event_id AS id,
           'gw_' || CAST(user_id % 4 AS VARCHAR) AS gateway_id,
           'sensor_' || CAST(user_id AS VARCHAR) AS device_id,
           ROUND(20 + value % 60, 2) AS temperature,
           CAST(30 + CAST(json_extract_string(props, '$.k') AS BIGINT) % 60 AS DOUBLE) AS humidity,
           ts AS "timestamp"
    FROM events
  )
)"""

ANOMALIES = """
anomalies AS (SELECT * FROM sensor_data WHERE classification = 'ANOMALY')"""

DEVICES = """
devices AS (
  SELECT CAST(split_part(device_id, '_', 2) AS BIGINT) AS id, device_id, md5(device_id) AS api_key,
         CAST(split_part(device_id, '_', 2) AS BIGINT) % 10 <> 0 AS active,
         MIN("timestamp") AS registered_at
  FROM sensor_data GROUP BY device_id
)"""

LOGS = """
logs AS (
  SELECT id, gateway_id AS source, device_id || ' → ' || classification AS message, "timestamp"
  FROM sensor_data
)"""

COUNTERS = """
counters AS (
  SELECT id, gateway_id, "timestamp",
         ROW_NUMBER() OVER w AS version,
         ROW_NUMBER() OVER w AS total_processed,
         CAST(SUM(CASE WHEN classification = 'ANOMALY' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS total_anomalies
  FROM sensor_data
  WINDOW w AS (PARTITION BY gateway_id ORDER BY "timestamp", id ROWS UNBOUNDED PRECEDING)
)"""

STATE_UPDATES = """
published AS (
  SELECT gateway_id, version, total_processed, total_anomalies, "timestamp" AS last_updated,
         (id * 7919) % 1000003 AS arrival_seq
  FROM counters
  QUALIFY ROW_NUMBER() OVER (
    PARTITION BY gateway_id, time_bucket(INTERVAL 3 SECONDS, "timestamp", TIMESTAMP '1970-01-01')
    ORDER BY version DESC) = 1
),
newest AS (
  SELECT * FROM published QUALIFY ROW_NUMBER() OVER (PARTITION BY gateway_id ORDER BY version DESC) = 1
),
state_updates AS (
  SELECT * FROM published
  UNION ALL
  SELECT gateway_id, version, total_processed, total_anomalies + 1000, last_updated, 2000000 FROM newest
  UNION ALL
  SELECT gateway_id, 1, total_processed, 0, last_updated, 3000000 FROM newest
)"""

GATEWAY_STATE = """
gateway_state AS (
  SELECT gateway_id, version, total_processed, total_anomalies, last_updated
  FROM state_updates
  QUALIFY ROW_NUMBER() OVER (PARTITION BY gateway_id ORDER BY version DESC, arrival_seq) = 1
)"""

RAW_MESSAGES = """
raw_messages AS (
  SELECT id, gateway_id,
    CASE WHEN id % 97 = 0 THEN substr('{' || d || ',' || t || ',' || h || ',' || s || '}', 1, 20)
         WHEN id % 101 = 0 THEN '{' || d || ',' || t || ',' || s || '}'
         WHEN id % 103 = 0 THEN '{' || d || ',"temperature":"' || CAST(temperature AS VARCHAR) || '",' || h || ',' || s || '}'
         WHEN id % 107 = 0 THEN '{' || d || ',' || t || ',' || h || ',"timestamp":"bad"}'
         WHEN id % 109 = 0 THEN '{' || d || ',"temperature":"nan",' || h || ',' || s || '}'
         WHEN id % 113 = 0 THEN '{' || d || ',' || t || ',"humidity":"-Infinity",' || s || '}'
         ELSE '{' || d || ',' || t || ',' || h || ',' || s || '}' END AS value
  FROM (
    SELECT id, gateway_id, temperature,
           '"device_id":"' || device_id || '"' AS d,
           '"temperature":' || CAST(temperature AS VARCHAR) AS t,
           '"humidity":' || CAST(humidity AS VARCHAR) AS h,
           '"timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '"' AS s
    FROM sensor_data
  )
)"""

# Unlike the Spark side this reads the four fields as text and casts them, which is
# enough for the kinds of damage the raw messages hold.
DECODED = """
decoded AS (
  SELECT id, gateway_id, value,
         json_extract_string(j, '$.device_id') AS device_id,
         TRY_CAST(json_extract_string(j, '$.temperature') AS DOUBLE) AS temperature,
         TRY_CAST(json_extract_string(j, '$.humidity') AS DOUBLE) AS humidity,
         TRY_CAST(json_extract_string(j, '$.timestamp') AS TIMESTAMP) AS "timestamp",
         CASE WHEN j IS NULL THEN 'malformed_json'
              WHEN json_extract_string(j, '$.device_id') IS NULL THEN 'missing_device_id'
              WHEN json_extract_string(j, '$.temperature') IS NULL THEN 'missing_temperature'
              WHEN json_extract_string(j, '$.humidity') IS NULL THEN 'missing_humidity'
              WHEN json_extract_string(j, '$.timestamp') IS NULL THEN 'missing_timestamp'
              WHEN NOT coalesce(isfinite(TRY_CAST(json_extract_string(j, '$.temperature') AS DOUBLE)), false)
                THEN 'bad_temperature'
              WHEN NOT coalesce(isfinite(TRY_CAST(json_extract_string(j, '$.humidity') AS DOUBLE)), false)
                THEN 'bad_humidity'
              WHEN TRY_CAST(json_extract_string(j, '$.timestamp') AS TIMESTAMP) IS NULL THEN 'bad_timestamp'
         END AS reason
  FROM (SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM raw_messages)
),
valid AS (
  SELECT id, gateway_id, device_id, temperature, humidity, "timestamp" FROM decoded WHERE reason IS NULL
),
stored AS (
  SELECT *, CASE WHEN temperature >= 70 THEN 'ANOMALY' ELSE 'NORMAL' END AS classification FROM valid
)"""

REQUESTS = """
validate_requests AS (
  SELECT id, CASE WHEN id % 50 = 0 THEN 'unknown' ELSE md5(device_id) END AS api_key FROM sensor_data
),
register_requests AS (
  SELECT id + 1 AS request_seq, id * 2 AS device_number FROM devices
  UNION ALL SELECT MAX(id) + 2, MIN(id) * 2 FROM devices HAVING COUNT(*) > 0
  UNION ALL SELECT MAX(id) + 3, -1 FROM devices HAVING COUNT(*) > 0
),
answers AS (
  SELECT request_seq, device_number, n.device_id,
         CASE WHEN n.device_id IS NULL THEN 'invalid'
              WHEN d.device_id IS NULL
                   AND ROW_NUMBER() OVER (PARTITION BY n.device_id ORDER BY request_seq) = 1 THEN 'created'
              ELSE 'exists' END AS status
  FROM (SELECT *, CASE WHEN device_number >= 0 THEN 'sensor_' || CAST(device_number AS VARCHAR) END AS device_id
        FROM register_requests) n
  LEFT JOIN devices d ON n.device_id = d.device_id
),
toggle_requests AS (
  SELECT device_id FROM (SELECT device_id, unnest(generate_series(1, id % 3)) FROM devices)
  UNION ALL SELECT 'unknown'
),
toggles AS (
  SELECT r.device_id, COUNT(*) AS toggles,
         CASE WHEN COUNT(*) % 2 = 1 THEN NOT ANY_VALUE(d.active) ELSE ANY_VALUE(d.active) END AS active,
         CASE WHEN ANY_VALUE(d.active) IS NULL THEN 'unknown' ELSE 'toggled' END AS status
  FROM toggle_requests r LEFT JOIN devices d USING (device_id) GROUP BY r.device_id
)"""

OUTBOX = """
anomaly_lines AS (
  SELECT id, '{"gateway_id":"' || gateway_id || '","device_id":"' || device_id
      || '","temperature":' || CAST(temperature AS VARCHAR) || ',"humidity":' || CAST(humidity AS VARCHAR)
      || ',"timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f')
      || '","classification":"' || classification || '"}' AS value
  FROM anomalies
),
outbox AS (
  SELECT value FROM anomaly_lines UNION ALL SELECT value FROM anomaly_lines WHERE id % 50 = 0
),
delivered AS (
  SELECT value FROM anomaly_lines WHERE id IN (SELECT event_id FROM events WHERE event_type <> 'error')
),
pending AS (SELECT value FROM outbox WHERE value NOT IN (SELECT value FROM delivered))"""

MODEL_REGISTRY = """
model_registry AS (
  SELECT date_diff('day', MIN(day) OVER (), day) + 1 AS version,
         'v=' || CAST(date_diff('day', MIN(day) OVER (), day) + 1 AS VARCHAR) AS path, created_at
  FROM (SELECT CAST("timestamp" AS DATE) AS day, MAX("timestamp") AS created_at FROM sensor_data GROUP BY 1)
)"""

READING = 'id, gateway_id, device_id, temperature, humidity, "timestamp", classification'
CARRIED = 'id, gateway_id, device_id, temperature, humidity, "timestamp"'
STATE_VIEWS = (COUNTERS, STATE_UPDATES, GATEWAY_STATE)
RAW_VIEWS = (RAW_MESSAGES, DECODED)


def _sql(select: str, *views: str) -> str:
    return "WITH " + ",".join((SENSOR_DATA, *views)) + "\n" + select


def oracle_sql() -> dict[str, str]:
    minutes = """SELECT date_trunc('minute', "timestamp") AS time, COUNT(*) AS {name} FROM {table} GROUP BY 1 ORDER BY 1"""
    rate = (
        "SELECT gateway_id, CAST(SUM(CASE WHEN classification = 'ANOMALY' THEN 1 ELSE 0 END) AS DOUBLE)"
        " / COUNT(*) * 100 AS anomaly_rate FROM sensor_data GROUP BY gateway_id"
    )
    state = "SELECT gateway_id, version, total_processed, total_anomalies, last_updated FROM gateway_state"
    trend = """SELECT date_trunc('millisecond', "timestamp") AS time, {m} FROM sensor_data ORDER BY time, id"""
    found = {
        "scan_sensor_data": _sql(f"SELECT {READING} FROM sensor_data"),
        "enrich_reading": _sql(f"SELECT {READING} FROM sensor_data"),
        "label_column": _sql(
            "SELECT id, classification, CASE WHEN classification = 'ANOMALY' THEN 1 ELSE 0 END AS label FROM sensor_data"
        ),
        "reading_bands": _sql(
            """SELECT measure, band, COUNT(*) AS readings FROM (
  SELECT measure, CASE WHEN v >= 70 THEN 'high' WHEN v >= 30 THEN 'medium' WHEN v >= 0 THEN 'low' END AS band
  FROM (SELECT 'temperature' AS measure, temperature AS v FROM sensor_data
        UNION ALL SELECT 'humidity', humidity FROM sensor_data))
GROUP BY measure, band"""
        ),
        "anomaly_filter": _sql(f"SELECT {READING} FROM anomalies", ANOMALIES),
        "gateway_records": _sql(
            "SELECT gateway_id, COUNT(*) AS processed_data FROM sensor_data WHERE gateway_id = 'gw_1' GROUP BY gateway_id"
        ),
        "recent_readings": _sql(
            f"""SELECT {READING} FROM sensor_data
WHERE "timestamp" >= (SELECT MAX("timestamp") FROM sensor_data) - INTERVAL 6 HOURS"""
        ),
        "temperature_trend": _sql(trend.format(m="temperature")),
        "humidity_trend": _sql(trend.format(m="humidity")),
        "recent_logs": _sql(
            'SELECT id, source, message, "timestamp" FROM logs ORDER BY "timestamp" DESC, id DESC LIMIT 20', LOGS
        ),
        "scatter_sample": _sql("SELECT temperature, humidity FROM sensor_data ORDER BY id LIMIT 200"),
        "validate_messages": _sql("SELECT * FROM valid", *RAW_VIEWS),
        "rejected_messages": _sql(
            "SELECT id, gateway_id, value, reason FROM decoded WHERE reason IS NOT NULL", *RAW_VIEWS
        ),
        "reject_summary": _sql(
            "SELECT reason, COUNT(*) AS rejected FROM decoded WHERE reason IS NOT NULL GROUP BY reason", *RAW_VIEWS
        ),
        "parse_timestamp": _sql(
            """SELECT id, CASE WHEN json_valid(value) THEN json_extract_string(value, '$.timestamp') END AS timestamp_text,
       TRY_CAST(CASE WHEN json_valid(value) THEN json_extract_string(value, '$.timestamp') END AS TIMESTAMP) AS parsed
FROM raw_messages""",
            RAW_MESSAGES,
        ),
        "total_records": _sql("SELECT COUNT(*) AS total_records FROM sensor_data"),
        "active_gateways": _sql("SELECT COUNT(*) AS active_gateways FROM gateway_state", *STATE_VIEWS),
        "total_anomalies": _sql("SELECT COUNT(*) AS total_anomalies FROM sensor_data WHERE classification = 'ANOMALY'"),
        "records_per_minute": _sql(minutes.format(name="processed_data", table="sensor_data")),
        "anomalies_per_minute": _sql(minutes.format(name="anomalies", table="anomalies"), ANOMALIES),
        "records_per_gateway": _sql("SELECT gateway_id, COUNT(*) AS processed_data FROM sensor_data GROUP BY gateway_id"),
        "gateway_anomaly_rate": _sql(rate),
        "distinct_gateways": _sql("SELECT DISTINCT gateway_id FROM sensor_data"),
        "analytics_summary": _sql(
            """SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE classification = 'ANOMALY') AS total_anomalies
FROM sensor_data"""
        ),
        "hourly_trend": _sql(
            """SELECT strftime("timestamp", '%Y-%m-%dT%H') AS hour, COUNT(*) AS records FROM sensor_data GROUP BY 1"""
        ),
        "anomaly_report": _sql(
            """SELECT gateway_id, COUNT(*) AS anomalies, (SELECT COUNT(*) FROM anomalies) AS total_anomalies
FROM anomalies GROUP BY gateway_id""",
            ANOMALIES,
        ),
        "anomaly_report_row": _sql(
            """SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_anomalies,
       '{' || COALESCE(string_agg('"' || gateway_id || '":' || n, ',' ORDER BY gateway_id), '') || '}' AS per_gateway
FROM (SELECT gateway_id, COUNT(*) AS n FROM anomalies GROUP BY gateway_id)""",
            ANOMALIES,
        ),
        "anomaly_detail": _sql(
            'SELECT gateway_id, device_id, temperature, humidity, "timestamp", classification FROM anomalies', ANOMALIES
        ),
        "series_totals": _sql(
            """SELECT 'processed_data' AS series, COUNT(*) AS total FROM sensor_data
UNION ALL SELECT 'anomalies', COUNT(*) FROM anomalies""",
            ANOMALIES,
        ),
        "reading_last_mean": _sql(
            """SELECT arg_max(temperature, ("timestamp", id)) AS last_temperature,
       ROUND(AVG(temperature), 6) AS mean_temperature,
       arg_max(humidity, ("timestamp", id)) AS last_humidity, ROUND(AVG(humidity), 6) AS mean_humidity
FROM sensor_data"""
        ),
        "last_not_null": _sql(
            """SELECT time, n AS last_value
FROM (SELECT date_trunc('minute', "timestamp") AS time, COUNT(*) AS n FROM anomalies GROUP BY 1)
ORDER BY time DESC LIMIT 1""",
            ANOMALIES,
        ),
        "throughput": _sql(
            """SELECT gateway_id, messages, duration_seconds,
       CASE WHEN duration_seconds > 0 THEN messages / duration_seconds END AS throughput
FROM (
  SELECT gateway_id, COUNT(*) AS messages,
         date_diff('microsecond', MIN("timestamp"), MAX("timestamp")) / 1000000 AS duration_seconds
  FROM sensor_data GROUP BY GROUPING SETS ((gateway_id), ())
)"""
        ),
        "merge_gateway_state": _sql(state, *STATE_VIEWS),
        "running_counters": _sql(
            'SELECT id, gateway_id, "timestamp", version, total_processed, total_anomalies FROM counters', COUNTERS
        ),
        "state_updates": _sql("SELECT * FROM state_updates", COUNTERS, STATE_UPDATES),
        "gateway_states": _sql(state, *STATE_VIEWS),
        "gateway_load": _sql("SELECT gateway_id, total_processed, total_anomalies FROM gateway_state", *STATE_VIEWS),
        "gateway_load_totals": _sql(
            """SELECT CAST(SUM(total_processed) AS BIGINT) AS total_processed,
       CAST(SUM(total_anomalies) AS BIGINT) AS total_anomalies FROM gateway_state""",
            *STATE_VIEWS,
        ),
        "gateway_leader": _sql(
            """SELECT gateway_id, (SELECT MIN(gateway_id) FROM gateway_state) AS leader,
       gateway_id = (SELECT MIN(gateway_id) FROM gateway_state) AS is_leader FROM gateway_state""",
            *STATE_VIEWS,
        ),
        "gateway_state_lookup": _sql(
            """SELECT a.gateway_id, s.version, s.total_processed, s.total_anomalies, s.gateway_id IS NOT NULL AS "exists"
FROM (SELECT DISTINCT gateway_id FROM sensor_data
      UNION ALL SELECT DISTINCT gateway_id || '_new' FROM sensor_data) a
LEFT JOIN gateway_state s ON a.gateway_id = s.gateway_id""",
            *STATE_VIEWS,
        ),
        "device_list": _sql("SELECT device_id, active, registered_at FROM devices", DEVICES),
        "validate_devices": _sql(
            "SELECT id, api_key FROM validate_requests WHERE api_key IN (SELECT api_key FROM devices WHERE active)",
            DEVICES,
            REQUESTS,
        ),
        "reject_devices": _sql(
            "SELECT id, api_key FROM validate_requests WHERE api_key NOT IN (SELECT api_key FROM devices WHERE active)",
            DEVICES,
            REQUESTS,
        ),
        "register_devices": _sql(
            """SELECT request_seq, device_number, device_id, status,
       CASE WHEN status = 'created' THEN substr(sha256(device_id || 'sensorloom'), 1, 32) END AS api_key
FROM answers""",
            DEVICES,
            REQUESTS,
        ),
        "toggle_devices": _sql("SELECT device_id, toggles, active, status FROM toggles", DEVICES, REQUESTS),
        "toggled_device_list": _sql(
            """SELECT d.device_id, COALESCE(t.active, d.active) AS active, d.registered_at
FROM devices d LEFT JOIN toggles t ON d.device_id = t.device_id""",
            DEVICES,
            REQUESTS,
        ),
        "device_key_violations": _sql(
            """SELECT constraint_name, key_value, COUNT(*) AS copies FROM (
  SELECT 'device_id' AS constraint_name, device_id AS key_value FROM pairs
  UNION ALL SELECT 'api_key', api_key FROM pairs)
GROUP BY constraint_name, key_value HAVING COUNT(*) > 1""",
            DEVICES,
            REQUESTS,
            """
pairs AS (
  SELECT device_id, api_key FROM devices
  UNION ALL SELECT device_id, substr(sha256(device_id || 'sensorloom'), 1, 32) FROM answers WHERE status = 'created'
  UNION ALL SELECT device_id, md5(device_id) FROM answers WHERE status = 'exists'
)""",
        ),
        "outbox_write": _sql("SELECT value FROM anomaly_lines", ANOMALIES, OUTBOX),
        "outbox_replay": _sql(
            """SELECT json_extract_string(value, '$.gateway_id') AS gateway_id,
       json_extract_string(value, '$.device_id') AS device_id,
       CAST(json_extract_string(value, '$.temperature') AS DOUBLE) AS temperature,
       CAST(json_extract_string(value, '$.humidity') AS DOUBLE) AS humidity,
       CAST(json_extract_string(value, '$.timestamp') AS TIMESTAMP) AS "timestamp",
       json_extract_string(value, '$.classification') AS classification, copies
FROM (SELECT value, COUNT(*) AS copies FROM pending GROUP BY value)""",
            ANOMALIES,
            OUTBOX,
        ),
        "outbox_ack": _sql("SELECT value FROM pending", ANOMALIES, OUTBOX),
        "log_append": _sql('SELECT id, source, message, "timestamp" FROM logs', LOGS),
        "dedup_anomalies": _sql(f"SELECT DISTINCT {READING} FROM anomalies", ANOMALIES),
        "train_forest": _sql(
            """SELECT COUNT(*) AS readings, COUNT(*) FILTER (WHERE classification = 'ANOMALY') AS anomalies,
       50 AS trees, 5 AS depth, true AS agrees FROM sensor_data"""
        ),
        "score_batch": _sql(f"SELECT {CARRIED}, true AS classified, true AS agrees FROM sensor_data"),
        "model_publish": _sql("SELECT CAST(2 AS BIGINT) AS version, COUNT(*) AS readings, true AS same FROM sensor_data"),
        "train_edge_model": "SELECT CAST(100 AS BIGINT) AS trees, CAST(100 AS BIGINT) AS roots, true AS within_depth,"
        " 256 AS sample_size, true AS flags_its_share",
        "edge_score": _sql(
            f"SELECT {CARRIED}, true AS classified, true AS consistent, true AS flags_its_share FROM sensor_data"
        ),
        "score_with_fallback": _sql(
            """SELECT model_type, COUNT(*) AS readings, COUNT(DISTINCT id) AS ids
FROM sensor_data, (VALUES ('random_forest'), ('isolation_forest')) m(model_type) GROUP BY model_type"""
        ),
        "stream_score": _sql(f"SELECT {CARRIED}, true AS classified, true AS agrees FROM valid", *RAW_VIEWS),
        "stream_model_switch": _sql(
            """SELECT CASE WHEN late THEN 'random_forest' ELSE 'isolation_forest' END AS model_type,
       CAST(CASE WHEN late THEN 1 ELSE 0 END AS BIGINT) AS model_version, COUNT(*) AS readings,
       MIN("timestamp") AS "first", MAX("timestamp") AS "last", true AS within_bounds
FROM (
  SELECT "timestamp", epoch_us("timestamp") > (
    SELECT (MIN(epoch_us("timestamp")) + MAX(epoch_us("timestamp"))) // 2 FROM sensor_data) AS late
  FROM valid
) GROUP BY late""",
            *RAW_VIEWS,
        ),
        "latest_model": _sql(
            """SELECT COUNT(*) > 0 AS "exists", MAX(version) AS version, arg_max(path, version) AS path
FROM model_registry""",
            MODEL_REGISTRY,
        ),
        "stream_ingest": _sql("SELECT * FROM valid", *RAW_VIEWS),
        "stream_store_readings": _sql(f"SELECT {READING} FROM stored", *RAW_VIEWS),
        "stream_store_anomalies": _sql(f"SELECT {READING} FROM stored WHERE classification = 'ANOMALY'", *RAW_VIEWS),
        "stream_outbox": _sql(
            "SELECT value FROM anomaly_lines",
            *RAW_VIEWS,
            "\nanomalies AS (SELECT * FROM stored WHERE classification = 'ANOMALY')",
            OUTBOX,
        ),
        "stream_outbox_delivered": _sql(
            """SELECT gateway_id, device_id, temperature, humidity, "timestamp", classification
FROM stored WHERE classification = 'ANOMALY'""",
            *RAW_VIEWS,
        ),
        "stream_running_counters": _sql(
            """SELECT id, gateway_id, "timestamp", ROW_NUMBER() OVER w AS version, ROW_NUMBER() OVER w AS total_processed,
       CAST(COUNT(*) FILTER (WHERE classification = 'ANOMALY') OVER w AS BIGINT) AS total_anomalies
FROM (
  SELECT *, CASE WHEN id % 500 = 0 THEN 0 ELSE
    (epoch_us("timestamp") - MIN(epoch_us("timestamp")) OVER ()) * 5
      // (MAX(epoch_us("timestamp")) OVER () - MIN(epoch_us("timestamp")) OVER () + 1) END AS place
  FROM sensor_data
)
WINDOW w AS (PARTITION BY gateway_id ORDER BY place DESC, "timestamp", id ROWS UNBOUNDED PRECEDING)"""
        ),
        "stream_register_devices": _sql(
            """SELECT id, device_id, substr(sha256(device_id || 'sensorloom'), 1, 32) AS api_key,
       toggles % 2 = 0 AS active, registered_at
FROM (
  SELECT CAST(split_part(device_id, '_', 2) AS BIGINT) AS id, device_id,
         arg_min("timestamp", id) FILTER (WHERE id % 7 = 0) AS registered_at,
         COUNT(*) FILTER (WHERE id % 7 <> 0) AS toggles
  FROM sensor_data WHERE (id % 7 = 0 OR id % 11 = 0) AND id % 91 <> 0 GROUP BY device_id
) WHERE registered_at IS NOT NULL"""
        ),
        "stream_rejects": _sql(
            """SELECT id, CASE WHEN id % 31 <> 0 THEN gateway_id END AS gateway_id, value,
       coalesce(reason, 'missing_gateway_id') AS reason
FROM decoded WHERE reason IS NOT NULL OR id % 31 = 0""",
            *RAW_VIEWS,
        ),
        "stream_outbox_pending": _sql(
            "SELECT value FROM anomaly_lines WHERE value NOT IN (SELECT value FROM sent)",
            *RAW_VIEWS,
            "\nanomalies AS (SELECT * FROM stored WHERE classification = 'ANOMALY')",
            OUTBOX,
            """
sent AS (
  SELECT '{"gateway_id":"' || gateway_id || '","device_id":"' || device_id
      || '","temperature":' || CAST(temperature AS VARCHAR) || ',"humidity":' || CAST(humidity AS VARCHAR)
      || ',"timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f')
      || '","classification":"' || classification || '"}' AS value
  FROM sensor_data
  WHERE classification = 'ANOMALY' AND id IN (SELECT event_id FROM events WHERE event_type <> 'error')
)""",
        ),
        "stream_recent_readings": _sql(
            f"""SELECT {READING} FROM stored
WHERE "timestamp" >= (SELECT MAX("timestamp") FROM stored) - INTERVAL 6 HOURS""",
            *RAW_VIEWS,
        ),
        "stream_restart": _sql(
            """SELECT gateway_id, COUNT(*) AS version, COUNT(*) AS total_processed,
       COUNT(*) FILTER (WHERE classification = 'ANOMALY') AS total_anomalies, MAX("timestamp") AS last_updated
FROM stored GROUP BY gateway_id""",
            *RAW_VIEWS,
        ),
    }
    # A stream gives what its batch form gives.
    return found | {
        "recent_logs_stored": found["recent_logs"],
        "stream_compacted_readings": found["stream_store_readings"],
        "stream_counters": found["gateway_states"],
        "stream_stored_counters": found["stream_restart"],
        "stream_published_state": found["stream_restart"],
        "stream_dedup_anomalies": found["dedup_anomalies"],
        "stream_merge_gateway_state": found["merge_gateway_state"],
        "stream_records_per_minute": found["records_per_minute"],
        "stream_anomalies_per_minute": found["anomalies_per_minute"],
        "stream_anomaly_rate": found["gateway_anomaly_rate"],
    }
