"""Fixed values of the telemetry contract and of the SLO rules.

These are values the results depend on; they are stated here once, in plain
text, and used everywhere else by name.
"""

# --- fixed values: event contract -------------------------------------------
STATUSES = ("OK", "WARNING", "FAILED")
EVENT_ID_MAX_LEN = 128
DEVICE_ID_MAX_LEN = 128
REGION_MAX_LEN = 64
TEMPERATURE_MIN, TEMPERATURE_MAX = -100.0, 250.0
VOLTAGE_MIN, VOLTAGE_MAX = 0.0, 1000.0
SUPPORTED_SCHEMA_VERSION = 1
ENVELOPE_KEYS_V0 = ("event", "received_at")
ENVELOPE_KEYS_V1 = ("schema_version", "schema_id", "event", "received_at")
EVENT_KEYS = ("event_id", "device_id", "timestamp", "temperature", "voltage", "status", "region")

# --- fixed values: enrichment ------------------------------------------------
OUTLIER_LOW, OUTLIER_HIGH = -40.0, 140.0          # strict bounds
VOLTAGE_DROP_THRESHOLD = 2.5                        # previous - current >= 2.5
TRAILING_WINDOW_SECONDS = 300                       # inclusive [t - 5 min, t]

# --- fixed values: ingestion edge --------------------------------------------
MAX_BATCH_EVENTS = 500
QUOTA_CAPACITY = 1000
QUOTA_WINDOW_SECONDS = 60

# --- fixed values: read queries ----------------------------------------------
RECENT_LIST_SIZE = 50
CACHE_TTL_SECONDS = 86400
TREND_ROW_CAP = 75000
TREND_BUCKETS = 12
LATEST_DEVICES = 12
DEVICE_HISTORY_DEFAULT_LIMIT = 500
DEVICE_HISTORY_MAX_LIMIT = 5000
ALERTS_DEFAULT_LIMIT = 100
ALERTS_MAX_LIMIT = 1000
LOW_VOLTAGE = 10.0
DLQ_LIST_DEFAULT_LIMIT = 20
RETENTION_DEFAULT_DAYS = 30
RETENTION_DEFAULT_BATCH = 10000

# --- fixed values: topics ----------------------------------------------------
RAW_TOPIC = "raw-telemetry"
VALIDATED_TOPIC = "validated-telemetry"
DEAD_LETTER_TOPIC = "dead-letter-telemetry"

# --- fixed values: metric histograms (upper bounds, +Inf implied) ------------
PERSISTENCE_LATENCY_BUCKETS_S = (0.05, 0.1, 0.25, 0.5, 1, 2, 5, 10, 30, 60)
PROCESSING_LATENCY_BUCKETS_MS = (5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000)

# --- fixed values: alert rules (name, threshold, comparison, hold seconds) ---
# worker ready max < 1 or absent, 2 m; consumer lag sum > 1000, 5 m;
# persistence p99 > 5 s, 5 m; dead-letter ratio > 0.001, 10 m;
# oldest pending ledger row > 30 s, 2 m; dependency ready min < 1, 2 m.
ALERT_RULES = (
    ("TelemetryWorkerUnavailable", "worker_ready", "max", "<", 1.0, 120),
    ("TelemetryConsumerLagHigh", "queue_lag", "sum", ">", 1000.0, 300),
    ("TelemetryPersistenceLatencySLOBreach", "persistence_p99_seconds", "max", ">", 5.0, 300),
    ("TelemetryDLQRateHigh", "dead_letter_ratio", "max", ">", 0.001, 600),
    ("TelemetryOutboxStalled", "outbox_oldest_pending_seconds", "max", ">", 30.0, 120),
    ("TelemetryAPINotReady", "dependency_ready", "min", "<", 1.0, 120),
)
DLQ_RATIO_FLOOR = 0.001
