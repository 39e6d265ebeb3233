"""Fixed values of the sensor pipeline: class names, thresholds, intervals, schemas."""

from pyspark.sql import types as T

# Class names and the codes the two models use for them.
NORMAL = "NORMAL"
ANOMALY = "ANOMALY"
FOREST_ANOMALY = 1.0
ISOLATION_ANOMALY = -1
ISOLATION_NORMAL = 1

# Colour steps of the temperature and humidity panels.
BAND_STEPS = (0.0, 30.0, 70.0)
BAND_NAMES = ("low", "medium", "high")

# Sizes, intervals and model settings.
LOOK_BACK = "6 hours"
RECENT_LOG_ROWS = 20
SCATTER_ROWS = 200
SCORING_INTERVAL = "500 milliseconds"
STATE_INTERVAL = "3 seconds"
STATE_SECONDS = 3.0
MODEL_CHECK_SECONDS = 10.0
FOREST_TREES = 50
FOREST_DEPTH = 5
CONTAMINATION = 0.05
MODEL_SEED = 42
FEATURES = ("temperature", "humidity")
DEVICE_PREFIX = "sensor_"
LOG_ARROW = " → "

READING = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("gateway_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("classification", T.StringType()),
    ]
)

# The outbox line: a scored reading as JSON, the time as ISO text.
OUTBOX_RECORD = T.StructType(
    [
        T.StructField("gateway_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("classification", T.StringType()),
    ]
)

GATEWAY_STATE = T.StructType(
    [
        T.StructField("gateway_id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("total_processed", T.LongType()),
        T.StructField("total_anomalies", T.LongType()),
        T.StructField("last_updated", T.TimestampNTZType()),
    ]
)

STATE_UPDATE = T.StructType(
    GATEWAY_STATE.fields + [T.StructField("arrival_seq", T.LongType())]
)

RAW_MESSAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("gateway_id", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
