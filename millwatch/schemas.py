"""Schemas and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

READING = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("equipment_id", T.StringType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.DoubleType())),
])

# The same reading as it travels in JSON: time is ISO-8601 text.
READING_JSON = T.StructType([
    T.StructField("timestamp", T.StringType()),
    *[f for f in READING.fields if f.name != "timestamp"],
])

REQUIRED_FIELDS = ["timestamp", "equipment_id", "sensor_type", "value", "unit", "location"]

MEASURES = ["value", "temperature", "rpm", "load"]

# Health weights, normal ranges and anomaly limits by sensor type.
SENSOR_WEIGHTS = {"vibration": 0.4, "temperature": 0.3, "pressure": 0.2, "rpm": 0.1}
SENSOR_RANGES = {
    "vibration": (0.0, 1.0),
    "temperature": (20.0, 80.0),
    "pressure": (0.0, 100.0),
    "rpm": (1500.0, 2000.0),
}
SENSOR_LIMITS = {"vibration": 1.0, "temperature": 100.0, "pressure": 150.0, "rpm": 2500.0}
DEFAULT_LIMIT = 1.0
NEUTRAL_HEALTH = 0.5

# Alert severities and states, in rising order.
SEVERITIES = ["info", "warning", "error", "critical"]
ALERT_STATES = ["active", "acknowledged", "resolved", "suppressed"]
