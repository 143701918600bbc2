"""The shared table contract: column lists, types, ranges and thresholds."""

from pyspark.sql import types as T

# Names, order, bounds and limits the results depend on.
SENSOR_COLS = [
    "speed_kmh",
    "battery_pct",
    "temp_motor_c",
    "temp_battery_c",
    "regen_brake_kw",
    "accel_x",
    "accel_y",
    "accel_z",
    "voltage_v",
    "current_a",
]
DRIFT_COLS = ["speed_kmh", "battery_pct", "temp_motor_c", "voltage_v", "current_a"]
REQUIRED_COLS = ["vehicle_id", "speed_kmh", "battery_pct"]
PREVIEW_COLS = [
    "vehicle_id",
    "speed_kmh",
    "battery_pct",
    "temp_motor_c",
    "power_kw",
    "temp_delta_c",
    "accel_magnitude",
    "rule_anomaly",
]
LAKE_PARTITIONS = ["year_", "month_", "region"]
SENSOR_RANGES = {
    "speed_kmh": (0.0, 200.0),
    "battery_pct": (0.0, 100.0),
    "temp_motor_c": (20.0, 150.0),
    "temp_battery_c": (-20.0, 80.0),
    "regen_brake_kw": (0.0, 50.0),
    "voltage_v": (300.0, 500.0),
    "current_a": (-200.0, 500.0),
    "odometer_km": (0.0, 200000.0),
}
RULE_THRESHOLDS = {
    "high_temp": 130.0,
    "low_battery": 10.0,
    "overvoltage": 480.0,
    "high_accel": 15.0,
}
SEQ_LEN = 30
ROLLING_ROWS = 30
POSITIVE_WEIGHT = 10.0
CONTAMINATION = 0.03

ORDER_COLS = ["event_ts", "event_id"]

TELEMETRY_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        *[T.StructField(c, T.DoubleType()) for c in SENSOR_COLS],
        T.StructField("odometer_km", T.DoubleType()),
        T.StructField("region", T.StringType()),
        T.StructField("firmware_ver", T.StringType()),
        T.StructField("injected_anomaly", T.IntegerType()),
    ]
)

READING_SCHEMA = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in SENSOR_COLS],
    ]
)
REQUEST_SCHEMA = T.StructType([T.StructField("readings", T.ArrayType(READING_SCHEMA))])
