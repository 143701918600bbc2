"""Casting, derived columns, rule flags and small row-wise projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampledger.functions import scalars as S
from ampledger.schema import RULE_THRESHOLDS, SENSOR_COLS, SENSOR_RANGES

FLAG_COLS = ["flag_high_temp", "flag_low_battery", "flag_overvoltage", "flag_high_accel"]
NUMERIC_COLS = [*SENSOR_COLS, "odometer_km"]


def project_sensors(df: DataFrame, label: str = "rule_anomaly", keys: list[str] | None = None) -> DataFrame:
    return df.select(*(keys or []), *SENSOR_COLS, label)


def rename_label(df: DataFrame, label: str = "rule_anomaly") -> DataFrame:
    return df.withColumnRenamed(label, "label")


def cast_telemetry(df: DataFrame, strict: bool = False) -> DataFrame:
    """Strings to timestamp and double. Bad text becomes NULL, or raises when ``strict``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    casts = {}
    for c in NUMERIC_COLS:
        if c in types and not isinstance(types[c], T.DoubleType):
            casts[c] = F.col(c).cast("double") if strict else F.col(c).try_cast("double")
    if isinstance(types.get("event_ts"), T.StringType):
        casts["event_ts"] = F.to_timestamp("event_ts") if strict else F.try_to_timestamp("event_ts")
    elif isinstance(types.get("event_ts"), T.TimestampNTZType):
        casts["event_ts"] = F.col("event_ts").cast("timestamp")
    return df.withColumns(casts) if casts else df


def ensure_key(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Add a row key where the table or a row has none: a hash of the row, the tie-breaker of equal timestamps.

    Exact copies share it, and may then take each other's place. A key that
    isn't an integer is replaced by its hash.
    """
    others = [c for c in df.columns if c != key]
    hashed = F.xxhash64(*others)
    if key not in df.columns:
        return df.withColumn(key, hashed)
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        return df.withColumn(key, F.when(F.col(key).isNull(), hashed).otherwise(F.xxhash64(key)))
    return df.withColumn(key, F.coalesce(F.col(key), hashed.cast(df.schema[key].dataType)))


def add_power(df: DataFrame) -> DataFrame:
    return df.withColumn("power_kw", S.power_kw())


def add_temp_delta(df: DataFrame) -> DataFrame:
    return df.withColumn("temp_delta_c", S.temp_delta())


def add_accel_magnitude(df: DataFrame) -> DataFrame:
    return df.withColumn("accel_magnitude", S.accel_magnitude())


def add_efficiency(df: DataFrame) -> DataFrame:
    """Needs power_kw."""
    return df.withColumn("efficiency_km_per_kw", S.efficiency())


def add_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "date_": F.to_date("event_ts"),
            "year_": F.year("event_ts"),
            "month_": F.month("event_ts"),
            "hour_": F.hour("event_ts"),
        }
    )


def add_rule_flags(df: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Four strict threshold flags as 0/1. Needs accel_magnitude."""
    limits = {**RULE_THRESHOLDS, **(thresholds or {})}
    return df.withColumns(
        {
            "flag_high_temp": S.above("temp_motor_c", limits["high_temp"]),
            "flag_low_battery": S.below("battery_pct", limits["low_battery"]),
            "flag_overvoltage": S.above("voltage_v", limits["overvoltage"]),
            "flag_high_accel": S.above("accel_magnitude", limits["high_accel"]),
        }
    )


def add_rule_anomaly(df: DataFrame) -> DataFrame:
    return df.withColumn("rule_anomaly", S.any_flag(*FLAG_COLS))


def derive(df: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """All row-wise columns of the processed table; a map-only plan."""
    steps = (add_power, add_temp_delta, add_accel_magnitude, add_efficiency, add_date_parts)
    for step in steps:
        df = df.transform(step)
    return df.transform(add_rule_flags, thresholds).transform(add_rule_anomaly)


def filter_anomalies(df: DataFrame, flag: str = "rule_anomaly") -> DataFrame:
    return df.filter(F.col(flag) == 1)


def fill_null_sensors(df: DataFrame, cols: list[str] = SENSOR_COLS) -> DataFrame:
    """NULL and NaN sensors become 0."""
    return df.na.fill(0.0, cols)


def const_columns(df: DataFrame, values: dict[str, int]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def clip_sensors(df: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    ranges = SENSOR_RANGES if ranges is None else ranges
    return df.withColumns({c: S.clip(c, *ranges[c]) for c in ranges if c in df.columns})
