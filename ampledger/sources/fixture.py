"""A deterministic telemetry view over the ``events`` test table.

The expressions are plain SQL that Spark and DuckDB read alike, but for the
name of the printf function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _u(a: int, b: int) -> str:
    return f"(cast((event_id*{a} + {b}) % 10007 as double) / cast(10007 as double))"


def _d(n: float) -> str:
    return f"cast({n} as double)"


_F = "(case when event_id % 33 = 0 then cast(1 as double) else cast(0 as double) end)"
_G = "(case when event_id % 97 = 0 then cast(1 as double) else cast(0 as double) end)"


def _pick(names: list[str]) -> str:
    whens = " ".join(f"when {i} then '{name}'" for i, name in enumerate(names))
    return f"case event_id % {len(names)} {whens} end"


COLUMNS = {
    "event_id": "event_id",
    "vehicle_id": "format_string('VH_%05d', user_id)",
    "event_ts": "cast(ts as timestamp)",
    "speed_kmh": f"{_d(200)}*{_u(7919, 11)}",
    "battery_pct": f"{_d(15)} + {_d(80)}*{_u(6101, 23)} - {_d(45)}*{_F}",
    "temp_motor_c": f"{_d(40)} + {_d(70)}*{_u(5003, 37)} + {_d(60)}*{_F}",
    "temp_battery_c": f"{_d(60)}*{_u(4001, 41)}",
    "regen_brake_kw": f"least(greatest(value/{_d(10)}, {_d(0)}), {_d(50)})",
    "accel_x": f"{_d(-4)} + {_d(8)}*{_u(3001, 53)} + {_d(14)}*{_G}",
    "accel_y": f"{_d(-4)} + {_d(8)}*{_u(2003, 67)}",
    "accel_z": f"{_d(8.3)} + {_d(3)}*{_u(9001, 71)}",
    "voltage_v": f"{_d(340)} + {_d(120)}*{_u(8009, 83)} + {_d(75)}*{_F}",
    "current_a": f"{_d(-60)} + {_d(360)}*{_u(7001, 97)}",
    "odometer_km": f"{_d(200000)}*{_u(6007, 101)}",
    "region": _pick(["north", "south", "east", "west", "coast"]),
    "firmware_ver": _pick(["fw-a", "fw-b", "fw-c", "fw-d"]),
    "injected_anomaly": "cast(case when event_id % 33 = 0 then 1 else 0 end as int)",
}


def from_events(events: DataFrame) -> DataFrame:
    """Batch or streaming events to telemetry rows."""
    return events.selectExpr(*[f"{expr} as {name}" for name, expr in COLUMNS.items()])


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet"))


def duckdb_sql() -> str:
    cols = ", ".join(f"{expr} as {name}" for name, expr in COLUMNS.items())
    return f"select {cols} from events".replace("format_string(", "printf(")
