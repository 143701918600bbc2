import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ampledger.schema import SENSOR_COLS  # noqa: E402
from ampledger.session import SESSION_CONF  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("tests")
    conf = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": "2",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


BASE = {
    "speed_kmh": 80.0,
    "battery_pct": 60.0,
    "temp_motor_c": 75.0,
    "temp_battery_c": 30.0,
    "regen_brake_kw": 5.0,
    "accel_x": 0.0,
    "accel_y": 0.0,
    "accel_z": 9.8,
    "voltage_v": 400.0,
    "current_a": 100.0,
}


@pytest.fixture(scope="session")
def readings(spark):
    """Frame of readings from dicts of the columns that differ from a calm one."""

    def make(rows):
        names = ["event_id", "vehicle_id", "event_ts", *SENSOR_COLS, "odometer_km", "region", "firmware_ver", "injected_anomaly"]
        types = ["bigint", "string", "string", *["double"] * 10, "double", "string", "string", "int"]
        full = []
        for i, row in enumerate(rows):
            r = {
                "event_id": i,
                "vehicle_id": "VH_00001",
                "event_ts": f"2024-01-01 00:{i // 60 % 60:02d}:{i % 60:02d}",
                **BASE,
                "odometer_km": 1000.0,
                "region": "US-CA",
                "firmware_ver": "v12.1",
                "injected_anomaly": 0,
                **row,
            }
            full.append(tuple(r[n] for n in names))
        schema = ", ".join(f"{n} {t}" for n, t in zip(names, types))
        return spark.createDataFrame(full, schema).withColumn("event_ts", F.to_timestamp("event_ts"))

    return make
