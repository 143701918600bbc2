import pytest
from pyspark.sql import functions as F

from ampledger.functions import scalars as S
from ampledger.operators import features as X
from ampledger.operators import validate as V
from ampledger.schema import SENSOR_COLS

NAN = float("nan")


def flags(df):
    return [tuple(r) for r in X.derive(df).orderBy("event_id").select(*X.FLAG_COLS, "rule_anomaly").collect()]


def test_values_at_a_threshold_do_not_flag(readings):
    df = readings(
        [
            {"temp_motor_c": 130.0, "battery_pct": 10.0, "voltage_v": 480.0, "accel_x": 0.0, "accel_y": 9.0, "accel_z": 12.0},
            {"temp_motor_c": 130.01},
            {"battery_pct": 9.99},
            {"voltage_v": 480.01},
            {"accel_z": 15.01},
        ]
    )
    assert flags(df) == [(0, 0, 0, 0, 0), (1, 0, 0, 0, 1), (0, 1, 0, 0, 1), (0, 0, 1, 0, 1), (0, 0, 0, 1, 1)]


def test_null_never_flags_and_nan_is_high(readings):
    df = readings([{"temp_motor_c": None, "battery_pct": None, "voltage_v": None, "accel_x": None}, {"temp_motor_c": NAN}])
    assert flags(df) == [(0, 0, 0, 0, 0), (1, 0, 0, 0, 1)]


def test_thresholds_can_be_changed(readings):
    df = X.add_rule_flags(X.add_accel_magnitude(readings([{"temp_motor_c": 90.0}])), {"high_temp": 80.0})
    assert df.first()["flag_high_temp"] == 1


def test_efficiency_needs_positive_power(readings):
    df = X.derive(readings([{"current_a": 0.0}, {"current_a": -10.0}, {"current_a": 100.0}, {"current_a": None}]))
    got = [(r["power_kw"], r["efficiency_km_per_kw"]) for r in df.orderBy("event_id").collect()]
    assert got == [(0.0, None), (-4.0, None), (40.0, 2.0), (None, None)]


def test_cast_bad_text_to_null_or_raise(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01", "12.5"), ("yesterday", "fast")], "event_ts string, speed_kmh string")
    got = X.cast_telemetry(df).collect()
    assert got[0]["speed_kmh"] == 12.5 and got[0]["event_ts"] is not None
    assert tuple(got[1]) == (None, None)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        X.cast_telemetry(df, strict=True).collect()


def test_clip_keeps_null_and_nan(readings):
    df = X.clip_sensors(readings([{"speed_kmh": 250.0}, {"speed_kmh": -1.0}, {"speed_kmh": None}, {"speed_kmh": NAN}]))
    got = [r["speed_kmh"] for r in df.orderBy("event_id").collect()]
    assert got[:3] == [200.0, 0.0, None] and got[3] != got[3]


def test_fill_covers_null_and_nan(readings):
    row = X.fill_null_sensors(readings([{"speed_kmh": None, "voltage_v": NAN}])).first()
    assert (row["speed_kmh"], row["voltage_v"]) == (0.0, 0.0)


def test_small_projections(readings):
    df = X.derive(readings([{}, {"voltage_v": 490.0}]))
    assert X.project_sensors(df).columns == [*SENSOR_COLS, "rule_anomaly"]
    assert "label" in X.rename_label(df).columns
    assert X.filter_anomalies(df).count() == 1
    assert X.const_columns(df, {"a": 3}).first()["a"] == 3


def test_scoring_scalars(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 800.0), (800.0, 0.0)], "z0 double, z1 double")
    got = df.select(S.softmax_pair("z0", "z1").alias("p"), S.argmax_class("z0", "z1").alias("c")).collect()
    assert [r["c"] for r in got] == [0, 1, 0]
    assert [r["p"] for r in got] == [0.5, 1.0, 0.0]
    half = spark.createDataFrame([(0.5,), (0.51,)], "p double").select(*S.decision("p")).collect()
    assert [tuple(r) for r in half] == [(False, 0.5, 0.5, "NORMAL"), (True, 0.51, 0.51, "ANOMALY")]
    losses = df.select(S.log_softmax_loss("z0", "z1", F.lit(1)).alias("l")).collect()
    assert [round(r["l"], 3) for r in losses] == [0.693, 0.0, 800.0]


def test_validate_schema(readings):
    df = readings([{}])
    assert V.validate_schema(df) is df
    with pytest.raises(ValueError, match="Missing columns! battery_pct"):
        V.validate_schema(df.drop("battery_pct"))
    report = {r["column_name"]: r for r in V.schema_report(df.drop("voltage_v").withColumn("speed_kmh", F.lit("x"))).collect()}
    assert not report["voltage_v"]["present"] and not report["speed_kmh"]["type_ok"]


def test_audits(readings):
    df = readings([{"speed_kmh": None}, {"speed_kmh": NAN}, {"speed_kmh": 201.0}, {"speed_kmh": 200.0, "battery_pct": -3.0}])
    nulls = {r["column_name"]: r["null_count"] for r in V.null_audit(df, ["speed_kmh", "vehicle_id"]).collect()}
    assert nulls == {"speed_kmh": 2, "vehicle_id": 0}
    outside = {r["column_name"]: r["out_of_range"] for r in V.range_audit(df).collect()}
    assert outside["speed_kmh"] == 2 and outside["battery_pct"] == 1
    rows = V.add_violations(df).orderBy("event_id").collect()
    assert [r["violations"] for r in rows] == [[], ["speed_kmh"], ["speed_kmh"], ["battery_pct"]]


def test_audits_of_an_empty_table(readings):
    empty = readings([{}]).limit(0)
    assert V.null_audit(empty, ["speed_kmh"]).first()["null_rate"] is None
    assert V.range_audit(empty).first()["out_of_range"] == 0
