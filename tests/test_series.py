"""Windows over series, on plain and on hot vehicles, against plain Python."""

import re
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from ampledger.operators import series as W

HOT = {"hot_rows": 50, "slice_rows": 16}


def mixed_rows():
    """A hot vehicle with dense seconds and equal timestamps, a sparse hot one, and small ones."""
    rows = []

    def add(vehicle, ts):
        i = len(rows)
        if ts and "." not in ts:
            ts += ".000"
        rows.append(
            {
                "event_id": i * 7 % 1009,
                "vehicle_id": vehicle,
                "event_ts": ts,
                "speed_kmh": float(i * 37 % 101),
                "temp_motor_c": float(i * 53 % 97),
                "battery_pct": float(i * 11 % 89),
                "injected_anomaly": int(i % 9 == 0),
            }
        )

    for i in range(120):
        add("A", "2024-01-01 00:00:00")
    for i in range(60):
        add("A", f"2024-01-01 00:00:0{i % 3}.{i * 131 % 997:03d}")
    for i in range(40):
        add("A", f"2024-01-01 00:{i % 24:02d}:00")
    for i in range(70):
        add("B", f"2024-01-01 0{i % 3}:{i * 7 % 60:02d}:30")
    for i in range(60):
        add(None, f"2024-01-01 00:{i:02d}:00")
    for i in range(5):
        add("A", None)
    for n, vehicle in ((1, "one"), (29, "v29"), (30, "v30"), (31, "v31"), (45, "v45")):
        for i in range(n):
            add(vehicle, f"2024-01-01 01:{i:02d}:00")
    return rows


def by_vehicle(rows):
    series = {}
    for r in rows:
        series.setdefault(r["vehicle_id"], []).append(r)
    for s in series.values():
        s.sort(key=lambda r: (r["event_ts"] is not None, r["event_ts"] or "", r["event_id"]))
    return series


@pytest.fixture(scope="module")
def mixed(readings):
    rows = mixed_rows()
    return readings(rows).repartition(5), by_vehicle(rows)


@pytest.mark.parametrize("args", [{}, HOT], ids=["plain", "sliced"])
def test_rolling(mixed, args):
    df, series = mixed
    want = {}
    for s in series.values():
        for i, r in enumerate(s):
            frame = s[max(0, i - 29) : i + 1]
            speeds = [x["speed_kmh"] for x in frame]
            want[r["event_id"]] = (
                sum(x["temp_motor_c"] for x in frame) / len(frame),
                statistics.stdev(speeds) if len(frame) > 1 else None,
            )
    got = {r["event_id"]: r for r in W.add_rolling(df, **args).collect()}
    assert got.keys() == want.keys()
    for key, (temp, std) in want.items():
        assert got[key]["rolling_avg_temp"] == pytest.approx(temp, abs=0.0051)
        if std is None:
            assert got[key]["rolling_std_speed"] is None
        else:
            assert got[key]["rolling_std_speed"] == pytest.approx(std, abs=0.000051)


@pytest.mark.parametrize("args, horizon", [({}, 1), ({}, 0), (HOT, 1)], ids=["plain", "plain-0", "sliced"])
def test_sequences(mixed, args, horizon):
    df, series = mixed
    want = {}
    for vehicle, s in series.items():
        for i in range(len(s) - 30 - horizon + 1):
            window = [x["speed_kmh"] for x in s[i : i + 30]]
            want[(vehicle, i)] = (s[i + 29 + horizon]["injected_anomaly"], window)
    rows = W.make_sequences(df, horizon=horizon, cols=["speed_kmh"], **args).collect()
    got = {(r["vehicle_id"], r["position"]): (r["label"], [v[0] for v in r["features"]]) for r in rows}
    assert len(rows) == len(want)
    assert got == want


@pytest.mark.parametrize("args", [{}, HOT], ids=["plain", "sliced"])
def test_positions_and_split(mixed, args):
    df, series = mixed
    want = {}
    for s in series.values():
        for i, r in enumerate(s):
            want[r["event_id"]] = (i + 1, "train" if i < int(len(s) * 0.8) else "val")
    got = {r["event_id"]: (r["position"], r["split"]) for r in W.chronological_split(df, **args).collect()}
    assert got == want


@pytest.mark.parametrize("split", ["rows", "sequences"])
def test_splits_agree_on_hot_and_plain(mixed, split):
    df, series = mixed
    rows = [W.sequence_labels(df, split=split, **args).collect() for args in ({}, HOT)]
    assert sorted(map(str, rows[0])) == sorted(map(str, rows[1]))
    if split == "rows":
        want = sum(max(n - 30, 0) for s in series.values() for n in (int(len(s) * 0.8), len(s) - int(len(s) * 0.8)))
    else:
        want = sum(max(len(s) - 30, 0) for s in series.values())
    assert len(rows[0]) == want


def test_shape_features_agree_on_hot_and_plain(mixed):
    df, _ = mixed
    cols = ["speed_kmh", "battery_pct"]
    names = W.shape_columns(cols)
    rounded = [F.round(c, 6).alias(c) for c in names]
    plain, sliced = (
        W.shape_features(df, cols=cols, **args).select("vehicle_id", "position", *rounded).collect() for args in ({}, HOT)
    )
    assert len(plain) > 0
    assert sorted(map(str, plain)) == sorted(map(str, sliced))


@pytest.mark.parametrize("args", [{}, HOT], ids=["plain", "sliced"])
def test_shape_statistics_are_never_sorted(mixed, args):
    """A sort that moves eighty statistics a row spills long before one of the readings does."""
    rows = W.shape_features(mixed[0], **args)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    orders = {order for line in windows for order in re.findall(r"(?<=\], \[)[^\[\]]*(?:ASC|DESC)[^\[\]]*(?=\])", line)}
    assert len(windows) > 0
    names = {re.sub("#[0-9]+L?", "", order) for order in orders}
    assert names == {"event_ts ASC NULLS FIRST, event_id ASC NULLS FIRST"}


def test_shape_of_a_ramp(readings):
    df = readings([{"speed_kmh": 2.0 * i, "battery_pct": float(i % 2)} for i in range(32)])
    row = W.shape_features(df, cols=["speed_kmh", "battery_pct"]).orderBy("position").collect()[-1]
    assert row["position"] == 2
    assert row["speed_kmh_slope"] == pytest.approx(2.0)
    assert (row["speed_kmh_diff1"], row["speed_kmh_diff2"]) == (2.0, 0.0)
    assert (row["battery_pct_diff1"], row["battery_pct_diff2"]) == (1.0, 2.0)
    assert (row["speed_kmh_min"], row["speed_kmh_max"], row["speed_kmh_range"]) == (4.0, 62.0, 58.0)


@pytest.mark.parametrize("seq_len", [3, 4, 7])
def test_shape_of_every_window_by_brute_force(readings, seq_len):
    """Missing values, and a value that would swamp sums kept beyond its window."""
    speeds = [None if i % 11 in (4, 5) else 1e15 if i == 9 else ((i * 37) % 23) / 4 for i in range(41)]
    df = readings([{"speed_kmh": v} for v in speeds])
    rows = W.shape_features(df, seq_len, cols=["speed_kmh"]).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(41 - seq_len + 1))
    for r in rows:
        window = speeds[r["position"] : r["position"] + seq_len]
        known = [(i, v) for i, v in enumerate(window) if v is not None]
        values = np.array([v for _, v in known])
        first = [None if a is None or b is None else b - a for a, b in zip(window, window[1:])]
        second = [None if a is None or b is None else b - a for a, b in zip(first, first[1:])]
        want = {
            "mean": values.mean() if len(values) else None,
            "std": values.std(ddof=1) if len(values) > 1 else None,
            "min": values.min() if len(values) else None,
            "max": values.max() if len(values) else None,
            "range": np.ptp(values) if len(values) else None,
            "slope": statistics.linear_regression(*zip(*known)).slope if len(values) > 1 else None,
        }
        for name, steps in (("diff1", first), ("diff2", second)):
            steps = [abs(x) for x in steps if x is not None]
            want[name] = sum(steps) / len(steps) if steps else None
        for name, value in want.items():
            got = r[f"speed_kmh_{name}"]
            assert (got is None) == (value is None), (name, r["position"])
            assert value is None or got == pytest.approx(value, rel=1e-9, abs=1e-12 * max(map(abs, values))), (name, r["position"])


def test_slices_are_bounded_and_split_equal_timestamps(mixed, spark):
    df, series = mixed
    hot = df.filter(F.col("vehicle_id") == "A").withColumn("_length", F.lit(225))
    sliced = W.slice_rows_of(hot, "vehicle_id", ["event_ts", "event_id"], 29, 64)
    own = sliced.filter(~F.col("_halo")).groupBy("_slice").count().collect()
    assert sum(r["count"] for r in own) == len(series["A"])
    assert len(own) >= 3
    assert max(r["count"] for r in own) < 2 * 64


def test_slices_with_hash_keys(mixed):
    """Keys spread over all 64 bits divide as well as counted ones."""
    df, series = mixed
    hashed = df.withColumn("event_id", F.xxhash64("event_id"))
    plain, sliced = (W.add_position(hashed, **args).select("event_id", "position").collect() for args in ({}, HOT))
    assert sorted(plain) == sorted(sliced)
    hot = hashed.filter(F.col("vehicle_id") == "A").withColumn("_length", F.lit(225))
    own = W.slice_rows_of(hot, "vehicle_id", ["event_ts", "event_id"], 0, 16).groupBy("_slice").count().collect()
    assert max(r["count"] for r in own) < 2 * 16


def test_equal_keys_stay_together(readings):
    df = readings([{"event_id": 1, "event_ts": "2024-01-01 00:00:00"} for _ in range(60)])
    out = W.add_rolling(df, hot_rows=20, slice_rows=10)
    assert out.count() == 60


def test_one_series(mixed):
    df, series = mixed
    n = sum(len(s) for s in series.values())
    plain = W.sequence_labels(df, by=None).collect()
    sliced = W.sequence_labels(df, by=None, hot_rows=100, slice_rows=40).collect()
    assert len(plain) == n - 30
    assert sorted(map(str, plain)) == sorted(map(str, sliced))


def test_partial_windows_keep_all_rows(mixed):
    df, series = mixed
    rows = W.make_sequences(df, horizon=0, cols=["speed_kmh"], partial=True, **HOT)
    assert rows.count() == sum(len(s) for s in series.values())


def test_plain_plan_has_one_shuffle(spark, sf_dir):
    from ampledger.plans.jobs import process
    from ampledger.sources.fixture import telemetry

    plan = process(telemetry(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Window [") == 1


def test_empty_input(readings):
    empty = readings([{}]).limit(0)
    assert W.add_rolling(empty).count() == 0
    assert W.make_sequences(empty).count() == 0
    assert W.shape_features(empty).count() == 0
