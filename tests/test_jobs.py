import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from ampledger.operators import features as X
from ampledger.operators import kpis as K
from ampledger.operators import layers as L
from ampledger.operators.metrics import RUN_SCHEMA, best_config
from ampledger.operators.series import add_rolling
from ampledger.plans.jobs import run_daily, run_drift, run_fleet_job
from ampledger.schema import SENSOR_COLS, TELEMETRY_SCHEMA
from ampledger.sources import readers as R
from ampledger.sources import sinks
from ampledger.sources.fixture import telemetry


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return telemetry(spark, sf_dir).cache()


def test_fleet_job(spark, rows, tmp_path):
    job = run_fleet_job(rows, str(tmp_path))
    n = rows.count()
    assert job.lake_path.endswith("_parquet")  # no Delta in this session
    assert job.lake.count() == n
    assert job.summary.first()["total"] == n
    assert job.fleet.agg(F.sum("record_count")).first()[0] == n
    assert job.top.count() == 10
    assert len(job.lake.columns) == 17 + 16
    pruned = job.lake.filter("region = 'west'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in pruned


def test_lake_write_replaces(spark, rows, tmp_path):
    small = X.derive(rows)
    for _ in range(2):
        path, fmt = sinks.write_lake(small, str(tmp_path / "lake"), fmt="parquet")
    assert spark.read.format(fmt).load(path).count() == rows.count()


def test_anomalies_of_other_dates_stay(spark, rows, tmp_path):
    out = str(tmp_path / "anomalies")
    df = rows.withColumn("is_anomaly", F.col("injected_anomaly"))
    n = df.filter("is_anomaly = 1").count()
    for date in ("2024-01-01", "2024-01-02", "2024-01-02"):
        sinks.write_anomalies(df, out, date)
    assert [r["count"] for r in spark.read.parquet(out).groupBy("run_date").count().collect()] == [n, n]


def test_stage_modes(rows):
    for mode in ("none", "persist", "parquet"):
        assert sinks.stage(rows.limit(10), mode).count() == 10
    with pytest.raises(ValueError):
        sinks.stage(rows, "pickle")


def test_readers(spark, rows, tmp_path):
    path = str(tmp_path / "raw")
    rows.limit(20).write.parquet(path)
    assert R.read_telemetry(spark, path).schema == TELEMETRY_SCHEMA
    plan = R.read_telemetry(spark, path).filter("speed_kmh > 100").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(speed_kmh,100.0)" in plan and "ReadSchema: struct<event_id:bigint,speed_kmh:double>" in plan


def test_object_store_sets_the_token(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(R, "read_telemetry", lambda s, path: seen.setdefault("path", path))
    R.read_object_store(spark, "acct", "fleet", "/raw/telemetry/", "token")
    assert seen["path"] == "wasbs://fleet@acct.blob.core.windows.net/raw/telemetry/"
    assert spark.conf.get("fs.azure.sas.fleet.acct.blob.core.windows.net") == "token"


def test_requests(spark):
    good = {"vehicle_id": "VH_00001", **{c: 1.5 for c in SENSOR_COLS}}
    lacking = {k: v for k, v in good.items() if k != "voltage_v"}
    bodies = [
        (1, json.dumps({"readings": [good, lacking]})),
        (2, '{"readings": [{"vehicle_id": '),
        (3, json.dumps({"readings": []})),
        (4, None),
    ]
    parsed = R.parse_requests(spark.createDataFrame(bodies, "batch_id bigint, body string"))
    assert [(r["batch_id"], r["position"]) for r in R.accepted_readings(parsed).collect()] == [(1, 0)]
    rejected = sorted((r["batch_id"], r["position"] is None) for r in R.rejected_readings(parsed).collect())
    assert rejected == [(1, False), (2, True), (3, True), (4, True)]


def scored(spark, n, batch=1):
    return spark.range(n).select(
        F.lit(batch).cast("bigint").alias("batch_id"),
        F.col("id").cast("int").alias("position"),
        F.format_string("VH_%05d", "id").alias("vehicle_id"),
        (F.col("id") % 4 == 0).alias("is_anomaly"),
        F.lit(0.9).alias("anomaly_score"),
        F.lit(0.9).alias("confidence"),
        F.lit("ANOMALY").alias("label"),
    )


def test_batch_summary(spark):
    for n in (8, 2500):
        totals = K.batch_summary(scored(spark, n)).collect()
        assert [(r["total"], r["anomalies_found"], r["anomaly_rate"]) for r in totals] == [(n, n // 4, 0.25)]
    assert K.batch_summary(scored(spark, 0)).count() == 0


def test_batch_results(spark):
    one = K.batch_results(scored(spark, 8)).collect()
    assert [x["position"] for x in one[0]["results"]] == list(range(8))
    parts = K.batch_results(scored(spark, 2500)).orderBy("part").collect()
    assert [len(r["results"]) for r in parts] == [1000, 1000, 500]
    assert [x["position"] for r in parts for x in r["results"]] == list(range(2500))
    with pytest.raises(Exception, match="no position"):
        K.batch_results(scored(spark, 3).withColumn("position", F.lit(None).cast("int"))).collect()


def test_summaries_of_nothing(spark, rows):
    empty = X.derive(rows.limit(0))
    assert tuple(K.processing_summary(empty).first()) == (0, 0, None)
    assert K.region_kpis(empty).count() == 0


def test_fleet_kpis_by_day(rows):
    df = X.derive(rows)
    assert "date_" in K.fleet_kpis(df, by_day=True).columns
    assert K.fleet_kpis(df, by_day=True).agg(F.sum("record_count")).first()[0] == rows.count()


def test_daily_run(spark, rows, tmp_path):
    for date in ("2024-02-01", "2024-02-02"):
        run = run_daily(rows, date, str(tmp_path))
    n = rows.count()
    assert run.scored.count() == n
    found = run.summary.first()["anomaly_count"]
    assert abs(found - 0.03 * n) <= 1
    stored = spark.read.parquet(run.anomalies_path)
    assert stored.filter("run_date = '2024-02-02'").count() == found
    assert spark.read.schema(RUN_SCHEMA).parquet(run.runs_path).count() == 2
    assert run.nulls.count() == len(SENSOR_COLS)
    with pytest.raises(ValueError, match="Missing columns"):
        run_daily(rows.drop("vehicle_id"), "2024-02-01", str(tmp_path))


@pytest.fixture(scope="module")
def layer(rows):
    return L.fit_layer(X.fill_null_sensors(rows), "sequence")


def test_sequence_layer_learns_the_faults(rows, layer):
    flagged = layer.flag(rows).filter("l2_seq_flag = 1")
    assert flagged.filter("injected_anomaly = 1").count() / flagged.count() > 0.8
    assert layer.flag(rows).columns == [*rows.columns, "l2_seq_flag"]


def test_layer_flags_missing_sensors_as_zero(rows, layer):
    gaps = rows.withColumn("speed_kmh", F.when(F.col("event_id") % 5 != 0, F.col("speed_kmh")))
    gaps = gaps.withColumn("voltage_v", F.when(F.col("event_id") % 7 != 0, F.col("voltage_v")).otherwise(float("nan")))
    one, two = (
        sorted(layer.flag(df).filter("l2_seq_flag = 1").select("event_id").collect())
        for df in (gaps, X.fill_null_sensors(gaps))
    )
    assert one == two


def test_layer_save_and_load(spark, rows, layer, tmp_path):
    for _ in range(2):
        layer.save(str(tmp_path / "layer"))
    again = L.LayerModel.load(spark, str(tmp_path / "layer"))
    assert again.scaler == layer.scaler
    one, two = (sorted(m.flag(rows).filter("l2_seq_flag = 1").select("event_id").collect()) for m in (layer, again))
    assert one == two


def test_tables_without_a_key(rows, tmp_path):
    bare = rows.drop("event_id", "firmware_ver")
    job = run_fleet_job(bare, str(tmp_path / "job"))
    with_key = run_fleet_job(rows, str(tmp_path / "job2"))
    assert sorted(map(str, job.region.collect())) == sorted(map(str, with_key.region.collect()))
    run = run_daily(bare.drop("odometer_km"), "2024-02-01", str(tmp_path / "daily"))
    assert run.scored.count() == rows.count()
    assert run.ranges.count() == 7


def test_layer_flags_agree_on_hot_vehicles(rows, layer):
    plain = layer.flag(rows).filter("l2_seq_flag = 1").select("event_id").collect()
    sliced = layer.flag(rows, hot_rows=40, slice_rows=16).filter("l2_seq_flag = 1").select("event_id").collect()
    assert sorted(plain) == sorted(sliced)


def test_shape_layer_and_vote(rows, layer, tmp_path):
    filled = X.fill_null_sensors(rows)
    shape = L.fit_layer(filled, "shape", {"maxDepth": 3, "maxIter": 3})
    run = run_daily(rows, "2024-02-01", str(tmp_path), sequence_model=layer, shape_model=shape)
    row = run.scored.agg(
        F.sum("l1_iso_flag").alias("l1"), F.sum("l3_shape_flag").alias("l3"), F.sum("is_anomaly").alias("all"),
        F.count(F.when((F.col("is_anomaly") == 1) & (F.col("anomaly_votes") < 2), 1)).alias("wrong"),
    ).first()
    assert row["l3"] > 0 and row["wrong"] == 0 and 0 < row["all"]


def test_config_grid(rows):
    runs = L.config_grid(X.fill_null_sensors(rows), "sequence", L.SEQUENCE_CONFIGS[1:3])
    assert [r["run_name"] for r in runs.orderBy("config_idx").collect()] == ["sequence_config_1", "sequence_config_2"]
    assert best_config(runs).count() <= 1


def test_grid_keeps_its_best_model(rows):
    filled = X.fill_null_sensors(rows)
    runs, best = L.fit_grid(filled, "sequence", L.SEQUENCE_CONFIGS[1:3], scale_on="train")
    winner = best_config(runs).first()
    assert (best is None) == (winner is None)
    if best is not None:
        assert best.flag(filled).count() == filled.count()
    assert best is None or best.scaler != L.fit_scaler(filled)


def test_training_windows_are_bounded(rows):
    filled = X.fill_null_sensors(rows)
    scaler = L.fit_scaler(filled)
    every = L.training_table(filled, "sequence", scaler).count()
    limit = filled.count() // 2
    some = L.training_table(filled, "sequence", scaler, fit_rows=limit).count()
    assert 0.3 * every < some < 0.7 * every


def test_batch_score(rows, layer):
    out = L.batch_score(rows, layer, keep=["event_id", "vehicle_id"])
    assert out.columns == ["event_id", "vehicle_id", "is_anomaly", "anomaly_score", "confidence", "label"]
    assert out.filter("anomaly_score < 0 or anomaly_score > 1 or confidence < 0.5").count() == 0
    assert out.filter("is_anomaly and label <> 'ANOMALY'").count() == 0


def test_drift_job(rows, tmp_path):
    run = run_drift(rows, rows.withColumn("speed_kmh", F.col("speed_kmh") + 50), str(tmp_path))
    drifted = {r["column"]: r["drift"] for r in run.report.collect()}
    assert drifted["speed_kmh"] and not drifted["voltage_v"]
    assert tuple(run.drifted.first()) == (1, 5)
    files = [f for f in os.listdir(run.report_path) if f.endswith(".csv")]
    assert len(files) == 1
    assert open(os.path.join(run.report_path, files[0])).readline().strip() == "column,ks_stat,p_value,drift"


def test_python_workers_need_no_package(sf_dir, tmp_path):
    """The forest runs when only the driver can import the package."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
        import sys
        sys.path.insert(0, {repo!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
        from ampledger.sources.fixture import telemetry
        from ampledger.operators.forest import fit_isolation_forest
        rows = telemetry(spark, {sf_dir!r})
        print("rows", fit_isolation_forest(rows, trees=4, subsample=32).transform(rows).count())
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 1000" in done.stdout, done.stderr[-2000:]


def test_rerun_without_hits_leaves_no_stale_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1), (2, 0)], "event_id long, is_anomaly int")
    sinks.write_anomalies(rows, str(tmp_path / "a"), "2024-01-01")
    sinks.write_anomalies(rows, str(tmp_path / "a"), "2024-01-02")
    sinks.write_anomalies(rows.filter("event_id = 2"), str(tmp_path / "a"), "2024-01-01")
    stored = spark.read.parquet(str(tmp_path / "a"))
    assert [(r["event_id"], str(r["run_date"])) for r in stored.collect()] == [(1, "2024-01-02")]


def test_retry_logs_one_run(spark, readings, tmp_path):
    rows = readings([{"speed_kmh": float(i % 90), "event_id": None if i % 2 else i} for i in range(400)])
    for _ in range(2):
        run = run_daily(rows, "2024-02-01", str(tmp_path / "d"))
    assert spark.read.parquet(run.runs_path).count() == 1


def test_csv_is_read_by_name(spark, tmp_path):
    names = [f.name for f in TELEMETRY_SCHEMA if f.name != "event_id"]
    text = {"vehicle_id": "VH_00001", "event_ts": "2024-01-01 00:09:58", "region": "US-CA", "firmware_ver": "v12.1", "injected_anomaly": "0"}
    order = sorted(names, reverse=True)
    lines = [",".join(order)]
    for speed in ("80.5", "fast", ""):
        lines.append(",".join({**text, "speed_kmh": speed}.get(n, "1.0") for n in order))
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    got = R.read_csv(spark, str(tmp_path / "in.csv"))
    assert got.columns == names
    assert sorted((r["vehicle_id"], str(r["event_ts"]), str(r["speed_kmh"])) for r in got.collect()) == [("VH_00001", "2024-01-01 00:09:58", x) for x in ("80.5", "None", "None")]
    assert [r["speed_kmh"] for r in R.csv_rejects(spark, str(tmp_path / "in.csv")).collect()] == ["fast"]
    (tmp_path / "short.csv").write_text("vehicle_id,event_ts\nVH_1,2024-01-01 00:00:00\n")
    with pytest.raises(ValueError):
        R.read_csv(spark, str(tmp_path / "short.csv"))


def test_text_tie_breaker_is_refused_at_any_size(spark, readings):
    rows = readings([{}]).withColumn("event_id", F.lit("e0"))
    with pytest.raises(TypeError):
        add_rolling(rows)


def test_files_of_several_layouts_are_read_as_they_are(spark, tmp_path, sf_dir):
    from ampledger.sources.fixture import telemetry

    rows = telemetry(spark, sf_dir).limit(40)
    path = str(tmp_path / "a folder")
    for k in range(3):  # layouts that take turns
        rows.write.mode("append").parquet(path)
        rows.withColumn("event_ts", F.col("event_ts").cast("string")).withColumn("injected_anomaly", F.lit(1).cast("long")).drop("event_id").write.mode("append").parquet(path)
    got = R.read_raw_telemetry(spark, path)
    assert got.schema.simpleString() == TELEMETRY_SCHEMA.simpleString()
    assert got.count() == 240 and got.filter("event_ts is null").count() == 0
    assert got.filter("event_id is null and injected_anomaly = 1").count() == 120
    bad = rows.withColumn("speed_kmh", F.lit("fast"))
    bad.write.parquet(str(tmp_path / "text"))
    assert R.read_raw_telemetry(spark, str(tmp_path / "text")).filter("speed_kmh is null").count() == 40
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        R.read_raw_telemetry(spark, str(tmp_path / "none"))


def test_csv_files_bind_by_their_own_header(spark, tmp_path):
    names = [f.name for f in TELEMETRY_SCHEMA if f.name != "event_id"]
    text = {"vehicle_id": "VH_00001", "event_ts": "2024-01-01 00:09:58", "region": "US-CA", "firmware_ver": "v12.1", "injected_anomaly": "0", "speed_kmh": "80.5"}
    for k, order in enumerate((names, names[::-1], names + ["extra"])):
        line = ",".join(text.get(n, "1.0") for n in order)
        (tmp_path / f"{k}.csv").write_text("\n".join([",".join(order), line, line.rsplit(",", 1)[0], line + ",more"]) + "\n")
    got = R.read_csv(spark, str(tmp_path)).collect()
    assert [(r["vehicle_id"], r["speed_kmh"], r["injected_anomaly"]) for r in got] == [("VH_00001", 80.5, 0)] * 3
    assert R.csv_rejects(spark, str(tmp_path)).filter(F.col(R.RAGGED).isNotNull()).count() == 6


def test_text_keys_are_hashed_by_the_jobs(spark, readings, tmp_path):
    rows = readings([{"speed_kmh": float(i)} for i in range(40)]).withColumn("event_id", F.concat(F.lit("e"), "event_id"))
    job = run_fleet_job(rows.withColumn("event_id", F.when(F.col("speed_kmh") > 3, F.col("event_id"))), str(tmp_path / "j"), fmt="parquet")
    assert job.lake.select("event_id").distinct().count() == 40
    assert dict(job.lake.dtypes)["event_id"] == "bigint"


def test_audit_limits_stop_a_run(spark, readings, tmp_path):
    rows = readings([{"speed_kmh": None if i % 4 == 0 else float(i % 90), "voltage_v": 900.0 if i % 10 == 0 else 400.0} for i in range(200)])
    run = run_daily(rows, "2024-02-01", str(tmp_path / "a"), limits={"null_count": 0.3, "out_of_range": 0.2})
    counts = {r["column_name"]: (r["n_records"], r["null_count"], r["out_of_range"]) for r in run.audits.collect()}
    assert counts["speed_kmh"] == (200, 50, 0) and counts["voltage_v"] == (200, 0, 20)
    assert spark.read.parquet(run.runs_path).first()["params"]["n_records"] == "200"
    for limit in ({"null_count": 0.2}, {"out_of_range": 0.05}):
        with pytest.raises(ValueError, match="audit"):
            run_daily(rows, "2024-02-01", str(tmp_path / "b"), limits=limit)
    assert not os.path.exists(tmp_path / "b" / "anomalies")
    assert spark.read.parquet(str(tmp_path / "b" / "audits")).count() == 10


def test_jobs_leave_no_staged_table(spark, readings, tmp_path):
    top = spark.conf.get("spark.checkpoint.dir") + f"/staged-{spark.sparkContext.applicationId}"
    tables = lambda: set(os.listdir(top)) if os.path.isdir(top) else set()
    rows = readings([{"speed_kmh": float(i % 90)} for i in range(200)])
    before = tables()
    run_fleet_job(rows, str(tmp_path / "j1"), fmt="parquet", hot_rows=50)
    run_drift(rows, rows, str(tmp_path / "j3"))
    run = run_daily(rows, "2024-02-01", str(tmp_path / "j2"))
    assert run.scored.count() == 200
    assert tables() == before


def test_grid_of_one_and_of_many_workers_agree(rows):
    filled = X.fill_null_sensors(rows)
    one, many = (L.fit_grid(filled, "sequence", L.SEQUENCE_CONFIGS[:3], workers=n) for n in (1, 3))
    assert one[0].drop("run_ts").collect() == many[0].drop("run_ts").collect()
    assert (one[1] is None) == (many[1] is None)
    assert one[1] is None or one[1].digest() == many[1].digest()
