"""The three composed jobs: batch processing, the daily anomaly run and the drift report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampledger.operators import kpis as K
from ampledger.operators.drift import drifted_column_count, ks_drift
from ampledger.operators.features import cast_telemetry, derive, ensure_key, fill_null_sensors
from ampledger.operators.forest import fit_isolation_forest, with_threshold
from ampledger.operators.layers import LayerModel, ensemble_vote
from ampledger.operators.metrics import log_runs, run_row
from ampledger.operators.scaling import fit_scaler
from ampledger.operators.series import add_rolling
from ampledger.operators.validate import audit_rows, check_audit, null_audit, observe_audit, range_audit, validate_schema
from ampledger.schema import CONTAMINATION, DRIFT_COLS, SENSOR_COLS
from ampledger.session import staging
from ampledger.sources.sinks import write_anomalies, write_kpis, write_lake, write_report_csv


def process(df: DataFrame, **series_args) -> DataFrame:
    """Raw telemetry to the processed table: cast, derive, flag, roll. One shuffle, by vehicle."""
    return add_rolling(derive(cast_telemetry(ensure_key(df))), **series_args)


@dataclass(frozen=True)
class FleetJob:
    lake_path: str
    lake: DataFrame
    fleet: DataFrame
    region: DataFrame
    top: DataFrame
    summary: DataFrame


def run_fleet_job(df: DataFrame, out: str, fmt: str = "auto", **series_args) -> FleetJob:
    """Process once into the lake; every later result reads the lake's few columns it needs."""
    spark = df.sparkSession
    with staging(spark):
        processed = process(df, **series_args)
        path, used = write_lake(processed, f"{out}/telemetry", fmt=fmt)
    reader = spark.read.format(used)
    lake = (reader.schema(processed.schema) if used == "parquet" else reader).load(path)
    fleet_path, region_path = write_kpis(K.fleet_kpis(lake), K.region_kpis(lake), out)
    region = spark.read.parquet(region_path)
    return FleetJob(
        lake_path=path,
        lake=lake,
        fleet=spark.read.parquet(fleet_path),
        region=region,
        top=K.top_regions(region),
        summary=K.summary_of_regions(region),
    )


@dataclass(frozen=True)
class DailyRun:
    scored: DataFrame
    anomalies_path: str
    runs_path: str
    nulls: DataFrame
    ranges: DataFrame
    summary: DataFrame
    audits: DataFrame


def run_daily(
    df: DataFrame,
    run_date: str,
    out: str,
    sequence_model: LayerModel | None = None,
    shape_model: LayerModel | None = None,
    min_votes: int | None = None,
    keys: list[str] | None = None,
    limits: dict[str, float] | None = None,
    **series_args,
) -> DailyRun:
    """Validate, fill, scale, run the layers, vote, store anomalies and the run's metrics.

    A missing window model leaves its layer at 0. ``min_votes`` defaults to the
    majority of three when a window model is given, else to any vote. Audit
    counts are gathered while the forest scores the rows for its threshold, and
    stored under the run date; with ``limits`` (shares for ``null_count`` and
    ``out_of_range``) a column above them fails the run before anomalies are
    stored. The summary is gathered while these are written: no step stores the
    whole table. ``scored`` is computed when it is used; store it to read it often.
    """
    keys = keys or ["event_id"]
    validate_schema(df)
    spark = df.sparkSession
    anomalies_path, runs_path, audits_path = f"{out}/anomalies", f"{out}/runs", f"{out}/audits"
    filled = fill_null_sensors(ensure_key(df))
    observed, seen = observe_audit(df)
    with staging(spark):
        scaler = fit_scaler(filled)
        forest = fit_isolation_forest(scaler.transform(filled), keys=keys, contamination=None)
        forest = with_threshold(forest, fill_null_sensors(ensure_key(observed)), scaler=scaler)
        counts = seen.get
        audit_rows(spark, counts).coalesce(1).write.mode("overwrite").parquet(f"{audits_path}/run_date={run_date}")
    check_audit(counts, limits or {})
    scored = filled
    for model, flag in ((sequence_model, "l2_seq_flag"), (shape_model, "l3_shape_flag")):
        scored = scored.withColumn(flag, F.lit(0)) if model is None else model.flag(scored, **series_args)
    if min_votes is None:
        min_votes = 1 if sequence_model is None and shape_model is None else 2
    scored = ensemble_vote(forest.transform(scored, scaler), min_votes=min_votes)
    watched, totals = K.observe_summary(scored)
    write_anomalies(watched, anomalies_path, run_date)
    totals = totals.get
    summary = spark.createDataFrame([(totals["anomaly_count"], totals["anomaly_rate_pct"])], K.RUN_SUMMARY)
    params = {"contamination": CONTAMINATION, "min_votes": min_votes, "run_date": run_date, "n_records": counts["n_records"]}
    log_runs(run_row(summary, f"ensemble_{run_date}", params), runs_path, run_id=run_date)
    audits = spark.read.parquet(f"{audits_path}/run_date={run_date}")
    return DailyRun(scored, anomalies_path, runs_path, null_audit(df, SENSOR_COLS), range_audit(df), summary, audits)


@dataclass(frozen=True)
class DriftRun:
    report: DataFrame
    report_path: str
    drifted: DataFrame


def run_drift(ref: DataFrame, cur: DataFrame, out: str, cols: list[str] = DRIFT_COLS, **ks_args) -> DriftRun:
    """Drift report to CSV; the counts read the stored report of one row per column."""
    path = f"{out}/drift_report"
    with staging(ref.sparkSession):
        report = ks_drift(ref, cur, cols, **ks_args)
        write_report_csv(report, path)
    stored = report.sparkSession.read.option("header", True).schema(report.schema).csv(path)
    return DriftRun(stored, path, drifted_column_count(stored))
