"""Every registered query next to the SQL that checks it.

All queries read the whole telemetry view over ``events``. Floats are rounded
and timestamps shown as text, so that both engines print the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampledger.functions import scalars as S
from ampledger.operators import features as X
from ampledger.operators import kpis as K
from ampledger.operators import layers as L
from ampledger.operators import metrics as M
from ampledger.operators import series as W
from ampledger.operators import validate as V
from ampledger.operators.augment import inject_faults
from ampledger.operators.drift import drifted_column_count, ks_drift, ks_two_sample
from ampledger.operators.forest import contamination_threshold, fit_transform
from ampledger.operators.ordering import first_rows
from ampledger.operators.scaling import fit_scaler, scale_sensors, scaler_stats
from ampledger.plans.jobs import process, run_daily, run_drift, run_fleet_job
from ampledger.schema import (
    DRIFT_COLS,
    PREVIEW_COLS,
    SENSOR_COLS,
    SENSOR_RANGES,
    TELEMETRY_SCHEMA,
)
from ampledger.session import scratch_path
from ampledger.sources import readers as R
from ampledger.sources import sinks
from ampledger.sources.fixture import EVENTS_SCHEMA, duckdb_sql, from_events, telemetry
from ampledger.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_DATE = "2024-02-01"
# Below the rows of a test vehicle, so that every vehicle takes the sliced path.
HOT_TEST = {"hot_rows": 40, "slice_rows": 16}

_PROCESSED = f"""
with telemetry as ({duckdb_sql()}),
base as (
  select *,
    round(voltage_v * current_a / cast(1000 as double), 2) as power_kw,
    round(temp_motor_c - temp_battery_c, 2) as temp_delta_c,
    round(sqrt(accel_x * accel_x + accel_y * accel_y + accel_z * accel_z), 4) as accel_magnitude,
    cast(event_ts as date) as date_,
    cast(year(event_ts) as int) as year_, cast(month(event_ts) as int) as month_,
    cast(hour(event_ts) as int) as hour_
  from telemetry),
derived as (
  select *,
    case when power_kw > 0 then round(speed_kmh / power_kw, 4) end as efficiency_km_per_kw,
    cast(temp_motor_c > 130 as int) as flag_high_temp,
    cast(battery_pct < 10 as int) as flag_low_battery,
    cast(voltage_v > 480 as int) as flag_overvoltage,
    cast(accel_magnitude > 15 as int) as flag_high_accel,
    cast(temp_motor_c > 130 or battery_pct < 10 or voltage_v > 480 or accel_magnitude > 15 as int) as rule_anomaly
  from base),
processed as (
  select *,
    round(avg(temp_motor_c) over w30, 2) as rolling_avg_temp,
    round(avg(battery_pct) over w30, 2) as rolling_avg_battery,
    round(stddev_samp(speed_kmh) over w30, 4) as rolling_std_speed
  from derived
  window w30 as (partition by vehicle_id order by event_ts, event_id rows between 29 preceding and current row)),
ranked as (
  select *, row_number() over (partition by vehicle_id order by event_ts, event_id) as pos,
    count(*) over (partition by vehicle_id) as n
  from derived),
logits as (
  select event_id, vehicle_id, cast(0 as double) as z0, (temp_motor_c - cast(100 as double)) / cast(10 as double) as z1,
    injected_anomaly as label, rule_anomaly as prediction
  from derived),
probs as (
  select *, exp(z1 - greatest(z0, z1)) / (exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1))) as p from logits),
decided as (
  select event_id, vehicle_id, event_id // 64 as batch_id, cast(event_id % 64 as int) as position, p > 0.5 as is_anomaly,
    round(p, 4) as anomaly_score, round(greatest(p, cast(1 as double) - p), 4) as confidence,
    case when p > 0.5 then 'ANOMALY' else 'NORMAL' end as label
  from probs),
votes as (
  select event_id, injected_anomaly as label, cast(temp_motor_c > 100 as int) as l1_iso_flag,
    cast(battery_pct < 30 as int) as l2_seq_flag, cast(voltage_v > 450 as int) as l3_shape_flag
  from derived),
voted as (
  select *, l1_iso_flag + l2_seq_flag + l3_shape_flag as anomaly_votes,
    cast(l1_iso_flag + l2_seq_flag + l3_shape_flag >= 2 as int) as is_anomaly
  from votes)
"""
_TS = "strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f')"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its check."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = _PROCESSED + sql
        return fn

    return add


def _ts_text(c: str = "event_ts"):
    return F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _rounded(cols: list[str], digits: int = 6) -> list:
    return [F.round(c, digits).alias(c) for c in cols]


def _sql_rounded(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in cols)


def derived(spark: SparkSession, sf: str) -> DataFrame:
    return X.derive(telemetry(spark, sf))


def logits(spark: SparkSession, sf: str) -> DataFrame:
    """Two logits per row from the motor temperature: a stand-in for a model."""
    return derived(spark, sf).select(
        "event_id",
        "vehicle_id",
        F.lit(0.0).alias("z0"),
        ((F.col("temp_motor_c") - 100.0) / 10.0).alias("z1"),
        F.col("injected_anomaly").alias("label"),
        F.col("rule_anomaly").alias("prediction"),
    )


def layer_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Three flags per row from plain thresholds: a stand-in for the layers."""
    return telemetry(spark, sf).select(
        "event_id",
        F.col("injected_anomaly").alias("label"),
        S.above("temp_motor_c", 100.0).alias("l1_iso_flag"),
        S.below("battery_pct", 30.0).alias("l2_seq_flag"),
        S.above("voltage_v", 450.0).alias("l3_shape_flag"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """JSON bodies of 64 readings each; some are cut off, some readings lack a voltage."""
    batch = F.floor(F.col("event_id") / 64).cast("bigint")
    voltage = F.when(F.col("event_id") % 50 != 7, F.col("voltage_v"))
    reading = F.struct("vehicle_id", *[voltage.alias(c) if c == "voltage_v" else F.col(c) for c in SENSOR_COLS])
    packed = F.array_sort(F.collect_list(F.struct("event_id", reading.alias("reading"))))
    bodies = telemetry(spark, sf).groupBy(batch.alias("batch_id")).agg(packed.alias("r"))
    body = F.to_json(F.struct(F.col("r.reading").alias("readings")))
    broken = F.expr("substring(body, 1, length(body) - 5)")
    return bodies.select("batch_id", body.alias("body")).withColumn(
        "body", F.when(F.col("batch_id") % 7 == 3, broken).otherwise(F.col("body"))
    )


def drift_samples(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Five sevenths of the rows as reference; the others, three columns shifted, as current."""
    rows = telemetry(spark, sf)
    is_ref = F.col("event_id") % 7 < 5
    shift = {
        "speed_kmh": F.col("speed_kmh") * 1.2 + 5.0,
        "temp_motor_c": F.col("temp_motor_c") + 8.0,
        "current_a": F.col("current_a") * 1.2,
    }
    return rows.filter(is_ref), rows.filter(~is_ref).withColumns(shift)


# Scans and sinks

_RAW = [*SENSOR_COLS, "odometer_km"]
_ALL_SQL = (
    f"select event_id, vehicle_id, {_TS} as event_ts, {_sql_rounded(_RAW)}, region, firmware_ver, injected_anomaly"
)


def _all_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "vehicle_id", _ts_text().alias("event_ts"), *_rounded(_RAW), "region", "firmware_ver", "injected_anomaly"
    )


@query("scan_parquet", f"{_ALL_SQL} from telemetry")
def scan_parquet(spark, sf):
    events = R.read_telemetry(spark, f"{sf}/events.parquet", EVENTS_SCHEMA)
    return _all_columns(from_events(events))


@query("scan_csv", f"{_ALL_SQL} from telemetry")
def scan_csv(spark, sf):
    path = scratch_path(spark, "csv")
    names = [f.name for f in TELEMETRY_SCHEMA.fields]
    rows = telemetry(spark, sf).withColumn("event_ts", _ts_text())
    rows.select(*names).write.option("header", True).csv(path)
    return _all_columns(R.read_csv(spark, path))


# One folder of three layouts: as declared; text time, long label and other types; and a table without key, place and label
# whose time is named otherwise.
_RAW_LAYOUT_SQL = """
    select case when event_id % 3 = 2 then null else event_id end as event_id, vehicle_id, event_ts,
           SENSORS, case when event_id % 3 = 2 then null else odometer_km end as odometer_km,
           case when event_id % 3 = 2 then null else region end as region,
           case when event_id % 3 = 2 then null else firmware_ver end as firmware_ver,
           case when event_id % 3 = 2 then null else injected_anomaly end as injected_anomaly
    from telemetry""".replace("SENSORS", ", ".join(SENSOR_COLS))


@query("scan_parquet_raw_layout", f"{_ALL_SQL} from ({_RAW_LAYOUT_SQL}) t")
def scan_parquet_raw_layout(spark, sf):
    path = scratch_path(spark, "raw")
    rows = telemetry(spark, sf)
    third = lambda k: rows.filter(F.col("event_id") % 3 == k)
    odd = {"event_ts": _ts_text(), "injected_anomaly": F.col("injected_anomaly").cast("long"), "odometer_km": F.col("odometer_km").cast("string")}
    third(0).write.parquet(path)
    third(1).withColumns(odd).write.mode("append").parquet(path)
    third(2).select("vehicle_id", F.col("event_ts").cast("timestamp_ntz").alias("timestamp"), *SENSOR_COLS).write.mode("append").parquet(path)
    return _all_columns(R.read_raw_telemetry(spark, path))


def _csv_lines(rows: DataFrame, names: list[str], path: str) -> None:
    """CSV text with a header in every file; a row's ``cells`` may be more or fewer than its names."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of its task
    line = F.array_join("cells", ",")
    rows.select(F.when(first, F.concat(F.lit(",".join(names) + "\n"), line)).otherwise(line).alias("value")).write.mode("append").text(path)


_CSV_NAMES = [f.name for f in TELEMETRY_SCHEMA.fields]


def _mixed_csv(spark, sf) -> str:
    """Files of two header orders in one folder; some rows with a cell too few, too many, or unreadable."""
    path = scratch_path(spark, "csv")
    rows = telemetry(spark, sf).withColumn("event_ts", _ts_text())
    cells = F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _CSV_NAMES))
    fault = F.col("event_id") % 50
    speed = _CSV_NAMES.index("speed_kmh") + 1
    spoilt = F.when(fault == 0, F.slice(cells, 1, len(_CSV_NAMES) - 2)).when(fault == 2, F.array_append(cells, F.lit("9")))
    spoilt = spoilt.when(fault == 4, F.concat(F.slice(cells, 1, speed - 1), F.array(F.lit("fast")), F.slice(cells, speed + 1, len(_CSV_NAMES))))
    even = rows.filter("event_id % 2 = 0").select(spoilt.otherwise(cells).alias("cells"))
    _csv_lines(even, _CSV_NAMES, path)
    _csv_lines(rows.filter("event_id % 2 = 1").select(F.reverse(cells).alias("cells")), _CSV_NAMES[::-1], path)
    return path


@query("scan_csv_mixed_headers", f"{_ALL_SQL.replace('round(speed_kmh, 6)', 'case when event_id % 50 <> 4 then round(speed_kmh, 6) end')} from telemetry where event_id % 50 not in (0, 2)")
def scan_csv_mixed_headers(spark, sf):
    return _all_columns(R.read_csv(spark, _mixed_csv(spark, sf)))


@query(
    "scan_csv_rejects",
    """select event_id, vehicle_id, event_id % 50 <> 4 as ragged, case when event_id % 50 = 4 then 'fast' end as speed
       from telemetry where event_id % 50 in (0, 2, 4)""",
)
def scan_csv_rejects(spark, sf):
    bad = R.csv_rejects(spark, _mixed_csv(spark, sf))
    ragged = F.col(R.RAGGED).isNotNull()
    speed = F.when(~ragged, F.col("speed_kmh"))
    return bad.select(F.col("event_id").cast("long").alias("event_id"), "vehicle_id", ragged.alias("ragged"), speed.alias("speed"))


def _saved_table(spark, sf):
    path = scratch_path(spark, "processed")
    name = "telemetry_" + path.rsplit("-", 1)[1]
    sinks.write_table(process(telemetry(spark, sf)), name, path=path)
    return name


_FIRST = "select event_id, vehicle_id, rule_anomaly, rolling_avg_temp from processed"


@query("scan_table_limit", f"{_FIRST} order by event_ts, event_id limit 30000")
def scan_table_limit(spark, sf):
    rows = R.read_table_first(spark, _saved_table(spark, sf), 30_000)
    return rows.select("event_id", "vehicle_id", "rule_anomaly", "rolling_avg_temp")


@query("scan_table_limit_bounded", f"{_FIRST} order by event_ts, event_id limit 500")
def scan_table_limit_bounded(spark, sf):
    """The same with a bound found first, as on tables too large for a top-n."""
    rows = first_rows(process(telemetry(spark, sf)), 500, gather_rows=100)
    return rows.select("event_id", "vehicle_id", "rule_anomaly", "rolling_avg_temp")


@query(
    "scan_json_readings",
    f"""select event_id // 64 as batch_id, cast(event_id % 64 as int) as position, vehicle_id, {_sql_rounded(SENSOR_COLS)}
        from telemetry where (event_id // 64) % 7 <> 3 and event_id % 50 <> 7""",
)
def scan_json_readings(spark, sf):
    good = R.accepted_readings(R.parse_requests(requests(spark, sf)))
    return good.select("batch_id", "position", "vehicle_id", *_rounded(SENSOR_COLS))


@query(
    "scan_json_rejects",
    """select event_id // 64 as batch_id, cast(event_id % 64 as int) as position, vehicle_id
       from telemetry where (event_id // 64) % 7 <> 3 and event_id % 50 = 7
       union all
       select distinct event_id // 64, cast(null as int), cast(null as varchar) from telemetry where (event_id // 64) % 7 = 3""",
)
def scan_json_rejects(spark, sf):
    bad = R.rejected_readings(R.parse_requests(requests(spark, sf)))
    return bad.select("batch_id", "position", "vehicle_id")


@query(
    "sink_partitioned",
    "select event_id, vehicle_id, year_, month_, region, power_kw, rolling_std_speed, rule_anomaly from processed",
)
def sink_partitioned(spark, sf):
    path, fmt = sinks.write_lake(process(telemetry(spark, sf)), scratch_path(spark, "lake"), fmt="parquet")
    cols = ["event_id", "vehicle_id", "year_", "month_", "region", "power_kw", "rolling_std_speed", "rule_anomaly"]
    return spark.read.format(fmt).load(path).select(*cols)


@query("sink_fallback", "select event_id, region, power_kw from derived")
def sink_fallback(spark, sf):
    path, fmt = sinks.write_lake(derived(spark, sf), scratch_path(spark, "lake"))
    return spark.read.format(fmt).load(path).select("event_id", "region", "power_kw")


@query("sink_table", "select event_id, vehicle_id, hour_, rule_anomaly, rolling_avg_battery from processed")
def sink_table(spark, sf):
    table = spark.table(_saved_table(spark, sf))
    return table.select("event_id", "vehicle_id", "hour_", "rule_anomaly", "rolling_avg_battery")


@query(
    "sink_kpis",
    """select 'fleet' as kpi, cast(count(*) as bigint) as n_groups, cast(sum(c) as bigint) as n_records, cast(sum(a) as bigint) as n_anomalies
       from (select count(*) as c, sum(rule_anomaly) as a from derived group by vehicle_id, year_, month_, hour_, region)
       union all
       select 'region', cast(count(*) as bigint), cast(sum(c) as bigint), cast(sum(a) as bigint)
       from (select count(*) as c, sum(rule_anomaly) as a from derived group by region, date_)""",
)
def sink_kpis(spark, sf):
    rows = derived(spark, sf)
    fleet, region = sinks.write_kpis(K.fleet_kpis(rows), K.region_kpis(rows), scratch_path(spark, "kpis"))

    def totals(path, name, records, anomalies):
        return spark.read.parquet(path).agg(
            F.lit(name).alias("kpi"),
            F.count(F.lit(1)).alias("n_groups"),
            F.sum(records).alias("n_records"),
            F.sum(anomalies).alias("n_anomalies"),
        )

    return totals(fleet, "fleet", "record_count", "anomaly_count").unionByName(
        totals(region, "region", "total_records", "total_anomalies")
    )


@query(
    "sink_anomalies_by_run",
    f"select event_id, vehicle_id, '{RUN_DATE}' as run_date from derived where rule_anomaly = 1",
)
def sink_anomalies_by_run(spark, sf):
    """Stored twice under one date: the rerun replaces it."""
    out = scratch_path(spark, "anomalies")
    rows = derived(spark, sf).select("event_id", "vehicle_id", "rule_anomaly")
    for _ in range(2):
        sinks.write_anomalies(rows, out, RUN_DATE, flag="rule_anomaly")
    return spark.read.parquet(out).select("event_id", "vehicle_id", F.col("run_date").cast("string").alias("run_date"))


@query("stage_checkpoint", "select event_id, power_kw, efficiency_km_per_kw, rule_anomaly from derived")
def stage_checkpoint(spark, sf):
    staged = sinks.stage(derived(spark, sf), "parquet")
    return staged.select("event_id", "power_kw", "efficiency_km_per_kw", "rule_anomaly")


@query(
    "sample_preview",
    f"""select {", ".join(c if c in ("vehicle_id", "rule_anomaly") else f"round({c}, 6) as {c}" for c in PREVIEW_COLS)}
        from derived order by event_ts, event_id limit 5""",
)
def sample_preview(spark, sf):
    first = first_rows(derived(spark, sf), 5)
    return first.select(*[c if c in ("vehicle_id", "rule_anomaly") else F.round(c, 6).alias(c) for c in PREVIEW_COLS])


# Projections and scalar functions


@query("project_sensors", f"select event_id, {_sql_rounded(SENSOR_COLS)}, rule_anomaly from derived")
def project_sensors(spark, sf):
    rows = X.project_sensors(derived(spark, sf), keys=["event_id"])
    return rows.select("event_id", *_rounded(SENSOR_COLS), "rule_anomaly")


@query("rename_label", "select event_id, rule_anomaly as label from derived")
def rename_label(spark, sf):
    return X.rename_label(derived(spark, sf)).select("event_id", "label")


_CAST_COLS = ["speed_kmh", "battery_pct", "regen_brake_kw", "odometer_km"]


@query(
    "cast_telemetry",
    f"""select event_id, case when event_id % 41 <> 0 then {_TS} end as event_ts,
        {", ".join(f"case when event_id % 50 <> {i} then round({c}, 6) end as {c}" for i, c in enumerate(_CAST_COLS))}
        from telemetry""",
)
def cast_telemetry(spark, sf):
    """All columns as text, some of it malformed, back to typed columns."""
    rows = telemetry(spark, sf)
    text = {
        c: F.when(F.col("event_id") % 50 != i, F.col(c).cast("string")).otherwise(F.lit("n/a"))
        for i, c in enumerate(_CAST_COLS)
    }
    text["event_ts"] = F.when(F.col("event_id") % 41 != 0, _ts_text()).otherwise(F.lit("yesterday"))
    typed = X.cast_telemetry(rows.withColumns(text))
    return typed.select("event_id", _ts_text().alias("event_ts"), *_rounded(_CAST_COLS))


@query("feat_power", "select event_id, power_kw from derived")
def feat_power(spark, sf):
    return X.add_power(telemetry(spark, sf)).select("event_id", "power_kw")


@query("feat_temp_delta", "select event_id, temp_delta_c from derived")
def feat_temp_delta(spark, sf):
    return X.add_temp_delta(telemetry(spark, sf)).select("event_id", "temp_delta_c")


@query("feat_accel_magnitude", "select event_id, accel_magnitude from derived")
def feat_accel_magnitude(spark, sf):
    return X.add_accel_magnitude(telemetry(spark, sf)).select("event_id", "accel_magnitude")


@query("feat_efficiency", "select event_id, efficiency_km_per_kw from derived")
def feat_efficiency(spark, sf):
    return X.add_efficiency(X.add_power(telemetry(spark, sf))).select("event_id", "efficiency_km_per_kw")


@query("feat_date_parts", "select event_id, cast(date_ as varchar) as date_, year_, month_, hour_ from derived")
def feat_date_parts(spark, sf):
    rows = X.add_date_parts(telemetry(spark, sf))
    return rows.select("event_id", F.col("date_").cast("string").alias("date_"), "year_", "month_", "hour_")


@query("rule_flags", f"select event_id, {', '.join(X.FLAG_COLS)} from derived")
def rule_flags(spark, sf):
    return X.add_rule_flags(X.add_accel_magnitude(telemetry(spark, sf))).select("event_id", *X.FLAG_COLS)


@query("rule_anomaly", "select event_id, rule_anomaly from derived")
def rule_anomaly(spark, sf):
    return derived(spark, sf).select("event_id", "rule_anomaly")


@query("filter_anomalies", "select event_id, vehicle_id, power_kw from derived where rule_anomaly = 1")
def filter_anomalies(spark, sf):
    return X.filter_anomalies(derived(spark, sf)).select("event_id", "vehicle_id", "power_kw")


_GAPS = ["speed_kmh", "voltage_v", "current_a"]


def with_gaps(spark, sf):
    """Telemetry with some NULL and NaN sensors."""
    rows = telemetry(spark, sf)
    gaps = {c: F.when(F.col("event_id") % 20 != i, F.col(c)) for i, c in enumerate(_GAPS)}
    gaps["battery_pct"] = F.when(F.col("event_id") % 20 != 9, F.col("battery_pct")).otherwise(F.lit(float("nan")))
    return rows.withColumns(gaps)


_GAP_FILLS = ", ".join(
    f"case when event_id % 20 <> {i} then round({c}, 6) else 0 end as {c}" for i, c in [*enumerate(_GAPS), (9, "battery_pct")]
)


@query("fill_null_sensors", f"select event_id, {_GAP_FILLS} from telemetry")
def fill_null_sensors(spark, sf):
    return X.fill_null_sensors(with_gaps(spark, sf)).select("event_id", *_rounded([*_GAPS, "battery_pct"]))


@query("const_columns", "select event_id, cast(0 as int) as l2_seq_flag, cast(0 as int) as l3_shape_flag from telemetry")
def const_columns(spark, sf):
    rows = X.const_columns(telemetry(spark, sf), {"l2_seq_flag": 0, "l3_shape_flag": 0})
    return rows.select("event_id", "l2_seq_flag", "l3_shape_flag")


_CLIPPED = ", ".join(
    f"round(least(greatest({c}, cast({a} as double)), cast({b} as double)), 6) as {c}"
    for c, (a, b) in SENSOR_RANGES.items()
)


@query("clip_sensors", f"select event_id, {_CLIPPED} from telemetry")
def clip_sensors(spark, sf):
    return X.clip_sensors(telemetry(spark, sf)).select("event_id", *_rounded(list(SENSOR_RANGES)))


@query("format_vehicle_id", "select event_id, printf('VH_%05d', user_id) as vehicle_id from events")
def format_vehicle_id(spark, sf):
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf}/events.parquet")
    return events.select("event_id", S.vehicle_id("user_id").alias("vehicle_id"))


_ELEMENTS = ", ".join(f"round({c}, 6) as v{i}" for i, c in enumerate(SENSOR_COLS))


@query("sensor_vector", f"select event_id, 10 as n, {_ELEMENTS} from telemetry")
def sensor_vector(spark, sf):
    rows = telemetry(spark, sf).select("event_id", S.sensor_vector().alias("v"))
    parts = [F.round(F.col("v")[i], 6).alias(f"v{i}") for i in range(len(SENSOR_COLS))]
    return rows.select("event_id", F.size("v").alias("n"), *parts)


_SCALED = ", ".join(
    f"round(({c} - avg({c}) over ()) / (stddev_pop({c}) over () + cast('1e-8' as double)), 4) as {c}" for c in SENSOR_COLS
)


@query("normalize_eps", f"select event_id, {_SCALED} from telemetry")
def normalize_eps(spark, sf):
    rows = telemetry(spark, sf)
    return fit_scaler(rows).normalize(rows).select("event_id", *_rounded(SENSOR_COLS, 4))


_VECTOR_SUM = " + ".join(SENSOR_COLS)


@query(
    "tile_sequence",
    f"""select event_id, 30 as n_steps, 10 as n_features, round(speed_kmh, 6) as first_value, round(current_a, 6) as last_value,
        round(30 * ({_VECTOR_SUM}), 3) as total from telemetry""",
)
def tile_sequence(spark, sf):
    rows = telemetry(spark, sf).select("event_id", S.tile(S.sensor_vector()).alias("seq"))
    total = F.aggregate(F.flatten("seq"), F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        "event_id",
        F.size("seq").alias("n_steps"),
        F.size(F.col("seq")[29]).alias("n_features"),
        F.round(F.col("seq")[0][0], 6).alias("first_value"),
        F.round(F.col("seq")[29][9], 6).alias("last_value"),
        F.round(total, 3).alias("total"),
    )


@query("softmax_pair", "select event_id, round(p, 6) as p from probs")
def softmax_pair(spark, sf):
    return logits(spark, sf).select("event_id", F.round(S.softmax_pair("z0", "z1"), 6).alias("p"))


@query("argmax_class", "select event_id, cast(z1 > z0 as int) as predicted from logits")
def argmax_class(spark, sf):
    return logits(spark, sf).select("event_id", S.argmax_class("z0", "z1").alias("predicted"))


def decisions(spark, sf):
    p = S.softmax_pair("z0", "z1")
    scored = logits(spark, sf).withColumn("p", p)
    batch = F.floor(F.col("event_id") / 64).cast("bigint").alias("batch_id")
    position = (F.col("event_id") % 64).cast("int").alias("position")
    return scored.select("event_id", "vehicle_id", batch, position, *S.decision("p"))


@query("score_decision", "select event_id, is_anomaly, anomaly_score, confidence, label from decided")
def score_decision(spark, sf):
    return decisions(spark, sf).select("event_id", "is_anomaly", "anomaly_score", "confidence", "label")


@query("class_weight", "select event_id, case when label = 1 then cast(10 as double) else cast(1 as double) end as weight from logits")
def class_weight(spark, sf):
    return logits(spark, sf).select("event_id", S.class_weight("label").alias("weight"))


@query(
    "inject_faults",
    """, hashed as (
         select *, row_number() over (order by md5(concat(cast(event_id as varchar), '|42'))) as r, count(*) over () as total
         from telemetry),
       chosen as (select *, r <= cast(floor(total * cast(0.03 as double)) as bigint) as hit from hashed)
       select event_id, cast(hit as int) as injected_anomaly,
         round(case when hit then temp_motor_c + 60 else temp_motor_c end, 6) as temp_motor_c,
         round(case when hit then battery_pct - 45 else battery_pct end, 6) as battery_pct,
         round(case when hit then voltage_v + 75 else voltage_v end, 6) as voltage_v
       from chosen""",
)
def inject(spark, sf):
    rows = inject_faults(telemetry(spark, sf))
    return rows.select("event_id", "injected_anomaly", *_rounded(["temp_motor_c", "battery_pct", "voltage_v"]))


# Validation

_NAMES = ", ".join(f"'{f.name}'" for f in TELEMETRY_SCHEMA.fields)


@query(
    "validate_schema",
    f"""select unnest([{_NAMES}]) as column_name, true as present, true as type_ok,
        (select count(*) from telemetry) as n_rows""",
)
def validate_schema(spark, sf):
    return V.schema_report(V.validate_schema(telemetry(spark, sf)))


def _audit_sql(tests: dict[str, str], source: str, count: str, rate: str) -> str:
    return " union all ".join(
        f"""select '{c}' as column_name, count(*) filter (where {test}) as {count}, count(*) as n_rows,
            round(cast(count(*) filter (where {test}) as double) / count(*), 6) as {rate} from {source}"""
        for c, test in tests.items()
    )


@query(
    "null_audit",
    _audit_sql(
        {
            **{c: f"event_id % 20 = {i}" for i, c in enumerate(_GAPS)},
            "battery_pct": "event_id % 20 = 9",
            "vehicle_id": "vehicle_id is null",
        },
        "telemetry",
        "null_count",
        "null_rate",
    ),
)
def null_audit(spark, sf):
    return V.null_audit(with_gaps(spark, sf), [*_GAPS, "battery_pct", "vehicle_id"])


_OUTSIDE = {c: f"({c} < {a} or {c} > {b})" for c, (a, b) in SENSOR_RANGES.items()}


@query("range_audit", _audit_sql(_OUTSIDE, "telemetry", "out_of_range", "out_of_range_rate"))
def range_audit(spark, sf):
    return V.range_audit(telemetry(spark, sf))


@query(
    "range_violations",
    f"""select event_id, {" + ".join(f"cast({t} as int)" for t in _OUTSIDE.values())} as n_violations,
        case {" ".join(f"when {t} then '{c}'" for c, t in _OUTSIDE.items())} end as first_violation from telemetry""",
)
def range_violations(spark, sf):
    rows = V.add_violations(telemetry(spark, sf))
    return rows.select(
        "event_id", F.size("violations").alias("n_violations"), F.get("violations", F.lit(0)).alias("first_violation")
    )


# Aggregations

_FLEET_AVGS = ["avg_speed_kmh", "avg_battery_pct", "avg_temp_motor_c", "avg_power_kw"]
_FLEET_SQL = """round(avg(speed_kmh), 6) as avg_speed_kmh, round(avg(battery_pct), 6) as avg_battery_pct,
  round(avg(temp_motor_c), 6) as avg_temp_motor_c, round(avg(power_kw), 6) as avg_power_kw,
  cast(sum(rule_anomaly) as bigint) as anomaly_count, count(*) as record_count,
  round(max(odometer_km), 6) as max_odometer_km"""
_FLEET_KEYS = "vehicle_id, year_, month_, hour_, region"
_REGION_SQL = """select region, cast(date_ as varchar) as date_, count(*) as total_records,
  cast(sum(rule_anomaly) as bigint) as total_anomalies, round(avg(battery_pct), 6) as avg_battery_pct,
  round(avg(temp_motor_c), 6) as avg_temp_motor_c,
  round(cast(sum(rule_anomaly) as double) / count(*), 4) as anomaly_rate from derived group by region, date_"""


def _region_rounded(kpis: DataFrame) -> DataFrame:
    avgs = _rounded(["avg_battery_pct", "avg_temp_motor_c"])
    date = F.col("date_").cast("string").alias("date_")
    return kpis.select("region", date, "total_records", "total_anomalies", *avgs, "anomaly_rate")


@query("fleet_kpis", f"select {_FLEET_KEYS}, {_FLEET_SQL} from derived group by {_FLEET_KEYS}")
def fleet_kpis(spark, sf):
    kpis = K.fleet_kpis(derived(spark, sf))
    floats = [*_FLEET_AVGS, "max_odometer_km"]
    return kpis.select(*_FLEET_KEYS.split(", "), *_rounded(floats), "anomaly_count", "record_count")


@query("region_kpis", _REGION_SQL)
def region_kpis(spark, sf):
    return _region_rounded(K.region_kpis(derived(spark, sf)))


@query("top_regions", f"select * from ({_REGION_SQL}) order by anomaly_rate desc, region, date_ limit 10")
def top_regions(spark, sf):
    return _region_rounded(K.top_regions(K.region_kpis(derived(spark, sf))))


_SUMMARY_SQL = """select count(*) as total, cast(sum(rule_anomaly) as bigint) as anomalies,
  round(cast(sum(rule_anomaly) as double) / count(*) * 100, 2) as anomaly_pct from derived"""


@query("processing_summary", _SUMMARY_SQL)
def processing_summary(spark, sf):
    return K.processing_summary(derived(spark, sf))


@query(
    "run_summary",
    "select cast(sum(is_anomaly) as bigint) as anomaly_count, round(avg(is_anomaly) * 100, 6) as anomaly_rate_pct from voted",
)
def run_summary(spark, sf):
    summary = K.run_summary(L.ensemble_vote(layer_flags(spark, sf)))
    return summary.select("anomaly_count", *_rounded(["anomaly_rate_pct"]))


@query(
    "batch_summary",
    """select batch_id, count(*) as total, count(*) filter (where is_anomaly) as anomalies_found,
         round(cast(count(*) filter (where is_anomaly) as double) / count(*), 4) as anomaly_rate
       from decided group by batch_id""",
)
def batch_summary(spark, sf):
    return K.batch_summary(decisions(spark, sf))


def large_batches(spark, sf):
    """Batches of 2,500 readings."""
    size = F.lit(2500)
    return decisions(spark, sf).withColumns(
        {"batch_id": F.floor(F.col("event_id") / size), "position": (F.col("event_id") % size).cast("int")}
    )


@query(
    "batch_summary_large",
    """select event_id // 2500 as batch_id, count(*) as total, count(*) filter (where is_anomaly) as anomalies_found,
         round(cast(count(*) filter (where is_anomaly) as double) / count(*), 4) as anomaly_rate
       from decided group by event_id // 2500""",
)
def batch_summary_large(spark, sf):
    return K.batch_summary(large_batches(spark, sf))


@query(
    "batch_results",
    """select event_id // 2500 as batch_id, event_id % 2500 // 1000 as part, cast(count(*) as int) as n_results,
         arg_min(vehicle_id, event_id) as first_vehicle, round(sum(anomaly_score), 4) as score_sum
       from decided group by event_id // 2500, event_id % 2500 // 1000""",
)
def batch_results(spark, sf):
    score_sum = F.aggregate("results", F.lit(0.0), lambda a, r: a + r["anomaly_score"])
    return K.batch_results(large_batches(spark, sf)).select(
        "batch_id",
        "part",
        F.size("results").alias("n_results"),
        F.col("results")[0]["vehicle_id"].alias("first_vehicle"),
        F.round(score_sum, 4).alias("score_sum"),
    )


@query("label_rate", "select round(avg(injected_anomaly) * 100, 6) as label_rate_pct from telemetry")
def label_rate(spark, sf):
    return K.label_rate(telemetry(spark, sf)).select(*_rounded(["label_rate_pct"]))


@query("row_count", "select count(*) as row_count from telemetry")
def row_count(spark, sf):
    return K.row_count(telemetry(spark, sf))


_CONFUSION = """count(*) filter (where label = 1 and prediction = 1) as tp, count(*) filter (where label = 0 and prediction = 1) as fp,
  count(*) filter (where label = 1 and prediction = 0) as fn, count(*) filter (where label = 0 and prediction = 0) as tn"""


@query("confusion_counts", f"select {_CONFUSION} from logits")
def confusion_counts(spark, sf):
    return M.confusion_counts(logits(spark, sf))


def _ratio(a: str, b: str) -> str:
    return f"coalesce(cast({a} as double) / nullif({b}, 0), 0)"


_METRICS = f"""round({_ratio('tp + tn', 'tp + fp + fn + tn')}, 6) as accuracy, round({_ratio('tp', 'tp + fp')}, 6) as precision,
  round({_ratio('tp', 'tp + fn')}, 6) as recall, round({_ratio('2 * tp', '2 * tp + fp + fn')}, 6) as f1"""
_METRIC_COLS = ["accuracy", "precision", "recall", "f1"]


@query("classification_metrics", f", c as (select {_CONFUSION} from logits) select {_METRICS} from c")
def classification_metrics(spark, sf):
    return M.classification_metrics(logits(spark, sf)).select(*_rounded(_METRIC_COLS))


@query(
    "classification_report",
    f""", c as (select {_CONFUSION} from logits),
       k as (
         select 'Normal' as class_name, {_ratio('tn', 'tn + fn')} as p, {_ratio('tn', 'tn + fp')} as r,
           {_ratio('2 * tn', '2 * tn + fn + fp')} as f, tn + fp as s from c
         union all
         select 'Anomaly', {_ratio('tp', 'tp + fp')}, {_ratio('tp', 'tp + fn')}, {_ratio('2 * tp', '2 * tp + fp + fn')}, tp + fn from c),
       a as (select {_ratio('tp + tn', 'tp + fp + fn + tn')} as acc, tp + fp + fn + tn as s from c),
       rows_ as (
         select * from k
         union all select 'accuracy', acc, acc, acc, s from a
         union all select 'macro avg', avg(p), avg(r), avg(f), sum(s) from k
         union all select 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) from k)
       select class_name, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1, cast(s as bigint) as support from rows_""",
)
def classification_report(spark, sf):
    report = M.classification_report(logits(spark, sf))
    return report.select("class_name", *_rounded(["precision", "recall", "f1"]), "support")


@query(
    "weighted_log_loss",
    """, l as (
         select greatest(z0, z1) + ln(exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1)))
             - case when label = 1 then z1 else z0 end as loss,
           case when label = 1 then cast(10 as double) else cast(1 as double) end as w
         from logits)
       select 'rows' as mean, round(avg(w * loss), 6) as log_loss from l
       union all select 'weights', round(sum(w * loss) / sum(w), 6) from l
       union all select 'unweighted', round(avg(loss), 6) from l""",
)
def weighted_log_loss(spark, sf):
    means = [F.struct(F.lit(m).alias("mean"), F.round(m, 6).alias("log_loss")) for m in ("rows", "weights", "unweighted")]
    return M.log_losses(logits(spark, sf)).select(F.inline(F.array(*means)))


@query(
    "false_positive_reduction",
    """, c as (select count(*) filter (where label = 0 and is_anomaly = 1) as fp_ensemble,
                count(*) filter (where label = 0 and l1_iso_flag = 1) as fp_single from voted)
       select *, round(1 - cast(fp_ensemble as double) / nullif(fp_single, 0), 6) as fp_reduction from c""",
)
def false_positive_reduction(spark, sf):
    r = M.false_positive_reduction(L.ensemble_vote(layer_flags(spark, sf)))
    return r.select("fp_ensemble", "fp_single", *_rounded(["fp_reduction"]))


# Windows and sequences


@query("rolling_avg_temp", "select event_id, rolling_avg_temp from processed")
def rolling_avg_temp(spark, sf):
    return W.add_rolling(telemetry(spark, sf)).select("event_id", "rolling_avg_temp")


@query("rolling_avg_battery", "select event_id, rolling_avg_battery from processed")
def rolling_avg_battery(spark, sf):
    return W.add_rolling(telemetry(spark, sf)).select("event_id", "rolling_avg_battery")


@query("rolling_std_speed", "select event_id, rolling_std_speed from processed")
def rolling_std_speed(spark, sf):
    return W.add_rolling(telemetry(spark, sf)).select("event_id", "rolling_std_speed")


_ROLLING = ["rolling_avg_temp", "rolling_avg_battery", "rolling_std_speed"]


@query("rolling_features_sliced", f"select event_id, {', '.join(_ROLLING)} from processed")
def rolling_features_sliced(spark, sf):
    """All three with every vehicle treated as hot."""
    return W.add_rolling(telemetry(spark, sf), **HOT_TEST).select("event_id", *_ROLLING)


_SEQ_SQL = f"""
, framed as (
  select *, count(*) over w as n_steps, first_value(speed_kmh) over w as first_speed, last_value(current_a) over w as last_current,
    sum({_VECTOR_SUM}) over w as total
  from ranked
  window w as (partition by vehicle_id order by event_ts, event_id rows between 30 preceding and 1 preceding))
select vehicle_id, pos - 31 as position, injected_anomaly as label, cast(n_steps as int) as n_steps, round(first_speed, 6) as first_speed,
  round(last_current, 6) as last_current, round(total, 3) as total
from framed where pos > 30"""


def _sequence_view(sequences: DataFrame) -> DataFrame:
    total = F.aggregate(F.flatten("features"), F.lit(0.0), lambda a, x: a + x)
    return sequences.select(
        "vehicle_id",
        "position",
        "label",
        F.size("features").alias("n_steps"),
        F.round(F.col("features")[0][0], 6).alias("first_speed"),
        F.round(F.col("features")[29][9], 6).alias("last_current"),
        F.round(total, 3).alias("total"),
    )


@query("sequences", _SEQ_SQL)
def sequences(spark, sf):
    return _sequence_view(W.make_sequences(telemetry(spark, sf)))


@query("sequences_sliced", _SEQ_SQL)
def sequences_sliced(spark, sf):
    return _sequence_view(W.make_sequences(telemetry(spark, sf), **HOT_TEST))


@query("sequence_labels", "select vehicle_id, pos - 31 as position, injected_anomaly as label from ranked where pos > 30")
def sequence_labels(spark, sf):
    return W.sequence_labels(telemetry(spark, sf))


@query(
    "sequence_labels_one_series",
    """, g as (select *, row_number() over (order by event_ts, event_id) as gpos from derived)
       select cast(0 as int) as series, gpos - 31 as position, injected_anomaly as label from g where gpos > 30""",
)
def sequence_labels_one_series(spark, sf):
    """The whole table as one series, cut into slices."""
    return W.sequence_labels(telemetry(spark, sf), by=None, hot_rows=500, slice_rows=200)


_CUT = "cast(floor(n * cast(0.8 as double)) as bigint)"


@query(
    "chronological_split",
    f"select event_id, vehicle_id, pos as position, case when pos <= {_CUT} then 'train' else 'val' end as split from ranked",
)
def chronological_split(spark, sf):
    return W.chronological_split(telemetry(spark, sf)).select("event_id", "vehicle_id", "position", "split")


_SPLIT_ROWS_SQL = f"""
, sided as (select *, case when pos <= {_CUT} then 'train' else 'val' end as split,
    case when pos <= {_CUT} then pos else pos - {_CUT} end as own from ranked)
select vehicle_id, own - 31 as position, injected_anomaly as label, split from sided where own > 30"""


@query("split_rows_then_sequences", _SPLIT_ROWS_SQL)
def split_rows_then_sequences(spark, sf):
    return W.sequence_labels(telemetry(spark, sf), split="rows")


@query("split_rows_then_sequences_sliced", _SPLIT_ROWS_SQL)
def split_rows_then_sequences_sliced(spark, sf):
    return W.sequence_labels(telemetry(spark, sf), split="rows", **HOT_TEST)


@query(
    "sequences_then_split",
    """select vehicle_id, pos - 31 as position, injected_anomaly as label,
         case when pos - 30 <= cast(floor((n - 30) * cast(0.8 as double)) as bigint) then 'train' else 'val' end as split
       from ranked where pos > 30""",
)
def sequences_then_split(spark, sf):
    return W.sequence_labels(telemetry(spark, sf), split="sequences")


@query("row_ranking", "select event_id, vehicle_id, pos as position from ranked")
def row_ranking(spark, sf):
    return W.add_position(telemetry(spark, sf)).select("event_id", "vehicle_id", "position")


@query("row_ranking_sliced", "select event_id, vehicle_id, pos as position from ranked")
def row_ranking_sliced(spark, sf):
    return W.add_position(telemetry(spark, sf), **HOT_TEST).select("event_id", "vehicle_id", "position")


def _shape_sql() -> str:
    d1 = ", ".join(f"{c} - lag({c}) over v as d1_{c}" for c in SENSOR_COLS)
    d2 = ", ".join(f"d1_{c} - lag(d1_{c}) over v as d2_{c}" for c in SENSOR_COLS)
    stats = ", ".join(
        f"""avg({c}) over w as {c}_mean, stddev_samp({c}) over w as {c}_std, min({c}) over w as {c}_min, max({c}) over w as {c}_max,
        max({c}) over w - min({c}) over w as {c}_range, regr_slope({c}, pos) over w as {c}_slope,
        avg(abs(d1_{c})) over w1 as {c}_diff1, avg(abs(d2_{c})) over w2 as {c}_diff2"""
        for c in SENSOR_COLS
    )
    by = "partition by vehicle_id order by event_ts, event_id"
    return f"""
, s1 as (select *, {d1} from ranked window v as ({by})),
s2 as (select *, {d2} from s1 window v as ({by})),
s3 as (select event_id, vehicle_id, pos, injected_anomaly, {stats} from s2
  window w as ({by} rows between 29 preceding and current row), w1 as ({by} rows between 28 preceding and current row),
    w2 as ({by} rows between 27 preceding and current row))
select vehicle_id, pos - 30 as position, injected_anomaly as label, {_sql_rounded(W.shape_columns(), 5)} from s3 where pos >= 30"""


@query("shape_features", _shape_sql())
def shape_features(spark, sf):
    rows = W.shape_features(telemetry(spark, sf))
    return rows.select("vehicle_id", "position", "label", *_rounded(W.shape_columns(), 5))


@query("shape_features_sliced", _shape_sql())
def shape_features_sliced(spark, sf):
    rows = W.shape_features(telemetry(spark, sf), **HOT_TEST)
    return rows.select("vehicle_id", "position", "label", *_rounded(W.shape_columns(), 5))


# Statistics, layers, drift


@query(
    "fit_scaler",
    " union all ".join(
        f"select '{c}' as column_name, round(avg({c}), 6) as mean, round(stddev_pop({c}), 6) as std from telemetry"
        for c in SENSOR_COLS
    ),
)
def scaler(spark, sf):
    return scaler_stats(telemetry(spark, sf)).select("column_name", *_rounded(["mean", "std"]))


@query(
    "scale_sensors",
    f"""select event_id, {", ".join(f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 4) as {c}" for c in SENSOR_COLS)}
        from telemetry""",
)
def scale(spark, sf):
    return scale_sensors(telemetry(spark, sf)).select("event_id", *_rounded(SENSOR_COLS, 4))


@query(
    "scale_sensors_on_train",
    f""", t as (select *, case when pos <= {_CUT} then 1 end as is_train from ranked)
        select event_id, {", ".join(
            f"round(({c} - avg({c}) filter (where is_train = 1) over ()) / stddev_pop({c}) filter (where is_train = 1) over (), 4) as {c}"
            for c in SENSOR_COLS)} from t""",
)
def scale_on_train(spark, sf):
    rows = scale_sensors(W.chronological_split(telemetry(spark, sf)), fit_on="train")
    return rows.select("event_id", *_rounded(SENSOR_COLS, 4))


@query("isolation_forest")
def isolation_forest(spark, sf):
    rows = X.fill_null_sensors(telemetry(spark, sf))
    scored = fit_transform(rows, fit_scaler(rows))
    return scored.select("event_id", F.round("anomaly_score", 6).alias("anomaly_score"), "l1_iso_flag")


_THRESHOLD_SQL = """, s as (select event_id, -(temp_motor_c / cast(10 as double) + accel_magnitude) as score from derived)
  select event_id, round(score, 6) as score,
    cast(score < (select quantile_cont(score, 0.03) from s) as int) as flag from s"""


def _scores(spark, sf):
    score = -(F.col("temp_motor_c") / F.lit(10.0) + F.col("accel_magnitude"))
    return derived(spark, sf).select("event_id", score.alias("score"))


@query("contamination_threshold", _THRESHOLD_SQL)
def threshold(spark, sf):
    return contamination_threshold(_scores(spark, sf), "score").select("event_id", *_rounded(["score"]), "flag")


@query("contamination_threshold_narrowed", _THRESHOLD_SQL)
def threshold_narrowed(spark, sf):
    """The same by narrowing, as on tables too large to order at once."""
    flagged = contamination_threshold(_scores(spark, sf), "score", gather_rows=200)
    return flagged.select("event_id", *_rounded(["score"]), "flag")


@query("sequence_layer")
def sequence_layer(spark, sf):
    rows = X.fill_null_sensors(telemetry(spark, sf))
    return L.fit_layer(rows, "sequence").flag(rows).select("event_id", "l2_seq_flag")


@query("shape_layer")
def shape_layer(spark, sf):
    rows = X.fill_null_sensors(telemetry(spark, sf))
    return L.fit_layer(rows, "shape").flag(rows).select("event_id", "l3_shape_flag")


@query("config_grid_sequence")
def config_grid_sequence(spark, sf):
    return M.explode_metrics(L.config_grid(X.fill_null_sensors(telemetry(spark, sf)), "sequence"))


@query("config_grid_shape")
def config_grid_shape(spark, sf):
    return M.explode_metrics(L.config_grid(X.fill_null_sensors(telemetry(spark, sf)), "shape"))


@query("batch_score")
def batch_score(spark, sf):
    rows = X.fill_null_sensors(telemetry(spark, sf))
    return L.batch_score(rows, L.fit_layer(rows, "sequence"), keep=["event_id", "vehicle_id"])


@query(
    "ensemble_vote",
    "select event_id, anomaly_votes, is_anomaly from voted",
)
def ensemble_vote(spark, sf):
    return L.ensemble_vote(layer_flags(spark, sf)).select("event_id", "anomaly_votes", "is_anomaly")


@query(
    "ensemble_vote_any",
    "select event_id, anomaly_votes, cast(anomaly_votes >= 1 as int) as is_anomaly from voted",
)
def ensemble_vote_any(spark, sf):
    return L.ensemble_vote(layer_flags(spark, sf), min_votes=1).select("event_id", "anomaly_votes", "is_anomaly")


_LIMITS = [100.0, 115.0, 130.0, 140.0]


def threshold_runs(spark, sf):
    """One run per temperature limit, evaluated against the fault labels."""
    rows = telemetry(spark, sf)
    runs = []
    for i, limit in enumerate(_LIMITS):
        predicted = rows.select(
            F.col("injected_anomaly").alias("label"), S.above("temp_motor_c", limit).alias("prediction")
        )
        runs.append(M.run_row(M.classification_metrics(predicted), f"limit_{i + 1}", {"limit": limit}, i, i))
    return reduce(DataFrame.unionByName, runs)


_RUNS_SQL = ", runs as (" + " union all ".join(
    f"""select 'limit_{i + 1}' as run_name, cast({i} as int) as config_idx, {_METRICS}
        from (select {_CONFUSION} from (select injected_anomaly as label, cast(temp_motor_c > {limit} as int) as prediction from telemetry))"""
    for i, limit in enumerate(_LIMITS)
) + ")"


@query(
    "experiment_runs",
    _RUNS_SQL
    + " union all ".join(
        f"select run_name, config_idx, config_idx as step, '{m}' as metric, {m} as value from runs" for m in _METRIC_COLS
    ),
)
def experiment_runs(spark, sf):
    """Runs appended to a stored run table, read back one metric per row."""
    path = scratch_path(spark, "runs")
    M.log_runs(threshold_runs(spark, sf), path)
    stored = spark.read.schema(M.RUN_SCHEMA).parquet(path)
    return M.explode_metrics(stored).withColumn("value", F.round("value", 6))


@query(
    "best_config",
    _RUNS_SQL + " select run_name, config_idx, f1 from runs where f1 > 0 order by f1 desc, config_idx limit 1",
)
def best_config(spark, sf):
    return M.best_config(threshold_runs(spark, sf)).withColumn("f1", F.round("f1", 6))


_KS_SQL = (
    ", samples as (select cast(event_id % 7 < 5 as int) as is_ref, battery_pct, voltage_v,"
    " case when event_id % 7 < 5 then speed_kmh else speed_kmh * cast(1.2 as double) + 5 end as speed_kmh,"
    " case when event_id % 7 < 5 then temp_motor_c else temp_motor_c + 8 end as temp_motor_c,"
    " case when event_id % 7 < 5 then current_a else current_a * cast(1.2 as double) end as current_a from telemetry),"
    " long as ("
    + " union all ".join(f"select '{c}' as col, {c} as v, is_ref from samples" for c in DRIFT_COLS)
    + """), counts as (select col, v, sum(is_ref) as r, sum(1 - is_ref) as c from long group by col, v),
  cdf as (select col, sum(r) over w as r, sum(c) over w as c, sum(r) over (partition by col) as n1, sum(c) over (partition by col) as n2
    from counts window w as (partition by col order by v)),
  ks as (select col, max(abs(cast(r as double) / n1 - cast(c as double) / n2)) as d, cast(max(n1) as double) as n1,
    cast(max(n2) as double) as n2 from cdf group by col),
  lam as (select *, (sqrt(n1 * n2 / (n1 + n2)) + cast(0.12 as double) + cast(0.11 as double) / sqrt(n1 * n2 / (n1 + n2))) * d as l from ks),
  pv as (select *, case when l < 0.2 then cast(1 as double) else least(greatest(cast(2 as double) *
    list_sum(list_transform(range(1, 101), lambda k: (case when k % 2 = 1 then cast(1 as double) else cast(-1 as double) end)
      * exp(cast(-2 as double) * k * k * l * l))), cast(0 as double)), cast(1 as double)) end as p from lam),
  report as (select col as "column", round(d, 4) as ks_stat, round(p, 4) as p_value, p < 0.05 as drift from pv)
"""
)


@query(
    "ks_two_sample",
    _KS_SQL + "select col as column_name, round(d, 6) as ks_stat, cast(n1 as bigint) as n_ref, cast(n2 as bigint) as n_cur from ks",
)
def ks(spark, sf):
    ref, cur = drift_samples(spark, sf)
    return ks_two_sample(ref, cur).withColumn("ks_stat", F.round("ks_stat", 6))


@query(
    "ks_two_sample_fine",
    _KS_SQL + "select col as column_name, round(d, 6) as ks_stat, cast(n1 as bigint) as n_ref, cast(n2 as bigint) as n_cur from ks",
)
def ks_fine(spark, sf):
    """The same with many small buckets, as on large tables."""
    ref, cur = drift_samples(spark, sf)
    return ks_two_sample(ref, cur, bucket_rows=20).withColumn("ks_stat", F.round("ks_stat", 6))


@query(
    "ks_two_sample_skewed",
    """, long as (select cast(event_id % 7 < 5 as int) as is_ref,
      case when event_id % 3 = 0 then cast(1 as double) else pow(cast(10 as double), floor(speed_kmh) / 20) end as v from telemetry),
    counts as (select v, sum(is_ref) as r, sum(1 - is_ref) as c from long where v is not null group by v),
    cdf as (select sum(r) over w as r, sum(c) over w as c, sum(r) over () as n1, sum(c) over () as n2 from counts window w as (order by v))
    select 'spread' as column_name, round(max(abs(cast(r as double) / n1 - cast(c as double) / n2)), 6) as ks_stat,
      cast(max(n1) as bigint) as n_ref, cast(max(n2) as bigint) as n_cur from cdf""",
)
def ks_skewed(spark, sf):
    """Values over many orders of magnitude, a third of them equal, divided again and again."""
    spread = F.when(F.col("event_id") % 3 == 0, F.lit(1.0)).otherwise(F.pow(F.lit(10.0), F.floor("speed_kmh") / 20))
    rows = telemetry(spark, sf).select("event_id", spread.alias("spread"))
    ref, cur = (rows.filter(F.col("event_id") % 7 < 5), rows.filter(F.col("event_id") % 7 >= 5))
    return ks_two_sample(ref, cur, ["spread"], bucket_rows=20).withColumn("ks_stat", F.round("ks_stat", 6))


@query("ks_drift_report", _KS_SQL + "select * from report")
def ks_report(spark, sf):
    return ks_drift(*drift_samples(spark, sf))


@query(
    "drifted_column_count",
    _KS_SQL + "select cast(sum(cast(drift as int)) as bigint) as drifted, count(*) as columns from report",
)
def drifted_columns(spark, sf):
    return drifted_column_count(ks_drift(*drift_samples(spark, sf)))


@query("sink_csv_report", _KS_SQL + "select * from report")
def sink_csv_report(spark, sf):
    report = ks_drift(*drift_samples(spark, sf))
    path = scratch_path(spark, "report")
    sinks.write_report_csv(report, path)
    return spark.read.option("header", True).schema(report.schema).csv(path)


# Streaming


def _event_stream(spark, sf):
    """The events file, or folder of files, as a stream; the pattern lets it be either."""
    return from_events(spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf}/events.parquet*"))


@query(
    "stream_score",
    """select d.event_id, d.vehicle_id, d.power_kw, d.accel_magnitude, d.rule_anomaly, is_anomaly, anomaly_score, confidence, label
       from derived d join decided using (event_id)""",
)
def stream_score(spark, sf):
    p = S.softmax_pair(F.lit(0.0), (F.col("temp_motor_c") - 100.0) / 10.0)
    return streams.run_available(
        _event_stream(spark, sf),
        scratch_path(spark, "scored"),
        scratch_path(spark, "scored-state"),
        lambda df: streams.score_rows(df, p),
    )


@query(
    "stream_fleet_hourly",
    f"""select strftime(date_trunc('hour', event_ts), '%Y-%m-%d %H:%M:%S.%f') as hour_start, vehicle_id, region, {_FLEET_SQL}
        from derived where date_trunc('hour', event_ts) + interval 2 hour <= (select max(event_ts) from derived)
        group by date_trunc('hour', event_ts), vehicle_id, region""",
)
def stream_fleet_hourly(spark, sf):
    """Windows the watermark has closed once all input is read."""
    kpis = streams.run_available(
        _event_stream(spark, sf),
        scratch_path(spark, "hourly"),
        scratch_path(spark, "hourly-state"),
        lambda df: streams.fleet_hourly(X.derive(df)),
    )
    floats = [*_FLEET_AVGS, "max_odometer_km"]
    return kpis.select(
        _ts_text("hour_start").alias("hour_start"), "vehicle_id", "region", *_rounded(floats), "anomaly_count", "record_count"
    )


@query(
    "stream_fleet_hourly_whole",
    f"""select kind, strftime(hour, '%Y-%m-%d %H:%M:%S.%f') as hour_start, vehicle_id, region, {_FLEET_SQL}
        from (select *, case when event_id % 2 = 1 and hour + interval 2 hour <= (select max(event_ts) from derived where event_id % 2 = 0) then 'late'
            when hour + interval 2 hour <= (select max(event_ts) from derived) then 'closed' else 'open' end as kind
          from (select *, date_trunc('hour', event_ts) as hour from derived))
        group by kind, hour, vehicle_id, region""",
)
def stream_fleet_hourly_whole(spark, sf):
    """Readings that arrive in two parts, so that much of the second is late: closed, open and late groups have every row."""
    src, out, state = (scratch_path(spark, name) for name in ("arrivals", "hourly", "hourly-state"))
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf}/events.parquet")
    for part in range(2):
        events.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(src)
        arrivals = from_events(spark.readStream.schema(EVENTS_SCHEMA).parquet(src))
        hourly = streams.run_hourly(X.derive(arrivals), out, state)
    floats = [*_FLEET_AVGS, "max_odometer_km"]
    return hourly.groups().select(
        "kind", _ts_text("hour_start").alias("hour_start"), "vehicle_id", "region", *_rounded(floats), "anomaly_count", "record_count"
    )


# Jobs


@query("fleet_batch_job", _REGION_SQL)
def fleet_batch_job(spark, sf):
    return _region_rounded(run_fleet_job(telemetry(spark, sf), scratch_path(spark, "job"), fmt="parquet").region)


@query("fleet_batch_job_summary", _SUMMARY_SQL)
def fleet_batch_job_summary(spark, sf):
    return run_fleet_job(telemetry(spark, sf), scratch_path(spark, "job"), fmt="parquet").summary


_RUN_COLS = ["event_id", "l1_iso_flag", "l2_seq_flag", "l3_shape_flag", "anomaly_votes", "is_anomaly"]


@query("daily_anomaly_run")
def daily_anomaly_run(spark, sf):
    """Layer 1 alone decides, as long as no window models are given."""
    return run_daily(telemetry(spark, sf), RUN_DATE, scratch_path(spark, "daily")).scored.select(*_RUN_COLS)


def _audit_sql() -> str:
    parts = []
    for c in SENSOR_COLS:
        low, high = SENSOR_RANGES.get(c, (None, None))
        bad = f"{c} < {low} or {c} > {high}" if low is not None else "false"
        parts.append(
            f"select '{c}' as column_name, count(*) as n_records, count(*) - count({c}) as null_count, "
            f"cast(coalesce(sum(case when {bad} then 1 else 0 end), 0) as bigint) as out_of_range from gapped"
        )
    return " union all ".join(parts)


@query(
    "daily_audits",
    f"""select * from (with gapped as (select * replace (case when event_id % 11 <> 0 then speed_kmh end as speed_kmh,
        case when event_id % 13 = 0 then 999 else voltage_v end as voltage_v) from telemetry) {_audit_sql()}) audits""",
)
def daily_audits(spark, sf):
    gapped = {
        "speed_kmh": F.when(F.col("event_id") % 11 != 0, F.col("speed_kmh")),
        "voltage_v": F.when(F.col("event_id") % 13 == 0, F.lit(999.0)).otherwise(F.col("voltage_v")),
    }
    return run_daily(telemetry(spark, sf).withColumns(gapped), RUN_DATE, scratch_path(spark, "daily")).audits


@query("daily_anomaly_run_layers")
def daily_anomaly_run_layers(spark, sf):
    """All three layers and the majority vote."""
    rows = telemetry(spark, sf)
    filled = X.fill_null_sensors(rows)
    run = run_daily(
        rows,
        RUN_DATE,
        scratch_path(spark, "daily"),
        sequence_model=L.fit_layer(filled, "sequence"),
        shape_model=L.fit_layer(filled, "shape"),
    )
    return run.scored.select(*_RUN_COLS)


@query("drift_job", _KS_SQL + "select * from report")
def drift_job(spark, sf):
    return run_drift(*drift_samples(spark, sf), scratch_path(spark, "drift")).report


# Fitted models: no SQL gives their scores, but SQL gives what must hold of them


# Spark and DuckDB read it alike.
_HELD = "cast(regexp_extract(vehicle_id, '([0-9]+)$', 1) as int) % 5 = 0"


# Fewer faults than these say nothing about a share of them.
_ENOUGH_FAULTS = 30


def _caught(flag: str, lift: float, recall: float | None = None, among: Column | None = None) -> list[Column]:
    """Over the rows ``among`` all: whether flagged rows are faults ``lift`` times as often as all rows, and the flag finds the share ``recall`` of the faults."""
    among = F.lit(True) if among is None else among
    hit, fault = among & (F.col(flag) == 1), among & (F.col("injected_anomaly") == 1)
    n, both, faults, flagged = (F.count(F.when(c, 1)) for c in (among, hit & fault, fault, hit))
    few = faults < _ENOUGH_FAULTS
    out = [(few | (both * n >= flagged * faults * F.lit(lift)) & (flagged > 0)).alias("lift_reached")]
    return out if recall is None else [*out, (few | (both >= faults * F.lit(recall))).alias("recall_reached")]


@query(
    "isolation_forest_checks",
    "select count(*) as n_rows, true as share_flagged, true as scores_in_range, true as flags_follow_scores, "
    "true as recall_reached, true as lift_reached from telemetry",
)
def isolation_forest_checks(spark, sf):
    """Three percent flagged, the highest scores, among them at least a fifth of the faults and five times their share."""
    rows = X.fill_null_sensors(telemetry(spark, sf))
    scored, n, score = fit_transform(rows, fit_scaler(rows)), F.count(F.lit(1)), F.col("anomaly_score")
    lowest_hit = F.min(F.when(F.col("l1_iso_flag") == 1, score))
    return scored.agg(
        n.alias("n_rows"),
        (F.abs(F.sum("l1_iso_flag") - 0.03 * n) <= 1 + 0.001 * n).alias("share_flagged"),
        (F.min(score.between(0, 1).cast("int")) == 1).alias("scores_in_range"),
        (lowest_hit > F.max(F.when(F.col("l1_iso_flag") == 0, score))).alias("flags_follow_scores"),
        *_caught("l1_iso_flag", 5.0, 0.2),
    )


def _held_out(spark, sf, kind: str, lift: float, recall: float | None = None) -> DataFrame:
    """A layer fitted on four fifths of the vehicles, judged on the full windows of the others."""
    rows = X.fill_null_sensors(telemetry(spark, sf))
    layer = L.fit_layer(rows.filter(f"not ({_HELD})"), kind)
    flag = L.FLAGS[kind]
    flagged = W.add_position(layer.flag(rows.filter(_HELD)))
    early = F.col("position") < layer.seq_len
    return flagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(early, 1)).alias("n_without_window"),
        F.coalesce(F.sum(F.when(early, F.col(flag))), F.lit(0)).alias("n_flagged_without_window"),
        *_caught(flag, lift, recall, ~early),
    )


_HELD_OUT_SQL = f"""select count(*) as n_rows, count(case when p < 30 then 1 end) as n_without_window, cast(0 as bigint) as n_flagged_without_window,
    true as lift_reached {{more}}
  from (select row_number() over (partition by vehicle_id order by event_ts, event_id) as p from telemetry where {_HELD})"""


@query("sequence_layer_held_out", _HELD_OUT_SQL.format(more=", true as recall_reached"))
def sequence_layer_held_out(spark, sf):
    """At least half of the faults found, and five times their share."""
    return _held_out(spark, sf, "sequence", 5.0, 0.5)


@query("shape_layer_held_out", _HELD_OUT_SQL.format(more=""))
def shape_layer_held_out(spark, sf):
    """Better than chance; the layer finds a third to a half of the faults, and no recall is promised."""
    return _held_out(spark, sf, "shape", 1.5)


_GRID_SQL = "select cast(5 as bigint) as n_runs, cast(20 as bigint) as n_metrics, true as in_range, true as f1_agrees"


def _grid_checks(spark, sf, kind: str) -> DataFrame:
    """Five runs of four figures, whose F1 follows from precision and recall."""
    runs = L.config_grid(X.fill_null_sensors(telemetry(spark, sf)), kind)
    figure = {m: F.col("metrics")[m] for m in _METRIC_COLS}
    p, r = figure["precision"], figure["recall"]
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    inside = reduce(lambda a, b: a & b, [c.between(0, 1) for c in figure.values()])
    return runs.agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum(F.size("metrics")).cast("bigint").alias("n_metrics"),
        F.coalesce(F.bool_and(inside), F.lit(False)).alias("in_range"),
        F.coalesce(F.bool_and(F.abs(f1 - figure["f1"]) < 1e-9), F.lit(False)).alias("f1_agrees"),
    )


@query("config_grid_sequence_checks", _GRID_SQL)
def config_grid_sequence_checks(spark, sf):
    return _grid_checks(spark, sf, "sequence")


@query("config_grid_shape_checks", _GRID_SQL)
def config_grid_shape_checks(spark, sf):
    return _grid_checks(spark, sf, "shape")


@query(
    "batch_score_checks",
    "select count(*) as n_rows, true as in_range, true as decision_agrees, true as confidence_agrees, true as lift_reached from telemetry",
)
def batch_score_checks(spark, sf):
    """Scores are probabilities, and flag, label and confidence follow from them."""
    rows = X.fill_null_sensors(telemetry(spark, sf))
    scored = L.batch_score(rows, L.fit_layer(rows, "sequence"), keep=["event_id", "injected_anomaly"])
    p, hit = F.col("anomaly_score"), F.col("is_anomaly").cast("int") == 1
    return scored.withColumn("hit", hit.cast("int")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(p.between(0, 1)).alias("in_range"),
        F.bool_and((hit == (p > 0.5)) | (F.abs(p - 0.5) < 1e-3)).alias("decision_agrees"),
        F.bool_and(F.abs(F.col("confidence") - F.greatest(p, 1 - p)) < 1e-3).alias("confidence_agrees"),
        *_caught("hit", 2.0),
    )


@query(
    "stream_batch_score",
    "select count(*) as n_rows, true as equal_scores, true as one_model, true as model_agrees from telemetry",
)
def stream_batch_score(spark, sf):
    """A fitted layer, stored and loaded by a stream, scores every reading as the batch does."""
    rows = X.fill_null_sensors(telemetry(spark, sf))
    layer, path = L.fit_layer(rows, "sequence"), scratch_path(spark, "layer")
    layer.save(path)
    out, state = scratch_path(spark, "scored"), scratch_path(spark, "scored-state")
    streamed = streams.score_available(_event_stream(spark, sf), path, out, state, ["event_id"])
    batch = L.batch_score(rows, layer, keep=["event_id"])
    names = [c for c in batch.columns if c != "event_id"]
    pairs = streamed.join(batch.select("event_id", F.struct(*names).alias("_batch")), "event_id", "full_outer")
    return pairs.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.coalesce(F.struct(*names) == F.col("_batch"), F.lit(False))).alias("equal_scores"),
        (F.min("model") == F.max("model")).alias("one_model"),
        F.bool_and(F.col("model") == layer.digest()).alias("model_agrees"),
    )


@query(
    "daily_run_checks",
    f"""select count(*) as n_rows, count(*) as n_records, true as stored_agree, true as rate_agrees, true as votes_agree,
      cast(1 as bigint) as n_runs, '{RUN_DATE}' as run_date from telemetry""",
)
def daily_run_checks(spark, sf):
    """Stored anomalies, the run row and the votes of one daily run agree, also after a second run of the date."""
    out = scratch_path(spark, "daily")
    for _ in range(2):
        run = run_daily(telemetry(spark, sf), RUN_DATE, out)
    scored = run.scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("is_anomaly").alias("found"),
        F.bool_and(F.col("is_anomaly") == (F.col("anomaly_votes") >= 1).cast("int")).alias("votes_agree"),
    )
    stored = spark.read.parquet(run.anomalies_path).agg(F.count(F.lit(1)).alias("stored"), F.min("is_anomaly").alias("low"))
    runs = spark.read.schema(M.RUN_SCHEMA).parquet(run.runs_path).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.max(F.col("metrics")["anomaly_rate_pct"]).alias("rate"),
        F.max(F.col("metrics")["anomaly_count"]).cast("bigint").alias("counted"),
        F.max(F.col("params")["n_records"]).cast("bigint").alias("n_records"),
        F.max(F.col("params")["run_date"]).alias("run_date"),
    )
    one = F.lit(1).alias("one")
    joined = scored.select(one, "*").join(stored.select(one, "*"), "one").join(runs.select(one, "*"), "one")
    return joined.select(
        "n_rows",
        "n_records",
        ((F.col("found") == F.col("stored")) & (F.col("found") == F.col("counted")) & (F.col("low") == 1)).alias("stored_agree"),
        (F.abs(F.col("rate") - F.col("found") * 100 / F.col("n_rows")) < 1e-9).alias("rate_agrees"),
        "votes_agree",
        "n_runs",
        "run_date",
    )
