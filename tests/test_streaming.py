from pyspark.sql import functions as F

from ampledger.functions.scalars import softmax_pair
from ampledger.operators import features as X
from ampledger.sources.fixture import EVENTS_SCHEMA, from_events, telemetry
from ampledger.streaming import streams


def parts(spark, sf_dir, tmp_path, n):
    """The events in time order as ``n`` files, so that a stream reads several batches."""
    src = str(tmp_path / "src")
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    bounds = events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [i / n for i in range(1, n)])).first()[0]
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:]):
        part = events
        part = part if low is None else part.filter(micros >= low)
        part = part if high is None else part.filter(micros < high)
        part.coalesce(1).write.mode("append").parquet(src)
    return from_events(spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src))


def test_scoring_stream_equals_batch(spark, sf_dir, tmp_path):
    p = softmax_pair(F.lit(0.0), (F.col("temp_motor_c") - 100.0) / 10.0)
    stream = parts(spark, sf_dir, tmp_path, 3)
    out = streams.run_available(
        stream, str(tmp_path / "out"), str(tmp_path / "state"), lambda df: streams.score_rows(df, p)
    )
    batch = streams.score_rows(telemetry(spark, sf_dir), p)
    assert sorted(map(str, out.collect())) == sorted(map(str, batch.collect()))


def test_scoring_stream_with_a_fitted_layer(spark, sf_dir, tmp_path):
    from ampledger.operators.layers import batch_score, fit_layer

    rows = telemetry(spark, sf_dir)
    layer = fit_layer(rows, "sequence")
    out = streams.run_available(
        parts(spark, sf_dir, tmp_path, 2),
        str(tmp_path / "out"),
        str(tmp_path / "state"),
        lambda df: batch_score(df, layer, keep=["event_id", "vehicle_id"]),
    )
    batch = batch_score(rows, layer, keep=["event_id", "vehicle_id"])
    assert sorted(map(str, out.collect())) == sorted(map(str, batch.collect()))


def test_hourly_windows_over_several_batches(spark, sf_dir, tmp_path):
    stream = parts(spark, sf_dir, tmp_path, 4)
    out = streams.run_available(
        stream, str(tmp_path / "out"), str(tmp_path / "state"), lambda df: streams.fleet_hourly(X.derive(df))
    )
    rows = telemetry(spark, sf_dir)
    last = rows.agg(F.max("event_ts")).first()[0]
    hour = F.date_trunc("hour", "event_ts")
    closed = rows.filter(hour + F.expr("interval 2 hours") <= F.lit(last))
    assert out.agg(F.sum("record_count")).first()[0] == closed.count()
    assert out.count() == closed.select("vehicle_id", "region", hour.alias("h")).distinct().count()


def test_hourly_sums_lose_no_row(spark, readings, tmp_path):
    """Late rows, open hours, rows without a time, nulls, an empty batch, and a batch that is run again."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    batches = [
        [{"event_id": 1, "event_ts": "2024-01-01 10:10:00", "speed_kmh": 10.0}, {"event_id": 2, "event_ts": "2024-01-01 12:30:00", "speed_kmh": None}],
        [],
        [{"event_id": 3, "event_ts": "2024-01-01 10:20:00", "speed_kmh": 50.0}, {"event_id": 4, "event_ts": "2024-01-01 12:40:00", "speed_kmh": 30.0},
         {"event_id": 5, "event_ts": None, "speed_kmh": 1.0}],
    ]
    for i, rows in enumerate(batches):
        frame = readings(rows or [{"event_id": 0, "event_ts": "2024-01-01 00:00:00"}])
        schema = frame.schema
        (frame if rows else frame.limit(0)).write.mode("append").parquet(src)
        stream = X.derive(spark.readStream.schema(schema).parquet(src))
        run = streams.run_hourly(stream, out, str(tmp_path / "state"))
    got = {(r["kind"], str(r["hour_start"])[11:13]): (r["record_count"], r["avg_speed_kmh"]) for r in run.groups().collect()}
    assert got == {("closed", "10"): (1, 10.0), ("late", "10"): (1, 50.0), ("late", ""): (1, 1.0), ("open", "12"): (2, 30.0)}
    assert sorted(r["event_id"] for r in run.late_rows.collect()) == [3, 5]
    # Nothing new arrived: the results stay.
    again = streams.run_hourly(stream, out, str(tmp_path / "state"))
    assert again.groups().count() == 4 and again.watermark == run.watermark
