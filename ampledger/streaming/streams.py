"""Structured Streaming versions of scoring and of the hourly fleet KPIs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampledger.functions.scalars import decision
from ampledger.operators.features import derive, fill_null_sensors
from ampledger.operators.kpis import fleet_measures, fleet_of_sums, fleet_sums
from ampledger.operators.layers import LayerModel, batch_score


def score_rows(df: DataFrame, probability) -> DataFrame:
    """Features, rule flags and the decision on a probability expression. Stateless, so batch and stream agree."""
    return derive(df).withColumn("_p", probability).select(
        "event_id", "vehicle_id", "power_kw", "accel_magnitude", "rule_anomaly", *decision("_p")
    )


def fleet_hourly(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Fleet KPIs per vehicle, region and event-time hour.

    Rows later than the watermark are dropped (see :func:`run_hourly`). State is one row of sums per
    open group, whatever the number of readings behind it.
    """
    kpis = (
        df.withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", "1 hour").alias("w"), "vehicle_id", "region")
        .agg(*fleet_measures())
    )
    return kpis.select(F.col("w.start").alias("hour_start"), *[c for c in kpis.columns if c != "w"])


@dataclass(frozen=True)
class HourlyRun:
    """The stored results of :func:`run_hourly` so far."""

    sums: DataFrame
    late_rows: DataFrame
    watermark: int | None

    def groups(self) -> DataFrame:
        """Fleet KPIs by hour, vehicle and region, and ``kind``: closed by the watermark, still open, or of late rows.

        Together they count every row once. The open groups are the flush: what
        closing all windows now would give.
        """
        ended = F.unix_micros("hour_start") + HOUR <= F.lit(self.watermark)
        kind = F.when(F.col("late"), "late").when(ended, "closed").otherwise("open")
        return fleet_of_sums(self.sums.withColumn("kind", kind), ["kind", *_GROUP])


_GROUP = ["hour_start", "vehicle_id", "region"]
HOUR = 3_600_000_000


def run_hourly(stream: DataFrame, out: str, checkpoint: str, delay: int = HOUR) -> HourlyRun:
    """Process what has arrived into hourly sums that lose no row; ``delay`` in microseconds.

    Each batch adds one row of sums per group to the stored sums, and its late
    rows, those of hours that the watermark of the batches before it had closed,
    to a table of their own. All of a batch lies in folders of its number, so a
    batch that is run again replaces itself. A row without a time is late.
    """
    spark = stream.sparkSession
    schemas = {}

    def watermark(before: int | None = None) -> int | None:
        seen = spark.read.schema("top long, batch long").parquet(f"{out}/progress")
        seen = seen if before is None else seen.filter(F.col("batch") < before)
        top = seen.agg(F.max("top")).first()[0]
        return None if top is None else top - delay

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        closed = watermark(number)
        start = F.date_trunc("hour", "event_ts")
        is_late = F.col("event_ts").isNull()
        if closed is not None:
            is_late = is_late | (F.unix_micros(start) + HOUR <= F.lit(closed))
        rows = batch.withColumns({"hour_start": start, "late": is_late})
        sums = rows.groupBy(*_GROUP, "late").agg(*fleet_sums())
        sums.write.mode("overwrite").parquet(f"{out}/sums/batch={number}")
        late = batch.filter(is_late)
        late.write.mode("overwrite").parquet(f"{out}/late/batch={number}")
        schemas.update(sums=sums.schema, late=late.schema)
        top = batch.agg(F.max(F.unix_micros("event_ts")).alias("top"))
        top.write.mode("overwrite").parquet(f"{out}/progress/batch={number}")

    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/progress")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    query = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()

    def table(name: str) -> DataFrame:
        reader = spark.read.schema(schemas[name]) if name in schemas else spark.read
        return reader.parquet(f"{out}/{name}").drop("batch")

    return HourlyRun(table("sums"), table("late"), watermark())


def run_available(
    stream: DataFrame, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Process what has arrived, append it to a parquet table and return that table."""
    result = transform(stream) if transform else stream
    query = (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return result.sparkSession.read.schema(result.schema).parquet(out)


def score_available(stream: DataFrame, model_path: str, out: str, checkpoint: str, keep: list[str]) -> DataFrame:
    """Score what has arrived with a stored window model, as :func:`batch_score` does, and append it to a table.

    The model is loaded when the run starts, so a later run picks up a model
    stored anew; ``model`` is the digest of the one that scored the row.
    Missing sensors count as 0. The path's table holds the rows of all runs.
    """
    layer = LayerModel.load(stream.sparkSession, model_path)
    digest = layer.digest()
    return run_available(
        stream, out, checkpoint, lambda df: batch_score(fill_null_sensors(df), layer, keep).withColumn("model", F.lit(digest))
    )
