"""Fleet and region KPIs and run summaries; all partial-aggregated before their shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

RUN_SUMMARY = "anomaly_count long, anomaly_rate_pct double"


def _averages(*cols: str) -> list[Column]:
    return [F.avg(c).alias(f"avg_{c}") for c in cols]


def fleet_measures() -> list[Column]:
    """The fleet KPIs of any group of processed rows, in batch and on streams."""
    return [
        *_averages(*_FLEET_AVERAGED),
        F.sum("rule_anomaly").alias("anomaly_count"),
        F.count(F.lit(1)).alias("record_count"),
        F.max("odometer_km").alias("max_odometer_km"),
    ]


_FLEET_AVERAGED = ["speed_kmh", "battery_pct", "temp_motor_c", "power_kw"]


def fleet_sums() -> list[Column]:
    """What :func:`fleet_measures` needs of a part of a group, so that parts can be added up."""
    return [
        *[F.sum(c).alias(f"sum_{c}") for c in _FLEET_AVERAGED],
        *[F.count(c).alias(f"n_{c}") for c in _FLEET_AVERAGED],
        F.sum("rule_anomaly").alias("anomaly_count"),
        F.count(F.lit(1)).alias("record_count"),
        F.max("odometer_km").alias("max_odometer_km"),
    ]


def fleet_of_sums(parts: DataFrame, by: list[str]) -> DataFrame:
    """The fleet KPIs of groups from the sums of their parts."""
    return parts.groupBy(*by).agg(
        *[F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}")).alias(f"avg_{c}") for c in _FLEET_AVERAGED],
        F.sum("anomaly_count").alias("anomaly_count"),
        F.sum("record_count").alias("record_count"),
        F.max("max_odometer_km").alias("max_odometer_km"),
    )


def fleet_kpis(df: DataFrame, by_day: bool = False) -> DataFrame:
    """KPIs by vehicle, year, month, hour of day and region; ``by_day`` adds the date."""
    day = ["date_"] if by_day else []
    return df.groupBy("vehicle_id", "year_", "month_", *day, "hour_", "region").agg(*fleet_measures())


def region_kpis(df: DataFrame) -> DataFrame:
    """Record and anomaly totals, averages and the anomaly rate by region and date."""
    totals = df.groupBy("region", "date_").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum("rule_anomaly").alias("total_anomalies"),
        *_averages("battery_pct", "temp_motor_c"),
    )
    rate = F.try_divide("total_anomalies", "total_records")
    return totals.withColumn("anomaly_rate", F.round(rate, 4))


def top_regions(kpis: DataFrame, n: int = 10) -> DataFrame:
    return kpis.orderBy(F.desc("anomaly_rate"), "region", "date_").limit(n)


def processing_summary(df: DataFrame, flag: str = "rule_anomaly") -> DataFrame:
    """Total rows, anomalies and percent, in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(flag), F.lit(0)).alias("anomalies")
    ).withColumn("anomaly_pct", F.round(F.try_divide(F.col("anomalies"), F.col("total")) * 100, 2))


def summary_of_regions(kpis: DataFrame) -> DataFrame:
    """The same figures as ``processing_summary`` from the region KPIs, without another pass over the rows."""
    return kpis.agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("total_anomalies"), F.lit(0)).alias("anomalies"),
    ).withColumn("anomaly_pct", F.round(F.try_divide(F.col("anomalies"), F.col("total")) * 100, 2))


def _run_measures(flag: str) -> list[Column]:
    hit = F.col(flag).cast("int")
    return [F.coalesce(F.sum(hit), F.lit(0)).alias("anomaly_count"), (F.avg(hit) * 100).alias("anomaly_rate_pct")]


def run_summary(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    return df.agg(*_run_measures(flag))


def observe_summary(df: DataFrame, flag: str = "is_anomaly") -> tuple[DataFrame, Observation]:
    """The frame, and an observation of :func:`run_summary`'s figures, known once an action has passed all rows."""
    seen = Observation("summary")
    return df.observe(seen, *_run_measures(flag)), seen


def label_rate(df: DataFrame, label: str = "injected_anomaly") -> DataFrame:
    return df.agg((F.avg(label) * 100).alias("label_rate_pct"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def batch_summary(scored: DataFrame, batch: str = "batch_id") -> DataFrame:
    """One row of totals per batch of any size, partially aggregated before the shuffle."""
    return (
        scored.groupBy(batch)
        .agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(F.col("is_anomaly").cast("int")), F.lit(0)).alias("anomalies_found"))
        .withColumn("anomaly_rate", F.round(F.try_divide("anomalies_found", "total"), 4))
    )


def batch_results(scored: DataFrame, batch: str = "batch_id", position: str = "position", part_rows: int = 1000) -> DataFrame:
    """The results of each batch in order of position, ``part_rows`` positions to an array.

    No task gathers a whole batch. Parsing a request gives every reading its
    position; a reading without one (a reject) is an error.
    """
    part = F.coalesce(F.floor(F.col(position) / F.lit(part_rows)).cast("bigint"), F.raise_error(f"a result has no {position}").cast("bigint"))
    result = F.struct(position, "vehicle_id", "is_anomaly", "anomaly_score", "confidence", "label")
    return scored.groupBy(batch, part.alias("part")).agg(F.array_sort(F.collect_list(result)).alias("results"))
