"""Sinks: partitioned lake, catalog table, KPI tables, per-run anomalies, CSV report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampledger.schema import LAKE_PARTITIONS
from ampledger.session import scratch_path


def has_delta(spark: SparkSession) -> bool:
    """Whether the session was started with the Delta extension."""
    return "DeltaSparkSessionExtension" in spark.conf.get("spark.sql.extensions", "")


def write_lake(
    df: DataFrame,
    path: str,
    partition_cols: list[str] | None = None,
    mode: str = "overwrite",
    fmt: str = "auto",
    rebalance: bool = True,
) -> tuple[str, str]:
    """Write a partitioned table; returns the path and format used.

    ``fmt="auto"`` takes Delta where the session has it; else parquet at ``path + "_parquet"``.
    The rebalance hint lets adaptive execution split large and join small
    lake partitions, so file counts follow the data and not tasks times partitions.
    """
    cols = LAKE_PARTITIONS if partition_cols is None else partition_cols
    if fmt == "auto":
        fmt, path = ("delta", path) if has_delta(df.sparkSession) else ("parquet", path + "_parquet")
    out = df.hint("rebalance", *cols) if rebalance and cols else df
    writer = out.write.format(fmt).mode(mode)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.save(path)
    return path, fmt


def write_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> None:
    writer = df.write.mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_kpis(fleet: DataFrame, region: DataFrame, out: str) -> tuple[str, str]:
    fleet_path, region_path = f"{out}/fleet_agg", f"{out}/region_agg"
    fleet.write.mode("overwrite").parquet(fleet_path)
    region.write.mode("overwrite").parquet(region_path)
    return fleet_path, region_path


def write_anomalies(df: DataFrame, out: str, run_date: str, flag: str = "is_anomaly") -> None:
    """Store the flagged rows under their run date; a rerun replaces that date only, also by no rows."""
    flagged = df.filter(F.col(flag).cast("int") == 1).drop("run_date")
    flagged.write.mode("overwrite").parquet(f"{out}/run_date={run_date}")


def write_report_csv(report: DataFrame, path: str) -> None:
    """One CSV file with a header. For reports of one row per column, not for tables."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def stage(df: DataFrame, mode: str = "parquet", outlive: bool = False) -> DataFrame:
    """Materialise between steps: in the shared folder, in executor memory or disk, or not at all.

    A table in the shared folder belongs to the open :func:`~ampledger.session.staging`
    scope, or with ``outlive`` to the one around it.
    """
    if mode == "none":
        return df
    if mode == "persist":
        return df.persist()
    if mode == "parquet":
        path = scratch_path(df.sparkSession, "stage", outlive)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    raise ValueError(f"unknown stage mode {mode!r}")
