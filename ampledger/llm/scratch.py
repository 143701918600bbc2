"""Tables written between steps, in the folder that the executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ampledger.session import scratch_path


def stage(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it back: later steps don't compute it again.

    The table belongs to the open staging scope, or with ``outlive`` to the one around it.
    """
    path = scratch_path(df.sparkSession, name, outlive)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
