"""Population scaler: fit once, apply as constants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampledger.functions.scalars import normalize_eps
from ampledger.schema import SENSOR_COLS


@dataclass(frozen=True)
class Scaler:
    """Mean and deviation per column: a fixed, small state that plans hold as literals."""

    cols: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    def columns(self) -> dict[str, Column]:
        """(x - mean) / std per column."""
        return {c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(self.cols, self.means, self.stds)}

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """Scale in place, or into columns of prefixed names."""
        return df.withColumns({prefix + c: scaled for c, scaled in self.columns().items()})

    def normalize(self, df: DataFrame, eps: float = 1e-8) -> DataFrame:
        """(x - mean) / (std + eps) in place, the form used when scoring."""
        return df.withColumns(
            {c: normalize_eps(c, m, s, eps) for c, m, s in zip(self.cols, self.means, self.stds)}
        )


def _stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: mean and population deviation, 1 where there is no spread."""
    totals = df.agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in cols]
    )
    long = totals.unpivot([], cols, "column_name", "s")
    std = F.when(F.col("s.std") == 0, F.lit(1.0)).otherwise(F.col("s.std"))
    return long.select("column_name", F.col("s.mean").alias("mean"), std.alias("std"))


def scaler_stats(df: DataFrame, cols: list[str] = SENSOR_COLS) -> DataFrame:
    return _stats(df, cols)


def fit_scaler(df: DataFrame, cols: list[str] = SENSOR_COLS) -> Scaler:
    """Fit in one aggregate; one row per column comes back."""
    rows = {r["column_name"]: r for r in _stats(df, cols).collect()}
    means = tuple(0.0 if rows[c]["mean"] is None else rows[c]["mean"] for c in cols)
    stds = tuple(1.0 if rows[c]["std"] is None else rows[c]["std"] for c in cols)
    return Scaler(tuple(cols), means, stds)


def scale_sensors(
    df: DataFrame, cols: list[str] = SENSOR_COLS, fit_on: str = "all", split: str = "split"
) -> DataFrame:
    """Scale with statistics of all rows, or of the rows whose ``split`` column says train."""
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    base = df.filter(F.col(split) == "train") if fit_on == "train" else df
    return fit_scaler(base, cols).transform(df)
