"""Labelled fault injection: an exact number of rows, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampledger.operators.ordering import hash_cut, row_hash

# Middle of the reference ranges 40..80, -60..-30 and 50..100.
FAULT_OFFSETS = {"temp_motor_c": 60.0, "battery_pct": -45.0, "voltage_v": 75.0}


def inject_faults(
    df: DataFrame,
    fraction: float = 0.03,
    offsets: dict[str, float] | None = None,
    keys: list[str] | None = None,
    seed: int = 42,
    label: str = "injected_anomaly",
) -> DataFrame:
    """Shift sensors of exactly ``int(n * fraction)`` rows and label them 1.

    The rows are those with the smallest key hashes. Finding the cut takes a
    few counts; applying it is a map-only step.
    """
    keys = keys or ["event_id"]
    offsets = offsets or FAULT_OFFSETS
    cut = hash_cut(df, int(df.count() * fraction), keys, seed)
    chosen = F.lit(False) if cut is None else row_hash(keys, seed) <= F.lit(cut)
    shifted = {c: F.when(chosen, F.col(c) + F.lit(d)).otherwise(F.col(c)) for c, d in offsets.items()}
    return df.withColumns({**shifted, label: F.when(chosen, 1).otherwise(0)})
