"""Column expressions: derived features, rule flags, scoring arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampledger.schema import POSITIVE_WEIGHT, SENSOR_COLS, SEQ_LEN


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def power_kw(voltage="voltage_v", current="current_a") -> Column:
    return F.round(_col(voltage) * _col(current) / F.lit(1000.0), 2)


def temp_delta(motor="temp_motor_c", battery="temp_battery_c") -> Column:
    return F.round(_col(motor) - _col(battery), 2)


def accel_magnitude(x="accel_x", y="accel_y", z="accel_z") -> Column:
    x, y, z = _col(x), _col(y), _col(z)
    return F.round(F.sqrt(x * x + y * y + z * z), 4)


def efficiency(speed="speed_kmh", power="power_kw") -> Column:
    """Speed per kW; NULL unless the (rounded) power is positive."""
    power = _col(power)
    return F.when(power > 0, F.round(_col(speed) / power, 4))


def above(c: str | Column, limit: float) -> Column:
    """1 where strictly above the limit, else 0; NULL counts as 0."""
    return F.when(_col(c) > F.lit(limit), 1).otherwise(0)


def below(c: str | Column, limit: float) -> Column:
    """1 where strictly below the limit, else 0; NULL counts as 0."""
    return F.when(_col(c) < F.lit(limit), 1).otherwise(0)


def any_flag(*flags: str) -> Column:
    hit = F.lit(False)
    for flag in flags:
        hit = hit | (F.col(flag) == 1)
    return F.when(hit, 1).otherwise(0)


def vehicle_id(number: str | Column) -> Column:
    return F.format_string("VH_%05d", _col(number))


def clip(c: str | Column, low: float, high: float) -> Column:
    """Bound a value to [low, high]; NULL and NaN stay as they are."""
    c = _col(c)
    bounded = F.least(F.greatest(c, F.lit(low)), F.lit(high))
    return F.when(c.isNull() | F.isnan(c), c).otherwise(bounded)


def sensor_vector(cols: list[str] = SENSOR_COLS) -> Column:
    return F.array(*[F.col(c) for c in cols])


def normalize_eps(c: str | Column, mean: float, std: float, eps: float = 1e-8) -> Column:
    return (_col(c) - F.lit(mean)) / F.lit(std + eps)


def tile(vector: str | Column, steps: int = SEQ_LEN) -> Column:
    return F.array_repeat(_col(vector), steps)


def softmax_pair(z0: str | Column, z1: str | Column) -> Column:
    """Probability of class 1 from two logits, shifted so that exp never overflows."""
    z0, z1 = _col(z0), _col(z1)
    top = F.greatest(z0, z1)
    e0, e1 = F.exp(z0 - top), F.exp(z1 - top)
    return e1 / (e0 + e1)


def log_softmax_loss(z0: str | Column, z1: str | Column, label: str | Column) -> Column:
    """Cross-entropy of one row in the stable log-sum-exp form."""
    z0, z1 = _col(z0), _col(z1)
    top = F.greatest(z0, z1)
    log_sum = top + F.log(F.exp(z0 - top) + F.exp(z1 - top))
    return log_sum - F.when(_col(label) == 1, z1).otherwise(z0)


def argmax_class(z0: str | Column, z1: str | Column) -> Column:
    return F.when(_col(z1) > _col(z0), 1).otherwise(0)


def class_weight(label: str | Column, positive: float = POSITIVE_WEIGHT) -> Column:
    return F.when(_col(label) == 1, F.lit(positive)).otherwise(F.lit(1.0))


def decision(p: str | Column, threshold: float = 0.5) -> list[Column]:
    """is_anomaly, anomaly_score, confidence and label of a probability."""
    p = _col(p)
    hit = p > F.lit(threshold)
    return [
        hit.alias("is_anomaly"),
        F.round(p, 4).alias("anomaly_score"),
        F.round(F.greatest(p, F.lit(1.0) - p), 4).alias("confidence"),
        F.when(hit, "ANOMALY").otherwise("NORMAL").alias("label"),
    ]
