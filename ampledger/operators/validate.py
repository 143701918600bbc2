"""Schema check, null audit and range audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampledger.schema import REQUIRED_COLS, SENSOR_COLS, SENSOR_RANGES, TELEMETRY_SCHEMA


def validate_schema(df: DataFrame, required: list[str] = REQUIRED_COLS) -> DataFrame:
    """The same frame, or ``ValueError`` when a required column is absent. Runs no job."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns! {', '.join(missing)}")
    return df


def schema_report(df: DataFrame, expected: T.StructType = TELEMETRY_SCHEMA) -> DataFrame:
    """Per expected column: present, of the expected type, and the row count of the table."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.name in actual).alias("present"),
            F.lit(actual.get(f.name) == f.dataType).alias("type_ok"),
        )
        for f in expected.fields
    ]
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select("n_rows", F.explode(F.array(*rows)).alias("r"))
        .select("r.*", "n_rows")
    )


def _is_null(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def _audit(df: DataFrame, tests: dict[str, Column], count: str, rate: str) -> DataFrame:
    """Count the hits of one test per column in one pass, one output row per column."""
    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(test, 1)).alias(c) for c, test in tests.items()],
    )
    return totals.unpivot(["n_rows"], list(tests), "column_name", count).select(
        "column_name", count, "n_rows", F.round(F.try_divide(F.col(count), F.col("n_rows")), 6).alias(rate)
    )


def null_audit(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL (and NaN) count and rate per column."""
    cols = cols or df.columns
    return _audit(df, {c: _is_null(df, c) for c in cols}, "null_count", "null_rate")


def out_of_range(c: str, bounds: tuple[float, float]) -> Column:
    """Outside the bounds; NULL is in range (the null audit counts it), NaN is not."""
    return F.coalesce((F.col(c) < F.lit(bounds[0])) | (F.col(c) > F.lit(bounds[1])), F.lit(False))


def _present(df: DataFrame, ranges: dict[str, tuple[float, float]] | None) -> dict[str, tuple[float, float]]:
    return {c: b for c, b in (ranges or SENSOR_RANGES).items() if c in df.columns}


def range_audit(df: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Count and rate of values outside their range, for the columns that the table has."""
    tests = {c: out_of_range(c, b) for c, b in _present(df, ranges).items()}
    return _audit(df, tests, "out_of_range", "out_of_range_rate")


def add_violations(df: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Row variant: an array of the columns that are out of range."""
    names = F.array(*[F.when(out_of_range(c, b), F.lit(c)) for c, b in _present(df, ranges).items()])
    return df.withColumn("violations", F.filter(names, lambda name: name.isNotNull()))


def observe_audit(df: DataFrame, cols: list[str] = SENSOR_COLS, ranges: dict[str, tuple[float, float]] | None = None) -> tuple[DataFrame, Observation]:
    """The frame, and an observation that has its audit counts once an action has passed all rows: no pass of its own."""
    seen = Observation("audit")
    bounds = _present(df, ranges)
    counts = [F.count(F.lit(1)).alias("n_records")]
    for c in (c for c in cols if c in df.columns):
        counts.append(F.count(F.when(_is_null(df, c), 1)).alias(f"{c} null_count"))
        bad = out_of_range(c, bounds[c]) if c in bounds else F.lit(False)
        counts.append(F.count(F.when(bad, 1)).alias(f"{c} out_of_range"))
    return df.observe(seen, *counts), seen


def audit_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """One row per audited column from the counts of :func:`observe_audit`: column_name, n_records, null_count, out_of_range."""
    names = [k.removesuffix(" null_count") for k in counts if k.endswith(" null_count")]
    rows = [(c, counts["n_records"], counts[f"{c} null_count"], counts[f"{c} out_of_range"]) for c in names]
    return spark.createDataFrame(rows, "column_name string, n_records long, null_count long, out_of_range long")


def check_audit(counts: dict[str, int], limits: dict[str, float]) -> None:
    """Raise where the share of a column's rows with a finding (``null_count``, ``out_of_range``) is above its limit."""
    n = max(counts["n_records"], 1)
    over = [f"{k} {v / n:.4f}" for k, v in counts.items() if v / n > limits.get(k.rsplit(" ", 1)[-1], 1.0) and k != "n_records"]
    if over:
        raise ValueError(f"the audit is over its limits: {', '.join(over)}")
