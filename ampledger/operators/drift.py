"""Two-sample Kolmogorov-Smirnov drift between any two tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ampledger.operators.series import small_side
from ampledger.schema import DRIFT_COLS
from ampledger.sources.sinks import stage

SPLITS = 64
# Cut points only balance the buckets; any cut gives the same distances.
CUT_ACCURACY = 1_000
BUCKET_ROWS = 1_000_000
_BUCKET = ["column_name", "bucket"]
_SIZES = "column_name string, bucket array<int>, r bigint, c bigint, low double, high double, cuts array<double>"


def _sizes(rows: DataFrame) -> DataFrame:
    """Rows of either side, extremes and equi-depth cut points of each bucket, in one pass."""
    shares = [i / SPLITS for i in range(SPLITS + 1)]
    return rows.groupBy(*_BUCKET).agg(
        F.sum("is_ref").cast("bigint").alias("r"),
        F.sum(1 - F.col("is_ref")).cast("bigint").alias("c"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.percentile_approx("value", shares, CUT_ACCURACY).alias("cuts"),
    )


def _in(side: DataFrame) -> Column:
    return (F.col("column_name") == side["_column"]) & (F.col("bucket") == side["_bucket"])


def _keyed(sizes: DataFrame, *more: str) -> DataFrame:
    return sizes.select(F.col("column_name").alias("_column"), F.col("bucket").alias("_bucket"), *more)


def value_buckets(values: DataFrame, sizes: DataFrame, bucket_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """Divide the values of each column until no bucket of unlike values has more than ``bucket_rows`` rows.

    A bucket is a path of digits, ascending with the value. A bucket too large
    is cut at its own quantiles: a value on a cut is a bucket of its own (odd
    digit), so that frequent values separate, and every cut takes at least one
    value out. Returns the rows with their buckets, and the sizes by level.
    """
    too_large = (F.col("r") + F.col("c") > bucket_rows) & (F.col("low") < F.col("high"))
    rows, levels = values, [sizes]
    while n_large := levels[-1].filter(too_large).count():
        cut = small_side(_keyed(levels[-1].filter(too_large), F.array_distinct("cuts").alias("_cuts")), n_large)
        below = F.size(F.filter("_cuts", lambda x: x < F.col("value")))
        upto = F.size(F.filter("_cuts", lambda x: x <= F.col("value")))
        rows = rows.join(cut, _in(cut), "left").withColumn("_split", F.col("_cuts").isNotNull())
        path = F.when(F.col("_split"), F.concat("bucket", F.array(below + upto))).otherwise(F.col("bucket"))
        rows = rows.select("is_ref", "column_name", "value", path.alias("bucket"), "_split")
        levels.append(stage(_sizes(rows.filter("_split"))))
        rows = rows.drop("_split")
        levels[-2] = levels[-2].filter(~too_large)
    return rows, levels


def ks_two_sample(ref: DataFrame, cur: DataFrame, cols: list[str] = DRIFT_COLS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Largest distance of the two distribution functions per column, with both sample sizes.

    Values are exchanged once, by bucket (see :func:`value_buckets`), and each
    window orders one bucket. Buckets of one value, such as one that a third of
    the rows share, are counted and not exchanged. Only a few numbers per bucket
    go on to the ordered sum over buckets. NULL and NaN are left out.
    """
    both = ref.select(*cols, F.lit(1).alias("is_ref")).unionByName(cur.select(*cols, F.lit(0).alias("is_ref")))
    both = both.select("is_ref", *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    values = both.unpivot(["is_ref"], cols, "column_name", "value").filter(F.col("value").isNotNull())
    values = values.withColumn("bucket", F.array().cast("array<int>"))

    whole = _sizes(values).select("column_name", "bucket", "r", "c", "low", "high", "cuts").collect()  # a row per column
    totals = {row["column_name"]: (row["r"], row["c"]) for row in whole}
    rows, levels = value_buckets(values, ref.sparkSession.createDataFrame(whole, _SIZES), bucket_rows)

    def total(side: int) -> Column:
        out = F.lit(None).cast("bigint")
        for name, both_sides in totals.items():
            out = F.when(F.col("column_name") == name, F.lit(both_sides[side]).cast("bigint")).otherwise(out)
        return out

    def gap(r: Column, c: Column) -> Column:
        return F.try_divide(r, total(0)) - F.try_divide(c, total(1))

    single = _union(levels).filter(F.col("low") == F.col("high"))
    n_single = single.count()
    if n_single:
        alone = small_side(_keyed(single), n_single)
        rows = rows.join(alone, _in(alone), "left_anti")
    # The default frame takes in all rows that share a value.
    upto = Window.partitionBy(*_BUCKET).orderBy("value")
    gaps = rows.withColumn("gap", gap(F.sum("is_ref").over(upto), F.sum(1 - F.col("is_ref")).over(upto)))
    buckets = gaps.groupBy(*_BUCKET).agg(
        F.sum("is_ref").alias("r"),
        F.sum(1 - F.col("is_ref")).alias("c"),
        F.max("gap").alias("top"),
        F.min("gap").alias("bottom"),
    )
    if n_single:
        step = gap(F.col("r"), F.col("c"))
        buckets = buckets.unionByName(single.select(*_BUCKET, "r", "c", step.alias("top"), step.alias("bottom")))
    before = Window.partitionBy("column_name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(gap(F.sum("r").over(before), F.sum("c").over(before)), F.lit(0.0))
    far = F.greatest(F.abs(F.col("top") + F.col("offset")), F.abs(F.col("bottom") + F.col("offset")))
    return (
        buckets.withColumn("offset", offset)
        .groupBy("column_name")
        .agg(F.max(far).alias("ks_stat"), F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def ks_p_value(d: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sided p-value with Stephens' small-sample correction."""
    size = F.sqrt(n_ref * n_cur / (n_ref + n_cur))
    lam = (size + F.lit(0.12) + F.try_divide(F.lit(0.11), size)) * d
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    series = F.lit(2.0) * F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    clamped = F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    # Below 0.2 the series converges too slowly; the p-value is 1 to many digits.
    return F.when(lam < 0.2, F.lit(1.0)).when(lam.isNotNull(), clamped)


def ks_drift(ref: DataFrame, cur: DataFrame, cols: list[str] = DRIFT_COLS, alpha: float = 0.05, **ks_args) -> DataFrame:
    """Drift report: drift is decided on the unrounded p-value, figures are rounded to 4 places."""
    p = ks_p_value(F.col("ks_stat"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    return (
        ks_two_sample(ref, cur, cols, **ks_args)
        .withColumn("p", p)
        .select(
            F.col("column_name").alias("column"),
            F.round("ks_stat", 4).alias("ks_stat"),
            F.round("p", 4).alias("p_value"),
            (F.col("p") < F.lit(alpha)).alias("drift"),
        )
    )


def drifted_column_count(report: DataFrame) -> DataFrame:
    return report.agg(F.sum(F.col("drift").cast("int")).alias("drifted"), F.count(F.lit(1)).alias("columns"))
