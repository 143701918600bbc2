"""Classification metrics, losses, experiment runs and the choice of a configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampledger.functions.scalars import class_weight, log_softmax_loss


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """True and false positives and negatives, optionally per group."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*(by or [])).agg(
        F.count(F.when(y & p, 1)).alias("tp"),
        F.count(F.when(~y & p, 1)).alias("fp"),
        F.count(F.when(y & ~p, 1)).alias("fn"),
        F.count(F.when(~y & ~p, 1)).alias("tn"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion_counts(df, label, prediction, by).select(
        *(by or []),
        _share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction", names: tuple[str, str] = ("Normal", "Anomaly")) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted averages.

    All rows come from one four-number aggregate.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def per_class(hit: Column, extra: Column, miss: Column) -> list[Column]:
        return [_share(hit, hit + extra), _share(hit, hit + miss), _share(2 * hit, 2 * hit + extra + miss)]

    normal, anomaly = per_class(tn, fn, fp), per_class(tp, fp, fn)
    n0, n1 = tn + fp, tp + fn
    total = n0 + n1
    macro = [(a + b) / F.lit(2.0) for a, b in zip(normal, anomaly)]
    weighted = [_share(a * n0 + b * n1, total) for a, b in zip(normal, anomaly)]
    accuracy = [_share(tp + tn, total)] * 3
    rows = [
        (names[0], normal, n0),
        (names[1], anomaly, n1),
        ("accuracy", accuracy, total),
        ("macro avg", macro, total),
        ("weighted avg", weighted, total),
    ]
    structs = [
        F.struct(
            F.lit(name).alias("class_name"),
            m[0].alias("precision"),
            m[1].alias("recall"),
            m[2].alias("f1"),
            support.alias("support"),
        )
        for name, m, support in rows
    ]
    counts = confusion_counts(df, label, prediction)
    return counts.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def log_losses(df: DataFrame, z0: str = "z0", z1: str = "z1", label: str = "label") -> DataFrame:
    """Cross-entropy with class weights averaged over ``rows`` and over ``weights``, and ``unweighted``, in one aggregate."""
    loss, weight = log_softmax_loss(z0, z1, label), class_weight(label)
    return df.agg(
        F.avg(weight * loss).alias("rows"),
        F.try_divide(F.sum(weight * loss), F.sum(weight)).alias("weights"),
        F.avg(loss).alias("unweighted"),
    )


def weighted_log_loss(df: DataFrame, mean: str | None = "rows", z0: str = "z0", z1: str = "z1", label: str = "label") -> DataFrame:
    """One of ``log_losses``: averaged over rows, over weights, or unweighted (None)."""
    if mean not in ("rows", "weights", None):
        raise ValueError(f"unknown mean {mean!r}")
    return log_losses(df, z0, z1, label).select(F.col(mean or "unweighted").alias("log_loss"))


def false_positive_reduction(df: DataFrame, ensemble: str = "is_anomaly", single: str = "l1_iso_flag", label: str = "label") -> DataFrame:
    """Share of a single layer's false positives that the ensemble avoids; NULL without any."""
    negative = F.col(label) != 1

    def false_hits(flag: str) -> Column:
        return F.count(F.when(negative & (F.col(flag).cast("int") == 1), 1))

    return df.agg(false_hits(ensemble).alias("fp_ensemble"), false_hits(single).alias("fp_single")).withColumn(
        "fp_reduction", F.lit(1.0) - F.try_divide("fp_ensemble", "fp_single")
    )


RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_name", T.StringType()),
        T.StructField("config_idx", T.IntegerType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("step", T.IntegerType()),
    ]
)


def run_row(metrics: DataFrame, run_name: str, params: dict, config_idx: int = 0, step: int = 0) -> DataFrame:
    """A run-table row from a one-row frame whose columns are all metrics."""
    pairs = [x for c in metrics.columns for x in (F.lit(c), F.col(c).cast("double"))]
    tags = [x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]
    empty = F.create_map().cast("map<string,string>")
    return metrics.select(
        F.lit(run_name).alias("run_name"),
        F.lit(config_idx).cast("int").alias("config_idx"),
        (F.create_map(*tags) if tags else empty).alias("params"),
        F.create_map(*pairs).alias("metrics"),
        F.lit(step).cast("int").alias("step"),
    )


def log_runs(runs: DataFrame, path: str, run_id: str | None = None) -> None:
    """Append run rows; with ``run_id`` they replace those logged under it before, so that a retry counts once."""
    if run_id is None:
        runs.write.mode("append").parquet(path)
    else:
        runs.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def explode_metrics(runs: DataFrame) -> DataFrame:
    return runs.select("run_name", "config_idx", "step", F.explode("metrics").alias("metric", "value"))


def best_config(runs: DataFrame, metric: str = "f1") -> DataFrame:
    """The run with the highest metric; ties keep the earliest, and 0 never wins."""
    value = F.col("metrics")[metric]
    return (
        runs.select("run_name", "config_idx", value.alias(metric))
        .filter(F.col(metric) > 0)
        .orderBy(F.desc(metric), "config_idx")
        .limit(1)
    )
