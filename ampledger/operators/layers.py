"""Window classifiers (layers 2 and 3), the vote over layers, and batch scoring."""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampledger.functions.scalars import argmax_class, class_weight, decision, sensor_vector, tile
from ampledger.operators.bins import BINS, tables_for_trees
from ampledger.operators.metrics import classification_metrics, run_row
from ampledger.operators.scaling import Scaler, fit_scaler
from ampledger.operators.series import chronological_split, make_sequences, shape_columns, shape_features
from ampledger.schema import SENSOR_COLS, SEQ_LEN
from ampledger.session import scratch_path, staging

# Five settings per layer, in the order they are tried.
SEQUENCE_CONFIGS = [
    {"regParam": 0.0, "maxIter": 10},
    {"regParam": 0.001, "maxIter": 10},
    {"regParam": 0.01, "maxIter": 10},
    {"regParam": 0.01, "maxIter": 20},
    {"regParam": 0.1, "maxIter": 20},
]
SHAPE_CONFIGS = [
    {"maxDepth": 2, "maxIter": 3, "stepSize": 0.3},
    {"maxDepth": 3, "maxIter": 3, "stepSize": 0.3},
    {"maxDepth": 3, "maxIter": 5, "stepSize": 0.1},
    {"maxDepth": 4, "maxIter": 3, "stepSize": 0.3},
    {"maxDepth": 4, "maxIter": 5, "stepSize": 0.1},
]


#: Configurations of a grid that are fitted at a time, and the windows that these hold together at most.
GRID_WORKERS = 4
GRID_ROWS = 2_000_000
FLAGS = {"sequence": "l2_seq_flag", "shape": "l3_shape_flag"}
_SCALED = "_scaled_"
_STATE_SCHEMA = "kind string, seq_len int, cols array<string>, means array<double>, stds array<double>"


@dataclass(frozen=True)
class LayerModel:
    """A fitted scaler and window classifier."""

    kind: str
    scaler: Scaler
    model: PipelineModel
    seq_len: int = SEQ_LEN

    def score(self, features: DataFrame) -> DataFrame:
        """Add p (probability of an anomaly) and prediction to a feature table."""
        scored = self.model.transform(features)
        p = vector_to_array("probability")
        return scored.withColumns({"p": p[1], "prediction": argmax_class(p[0], p[1])}).drop(
            "rawPrediction", "probability"
        )

    def digest(self) -> str:
        """Digest of the scaler and the fitted numbers: equal for a model and its stored form."""
        fitted = self.model.stages[-1]
        body = fitted.toDebugString.split("\n", 1)[1] if self.kind == "shape" else (fitted.coefficients.toArray().tolist(), fitted.intercept)
        state = (self.kind, self.seq_len, list(self.scaler.cols), list(self.scaler.means), list(self.scaler.stds), body)
        return hashlib.sha256(repr(state).encode()).hexdigest()

    def save(self, path: str) -> None:
        """Write the classifier and the scaler; an existing model at the path is replaced."""
        self.model.write().overwrite().save(f"{path}/model")
        state = [(self.kind, self.seq_len, list(self.scaler.cols), list(self.scaler.means), list(self.scaler.stds))]
        spark = SparkSession.active()
        spark.createDataFrame(state, _STATE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/state")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LayerModel:
        state = spark.read.schema(_STATE_SCHEMA).parquet(f"{path}/state").first()
        scaler = Scaler(tuple(state["cols"]), tuple(state["means"]), tuple(state["stds"]))
        return LayerModel(state["kind"], scaler, PipelineModel.load(f"{path}/model"), state["seq_len"])

    def flag(self, df: DataFrame, **series_args) -> DataFrame:
        """Add the layer's flag to every row: 1 where the window ending there scores above 0.5.

        Rows without a full window get 0; missing sensors count as 0 before scaling.
        The columns stay as they are; no join is needed.
        """
        names = [_SCALED + c for c in SENSOR_COLS]
        zero = F.lit(0.0)
        filled = df.withColumns({_SCALED + c: F.coalesce(F.nanvl(c, zero), zero) for c in SENSOR_COLS})
        table = _table(
            self.kind,
            replace(self.scaler, cols=tuple(names)).transform(filled),
            cols=names,
            label=None,
            keep=df.columns,
            seq_len=self.seq_len,
            partial=True,
            **series_args,
        )
        full = F.col("position") >= 0
        blank = F.array_repeat(F.lit(0.0), self.seq_len * len(names) if self.kind == "sequence" else len(shape_columns()))
        table = table.withColumn("features", array_to_vector(F.when(full, F.col("features")).otherwise(blank)))
        hit = F.when(full & (F.col("p") > 0.5), 1).otherwise(0)
        return self.score(table).select(*df.columns, hit.alias(FLAGS[self.kind]))


def _table(kind: str, scaled: DataFrame, cols: list[str] = SENSOR_COLS, **args) -> DataFrame:
    """One flat array of numbers per window that ends at the labelled row."""
    if kind == "sequence":
        return make_sequences(scaled, horizon=0, cols=cols, **args).withColumn("features", F.flatten("features"))
    if kind == "shape":
        stats = shape_features(scaled, cols=cols, **args)
        names = shape_columns(cols)
        return stats.withColumn("features", F.array(*[F.col(c) for c in names])).drop(*names)
    raise ValueError(f"unknown layer kind {kind!r}")


def training_table(df: DataFrame, kind: str, scaler: Scaler, fit_rows: int | None = None, **args) -> DataFrame:
    """Vectors, labels and class weights of every full window.

    A caller who asks for ``fit_rows`` gets about so many of a larger table instead: windows are chosen by the
    hash of their numbers, the same in every run.
    """
    table = _table(kind, scaler.transform(df), **args)
    if fit_rows is not None and (n := df.count()) > fit_rows:
        table = table.filter(F.pmod(F.xxhash64("features"), F.lit(1 << 40)) < F.lit(int(fit_rows / n * (1 << 40))))
    return table.withColumns({"features": array_to_vector("features"), "weight": class_weight("label")})


def _estimator(kind: str, params: dict):
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    if kind == "sequence":
        return LogisticRegression(**common, standardization=True, **params)
    return GBTClassifier(**common, seed=42, **params)


def _fit(kind: str, table: DataFrame, params: dict) -> PipelineModel:
    """The fitted classifier, read back from its stored form.

    A fresh logistic model holds a summary with its session and training table, and cannot be sent to the
    workers once that session has observed metrics.
    """
    with staging(table.sparkSession):
        path = scratch_path(table.sparkSession, "model")
        PipelineModel([_estimator(kind, params).fit(table)]).write().save(path)
        return PipelineModel.load(path)


def fit_layer(df: DataFrame, kind: str = "sequence", params: dict | None = None, **args) -> LayerModel:
    """Fit layer 2 (``sequence``: weighted logistic regression over raw windows) or
    layer 3 (``shape``: weighted boosted trees over window statistics).

    The window ending at a row is labelled with that row. Rows need their sensors filled.
    """
    configs = SEQUENCE_CONFIGS if kind == "sequence" else SHAPE_CONFIGS
    scaler = fit_scaler(df)
    table = training_table(df, kind, scaler, **args).select("features", "label", "weight")
    params, seq_len = params or configs[1], args.get("seq_len", SEQ_LEN)
    if kind == "sequence":
        # Logistic regression keeps blocks of its own.
        return LayerModel(kind, scaler, _fit(kind, table, params), seq_len)
    bins = params.get("maxBins", BINS)
    with tables_for_trees(table, {bins}) as tables:
        table, max_bins = tables[bins]
        return LayerModel(kind, scaler, _fit(kind, table, {**params, "maxBins": max_bins}), seq_len)


def fit_grid(
    df: DataFrame,
    kind: str = "sequence",
    configs: list[dict] | None = None,
    metric: str = "f1",
    scale_on: str = "all",
    workers: int = GRID_WORKERS,
    **args,
) -> tuple[DataFrame, LayerModel | None]:
    """Fit every configuration on the first 80 % of each series' windows, with metrics on the rest.

    Returns the run rows and the model of the best run by ``metric``; ties keep
    the earliest, and None means that all are 0. The scaler learns from all
    rows, or with ``scale_on="train"`` from the first 80 % of each series.
    ``workers`` configurations are fitted at a time from one cached table, as
    the many short jobs of one fit leave executors idle; with fair scheduling
    (``spark.scheduler.mode``) each has a pool of its own. Each fit caches the
    windows in a form of its own, so fewer are fitted at a time where together
    they would hold more than ``GRID_ROWS`` windows.
    """
    if scale_on not in ("all", "train"):
        raise ValueError(f"scale_on must be 'all' or 'train', not {scale_on!r}")
    configs = configs or (SEQUENCE_CONFIGS if kind == "sequence" else SHAPE_CONFIGS)
    spark = df.sparkSession
    base = chronological_split(df).filter(F.col("split") == "train") if scale_on == "train" else df
    scaler = fit_scaler(base)
    table = training_table(df, kind, scaler, split="sequences", **args)
    table = table.select("features", "label", "weight", "split")

    def run(idx: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"grid-{idx}")
        params = configs[idx]
        ready, train = table, table.filter(F.col("split") == "train")
        if kind == "shape":
            ready, max_bins = tables[params.get("maxBins", BINS)]
            train, params = ready.filter(F.col("split") == "train"), {**params, "maxBins": max_bins}
        model = LayerModel(kind, scaler, _fit(kind, train, params), args.get("seq_len", SEQ_LEN))
        # One row of four figures per configuration; the cached windows are not needed later.
        return model, classification_metrics(model.score(ready.filter(F.col("split") == "val"))).first()

    sizes = {params.get("maxBins", BINS) for params in configs} if kind == "shape" else set()
    # The cache is filled before: fits that start together would each compute what they find missing.
    with tables_for_trees(table, sizes) as tables:
        n = next((t for t, _ in tables.values()), table).count()
        with ThreadPoolExecutor(max(1, min(workers, len(configs), GRID_ROWS // max(n, 1)))) as pool:
            # Threads of the pool take the session's properties, and keep their own pool names to themselves.
            started = [pool.submit(inheritable_thread_target(spark)(run), idx) for idx in range(len(configs))]
            results = [f.result() for f in started]
        runs, best, highest = [], None, 0.0
        for idx, (model, row) in enumerate(results):
            if row[metric] > highest:
                best, highest = model, row[metric]
            runs.append(run_row(spark.createDataFrame([row]), f"{kind}_config_{idx + 1}", configs[idx], config_idx=idx))
        return reduce(DataFrame.unionByName, runs), best


def config_grid(df: DataFrame, kind: str = "sequence", configs: list[dict] | None = None, **args) -> DataFrame:
    """The run rows of ``fit_grid``."""
    return fit_grid(df, kind, configs, **args)[0]


def ensemble_vote(
    df: DataFrame,
    flags: tuple[str, ...] = ("l1_iso_flag", "l2_seq_flag", "l3_shape_flag"),
    min_votes: int = 2,
) -> DataFrame:
    """anomaly_votes, and is_anomaly (0/1) from ``min_votes`` on. ``min_votes=1`` flags on any layer."""
    votes = sum((F.coalesce(F.col(f).cast("int"), F.lit(0)) for f in flags), F.lit(0))
    return df.withColumn("anomaly_votes", votes).withColumn(
        "is_anomaly", F.when(F.col("anomaly_votes") >= min_votes, 1).otherwise(0)
    )


def batch_score(readings: DataFrame, layer: LayerModel, keep: list[str] | None = None) -> DataFrame:
    """Score single readings in one map-only pass.

    A reading is normalised and repeated to the length of a window, so that the
    sequence layer can judge it alone. Works on streams as well.
    """
    keep = keep or [c for c in readings.columns if c not in SENSOR_COLS]
    scaled = layer.scaler.normalize(readings)
    sequence = F.flatten(tile(sensor_vector(), layer.seq_len))
    table = scaled.select(*keep, array_to_vector(sequence).alias("features"))
    scored = layer.score(table)
    return scored.select(*keep, *decision("p"))
