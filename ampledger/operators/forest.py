"""Isolation forest: trees grown from small subsamples, scores computed where the rows are."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ampledger.functions.isolation import check_sample, expected_path, grow_tree, path_lengths
from ampledger.operators.ordering import exact_quantile, row_hash
from ampledger.operators.scaling import Scaler
from ampledger.schema import CONTAMINATION, SENSOR_COLS
from ampledger.session import staging
from ampledger.sources.sinks import stage

_NODE_SCHEMA = "tree int, node int, feature int, split double, path double"


@dataclass(frozen=True)
class IsolationForestModel:
    """Node arrays of shape (trees, nodes); at most trees * 2 * subsample entries."""

    cols: tuple[str, ...]
    nodes: dict[str, np.ndarray]
    depth: int
    norm: float
    offset: float | None = None

    def score(self, df: DataFrame, scaler: Scaler | None = None) -> DataFrame:
        """Add anomaly_score in (0, 1), higher for more isolated rows. Only the sensors go to Python.

        With a scaler the model sees scaled sensors and the frame keeps its own.
        """
        nodes, depth, norm = self.nodes, self.depth, self.norm

        @F.pandas_udf("double")
        def anomaly_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
                yield pd.Series(np.exp2(-path_lengths(points, nodes, depth) / norm))

        inputs = scaler.columns() if scaler else {c: F.col(c) for c in self.cols}
        return df.withColumn("anomaly_score", anomaly_score(*[inputs[c] for c in self.cols]))

    def transform(self, df: DataFrame, scaler: Scaler | None = None) -> DataFrame:
        """Add anomaly_score and l1_iso_flag: 1 strictly above the fitted threshold."""
        if self.offset is None:
            raise ValueError("the model has no threshold; fit it with one or use fit_transform")
        return flag_scores(self.score(df, scaler), self.offset)


def flag_scores(scored: DataFrame, offset: float | None) -> DataFrame:
    hit = -F.col("anomaly_score") < F.lit(offset).cast("double")
    return scored.withColumn("l1_iso_flag", F.when(hit, 1).otherwise(0))


def _subsamples(df: DataFrame, cols: list[str], keys: list[str], trees: int, size: int, seed: int, n: int) -> DataFrame:
    """``size`` distinct rows per tree: columns tree, h and the sensors.

    The pool is the ``trees * size`` rows with the smallest hashes (all rows of
    a smaller table), in hash order. Trees take consecutive blocks of it and go
    on from its start when it ends, at every table size; ``size`` is at most the
    pool, so no tree has a row twice. A hash bound keeps all but about twice the
    pool out of the ordering.
    """
    wanted = trees * size
    share = min(1.0, (2.0 * wanted + 1000) / n)
    bound = format(min(int(share * 16**8), 16**8 - 1), "08x")
    near = df.select(row_hash(keys, seed).alias("h"), *cols).filter(F.substring("h", 1, 8) <= bound)
    near = near.orderBy("h", *cols).limit(wanted)
    ranked = near.withColumn("_rank", F.row_number().over(Window.orderBy("h", *cols)) - 1)
    places = F.sequence(F.col("_rank"), F.lit(wanted - 1), F.lit(min(n, wanted)))
    dealt = ranked.select("h", *cols, F.explode(places).alias("_place"))
    return dealt.withColumn("tree", F.floor(F.col("_place") / size).cast("int")).drop("_place")


def fit_isolation_forest(
    df: DataFrame,
    cols: list[str] = SENSOR_COLS,
    keys: list[str] | None = None,
    trees: int = 100,
    subsample: int = 256,
    contamination: float | None = CONTAMINATION,
    seed: int = 42,
) -> IsolationForestModel:
    """Grow the trees in parallel, then set the threshold at the contamination quantile (None: no threshold)."""
    keys = keys or ["event_id"]
    n = df.count()
    if n == 0:
        raise ValueError("cannot fit a forest on an empty table")
    size = min(subsample, n)
    sample = _subsamples(df, cols, keys, trees, size, seed, n)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        check_sample(pdf["h"], size, keys)
        pdf = pdf.sort_values(["h", *cols])
        return grow_tree(pdf[cols].to_numpy(dtype=float), int(pdf["tree"].iloc[0]), seed)

    # A fixed partition count: adaptive execution would join the small groups into one task.
    spread = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    grown = sample.repartition(spread, "tree").groupBy("tree").applyInPandas(grow, _NODE_SCHEMA).toPandas()
    if grown["tree"].nunique() != trees:
        raise ValueError(f"columns {keys} do not tell the rows apart; sampling needs a unique key")
    shape = (trees, int(grown["node"].max()) + 1)

    def table(name: str, dtype) -> np.ndarray:
        out = np.zeros(shape, dtype=dtype)
        out[grown["tree"].to_numpy(), grown["node"].to_numpy()] = grown[name].to_numpy()
        return out

    kinds = {"feature": np.int32, "split": float, "path": float}
    model = IsolationForestModel(
        cols=tuple(cols),
        nodes={name: table(name, dtype) for name, dtype in kinds.items()},
        depth=int(np.ceil(np.log2(max(size, 2)))),
        norm=expected_path(size) or 1.0,
    )
    return model if contamination is None else with_threshold(model, df, contamination)


def with_threshold(
    model: IsolationForestModel, df: DataFrame, contamination: float = CONTAMINATION, scaler: Scaler | None = None
) -> IsolationForestModel:
    """The model with its threshold at the contamination quantile of the scores of ``df``.

    Stores eight bytes a row, the score, until the quantile is known.
    """
    with staging(df.sparkSession):
        scores = stage(model.score(df, scaler).select((-F.col("anomaly_score")).alias("score")))
        return replace(model, offset=exact_quantile(scores, "score", contamination))


def fit_transform(
    df: DataFrame, scaler: Scaler, contamination: float = CONTAMINATION, keys: list[str] | None = None, **forest_args
) -> DataFrame:
    """Grow the forest on scaled sensors and add anomaly_score and l1_iso_flag.

    Rows are scored once for the threshold and once when the result is used:
    scoring reads ten doubles a row, less than storing and reading all columns.
    """
    model = fit_isolation_forest(scaler.transform(df), keys=keys, contamination=None, **forest_args)
    return with_threshold(model, df, contamination, scaler).transform(df, scaler)


def contamination_threshold(
    df: DataFrame, score: str, contamination: float = CONTAMINATION, flag: str = "flag", **quantile_args
) -> DataFrame:
    """Flag the rows strictly below the contamination quantile of a score."""
    threshold = exact_quantile(df, score, contamination, **quantile_args)
    return df.withColumn(flag, F.when(F.col(score) < F.lit(threshold).cast("double"), 1).otherwise(0))
