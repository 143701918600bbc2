"""The window layers learn from every window, and choose their thresholds from every window."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ampledger.operators import bins as B
from ampledger.operators import layers as L
from ampledger.operators.scaling import Scaler
from ampledger.schema import SENSOR_COLS


def series(spark, vehicles, length, fault):
    """Vehicles of equally many readings, calm but where ``fault`` holds."""
    rows = spark.range(vehicles * length).withColumnRenamed("id", "event_id")
    values = {c: F.lit(1.0) for c in SENSOR_COLS} | {"speed_kmh": F.when(fault, 200.0).otherwise(80.0)}
    return rows.withColumns(
        {
            "vehicle_id": F.format_string("VH_%05d", F.floor(F.col("event_id") / length)),
            "event_ts": F.timestamp_seconds("event_id"),
            **values,
            "injected_anomaly": F.when(fault, 1).otherwise(0),
        }
    )


@pytest.mark.parametrize("kind", ["sequence", "shape"])
def test_every_window_of_a_large_table_is_learned_from(spark, kind):
    vehicles, length = 20, 25_100
    rows = series(spark, vehicles, length, F.col("event_id") % 33 == 0)
    # No two windows are alike, so that a choice by hash would leave some out.
    rows = rows.withColumn("battery_pct", F.col("event_id").cast("double"))
    same = Scaler(tuple(SENSOR_COLS), (0.0,) * 10, (1.0,) * 10)
    windows = L.training_table(rows, kind, same, seq_len=3).select("label")
    assert rows.count() > 500_000
    assert windows.count() == vehicles * (length - 2)
    assert windows.agg(F.sum("label")).first()[0] == rows.filter("event_id % 33 = 0 and event_id % 25100 > 1").count()


def test_the_one_unlike_window_of_many_is_found(spark):
    # 39,200 windows; Spark's trees by themselves look for thresholds in about 10,000 of them.
    rows = series(spark, 400, 100, F.col("event_id") == 20_099)
    layer = L.fit_layer(rows, "shape", {"maxDepth": 1, "maxIter": 1}, seq_len=3)
    assert [r["event_id"] for r in layer.flag(rows).filter("l3_shape_flag = 1").collect()] == [20_099]


def test_grid_judges_windows_like_the_features_themselves(spark):
    rows = series(spark, 400, 100, F.col("event_id") % 10 == 8)
    configs = [{"maxDepth": 1, "maxIter": 1}, {"maxDepth": 2, "maxIter": 1, "maxBins": 8}]
    runs, best = L.fit_grid(rows, "shape", configs, seq_len=3)
    table = L.training_table(rows, "shape", best.scaler, split="sequences", seq_len=3).filter("split = 'val'")
    figures = L.classification_metrics(best.score(table)).first().asDict()
    assert max((r["metrics"] for r in runs.collect()), key=lambda m: m["f1"]) == figures


def vectors(spark, columns):
    data = [tuple(float(x) for x in row) for row in zip(*columns)]
    frame = spark.createDataFrame(data, ", ".join(f"c{i} double" for i in range(len(columns))))
    return frame.select(array_to_vector(F.array(*frame.columns)).alias("features"))


def test_bin_values_follow_all_rows(spark):
    rng, n = np.random.default_rng(5), 4000
    inf = math.inf
    columns = [
        rng.normal(size=n),
        np.exp(rng.normal(size=n) * 6),  # most of the range is empty
        np.r_[np.full(n - 1, 0.0), 1e9],
        np.arange(n) % 32,
        np.r_[np.full(n // 2, 7.0), rng.random(n // 2) * 1e-9],  # half of the rows share a value
        np.full(n, math.nan),
        np.r_[inf, -inf, math.nan, np.full(n - 4, 2.0), 3.0],
        np.where(np.arange(n) % 2 == 0, 0.1, math.nextafter(0.1, 1)),
    ]
    table = vectors(spark, columns)
    for parts in (7, 512):
        found = B.bin_values(table, len(columns), 32, parts)
        for i in (0, 1):
            ranks = np.searchsorted(np.sort(columns[i]), found[i]) / n
            assert len(found[i]) == 32 and set(found[i]) <= set(columns[i])
            assert np.abs(ranks - (np.arange(32) + 0.5) / 32).max() <= 1 / 128 + 1 / n
        assert found[2] == [0.0, 1e9]
        assert found[3] == [float(i) for i in range(32)]
        assert found[4][-1] == 7.0 and len(found[4]) == 17
        assert found[5] == [0.0] and found[6] == [2.0, 3.0]
        assert set(found[7]) <= {0.1, math.nextafter(0.1, 1)}
    assert B.bin_values(table.repartition(7), len(columns)) == B.bin_values(table, len(columns))


def test_replaced_values_take_the_way_of_the_features(spark):
    rng, n = np.random.default_rng(6), 3000
    x = rng.normal(size=(2, n)).round(2)
    x[0, :3] = math.nan, math.inf, -math.inf
    table = vectors(spark, [*x, np.full(n, 4.0)])
    values = B.bin_values(table, 3, 8)
    coded = B.decode(B.encode(table.withColumn("id", F.monotonically_increasing_id()), values), values)
    got = np.array([r[0] for r in coded.orderBy("id").select(vector_to_array("features")).collect()]).T
    for i in (0, 1):
        cuts = (np.array(values[i][1:]) + np.array(values[i][:-1])) / 2
        expected = np.array(values[i])[np.searchsorted(cuts, x[i], side="left")]
        assert (got[i] == expected).all() and set(values[i]) == set(got[i])
    assert set(got[2]) == {4.0}


def test_trees_are_given_bins_enough_to_read_all(spark):
    n = 20_000
    x = F.col("id") % 1009
    table = spark.range(n).select(
        array_to_vector(F.array(x.cast("double"))).alias("features"),
        F.when(x > 700, 1.0).otherwise(0.0).alias("label"), F.lit(1.0).alias("weight"),
    )
    with B.tables_for_trees(table, {2, 32, 200}) as tables:
        assert tables[200] == (table, 200)
        for bins in (2, 32):
            ready, most = tables[bins]
            assert most * most >= n and ready.count() == n
            (values,) = B.bin_values(table, 1, bins)
            assert len(values) == bins
            model = GBTClassifier(weightCol="weight", maxDepth=4, maxIter=1, maxBins=most).fit(ready)
            cuts = {(a + b) / 2 for a, b in zip(values, values[1:])}
            used = {float(line.split("<=")[1].strip(" )")) for line in model.toDebugString.split("\n") if "<=" in line}
            assert used and used <= cuts
