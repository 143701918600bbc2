import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ampledger.operators import metrics as M
from ampledger.operators.augment import inject_faults
from ampledger.operators.drift import _sizes, drifted_column_count, ks_drift, ks_two_sample, value_buckets
from ampledger.operators.forest import contamination_threshold, fit_isolation_forest, fit_transform
from ampledger.operators.layers import ensemble_vote
from ampledger.operators.ordering import _ranked, exact_quantile, first_rows, hash_cut
from ampledger.operators.scaling import fit_scaler, scale_sensors
from ampledger.schema import SENSOR_COLS
from ampledger.sources.sinks import stage

NAN = float("nan")


def numbers(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double").repartition(4)


def linear_quantile(values, q):
    values = sorted(values)
    at = (len(values) - 1) * q
    low = math.floor(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.mark.parametrize("q", [0.0, 0.03, 0.5, 0.97, 1.0])
def test_exact_quantile_narrowed(spark, q):
    rng = random.Random(1)
    # A third of the rows share one value, as a stuck sensor would.
    values = [rng.gauss(0, 1) for _ in range(2000)] + [0.25] * 1000
    got = exact_quantile(numbers(spark, values), "v", q, gather_rows=50)
    assert got == pytest.approx(linear_quantile(values, q), abs=1e-12)
    assert got == exact_quantile(numbers(spark, values), "v", q)


@pytest.mark.parametrize("k", [0, 1, 101, 149, 150, 249, 299])
def test_ranks_when_the_sketch_misses(spark, k):
    """Brackets beside the rank, on it, and with the next value outside."""
    values = sorted([0.25] * 100 + [float(i) for i in range(200)])
    df = numbers(spark, values)
    want = (values[k], values[k + 1] if k + 1 < len(values) else None)
    for low, high in [(50.0, 50.0), (0.25, 199.0), (0.0, 60.0), (0.25, 150.0), (0.0, 1.0), (-5.0, -4.0), (150.0, 151.0)]:
        assert _ranked(df, len(values), k, low, high, 1e-4, 20) == want


def test_exact_quantile_ignores_null_and_empty(spark):
    assert exact_quantile(numbers(spark, [None, 3.0, 1.0]), "v", 0.5) == 2.0
    assert exact_quantile(numbers(spark, [None]), "v", 0.5) is None
    assert exact_quantile(numbers(spark, [7.0] * 300), "v", 0.4, gather_rows=10) == 7.0


def test_contamination_threshold_is_strict(spark):
    df = numbers(spark, [1.0] * 50 + [2.0] * 50)
    assert contamination_threshold(df, "v", 0.03).agg(F.sum("flag")).first()[0] == 0
    df = numbers(spark, [float(i) for i in range(100)])
    assert contamination_threshold(df, "v", 0.03).agg(F.sum("flag")).first()[0] == 3


def test_first_rows_bounded(readings):
    rows = [{"event_id": 999 - i, "event_ts": f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00"} for i in range(900)]
    rows += [{"event_id": 2000 + i, "event_ts": None} for i in range(5)]
    df = readings(rows)
    want = [r["event_id"] for r in first_rows(df, 20).collect()]
    assert [r["event_id"] for r in first_rows(df, 20, gather_rows=10).collect()] == want
    assert want[:5] == [2000, 2001, 2002, 2003, 2004]


def test_hash_cut_picks_exactly_k(spark):
    df = spark.range(5000).withColumnRenamed("id", "event_id")
    hashes = sorted(hashlib.md5(f"{i}|42".encode()).hexdigest() for i in range(5000))
    for k in (1, 150, 4999, 5000):
        assert hash_cut(df, k, ["event_id"], 42, gather_rows=1) == hashes[k - 1]
    with pytest.raises(ValueError, match="fewer than"):
        hash_cut(df, 5001, ["event_id"], 42)
    with pytest.raises(ValueError, match="unique key"):
        hash_cut(spark.range(10).select(F.lit(1).alias("event_id")), 3, ["event_id"], 42)


def test_inject_faults(spark, readings):
    df = readings([{} for _ in range(1000)])
    out = inject_faults(df, 0.05)
    hit = out.filter("injected_anomaly = 1")
    assert hit.count() == 50
    row = hit.first()
    assert (row["temp_motor_c"], row["battery_pct"], row["voltage_v"]) == (135.0, 15.0, 475.0)
    same = inject_faults(df.repartition(7), 0.05).filter("injected_anomaly = 1")
    assert sorted(r[0] for r in same.select("event_id").collect()) == sorted(r[0] for r in hit.select("event_id").collect())
    assert inject_faults(df, 0.0).filter("injected_anomaly = 1").count() == 0
    assert inject_faults(df.limit(0), 0.5).count() == 0


def ks_by_hand(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


@pytest.mark.parametrize("bucket_rows", [1_000_000, 1])
def test_ks_against_brute_force(spark, bucket_rows):
    rng = random.Random(3)
    a = [rng.gauss(0, 1) for _ in range(300)] + [0.5] * 150
    b = [rng.gauss(0.3, 1.2) for _ in range(200)] + [0.5] * 10
    ref, cur = numbers(spark, a + [None, NAN]), numbers(spark, b + [None])
    row = ks_two_sample(ref, cur, ["v"], bucket_rows=bucket_rows).first()
    assert row["ks_stat"] == pytest.approx(ks_by_hand(a, b), abs=1e-12)
    assert (row["n_ref"], row["n_cur"]) == (450, 210)
    back = ks_two_sample(cur, ref, ["v"], bucket_rows=bucket_rows).first()
    assert back["ks_stat"] == pytest.approx(row["ks_stat"], abs=1e-12)


def test_buckets_of_a_skewed_column_are_bounded(spark):
    rng = random.Random(8)
    values = [rng.lognormvariate(0, 4) for _ in range(6000)] + [1.0] * 3000 + [-0.0, 0.0]
    rows = numbers(spark, values, "value").select(
        F.lit(1).alias("is_ref"), F.lit("v").alias("column_name"), "value", F.array().cast("array<int>").alias("bucket")
    )
    out, levels = value_buckets(rows, _sizes(rows), 10)
    got = out.groupBy("bucket").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
    assert sum(r["n"] for r in got) == len(values) and len(levels) > 2
    assert all(r["n"] <= 10 or r["low"] == r["high"] for r in got)
    got.sort(key=lambda r: r["bucket"])
    assert all(a["high"] < b["low"] for a, b in zip(got, got[1:]))
    assert [r["n"] for r in got if r["low"] == 1.0] == [3000]


@pytest.mark.parametrize("bucket_rows, exchanges", [(1_000_000, 1), (5, 2)])
def test_ks_exchanges_values_once(spark, bucket_rows, exchanges):
    """Values by bucket, and then, where there are several buckets, their numbers by column."""
    a = numbers(spark, [float(i) for i in range(50)])
    plan = ks_two_sample(a, a, ["v"], bucket_rows=bucket_rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == exchanges, plan


def test_ks_identical_and_disjoint(spark):
    a, b = numbers(spark, [float(i) for i in range(50)]), numbers(spark, [float(i) for i in range(100, 150)])
    same = ks_drift(a, a, ["v"]).first()
    assert (same["ks_stat"], same["p_value"], same["drift"]) == (0.0, 1.0, False)
    apart = ks_drift(a, b, ["v"])
    assert tuple(apart.first()) == ("v", 1.0, 0.0, True)
    assert tuple(drifted_column_count(apart).first()) == (1, 1)


def test_ks_empty_sides(spark):
    a = numbers(spark, [1.0, 2.0])
    assert ks_drift(a.limit(0), a.limit(0), ["v"]).count() == 0
    row = ks_drift(a, a.limit(0), ["v"]).first()
    assert row["ks_stat"] is None and row["drift"] is None


def test_scaler(readings):
    df = readings([{"speed_kmh": 1.0}, {"speed_kmh": 3.0}])
    fitted = fit_scaler(df)
    assert (fitted.means[0], fitted.stds[0]) == (2.0, 1.0)
    assert fitted.stds[1] == 1.0  # constant column
    assert sorted(r["speed_kmh"] for r in fitted.transform(df).collect()) == [-1.0, 1.0]
    parts = df.withColumn("split", F.when(F.col("speed_kmh") < 2, "train").otherwise("val"))
    assert sorted(r["speed_kmh"] for r in scale_sensors(parts, fit_on="train").collect()) == [0.0, 2.0]
    assert fit_scaler(df.limit(0)).stds[0] == 1.0


def labelled(spark, pairs):
    return spark.createDataFrame(pairs, "label int, prediction int")


def test_metrics(spark):
    df = labelled(spark, [(1, 1)] * 3 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(0, 0)] * 4)
    assert tuple(M.confusion_counts(df).first()) == (3, 1, 2, 4)
    row = M.classification_metrics(df).first()
    assert row["accuracy"] == 0.7 and row["precision"] == 0.75 and row["recall"] == 0.6
    assert row["f1"] == pytest.approx(2 / 3)
    none = M.classification_metrics(labelled(spark, [(1, 0), (0, 0)])).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)
    report = {r["class_name"]: r for r in M.classification_report(df).collect()}
    assert report["Normal"]["support"] == 5 and report["weighted avg"]["support"] == 10
    assert report["macro avg"]["recall"] == pytest.approx((0.8 + 0.6) / 2)


def test_losses(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1), (0.0, 0.0, 0)], "z0 double, z1 double, label int")
    ln2 = math.log(2)
    assert M.weighted_log_loss(df, "rows").first()[0] == pytest.approx(11 * ln2 / 2)
    assert M.weighted_log_loss(df, "weights").first()[0] == pytest.approx(ln2)
    assert M.weighted_log_loss(df, None).first()[0] == pytest.approx(ln2)
    with pytest.raises(ValueError):
        M.weighted_log_loss(df, "median")


def test_runs_and_best(spark, tmp_path):
    def run(name, idx, f1):
        return M.run_row(spark.createDataFrame([(f1,)], "f1 double"), name, {"lr": 0.1}, idx)

    runs = run("a", 0, 0.5).unionByName(run("b", 1, 0.7)).unionByName(run("c", 2, 0.7))
    assert M.best_config(runs).first()["run_name"] == "b"
    assert M.best_config(run("z", 0, 0.0)).count() == 0
    path = str(tmp_path / "runs")
    M.log_runs(runs, path)
    M.log_runs(run("d", 3, 0.1), path)
    stored = spark.read.schema(M.RUN_SCHEMA).parquet(path)
    assert stored.count() == 4 and stored.first()["params"] == {"lr": "0.1"}
    assert M.explode_metrics(stored).filter("metric = 'f1'").count() == 4


def test_votes_fall_with_the_bar(spark):
    df = spark.createDataFrame(
        [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)] + [(1, None, 1)],
        "l1_iso_flag int, l2_seq_flag int, l3_shape_flag int",
    )
    hits = [ensemble_vote(df, min_votes=m).agg(F.sum("is_anomaly")).first()[0] for m in (1, 2, 3)]
    assert hits == [8, 5, 1]
    assert ensemble_vote(df).filter("l2_seq_flag is null").first()["anomaly_votes"] == 2


def test_false_positive_reduction(spark):
    df = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (1, 1, 1)], "label int, l1_iso_flag int, is_anomaly int")
    assert tuple(M.false_positive_reduction(df).first()) == (1, 2, 0.5)
    assert M.false_positive_reduction(df.filter("label = 1")).first()["fp_reduction"] is None


@pytest.fixture(scope="module")
def sensors(spark, sf_dir):
    from ampledger.sources.fixture import telemetry

    return telemetry(spark, sf_dir).cache()


def test_forest_flags_the_share_and_finds_faults(sensors):
    n = sensors.count()
    scored = fit_transform(sensors, fit_scaler(sensors))
    row = scored.agg(
        F.sum("l1_iso_flag").alias("flags"),
        F.avg(F.when(F.col("injected_anomaly") == 1, F.col("anomaly_score"))).alias("bad"),
        F.avg(F.when(F.col("injected_anomaly") == 0, F.col("anomaly_score"))).alias("good"),
        F.min("anomaly_score").alias("low"),
        F.max("anomaly_score").alias("high"),
    ).first()
    assert abs(row["flags"] - 0.03 * n) <= 1
    assert row["bad"] > row["good"] + 0.03
    assert 0 < row["low"] < row["high"] < 1
    caught = scored.filter("l1_iso_flag = 1 and injected_anomaly = 1").count()
    assert caught / row["flags"] > 0.3


def test_forest_stores_scores_alone(sensors, monkeypatch):
    from ampledger.operators import forest

    stored = []

    def watch(df, *args, **kwargs):
        stored.append(df.columns)
        return stage(df, *args, **kwargs)

    monkeypatch.setattr(forest, "stage", watch)
    flagged = fit_transform(sensors, fit_scaler(sensors), trees=10, subsample=64)
    assert stored == [["score"]]
    assert flagged.columns == [*sensors.columns, "anomaly_score", "l1_iso_flag"]


def test_forest_does_not_depend_on_partitioning(sensors):
    one, two = (
        fit_isolation_forest(df, trees=10, subsample=64).transform(df).select("event_id", "anomaly_score", "l1_iso_flag")
        for df in (sensors, sensors.repartition(7))
    )
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_forest_large_table_takes_own_blocks(sensors):
    from ampledger.operators.forest import _subsamples

    sample = _subsamples(sensors, SENSOR_COLS, ["event_id"], 5, 20, 42, sensors.count())
    assert {r["tree"]: r["count"] for r in sample.groupBy("tree").count().collect()} == {t: 20 for t in range(5)}
    assert sample.select("h").distinct().count() == 100


def test_forest_samples_small_tables_by_the_same_rule(readings):
    from ampledger.operators.forest import _subsamples

    df = readings([{"speed_kmh": float(i)} for i in range(30)])
    sample = _subsamples(df, SENSOR_COLS, ["event_id"], 5, 20, 42, 30).collect()
    for t in range(5):
        assert len({r["h"] for r in sample if r["tree"] == t}) == sum(r["tree"] == t for r in sample) == 20
    pool = [r["h"] for r in _subsamples(df, SENSOR_COLS, ["event_id"], 1, 30, 42, 30).orderBy("h").collect()]
    for t in range(5):
        assert {r["h"] for r in sample if r["tree"] == t} == {pool[(20 * t + j) % 30] for j in range(20)}


def test_forest_refuses_a_key_that_tells_nothing_apart(sensors):
    with pytest.raises(Exception, match="do not tell the rows apart"):
        fit_isolation_forest(sensors.withColumn("event_id", F.lit(None).cast("bigint")), trees=3, subsample=64)


def test_forest_on_few_rows(readings):
    df = readings([{"speed_kmh": float(i)} for i in range(3)])
    assert fit_isolation_forest(df, trees=3).transform(df).count() == 3
    with pytest.raises(ValueError, match="empty"):
        fit_isolation_forest(df.limit(0))
