"""Windows over per-vehicle ordered series that survive a hot vehicle.

A window partitioned by vehicle puts one vehicle into one task. Vehicles above
``hot_rows`` are therefore cut into slices of consecutive rows, each with the
few rows before it that a row frame looks back on; all others take the plain
one-shuffle window. The results are the same either way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from ampledger.functions.scalars import sensor_vector
from ampledger.schema import ORDER_COLS, ROLLING_ROWS, SENSOR_COLS, SEQ_LEN
from ampledger.sources.sinks import stage

HOT_ROWS = 4_000_000
SLICE_ROWS = 1_000_000
MAX_PARTS = 256
BROADCAST_ROWS = 100_000
WHOLE = "series"
_FIRST = -(2**63)
_SLICE, _START, _HALO, _LENGTH = "_slice", "_start", "_halo", "_length"
_TIME, _TIE = "_time", "_tie"


class Series:
    """How a computation addresses its series: window specs, position and length."""

    def __init__(self, keys: list[str], order: list[str], sliced: bool):
        self.keys, self._order, self._sliced = keys, order, sliced

    def rows(self, start: int, end: int) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self._order).rowsBetween(start, end)

    def lag(self, col: str | Column, offset: int = 1) -> Column:
        return F.lag(col, offset).over(Window.partitionBy(*self.keys).orderBy(*self._order))

    def position(self) -> Column:
        """1 for the first row of the series."""
        spec = Window.partitionBy(*self.keys).orderBy(*self._order)
        if not self._sliced:
            return F.row_number().over(spec).cast("bigint")
        own = F.sum(F.when(F.col(_HALO), 0).otherwise(1))
        return F.col(_START) + own.over(spec.rowsBetween(Window.unboundedPreceding, 0))

    def index(self) -> Column:
        """Consecutive numbers in series order, borrowed rows included; only differences count."""
        return F.row_number().over(Window.partitionBy(*self.keys).orderBy(*self._order))

    def length(self) -> Column:
        """Rows in the whole series."""
        if not self._sliced:
            return F.count(F.lit(1)).over(Window.partitionBy(*self.keys))
        return F.col(_LENGTH)


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Store a small table and broadcast it if its counted rows allow; else adaptive joins decide.

    Storing it also keeps the plans of later steps from repeating the steps behind it.
    """
    stored = stage(df, "parquet")
    rows = stored.count() if rows is None else rows
    return F.broadcast(stored) if rows <= BROADCAST_ROWS else stored


def hot_series(df: DataFrame, by: str, hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and their counts; None when there are none."""
    counts = df.groupBy(F.col(by).alias("_key")).agg(F.count(F.lit(1)).alias(_LENGTH))
    hot = counts.filter(F.col(_LENGTH) > hot_rows)
    return None if hot.isEmpty() else small_side(hot)


def _series_key(df: DataFrame, by: str | None) -> tuple[DataFrame, str]:
    """``by=None`` makes the whole table one series, numbered 0 in the column ``series``."""
    return (df.withColumn(WHOLE, F.lit(0)), WHOLE) if by is None else (df, by)


def over_series(
    df: DataFrame,
    compute: Callable[[DataFrame, Series], DataFrame],
    by: str = "vehicle_id",
    lookback: int = 0,
    order: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Apply ``compute(frame, series)``, whose frames reach at most ``lookback`` rows back.

    ``compute`` keeps the frame's ``_halo`` column where there is one: it marks
    the borrowed rows, which are dropped afterwards.
    """
    order = order or ORDER_COLS
    # Slices divide by the tie-breaker as a number, so both ways of working ask for one.
    if not isinstance(df.schema[order[1]].dataType, T.IntegralType):
        raise TypeError(f"{order[1]} must be an integer to break ties; hash other keys first")

    def over_slices(rows: DataFrame) -> DataFrame:
        sliced = slice_rows_of(rows, by, order, lookback, slice_rows)
        done = compute(sliced, Series([by, _SLICE], order, sliced=True)).filter(~F.col(_HALO))
        return done.drop(_SLICE, _START, _HALO, _LENGTH)

    plain = Series([by], order, sliced=False)
    if by == WHOLE:
        n = df.count()
        return compute(df, plain) if n <= hot_rows else over_slices(df.withColumn(_LENGTH, F.lit(n).cast("bigint")))
    hot = hot_series(df, by, hot_rows)
    if hot is None:
        return compute(df, plain)
    same_key = F.col(by).eqNullSafe(F.col("_key"))
    cold = compute(df.join(hot, same_key, "left_anti"), plain)
    return cold.unionByName(over_slices(df.join(hot, same_key, "inner").drop("_key")))


def slice_rows_of(df: DataFrame, by: str, order: list[str], lookback: int, slice_rows: int) -> DataFrame:
    """Add slice number, rows before the slice, and the borrowed rows of each slice.

    Each series is divided into time buckets. Buckets of more than ``slice_rows``
    rows are divided again, by time and then by the integer tie-breaker, into as
    many parts as their size asks for. Rows equal in both stay together.
    """
    ts, tie = order
    df = df.withColumns(
        {
            _TIME: F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(_FIRST)),
            _TIE: F.coalesce(F.col(tie).cast("bigint"), F.lit(_FIRST)),
        }
    )
    keys: list[str] = []
    while True:
        counts = _bucket_counts(df, by, keys)
        too_many = F.col("_n") > slice_rows
        n_dense, large, time_span, tie_span = counts.filter(too_many).agg(
            F.count(F.lit(1)), F.max("_n"), F.max("_time_span"), F.max("_tie_span")
        ).first()
        if n_dense == 0 or time_span + tie_span == 0:
            break
        col, span = (_TIME, time_span) if time_span > 0 else (_TIE, tie_span)
        width = int(span) // min(4 * large // slice_rows + 1, MAX_PARTS) + 1
        name = f"_k{len(keys)}"
        part = F.expr(f"{col} div {width}L")
        if keys:
            dense = counts.filter(too_many).select(
                F.col(by).alias("_by"), *[F.col(k).alias(f"_d{k}") for k in keys], F.lit(True).alias("_dense")
            )
            df = df.join(small_side(dense, n_dense), _same(by, keys, "_by", "_d"), "left")
            df = df.drop("_by", *[f"_d{k}" for k in keys])
            df = df.withColumn(name, F.when(F.col("_dense"), part).otherwise(F.lit(_FIRST))).drop("_dense")
        else:
            df = df.withColumn(name, part)
        keys.append(name)

    in_order = Window.partitionBy(by).orderBy(*(keys or [F.lit(0)]))
    upto = F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    buckets = counts.withColumn("_first", upto - F.col("_n")).withColumn(
        _SLICE, F.floor(F.col("_first") / F.lit(slice_rows)).cast("bigint")
    )
    buckets = buckets.withColumn(_START, F.min("_first").over(Window.partitionBy(by, _SLICE)))
    if lookback > 0:
        # Slices that start within `lookback` rows after the end of a bucket need that bucket's rows.
        by_first = Window.partitionBy(by).orderBy("_first")
        soon = F.collect_set(_SLICE).over(by_first.rangeBetween(0, lookback - 1))
        buckets = buckets.withColumn("_soon", soon)
        buckets = buckets.withColumn("_soon", F.coalesce(F.lead("_soon").over(by_first), F.array().cast("array<bigint>")))
        buckets = buckets.withColumn("_lend", F.array_except("_soon", F.array(_SLICE)))
    else:
        buckets = buckets.withColumn("_lend", F.array().cast("array<bigint>"))
    buckets = buckets.select(
        F.col(by).alias("_by"), *[F.col(k).alias(f"_d{k}") for k in keys], _SLICE, _START, "_lend"
    )
    buckets = small_side(buckets)
    copies = F.concat(
        F.array(F.struct(F.col(_SLICE).alias("s"), F.lit(False).alias("h"))),
        F.transform("_lend", lambda s: F.struct(s.alias("s"), F.lit(True).alias("h"))),
    )
    return (
        df.join(buckets, _same(by, keys, "_by", "_d"), "inner")
        .drop("_by", *[f"_d{k}" for k in keys], *keys, _TIME, _TIE)
        .withColumn("_copy", F.explode(copies))
        .withColumns({_SLICE: F.col("_copy.s"), _HALO: F.col("_copy.h")})
        .drop("_copy", "_lend")
    )


def _bucket_counts(df: DataFrame, by: str, keys: list[str]) -> DataFrame:
    def span(c: str) -> Column:
        return (F.max(c).cast("double") - F.min(c).cast("double")).alias(f"{c}_span")

    return df.groupBy(by, *keys).agg(F.count(F.lit(1)).alias("_n"), span(_TIME), span(_TIE))


def _same(by: str, keys: list[str], other_by: str, prefix: str) -> Column:
    cond = F.col(by).eqNullSafe(F.col(other_by))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"{prefix}{k}"))
    return cond


# Rolling statistics, positions, sequences and shape features


def add_rolling(df: DataFrame, rows: int = ROLLING_ROWS, **series_args) -> DataFrame:
    """Rolling averages and deviation over the last ``rows`` rows of each vehicle, fewer at its start."""

    def compute(frame: DataFrame, series: Series) -> DataFrame:
        w = series.rows(-(rows - 1), 0)
        return frame.withColumns(
            {
                "rolling_avg_temp": F.round(F.avg("temp_motor_c").over(w), 2),
                "rolling_avg_battery": F.round(F.avg("battery_pct").over(w), 2),
                "rolling_std_speed": F.round(F.stddev("speed_kmh").over(w), 4),
            }
        )

    return over_series(df, compute, lookback=rows - 1, **series_args)


def add_position(df: DataFrame, name: str = "position", **series_args) -> DataFrame:
    """Position of each row in its series, from 1."""
    return over_series(df, lambda f, s: f.withColumn(name, s.position()), **series_args)


def split_column(position: Column, length: Column, train: float = 0.8) -> Column:
    """``train`` for the first share of the positions (from 1), else ``val``."""
    return F.when(position <= _train_rows(length, train), "train").otherwise("val")


def _train_rows(length: Column, train: float) -> Column:
    return F.floor(length * F.lit(train)).cast("bigint")


def chronological_split(df: DataFrame, train: float = 0.8, **series_args) -> DataFrame:
    """Add position and split columns: the first share of each series trains."""

    def compute(frame: DataFrame, series: Series) -> DataFrame:
        frame = frame.withColumns({"position": series.position(), "_n": series.length()})
        return frame.withColumn("split", split_column(F.col("position"), F.col("_n"), train)).drop("_n")

    return over_series(df, compute, **series_args)


def _window_columns(
    frame: DataFrame, by: str, label: str | None, split: str | None, rest: list[str], partial: bool
) -> DataFrame:
    """Keep the rows with a full window (all rows when ``partial``) and the wanted columns."""
    value = F.lit(0) if label is None else F.col(label).cast("int")
    names = [c for c in rest if c != by] + ([_HALO] if _HALO in frame.columns else [])
    if not partial:
        frame = frame.filter(F.col("position") >= 0)
    return frame.select(by, "position", value.alias("label"), *(["split"] if split else []), *names)


def _windows(
    df: DataFrame,
    label: str | None,
    seq_len: int,
    horizon: int,
    by: str | None,
    split: str | None,
    train: float,
    extra: Callable[[Series], dict[str, Column]],
    keep: list[str],
    partial: bool = False,
    **series_args,
) -> DataFrame:
    df, by = _series_key(df, by)

    def compute(frame: DataFrame, series: Series) -> DataFrame:
        columns = {"_pos": series.position(), **extra(series)}
        if split:
            columns["_n"] = series.length()
        frame = frame.withColumns(columns).withColumn("position", F.col("_pos") - seq_len - horizon)
        if split == "sequences":
            windows = F.col("_n") - F.lit(seq_len + horizon - 1)
            frame = frame.withColumn("split", split_column(F.col("position") + 1, windows, train))
        elif split == "rows":
            frame = frame.withColumn("split", split_column(F.col("_pos"), F.col("_n"), train))
            cut = F.when(F.col("split") == "train", F.lit(0)).otherwise(_train_rows(F.col("_n"), train))
            frame = frame.withColumn("position", F.col("position") - cut)
        return _window_columns(frame, by, label, split, keep, partial)

    return over_series(df, compute, by=by, lookback=seq_len + horizon, **series_args)


def make_sequences(
    df: DataFrame,
    seq_len: int = SEQ_LEN,
    horizon: int = 1,
    by: str | None = "vehicle_id",
    label: str | None = "injected_anomaly",
    cols: list[str] = SENSOR_COLS,
    split: str | None = None,
    train: float = 0.8,
    keep: list[str] | None = None,
    partial: bool = False,
    **series_args,
) -> DataFrame:
    """Every full window of ``seq_len`` rows with the label ``horizon`` rows after its last row.

    ``position`` counts windows from 0; ``by=None`` makes the table one series. ``split="rows"`` divides each series
    first and forms windows on either side; ``split="sequences"`` divides the windows.
    ``partial`` keeps the rows without a full window, at negative positions.
    """

    def extra(series: Series) -> dict[str, Column]:
        frame = series.rows(-(seq_len - 1) - horizon, -horizon)
        return {"features": F.collect_list(sensor_vector(cols)).over(frame)}

    return _windows(
        df, label, seq_len, horizon, by, split, train, extra, ["features", *(keep or [])], partial, **series_args
    )


def sequence_labels(
    df: DataFrame,
    seq_len: int = SEQ_LEN,
    horizon: int = 1,
    by: str | None = "vehicle_id",
    label: str = "injected_anomaly",
    split: str | None = None,
    train: float = 0.8,
    keep: list[str] | None = None,
    **series_args,
) -> DataFrame:
    """Positions and labels of the sequences, without building them."""
    return _windows(
        df, label, seq_len, horizon, by, split, train, lambda s: {}, keep or [], **series_args
    )


SHAPE_STATS = ["mean", "std", "min", "max", "range", "slope", "diff1", "diff2"]


def shape_columns(cols: list[str] = SENSOR_COLS) -> list[str]:
    return [f"{c}_{stat}" for c in cols for stat in SHAPE_STATS]


def shape_features(
    df: DataFrame,
    seq_len: int = SEQ_LEN,
    by: str | None = "vehicle_id",
    label: str | None = "injected_anomaly",
    cols: list[str] = SENSOR_COLS,
    split: str | None = None,
    train: float = 0.8,
    keep: list[str] | None = None,
    partial: bool = False,
    **series_args,
) -> DataFrame:
    """Signal-shape statistics per channel over each full window that ends at a row.

    Level (mean, min, max), spread (std, range), trend (slope per row) and
    roughness (mean absolute first and second differences inside the window).
    Missing values are left out. ``seq_len`` is at least 3.
    """
    if seq_len < 3:
        raise ValueError(f"seq_len must be at least 3, not {seq_len}")
    df, by = _series_key(df, by)

    def compute(frame: DataFrame, series: Series) -> DataFrame:
        steps = {f"_d1_{c}": F.col(c) - series.lag(c) for c in cols}
        frame = frame.withColumns({"_pos": series.position(), "_x": series.index(), **steps})
        if split:
            frame = frame.withColumn("_n", series.length())
        frame = frame.withColumns({f"_d2_{c}": F.col(f"_d1_{c}") - series.lag(f"_d1_{c}") for c in cols})
        # Sliding frames in the order that the rows have: no sort has to move the statistics.
        w, w1, w2 = (series.rows(n - seq_len + 1, 0) for n in range(3))
        stats = {}
        for c in cols:
            stats[f"{c}_mean"] = F.avg(c).over(w)
            stats[f"{c}_std"] = F.stddev(c).over(w)
            stats[f"{c}_min"] = F.min(c).over(w)
            stats[f"{c}_max"] = F.max(c).over(w)
            stats[f"{c}_slope"] = F.regr_slope(c, "_x").over(w)
            stats[f"{c}_diff1"] = F.avg(F.abs(F.col(f"_d1_{c}"))).over(w1)
            stats[f"{c}_diff2"] = F.avg(F.abs(F.col(f"_d2_{c}"))).over(w2)
        frame = frame.withColumns(stats)
        frame = frame.withColumns({f"{c}_range": F.col(f"{c}_max") - F.col(f"{c}_min") for c in cols})
        frame = frame.withColumn("position", F.col("_pos") - seq_len)
        if split:
            windows = F.col("_n") - F.lit(seq_len - 1)
            frame = frame.withColumn("split", split_column(F.col("position") + 1, windows, train))
        return _window_columns(frame, by, label, split, [*(keep or []), *shape_columns(cols)], partial)

    return over_series(df, compute, by=by, lookback=seq_len + 1, **series_args)
