"""Exact ranks over whole tables without a one-task window.

Each function narrows the search with small aggregates (one row, or at most
65,536 groups) until what is left is below a checked bound, and only then
orders it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ampledger.schema import ORDER_COLS
from ampledger.session import staging
from ampledger.sources.sinks import stage

GATHER_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000
# A sketched rank is off by one part of its accuracy at most.
SLACK = 2.0 / SKETCH_ACCURACY


def first_rows(df: DataFrame, n: int, order: list[str] | None = None, gather_rows: int = GATHER_ROWS) -> DataFrame:
    """The first ``n`` rows in a total order.

    A top-n sends up to n rows of every task to one task, so on large tables a
    bound on the leading timestamp is found first; the filter keeps a superset
    of the answer and reaches the scan.
    """
    order = order or ORDER_COLS
    lead = order[0]
    total = df.count()
    # NULLs sort first, so a bound on the timestamp is only a superset together with them.
    if total > max(gather_rows, 4 * n) and isinstance(
        df.schema[lead].dataType, (T.TimestampType, T.TimestampNTZType)
    ):
        share = min(1.0, 2.0 * n / total + 2.0 / SKETCH_ACCURACY)
        bound = df.agg(F.percentile_approx(lead, share, SKETCH_ACCURACY).cast("string")).first()[0]
        if bound is not None:
            limit = F.lit(bound).cast(df.schema[lead].dataType)
            near = df.filter(F.col(lead).isNull() | (F.col(lead) <= limit))
            if near.count() >= n:
                df = near
    return df.orderBy(*order).limit(n)


def _bracket(share: float, slack: float) -> Column:
    """Sketched values on either side of a rank, given as a share of the rows."""
    shares = [max(share - slack, 0.0), min(share + slack, 1.0)]
    return F.percentile_approx("v", shares, SKETCH_ACCURACY)


def _ranked(values: DataFrame, n: int, k: int, low: float, high: float, slack: float, gather_rows: int):
    """The k-th smallest (from 0) of ``n`` values ``v`` and the next one in order (None: there is none).

    One read counts what lies outside the bracket and at its ends, and stores
    what lies strictly inside: two sketch errors of the rows, however many share
    a value. Only that is read again.
    """
    if n <= gather_rows:
        # At most gather_rows rows, by the count.
        below = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        ranked = values.groupBy("v").agg(F.count("*").alias("n")).withColumn("upto", below)
        near = ranked.filter(F.col("upto") > k).orderBy("v").limit(2).collect()
        if near[0]["upto"] > k + 1:
            return near[0]["v"], near[0]["v"]
        return near[0]["v"], near[1]["v"] if len(near) > 1 else None
    v, seen = F.col("v"), Observation()
    between = (v > low) & (v < high)
    watched = values.observe(
        seen,
        F.count(F.when(v < low, 1)).alias("less"),
        F.count(F.when(v == low, 1)).alias("at_low"),
        F.count(F.when(between, 1)).alias("inside"),
        F.count(F.when((v == high) & (v > low), 1)).alias("at_high"),
        F.min(F.when(v > high, v)).alias("above"),
    )
    inside = stage(watched.filter(between))
    got = seen.get
    first = got["less"] + got["at_low"]
    last = first + got["inside"]
    if not got["less"] <= k < last + got["at_high"]:  # the sketch missed the rank
        around = values.agg(_bracket((k + 0.5) / n, 8 * slack)).first()[0]
        return _ranked(values, n, k, *around, 8 * slack, gather_rows)

    def value(rank: int):
        if rank < first:
            return low
        return high if rank < last + got["at_high"] else got["above"]

    if not first <= k < last:
        following = _first(inside) if k + 1 == first < last else value(k + 1)
        return value(k), following
    share = (k - first + 0.5) / got["inside"]
    around = inside.agg(_bracket(share, SLACK)).first()[0]
    kth, following = _ranked(inside, got["inside"], k - first, *around, SLACK, gather_rows)
    return kth, value(k + 1) if following is None else following


def _first(values: DataFrame) -> float:
    return values.agg(F.min("v")).first()[0]


def exact_quantile(df: DataFrame, col: str | Column, q: float, gather_rows: int = GATHER_ROWS) -> float | None:
    """Interpolated quantile of the non-NULL values, bit-equal to the built-in ``percentile``.

    The built-in keeps every distinct value in one task, so it serves only
    tables of at most ``gather_rows`` values; both ways weigh the two
    neighbours by the same formula. Larger tables are read twice: one read
    counts and sketches, one narrows the search to a small stored part.
    """
    c = F.col(col) if isinstance(col, str) else col
    values = df.select(c.cast("double").alias("v")).filter(F.col("v").isNotNull())
    n, around = values.agg(F.count("v"), _bracket(q, SLACK)).first()
    if n <= gather_rows:
        return values.agg(F.percentile("v", q)).first()[0]
    position = (n - 1) * q
    rank = int(position)
    with staging(df.sparkSession):
        low, high = _ranked(values, n, rank, *around, SLACK, gather_rows)
    share = position - rank
    return low if share == 0 or high == low else (rank + 1 - position) * low + share * high


def row_hash(keys: list[str], seed: int) -> Column:
    """Hex md5 of the key columns and a seed: a uniform order that any engine can repeat."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))


def hash_cut(df: DataFrame, k: int, keys: list[str], seed: int, gather_rows: int = 10_000) -> str | None:
    """The hash value that exactly ``k`` rows do not exceed.

    Counts rows per four leading hex digits, descends into the group that holds
    the k-th row, and orders only a small remainder.
    """
    if k <= 0:
        return None
    hashes = df.select(row_hash(keys, seed).alias("h"))
    prefix, left = "", k
    while len(prefix) < 32:
        here = hashes.filter(F.col("h").startswith(prefix)) if prefix else hashes
        digits = F.substring("h", len(prefix) + 1, 4)
        counts = here.groupBy(digits.alias("d")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0))
        hit = counts.withColumn("upto", upto).filter(F.col("upto") >= left).orderBy("d").first()
        if hit is None:
            raise ValueError(f"the table holds fewer than {k} rows")
        prefix += hit["d"]
        left -= hit["upto"] - hit["n"]
        if hit["n"] <= gather_rows:
            rank = Window.orderBy("h")
            near = hashes.filter(F.col("h").startswith(prefix)).select("h", F.row_number().over(rank).alias("r"))
            cut = near.filter(F.col("r") == left).first()["h"]
            same, before = near.agg(
                F.count(F.when(F.col("h") == cut, 1)), F.count(F.when(F.col("h") < cut, 1))
            ).first()
            if before + same == left:
                return cut
            break
        if len(prefix) == 32 and hit["n"] == left:
            return prefix
    raise ValueError(f"columns {keys} do not tell the rows apart; an exact count needs a unique key")
