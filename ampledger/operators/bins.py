"""Bins of boosted trees from counts of all rows.

Above max(maxBins * maxBins, 10,000) rows Spark's trees choose their thresholds from a sample. They read every
row where ``maxBins`` is large enough, but then gather all values of a feature in one task. Here each value is
first replaced by the nearest of a few of the feature's own values, found by counting all rows; thresholds are
the middles between neighbours, as for any feature of few values, so that a fitted tree sends a value and what
replaces it the same way, and serves features as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of Spark's trees by default.
BINS = 32
#: Spark reads all rows of tables up to this size, or up to the square of the bins.
SPARK_ROWS = 10_000
#: Spark squares the bins as a 32-bit number; above some 2,147,000,000 rows it chooses among so many.
MOST_BINS = 46_340
PARTS = 512

Leaf = tuple[float, float, int]  # least and greatest value, rows


def _wanted(leaves: list[Leaf], bins: int) -> list[bool]:
    """Whether a leaf, in order, has the middle row of one of ``bins`` equal shares of the rows."""
    total, below, out = sum(n for _, _, n in leaves), 0, []
    for _, _, n in leaves:
        # Twice the rank of the k-th middle row is (2 k + 1) * total / bins.
        k = max(0, -((total - 2 * below * bins) // (2 * total)))
        out.append((2 * k + 1) * total < 2 * (below + n) * bins)
        below += n
    return out


def _divisible(leaves: list[Leaf], bins: int) -> list[Leaf]:
    """Leaves of unlike values that are too coarse: of a feature with few so far, or a large one that a bin is read from."""
    few, total = len(leaves) <= bins, sum(n for _, _, n in leaves)
    return [
        leaf
        for leaf, wanted in zip(leaves, _wanted(leaves, bins))
        if leaf[0] < leaf[1] and (few or (wanted and 4 * bins * leaf[2] > total))
    ]


def bin_values(table: DataFrame, size: int, bins: int = BINS, parts: int = PARTS) -> list[list[float]]:
    """At most ``bins`` values for each of the ``size`` entries of ``features``, about as many rows apart.

    A feature of no more distinct values gets them all. Ranges of values are divided into equal parts and
    counted, and parts with too many rows divided again; what comes back is bounded by bins, parts and
    features, not by rows, and does not depend on how the rows are laid out.
    """
    values = table.select(F.posexplode(vector_to_array("features")).alias("i", "x"))
    values = values.filter(F.abs("x") < float("inf"))
    counts = [F.min("x"), F.max("x"), F.count(F.lit(1))]
    leaves: dict[int, list[Leaf]] = {i: [tuple(leaf)] for i, *leaf in values.groupBy("i").agg(*counts).collect()}
    while coarse := {(i, lo): hi for i, found in leaves.items() for lo, hi, _ in _divisible(found, bins)}:
        ranges = values.sparkSession.createDataFrame(
            [(i, lo, hi) for (i, lo), hi in coarse.items()], "i int, lo double, hi double"
        )
        inside = values.join(F.broadcast(ranges), "i").filter("x between lo and hi")
        part = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * parts), F.lit(parts - 1))
        found = inside.groupBy("i", "lo", part.alias("part")).agg(*counts).collect()
        leaves = {i: [leaf for leaf in kept if (i, leaf[0]) not in coarse] for i, kept in leaves.items()}
        for i, _, _, *leaf in found:
            leaves[i].append(tuple(leaf))
        for kept in leaves.values():
            kept.sort()
    return [_values(leaves.get(i, []), bins) for i in range(size)]


def _values(leaves: list[Leaf], bins: int) -> list[float]:
    keep = [True] * len(leaves) if len(leaves) <= bins else _wanted(leaves, bins)
    out: list[float] = []
    for (_, hi, _), wanted in zip(leaves, keep):
        # Neighbours so close that no number lies between them can share a middle; one of them does for both.
        if wanted and (not out or (out[-1] + hi) / 2.0 < hi):
            out.append(hi + 0.0)
    return out or [0.0]


def encode(table: DataFrame, values: list[list[float]]) -> DataFrame:
    """``features`` as numbers of their nearest values: two bytes each. NaN goes with the greatest, as in trees."""
    many = [i for i, v in enumerate(values) if len(v) > 1]
    rest = [c for c in table.columns if c != "features"]
    wide = table.select(*rest, vector_to_array("features").alias("_x"))
    wide = wide.select(*rest, *[F.col("_x")[i].alias(f"_x{i}") for i in many])
    if many:
        # Trees send a value equal to the threshold left; a bucket begins with its lower split.
        splits = [
            [-math.inf, *(math.nextafter((a + b) / 2.0, math.inf) for a, b in zip(values[i], values[i][1:])), math.inf]
            for i in many
        ]
        names = {"inputCols": [f"_x{i}" for i in many], "outputCols": [f"_c{i}" for i in many]}
        wide = Bucketizer(splitsArray=splits, handleInvalid="keep", **names).transform(wide)
    one = F.lit(0).cast("smallint")
    codes = [F.least(f"_c{i}", F.lit(len(v) - 1.0)).cast("smallint") if len(v) > 1 else one for i, v in enumerate(values)]
    return wide.select(*rest, F.array(*codes).alias("codes"))


def decode(coded: DataFrame, values: list[list[float]]) -> DataFrame:
    """``features`` of the values behind the numbers."""
    read = [F.element_at(F.lit(v), F.col("codes")[i].cast("int") + 1) for i, v in enumerate(values)]
    return coded.withColumn("features", array_to_vector(F.array(*read))).drop("codes")


@contextmanager
def tables_for_trees(table: DataFrame, sizes: set[int]) -> Iterator[dict[int, tuple[DataFrame, int]]]:
    """Caches the table; gives, by the bins asked for, one for boosted trees and the ``maxBins`` with which they read it all.

    Where there is a column ``split``, bins are those of its ``train`` rows.
    """
    held = [table.persist()]
    try:
        train = table.filter(F.col("split") == "train") if "split" in table.columns else table
        n, found = train.count(), {}
        for bins in sorted(sizes):
            if n <= max(bins * bins, SPARK_ROWS):
                found[bins] = table, bins
                continue
            values = bin_values(train, len(train.first()["features"]), bins)
            held.append(encode(table, values).persist())
            held[-1].count()
            found[bins] = decode(held[-1], values), max(bins, min(math.isqrt(n) + 1, MOST_BINS))
        if found and all(t is not table for t, _ in found.values()):
            table.unpersist()
        yield found
    finally:
        for t in held:
            t.unpersist()
