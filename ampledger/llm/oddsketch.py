"""Near duplicates by odd sketches of min-hash samples.

The min-hash values of a text's shingles fall into bands; texts that share a
band meet in a bucket. Which of them are worth a look at their full sets is told by odd
sketches: every (place, value) of the sample flips one bit of a bitmap, so that
the XOR of two bitmaps counts what the samples do not share.

Not all pairs of a bucket are looked at. Every member is compared with one
leader first, then with the bucket's two ends where these are still in other
components. Only members that remain outside their bucket's largest component
meet the rest then, in blocks of bounded size, and only edges that join
something leave a task. A pair that is passed over joins nothing that isn't
joined already.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampledger.llm.arrays import GOLDEN, give_back, mix, pack, unpack
from ampledger.llm.components import components
from ampledger.llm.jaccard import min_hashes, set_keys, shingle_sets
from ampledger.llm.membership import Membership, membership
from ampledger.llm.scratch import stage
from ampledger.session import staging

#: Fixed values of the contract: words of a shingle, and least similarity in per cent.
WORDS = 5
PERCENT = 85
#: Min-hash values of a set, and the probability with which a pair at the threshold may share none of their bands.
SAMPLES = 125
MISSED = 1e-6
#: Bits of a sketch, kept as 64-bit integers.
BITS = 512
LIMBS = [f"s{i}" for i in range(BITS // 64)]
#: Standard deviations below the threshold at which an estimate still lets a pair pass.
SLACK = 5
#: Members of a bucket that meet as many members outside its largest component in one group.
BLOCK = 512
#: Rows that a task compares at a time, about.
BIN_ROWS = 2_048


def odd_sketches(values: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bitmaps (rows of 64-bit integers) in which each sampled value flips one bit."""
    n, count = values.shape
    spot = mix((np.arange(count, dtype=np.uint64) + np.uint64(1)) * GOLDEN ^ mix(values.astype(np.uint64))) % np.uint64(bits)
    flips = np.bincount((np.arange(n)[:, None] * bits + spot.astype(np.int64)).ravel(), minlength=n * bits)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, bits), axis=1, bitorder="little").view("<u8")


def estimate(ones: float, samples: int = SAMPLES, bits: int = BITS) -> float:
    """Similarity of two sets whose sketches differ in ``ones`` bits."""
    if 2 * ones >= bits:
        return 0.0
    return max(0.0, 1 + bits / (4 * samples) * math.log(1 - 2 * ones / bits))


def most_ones(threshold: float, samples: int = SAMPLES, bits: int = BITS, slack: float = SLACK) -> int:
    """The most differing bits with which a pair may still have the similarity ``threshold``."""
    deviation = math.sqrt(threshold * (1 - threshold) / samples)
    return max(k for k in range(bits) if estimate(k, samples, bits) >= min(threshold - slack * deviation, 1) or k == 0)


def rows_for(threshold: float, samples: int = SAMPLES, missed: float = MISSED) -> int:
    """The most values in a band with which a pair at the threshold is missed with at most this probability."""
    return max(r for r in range(1, samples + 1) if r == 1 or (1 - threshold**r) ** (samples // r) <= missed)


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` values."""
    n, count = len(values), values.shape[1] // rows
    out = np.broadcast_to(mix(np.arange(1, count + 1, dtype=np.uint64) * GOLDEN), (n, count)).copy()
    parts = values[:, : count * rows].astype(np.uint64).reshape(n, count, rows)
    for k in range(rows):
        out = mix(out * GOLDEN + parts[:, :, k])
    return out


def _ones(a: str, b: str) -> Column:
    """Bits in which the sketches of two sides differ."""
    total = F.lit(0)
    for s in LIMBS:
        total = total + F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}")))
    return total


def _may_link(a: str, b: str, percent: int) -> Column:
    sizes = F.col(f"{a}.size"), F.col(f"{b}.size")
    return (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (_ones(a, b) <= most_ones(percent / 100))


def near_duplicate_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Two texts are linked if the intersection of their sets of ``words``-word
    shingles (A-Z lower-cased) has ``percent`` per cent of the union or more;
    a text with fewer words, but not none, has one shingle of all of them.
    ``component_id`` is the smallest id that links lead to, ``kept`` tells
    whether it is the row's own.

    Texts without a word (null, empty) are linked with nothing. Repeated rows
    are copies, and rows that repeat the smallest id of a component are all
    kept. A null id is smaller than none: a component whose ids are all null
    has a null id and keeps its rows. Other columns are ignored, and very long
    texts are taken as a whole. An empty table gives no rows.

    Every link is confirmed on the full sets; a pair at the threshold is missed
    with a probability of at most 1e-6, unless other links join it.
    """
    with staging(docs.sparkSession):
        return _near_duplicate_components(docs, id_col, text_col, words, percent)


def _near_duplicate_components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    limbs = ", ".join(f"{s} long" for s in LIMBS)
    per_band = rows_for(percent / 100)
    wide = SAMPLES // per_band

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                codes, offsets = shingle_sets(batch.column(1), words)
                sizes = np.diff(offsets)
                c, _ = set_keys(codes, offsets)
                sketch = np.zeros((len(sizes), len(LIMBS)), np.uint64)
                bands = np.zeros((len(sizes), wide), np.uint64)
                full = np.flatnonzero(sizes)
                if len(full):
                    values = min_hashes(codes, np.append(offsets[:-1][full], len(codes)), SAMPLES)
                    sketch[full], bands[full] = odd_sketches(values), band_keys(values, per_band)
                each = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * wide, pa.int32()), pa.array(bands.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(c.view(np.int64)), pa.array(sizes, pa.int64()), *(pa.array(s) for s in np.ascontiguousarray(sketch.T).view(np.int64)), each],
                    ["id", "c", "size", *LIMBS, "bands"],
                )
        give_back()

    signed = stage(source.mapInArrow(sign, f"id {kind}, c long, size long, {limbs}, bands array<long>"), "signed")
    # Equal sets are one class from here on; what depends on the set alone is the same for all of them.
    grouped = signed.filter("size > 0").groupBy("c").agg(F.min("id").alias("id"), *(F.max(x).alias(x) for x in ("size", *LIMBS, "bands")))
    classes = stage(grouped, "classes")
    sketches = classes.select("c", F.struct("size", *LIMBS).alias("sketch"))
    rows = classes.select(F.explode("bands").alias("g"), "c")
    buckets = stage(rows.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).filter("lo < hi"), "buckets")
    met = stage(rows.join(buckets, "g"), "met")

    shared = stage(met.select("c").distinct().join(classes.select("c", "id"), "c"), "shared")
    sets = _full_sets(source, membership(shared.select(F.xxhash64("id").alias("h"))), words)
    sets = stage(sets.join(shared.select("c"), "c", "left_semi").dropDuplicates(["c"]), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are linked."""
        told = pairs.join(sketches.withColumnRenamed("c", "a").withColumnRenamed("sketch", "x"), "a")
        told = told.join(sketches.withColumnRenamed("c", "b").withColumnRenamed("sketch", "y"), "b")
        likely = stage(told.filter(_may_link("x", "y", percent)).select("a", "b"), "likely")
        both = likely.join(sets.toDF("a", "p"), "a").join(sets.toDF("b", "q"), "b").select("a", "b", "p", "q")
        return stage(both.mapInArrow(lambda b: _linked(b, percent), "a long, b long"), "edges")

    def labelled(edges: DataFrame) -> DataFrame:
        return stage(components(edges), "labels")

    def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Those of the pairs that aren't in one component yet."""
        for end in ("a", "b"):
            own = labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))
            pairs = pairs.join(own, end, "left").withColumn(f"l{end}", F.coalesce(f"l{end}", end))
        return pairs.filter("la <> lb").select("a", "b")

    # One leader for each class: the smallest one that it meets.
    edges = confirmed(met.groupBy(F.col("c").alias("b")).agg(F.min("lo").alias("a")).filter("a <> b").select("a", "b"))
    labels = labelled(edges)
    ends = met.select(F.least("c", "lo").alias("a"), F.greatest("c", "lo").alias("b")).union(met.select(F.least("c", "hi"), F.greatest("c", "hi")))
    more = confirmed(apart(ends.filter("a <> b").distinct(), labels))
    edges = edges.union(more)
    labels = labelled(edges)
    # Buckets of three have met all pairs by now. In the others, members outside the largest component meet the rest.
    named = met.filter("n > 3").join(labels.withColumnRenamed("node", "c"), "c", "left").select("g", "c", "n", F.coalesce("label", "c").alias("label"))
    per_label = named.groupBy("g", "label").agg(F.count("*").alias("m"))
    mixed = per_label.groupBy("g").agg(F.count("*").alias("k"), (F.sum("m") - F.max("m")).alias("rest"), F.max_by("label", F.struct("m", "label")).alias("main"))
    open_ = stage(named.join(mixed.filter("k > 1").drop("k"), "g").withColumn("out", F.col("label") != F.col("main")).drop("main"), "open")
    total = open_.count()
    if total:
        payload = classes.select("c", "size", "bands", F.array(*LIMBS).alias("limbs")).join(sets, "c")
        rest = _meet(open_.join(payload, "c"), total, percent)
        labels = labelled(edges.union(stage(rest, "edges")))

    inside = labels.select(F.col("node").alias("c"), "label").join(classes.select("c", "id"), "c")
    least = stage(inside.groupBy("label").agg(F.min("id").alias("component_id")), "least")
    found = inside.select("c", "label").join(least, "label").select("c", "component_id", F.lit(True).alias("linked"))
    own = classes.select("c", F.col("id").alias("own_id")).join(found, "c", "left")
    named_classes = own.select("c", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("own_id")).alias("component_id"))
    worded = signed.filter("size > 0").select("id", "c", "size").join(named_classes, "c").select("id", "size", "component_id")
    every = worded.union(signed.filter("size = 0").select("id", "size", F.col("id").alias("component_id")))
    result = every.select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
    return stage(result, "components", outlive=True)


def _meet(members: DataFrame, total: int, percent: int) -> DataFrame:
    """Edges (a, b) between members (``out``: outside their bucket's largest component) and all others of the bucket.

    Of ``n`` members ``rest`` are outside; these are dealt to n / BLOCK blocks,
    and each member to rest / BLOCK. A pair is compared where it meets first.
    """
    homes, guests = (F.ceil(F.col(x) / BLOCK).cast("int") for x in ("n", "rest"))
    home, guest = (F.pmod(F.xxhash64("c", F.lit(k)), blocks).cast("int") for k, blocks in ((1, homes), (2, guests)))
    as_home = members.withColumn("guest", F.explode(F.sequence(F.lit(0), guests - 1))).withColumns({"home": home, "calls": F.lit(False)})
    as_guest = members.filter("out").withColumn("home", F.explode(F.sequence(F.lit(0), homes - 1))).withColumns({"guest": guest, "calls": F.lit(True)})
    dealt = as_home.unionByName(as_guest).drop("n", "rest")
    bins = max(4 * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BIN_ROWS)
    dealt = dealt.withColumn("bin", F.pmod(F.xxhash64("g", "home", "guest"), F.lit(bins)))
    limit = most_ones(percent / 100)

    def compare(table: pa.Table) -> pa.Table:
        t = {n: table.column(n).to_numpy() for n in ("g", "home", "guest", "c", "label", "size", "out", "calls")}
        wide = len(table.column("bands")[0])
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, wide)
        limbs = table.column("limbs").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, len(LIMBS))
        codes = table.column("codes")
        order = np.lexsort((t["calls"], t["guest"], t["home"], t["g"]))
        groups = np.stack([t["g"], t["home"], t["guest"]])[:, order]
        cuts = np.flatnonzero(np.concatenate([[True], (groups[:, 1:] != groups[:, :-1]).any(axis=0), [True]]))
        edges: list[tuple[int, int]] = []
        for low, high in zip(cuts[:-1], cuts[1:]):
            own = order[low:high]
            at_home, callers = own[~t["calls"][own]], own[t["calls"][own]]
            over = {int(x): int(x) for x in t["label"][own]}

            def root(x: int) -> int:
                while over[x] != x:
                    x = over[x]
                return x

            unpacked: dict[int, np.ndarray] = {}
            for i in callers:
                band = int(np.flatnonzero(bands[i] == t["g"][i])[0])
                ones = np.bitwise_count(limbs[at_home] ^ limbs[i]).sum(axis=1)
                sizes = t["size"][at_home]
                near = (ones <= limit) & (100 * np.minimum(sizes, t["size"][i]) >= percent * np.maximum(sizes, t["size"][i]))
                # Two members outside meet twice; one of the times counts, and only in the first band that they share.
                near &= (t["label"][at_home] != t["label"][i]) & (~t["out"][at_home] | (t["c"][at_home] > t["c"][i]))
                some = at_home[near]
                some = some[(bands[some] == bands[i]).argmax(axis=1) == band]
                for j in some:
                    x, y = root(int(t["label"][i])), root(int(t["label"][j]))
                    if x != y and _alike(*(unpacked.setdefault(int(k), unpack(codes[int(k)].as_py())) for k in (i, j)), percent):
                        over[max(x, y)] = min(x, y)
                        edges.append((int(t["c"][i]), int(t["c"][j])))
        give_back()
        a, b = zip(*edges) if edges else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("bin").applyInArrow(compare, "a long, b long")


def _full_sets(source: DataFrame, wanted: Membership, words: int) -> DataFrame:
    """Set keys and packed shingle sets of the texts whose id may be a wanted one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            some = whole.filter(pa.array(wanted.maybe(whole.column(0).to_numpy())))
            for at in range(0, some.num_rows, 500):
                codes, offsets = shingle_sets(some.slice(at, 500).column(1), words)
                c, _ = set_keys(codes, offsets)
                blobs = [pack(codes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)), pa.array(blobs, pa.binary())], ["c", "codes"])
        give_back()

    return source.select(F.xxhash64("id").alias("h"), "text").mapInArrow(run, "c long, codes binary")


def _alike(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    """Whether the intersection of two sorted sets has that share of their union."""
    short, long = (first, second) if len(first) < len(second) else (second, first)
    at = np.searchsorted(long, short)
    both = int((long[np.minimum(at, len(long) - 1)] == short).sum())
    return 100 * both >= percent * (len(first) + len(second) - both)


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    for b in batches:
        keep = np.zeros(b.num_rows, bool)
        last, first = None, np.zeros(0, np.uint64)
        for i, (p, q) in enumerate(zip(b.column(2), b.column(3))):
            blob = p.as_py()
            if blob != last:
                last, first = blob, unpack(blob)
            keep[i] = _alike(first, unpack(q.as_py()), percent)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep))
    give_back()
