"""Near duplicates by word shingles: a chosen-path similarity join.

Texts with equal shingle sets form one class from the start. The sets of the
classes are embedded as min-hash values. In every run a set goes down the paths
of those of its tokens that a hash of path and token chooses, so that similar
sets choose the same; a bucket that is still large is split again on further
tokens, small ones are compared by brute force. Runs are repeated until a pair
at the threshold is met with the target probability. What the comparison of
min-hash values leaves is verified exactly on the shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampledger.llm.arrays import GOLDEN, LOWER, SPACE, give_back, mix, ngrams, pack, text_bytes, unpack, word_hashes
from ampledger.llm.components import components
from ampledger.llm.membership import membership
from ampledger.llm.scratch import stage
from ampledger.session import staging

WORDS = 5
THRESHOLD = 0.8
#: Min-hash values of a set.
VALUES = 128
#: Probability with which a pair at the threshold is to be met.
TARGET = 0.999
#: Sets in a bucket that are compared without a further split, and most levels of splits.
BUCKET = 512
DEPTH = 3
#: Sets of a large bucket or component that are compared with as many others in one group.
BLOCK = 512
#: Standard deviations of the estimate below the threshold at which a pair is still verified.
SLACK = 4
#: Rows that a task compares at a time, about.
BIN_ROWS = 2_048


def met(depth: int) -> float:
    """Probability that one run brings a pair at the threshold to a bucket at this depth."""
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return q


def runs_for(target: float, depth: int) -> int:
    return math.ceil(math.log(1 - target) / math.log(1 - met(depth)))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and their n + 1 offsets.

    A text with fewer words, but not none, has one shingle of all of them.
    """
    raw, offsets = text_bytes(texts)
    h, per_text = word_hashes(LOWER[raw], offsets, SPACE)
    n = len(per_text) - 1
    sizes = np.diff(per_text)
    owner = np.repeat(np.arange(n), sizes)
    codes = ngrams(h, words)
    inside = owner[: len(codes)] == owner[words - 1 :][: len(codes)] if len(codes) else np.zeros(0, bool)
    codes, owner = codes[inside], owner[: len(inside)][inside]
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    if len(short):
        extra = np.array([ngrams(h[per_text[i] : per_text[i + 1]], int(sizes[i]))[0] for i in short], np.uint64)
        codes, owner = np.concatenate([codes, extra]), np.concatenate([owner, short])
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    codes, owner = codes[new], owner[new]
    return codes, np.searchsorted(owner, np.arange(n + 1))


def set_keys(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set that do not depend on order."""
    zero = np.zeros(1, np.uint64)
    first = np.concatenate([zero, np.cumsum(mix(codes ^ GOLDEN), dtype=np.uint64)])
    second = np.concatenate([zero, np.cumsum(mix(codes + GOLDEN), dtype=np.uint64)])
    return mix(first[offsets[1:]] - first[offsets[:-1]]), mix(second[offsets[1:]] - second[offsets[:-1]])


def min_hashes(codes: np.ndarray, offsets: np.ndarray, values: int) -> np.ndarray:
    """Min-hash values (32 bits) of sets that aren't empty."""
    seeds = mix(np.arange(1, 2 * values + 1, dtype=np.uint64) * GOLDEN)
    out = np.empty((len(offsets) - 1, values), np.uint32)
    for i in range(values):
        h = (codes ^ seeds[i]) * (seeds[values + i] | np.uint64(1))
        out[:, i] = (np.minimum.reduceat(h, offsets[:-1]) >> np.uint64(16)).astype(np.uint32)
    return out


def chosen(paths: np.ndarray, values: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the new paths of their chosen tokens; a token is chosen with 1 / (threshold * values)."""
    count = values.shape[1]
    tokens = mix((np.arange(count, dtype=np.uint64) + np.uint64(1)) * GOLDEN + values.astype(np.uint64))
    path = mix(tokens ^ paths[:, None])
    limit = np.uint64(int(2**64 / (threshold * count)))
    row, col = np.nonzero(mix(path + GOLDEN) < limit)
    return row, path[row, col]


def _star(members: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest linked member of each place, by union of the pairs."""
    root = np.arange(len(members))
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return members[root]


def _pairs_within(batch_rows: dict, compare) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of one bin: indexes of the group, and the places of linked pairs."""
    key = np.stack([batch_rows["g"], batch_rows["lo"], batch_rows["hi"]])
    order = np.lexsort((batch_rows["c"], *key))
    sorted_key = key[:, order]
    edge = np.flatnonzero(np.concatenate([[True], (sorted_key[:, 1:] != sorted_key[:, :-1]).any(axis=0), [True]]))
    for i, j in zip(edge[:-1], edge[1:]):
        own = order[i:j]
        # Equal members of a group are one.
        c = batch_rows["c"][own]
        own = own[np.concatenate([[True], c[1:] != c[:-1]])]
        if len(own) > 1:
            a, b = compare(own)
            if len(a):
                lo, hi, block = batch_rows["lo"][own[0]], batch_rows["hi"][own[0]], batch_rows["block"][own]
                if lo != hi:  # pairs within a block have their own group
                    cross = block[a] != block[b]
                    a, b = a[cross], b[cross]
                yield own, a, b


def _dealt(rows: DataFrame, total: int, partitions: int) -> DataFrame:
    """Rows (g, n, c, ...) with n members in group g, dealt to block pairs and bins of bounded size."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    with_block = rows.withColumn("block", F.pmod(F.xxhash64("c", "g"), blocks).cast("int"))
    with_pair = with_block.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    paired = with_pair.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    bins = max(4 * partitions, total // BIN_ROWS)
    return paired.drop("other", "n").withColumn("bin", F.pmod(F.xxhash64("g", "lo", "hi"), F.lit(bins)).cast("int"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    target: float = TARGET,
) -> DataFrame:
    """One row per input row: id, class_id, n_links, n_shingles.

    Two texts are linked if their sets of ``words``-word shingles (A-Z
    lower-cased) have a Jaccard similarity of ``threshold`` or more; a class is
    a connected component of links and ``class_id`` its smallest id. ``n_links``
    counts the other rows that a row is linked to, copies included. Rows of
    texts without a word (null, empty) are linked to nothing and are their own
    class. Repeated rows count as copies; the class id is null if all ids of
    the class are. Other columns are ignored.

    Links of equal sets are certain; others are met with a probability of at
    least ``target`` at the threshold, and more above. Every link is exact.
    """
    with staging(docs.sparkSession):
        return stage(_near_duplicates(docs, id_col, text_col, words, threshold, target), "near_duplicates", outlive=True)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, words: int, threshold: float, target: float) -> DataFrame:
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    runs = runs_for(target, DEPTH)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                codes, offsets = shingle_sets(batch.column(1), words)
                sizes = np.diff(offsets)
                c, d = set_keys(codes, offsets)
                full = np.flatnonzero(sizes)
                blobs = np.full(len(sizes), None, object)
                if len(full):
                    for i, row in zip(full, min_hashes(codes, np.append(offsets[:-1][full], len(codes)), VALUES)):
                        blobs[i] = row.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(c.view(np.int64)), pa.array(d.view(np.int64)), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
                    ["id", "c", "d", "size", "sig"],
                )
        give_back()

    signed = stage(source.mapInArrow(sign, f"id {kind}, c long, d long, size long, sig binary"), "signed")
    classes = stage(
        signed.filter("size > 0").groupBy("c", "d", "size").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("sig").alias("sig")),
        "classes",
    )

    def descend(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                c = batch.column(0).to_numpy()
                values = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(-1, VALUES)
                starts = [mix(np.full(len(c), r + 1, np.uint64)) for r in range(runs)] if first else [batch.column(2).to_numpy().view(np.uint64)]
                for paths in starts:
                    row, path = chosen(paths, values, threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(c[row])], ["g", "c"])

    sigs = classes.select("c", "sig")
    rows = stage(sigs.mapInArrow(lambda b: descend(b, True), "g long, c long"), "paths")
    leaves = []
    for level in range(1, DEPTH + 1):
        members = rows.groupBy("g").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("c")).alias("x"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("y"))
        # Buckets of the same members are compared once.
        buckets = stage(members.filter("n > 1").groupBy("x", "y", "n").agg(F.min("g").alias("g")).select("g", "n"), "buckets")
        last = level == DEPTH
        leaves.append(rows.join(buckets if last else buckets.filter(F.col("n") <= BUCKET), "g"))
        if last or buckets.filter(F.col("n") > BUCKET).limit(1).count() == 0:
            break
        large = rows.join(buckets.filter(F.col("n") > BUCKET), "g").select("g", "c")
        deeper = large.join(sigs, "c").select("c", "sig", "g")
        rows = stage(deeper.mapInArrow(lambda b: descend(b, False), "g long, c long"), "paths")
    met_rows = leaves[0]
    for more in leaves[1:]:
        met_rows = met_rows.union(more)
    met_rows = stage(met_rows.select("g", "n", "c"), "leaves")
    least = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / VALUES)

    def columns(table: pa.Table, names: list[str]) -> dict[str, np.ndarray]:
        return {n: table.column(n).to_numpy() for n in names}

    def compare_values(table: pa.Table) -> pa.Table:
        got = columns(table, ["g", "lo", "hi", "block", "c", "size"])
        values = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(-1, VALUES)
        out_a, out_b = [], []

        def compare(own: np.ndarray):
            v, size = values[own], got["size"][own]
            pa_, pb_ = [], []
            for i in range(len(own) - 1):
                alike = (v[i + 1 :] == v[i]).sum(axis=1) >= least * VALUES
                near = np.minimum(size[i + 1 :], size[i]) >= threshold * np.maximum(size[i + 1 :], size[i]) - 1e-9
                hit = np.flatnonzero(alike & near)
                pa_.append(np.full(len(hit), i))
                pb_.append(hit + i + 1)
            return np.concatenate(pa_), np.concatenate(pb_)

        for own, a, b in _pairs_within(got, compare):
            members = got["c"][own]
            root = _star(members, a, b)
            linked = root != members
            out_a.append(members[linked])
            out_b.append(root[linked])
        give_back()
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"a": pa.array(join(out_a), pa.int64()), "b": pa.array(join(out_b), pa.int64())})

    dealt = _dealt(met_rows.join(classes.select("c", "sig", "size"), "c"), met_rows.count(), partitions)
    likely = components(dealt.groupBy("bin").applyInArrow(compare_values, "a long, b long"))

    # Exact: the sets of all members of a likely component are compared.
    labels = stage(likely, "likely")
    sized = stage(labels.groupBy("label").agg(F.count("*").alias("n")), "sizes")
    members = stage(labels.join(sized, "label").select(F.col("node").alias("c"), F.col("label").alias("g"), "n").join(classes.select("c", "id", "copies"), "c"), "members")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            some = whole.filter(pa.array(wanted.maybe(whole.column(0).to_numpy())))
            for at in range(0, some.num_rows, 500):
                codes, offsets = shingle_sets(some.slice(at, 500).column(1), words)
                c, _ = set_keys(codes, offsets)
                blobs = [pack(codes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)), pa.array(blobs, pa.binary())], ["c", "codes"])
        give_back()

    # Texts are not shuffled to find those of the members: most others stop here, the join by c drops the rest.
    wanted = membership(members.select(F.xxhash64("id").alias("h")))
    coded = source.select(F.xxhash64("id").alias("h"), "text").mapInArrow(sets, "c long, codes binary")
    total = members.count()

    def compare_sets(table: pa.Table) -> pa.Table:
        got = columns(table, ["g", "lo", "hi", "block", "c", "copies"])
        blobs = table.column("codes")
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def compare(own: np.ndarray):
            parts = [unpack(blobs[int(i)].as_py()) for i in own]
            sizes = np.array([len(p) for p in parts])
            offsets = np.cumsum(sizes) - sizes
            _, place = np.unique(np.concatenate(parts), return_inverse=True)
            mark = np.zeros(int(place.max()) + 1, np.int32)
            pa_, pb_ = [], []
            for i in range(len(own) - 1):
                mine = place[offsets[i] : offsets[i] + sizes[i]]
                mark[mine] = 1
                rest = offsets[i + 1]
                both = np.add.reduceat(mark[place[rest:]], offsets[i + 1 :] - rest)
                mark[mine] = 0
                hit = np.flatnonzero(both >= threshold * (sizes[i + 1 :] + sizes[i] - both) - 1e-9)
                pa_.append(np.full(len(hit), i))
                pb_.append(hit + i + 1)
            return np.concatenate(pa_), np.concatenate(pb_)

        for own, a, b in _pairs_within(got, compare):
            members_, copies = got["c"][own], got["copies"][own]
            links = np.bincount(a, copies[b], len(own)) + np.bincount(b, copies[a], len(own))
            kept = links > 0
            out.append((members_[kept], links[kept].astype(np.int64), _star(members_, a, b)[kept]))
        give_back()
        names, kinds = ("c", "links", "root"), [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else [()] * 3)]
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(names, kinds)})

    pairs = _dealt(members.select("g", "n", "c", "copies").join(coded, "c"), total, partitions)
    exact = stage(pairs.groupBy("bin").applyInArrow(compare_sets, "c long, links long, root long"), "links")
    final = stage(components(exact.select(F.col("c").alias("a"), F.col("root").alias("b"))), "final")
    counted = stage(exact.groupBy("c").agg(F.sum("links").alias("links")), "counted")
    of_class = stage(
        classes.select("c", "id", "copies")
        .join(final.withColumnRenamed("node", "c"), "c", "left")
        .join(counted, "c", "left")
        .select("c", "id", "copies", F.coalesce("label", "c").alias("label"), F.coalesce("links", F.lit(0)).alias("links")),
        "class",
    )
    named = stage(of_class.groupBy("label").agg(F.min("id").alias("class_id")), "named")
    known = stage(of_class.join(named, "label").select("c", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links")), "known")
    alone = signed.filter("size = 0").select(F.col("id").alias(id_col), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("size").alias("n_shingles"))
    linked = signed.filter("size > 0").select("id", "c", "size").join(known, "c")
    return linked.select(F.col("id").alias(id_col), "class_id", "n_links", F.col("size").alias("n_shingles")).union(alone)
