"""Benchmark decontamination with a distributed positional inverted index.

The index is made of segments: each holds some documents' words as sorted
terms with their positions, and is one row of a stored table, so that common
terms are spread over all segments. Test items are cut into distinct phrases by
Spark, which deals them by their hash into blocks of bounded size; a search sends
a block of hashed phrases to every segment. There the position lists of a
phrase's terms, moved by their offsets, are intersected from the rarest term on.
Store an index before searching it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampledger.llm.arrays import LOWER, NOT_ALNUM, give_back, pack, pack_small, text_bytes, unpack, unpack_small, word_hashes
from ampledger.llm.scratch import stage

#: Fixed values of the contract: words of a window, and the share of hit words (1 in 20) that contaminates.
WINDOW = 13
HIT_SHARE = 20
#: Text bytes in a segment (a longer text is a segment of its own).
SEGMENT_BYTES = 4 << 20
#: Words of distinct test phrases, and names of their items, that are searched at a time.
BLOCK_WORDS = 1_000_000
#: Phrases of one item in a batch of rows.
BATCH_PHRASES = 10_000


def item_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words (A-Z lower-cased) of all texts and the n + 1 offsets."""
    raw, offsets = text_bytes(texts)
    return word_hashes(LOWER[raw], offsets, NOT_ALNUM)


def pieces_of(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, or of one row."""
    _, offsets = text_bytes(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, end
        at = end


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The segments, one row each: keys and word counts of its documents, terms, postings per term, positions.

    Positions count words over the whole segment. Null and empty texts have no
    words and keep their row in the segment. No shuffle.
    """
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in pieces_of(whole.column(1), segment_bytes):
                batch = whole.slice(a, b - a)
                words, offsets = item_words(batch.column(1))
                order = np.argsort(words, kind="stable")
                terms, first = np.unique(words[order], return_index=True)
                keys = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
                row = [pack(offsets), pack(terms), pack(first), pack_small(np.diff(order, prepend=0).astype(np.int32).view(np.uint32))]
                yield pa.RecordBatch.from_arrays([keys, *(pa.array([x], pa.binary()) for x in row)], ["keys", "word_offsets", "terms", "term_offsets", "positions"])
        give_back()

    schema = f"keys array<{key}>, word_offsets binary, terms binary, term_offsets binary, positions binary"
    # Each segment keeps its number once the index is stored.
    return docs.select(id_col, text_col).mapInArrow(run, schema).withColumn("segment", F.monotonically_increasing_id())


def distinct_phrases(items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The distinct phrases of all items: hashed words, and the sorted names of the items that have each.

    A null id is the empty name.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = item_words(batch.column(1))
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                width = min(b - a, window)
                for start in range(a, b - width + 1 if width else a, BATCH_PHRASES):
                    end = min(start + BATCH_PHRASES, b - width + 1)
                    phrases = [words[k : k + width].tobytes() for k in range(start, end)]
                    names = pa.array([batch.column(0)[i].as_py()] * len(phrases), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.binary()), names], ["words", "name"])

    named = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("name"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(cut, "words binary, name string").groupBy("words").agg(F.array_sort(F.collect_set("name")).alias("names"))


class Phrases:
    """A block of distinct phrases, as hashed words, and the items that have each."""

    def __init__(self, words: list[bytes], names: list[list[str]]):
        every = np.frombuffer(b"".join(words), np.uint64)
        self.terms, self.term_of = np.unique(every, return_inverse=True)
        self.bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(w) // 8 for w in words], dtype=np.int64)])
        self.names = sorted({name for each in names for name in each})
        number = {name: i for i, name in enumerate(self.names)}
        self.items = [[number[name] for name in each] for each in names]


def intersect(lists: list[np.ndarray], offsets: list[int], slop: int) -> np.ndarray:
    """Starts at which every term stands at its offset, or at most ``slop`` words from it; lists from the rarest on."""
    starts = lists[0].astype(np.int64) - offsets[0]
    for positions, offset in zip(lists[1:], offsets[1:]):
        if not len(starts):
            break
        want = starts + offset
        at = np.searchsorted(positions, want - slop)
        ok = at < len(positions)
        ok[ok] = positions[at[ok]] <= want[ok] + slop
        starts = starts[ok]
    return starts


def _search_segment(row: dict, phrases: Phrases | SimpleNamespace, slop: int):
    """Covered word ranges and items of each document of a segment."""
    offsets = unpack(row["word_offsets"]).astype(np.int64)
    terms = unpack(row["terms"])
    ranges: list[tuple[int, int, int]] = []
    if len(terms) and len(phrases.terms):
        at = np.minimum(np.searchsorted(terms, phrases.terms), len(terms) - 1)
        present = terms[at] == phrases.terms
        first = np.append(unpack(row["term_offsets"]).astype(np.int64), offsets[-1])
        count = np.where(present, first[at + 1] - first[at], 0)
        least = np.minimum.reduceat(count[phrases.term_of], phrases.bounds[:-1])
        alive = np.flatnonzero(least > 0)
        if len(alive):
            positions = np.cumsum(unpack_small(row["positions"]).view(np.int32).astype(np.int64))
        for w in alive.tolist():
            own = phrases.term_of[phrases.bounds[w] : phrases.bounds[w + 1]]
            rare = np.argsort(count[own], kind="stable").tolist()
            starts = intersect([positions[first[at[own[o]]] : first[at[own[o]] + 1]] for o in rare], rare, slop)
            if len(starts):
                inside = starts >= 0
                starts = starts[inside]
                ends = starts + len(own)
                doc = np.searchsorted(offsets, starts, side="right") - 1
                fits = (doc < len(offsets) - 1) & (ends <= offsets[np.minimum(doc + 1, len(offsets) - 1)])
                ranges.extend((int(d), int(s), w) for d, s in zip(doc[fits], starts[fits]))
    return offsets, ranges


def find_phrases(index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per indexed document: key, n_words, n_hit, items, starts, ends.

    ``items`` (sorted strings) are those with an occurring window; ``starts``
    and ``ends`` bound the maximal runs of hit words. A window is ``window``
    consecutive item words; an item of fewer words, but not none, is one
    window; null and empty items have none. ``slop`` 0 finds exact phrases; more
    finds windows whose terms each stand at most that many words from their
    place (proximity). A null item id counts as the empty name. All phrases are
    searched, in blocks of about ``block_words`` words and item names; the index
    is read once a block. Long or repeated items spread over the blocks. Only
    a block at a time, as hashes, comes to the driver.
    """
    spark = index.sparkSession
    phrases = stage(distinct_phrases(items, item_col, text_col, window), "phrases")
    total = phrases.agg(F.sum(F.length("words") / 8 + F.size("names"))).first()[0] or 0
    blocks = int(total // block_words) + 1
    dealt = phrases.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    key = index.schema["keys"].dataType.elementType.simpleString()
    schema = f"segment long, place int, key {key}, n_words long, items array<string>, starts array<int>, ends array<int>"
    found = []
    for k in range(blocks):
        rows = dealt.filter(F.col("block") == k).select("words", "names").collect()
        sent = spark.sparkContext.broadcast(vars(Phrases([bytes(r["words"]) for r in rows], [r["names"] for r in rows])))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, every=k == 0) -> Iterator[pa.RecordBatch]:
            phrases = SimpleNamespace(**sent.value)
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {n: batch.column(n)[i].as_py() for n in ("word_offsets", "terms", "term_offsets", "positions", "segment")}
                    offsets, ranges = _search_segment(row, phrases, slop)
                    keys = batch.column("keys")[i].values
                    n = len(keys)
                    out_items: list[list[str]] = [[] for _ in range(n)]
                    out_starts: list[list[int]] = [[] for _ in range(n)]
                    out_ends: list[list[int]] = [[] for _ in range(n)]
                    by_doc: dict[int, list[tuple[int, int]]] = {}
                    for d, s, w in ranges:
                        by_doc.setdefault(d, []).append((s, w))
                    for d, hits in by_doc.items():
                        out_items[d] = sorted({phrases.names[x] for _, w in hits for x in phrases.items[w]})
                        spans = [(s - int(offsets[d]), s - int(offsets[d]) + int(phrases.bounds[w + 1] - phrases.bounds[w])) for s, w in hits]
                        out_starts[d], out_ends[d] = merged(spans)
                    out = pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["segment"]] * n, pa.int64()),
                            pa.array(range(n), pa.int32()),
                            keys,
                            pa.array(np.diff(offsets), pa.int64()),
                            pa.array(out_items, pa.list_(pa.string())),
                            pa.array(out_starts, pa.list_(pa.int32())),
                            pa.array(out_ends, pa.list_(pa.int32())),
                        ],
                        ["segment", "place", "key", "n_words", "items", "starts", "ends"],
                    )
                    # The first block has a row for every document, later ones for those with hits.
                    yield out if every else out.take(pa.array(sorted(by_doc), pa.int32()))

        found.append(index.mapInArrow(run, schema))
    if len(found) == 1:
        result = found[0]
    else:
        whole = reduce(DataFrame.unionByName, found)
        grouped = whole.groupBy("segment", "place").agg(
            F.first("key").alias("key"),
            F.first("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.sort_array(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))).alias("spans"),
        )
        result = grouped.mapInArrow(_merge_rows, schema)
    return result.select(
        "key",
        "n_words",
        F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0), lambda a, x: a + x).cast("long").alias("n_hit"),
        F.array_sort("items").alias("items"),
        "starts",
        "ends",
    )


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Maximal runs that the spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _merge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [merged([(x["starts"], x["ends"]) for x in row]) for row in batch.column("spans").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("segment", "place", "key", "n_words", "items")), pa.array([r[0] for r in runs], pa.list_(pa.int32())), pa.array([r[1] for r in runs], pa.list_(pa.int32()))],
            ["segment", "place", "key", "n_words", "items", "starts", "ends"],
        )


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Index the documents, search the items, and judge: one row per document with key and ``contaminated``.

    A document without words is clean. Repeated rows are each judged.
    """
    index = stage(build_index(docs, id_col, text_col), "postings")
    found = find_phrases(index, items, item_col, item_text_col)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words")))
