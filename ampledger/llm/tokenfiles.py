"""Token-id files coded with a static range asymmetric numeral system.

A corpus is stored in three tables under one path: ``frequencies`` (the one
table of symbol frequencies that all blocks share), ``blocks`` (independent
blocks of whole documents in ascending key order) and ``parts`` (ids in each
part). A block's ids go round ``LANES`` interleaved states with one stream of
32-bit words; the states and the stream's place are kept at checkpoints, from
which a block is decoded in parallel, and a checksum of the ids is verified.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampledger.llm.arrays import LOWER, SPACE, spans, text_bytes, worker_cache
from ampledger.llm.scratch import stage
from ampledger.llm.wordcache import WordCache, coded_words
from ampledger.session import scratch_path

LANES = 256
#: Rounds of all lanes between checkpoints.
CHECKPOINT = 128
#: Ids in a block; a longer document is a block of its own.
BLOCK_IDS = 1 << 18
#: The frequencies add up to this power of two.
SCALE = 19
LOW = np.uint64(1 << 31)
CACHE_WORDS = 600_000

_32 = np.uint64(32)


def shared_table(ids: np.ndarray, counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies by id up to the largest id, at least 1 for each that occurs, 2**scale in all."""
    if not len(ids):
        return np.zeros(0, np.int64)
    total = 1 << scale
    if len(ids) > total // 2:
        raise ValueError("too many different ids for the table")
    freq = np.maximum(1, counts.astype(np.float64) * total / counts.sum()).astype(np.int64)
    # The most frequent ids take up the rounding.
    order = np.argsort(-freq, kind="stable")
    at = 0
    while (left := total - int(freq.sum())) != 0:
        k = order[at % len(order)]
        step = left if left > 0 else max(left, 1 - int(freq[k]), -max(1, int(freq[k]) // 2))
        freq[k] += step
        at += 1
    out = np.zeros(int(ids.max()) + 1, np.int64)
    out[ids] = freq
    return out


class Coder:
    """Encoder and decoder of blocks for one shared table."""

    def __init__(self, freq: np.ndarray, scale: int = SCALE):
        self.scale = np.uint64(scale)
        self.mask = np.uint64((1 << scale) - 1)
        self.freq = freq.astype(np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        self.limit = self.freq << np.uint64(63 - scale)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.pad = int(freq.argmax()) if len(freq) else 0

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """The stream of words, and the checkpoints: words before each and the states of all lanes."""
        rounds = -(-len(ids) // LANES)
        full = np.full(rounds * LANES, self.pad, np.int64)
        full[: len(ids)] = ids
        full = full.reshape(rounds, LANES)
        freq, start, limit = self.freq[full], self.start[full], self.limit[full]
        x = np.full(LANES, LOW, np.uint64)
        out = np.zeros((rounds, LANES), np.uint32)
        sent = np.zeros((rounds, LANES), bool)
        states = {}
        for t in range(rounds - 1, -1, -1):
            over = x >= limit[t]
            out[t] = x.astype(np.uint32)
            sent[t] = over
            x = np.where(over, x >> _32, x)
            q = x // freq[t]
            x = (q << self.scale) + (x - q * freq[t]) + start[t]
            if t % CHECKPOINT == 0:
                states[t] = x
        before = np.concatenate([[0], np.cumsum(sent.sum(axis=1))])
        marks = sorted(states)
        head = np.array([before[t] for t in marks], np.uint64)
        return out[sent].astype("<u4").tobytes(), np.concatenate([head, *(states[t] for t in marks)]).astype("<u8").tobytes()

    def decode(self, stream: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        """The n ids; all checkpoints are decoded side by side."""
        rounds = -(-n // LANES)
        if not rounds:
            return np.zeros(0, np.uint32)
        parts = -(-rounds // CHECKPOINT)
        kept = np.frombuffer(checkpoints, "<u8")
        at, x = kept[:parts].astype(np.int64), kept[parts:].reshape(parts, LANES).astype(np.uint64)
        words = np.frombuffer(stream, "<u4").astype(np.uint64)
        out = np.zeros((CHECKPOINT, parts, LANES), np.uint32)
        for t in range(min(CHECKPOINT, rounds)):
            # Only the last part can have fewer rounds; it stays behind when it is through.
            if (live := parts - (rounds - (parts - 1) * CHECKPOINT <= t)) < len(x):
                x, at = x[:live], at[:live]
            slot = x & self.mask
            symbol = self.symbol[slot]
            out[t, :live] = symbol
            x = self.freq[symbol] * (x >> self.scale) + slot - self.start[symbol]
            low = x < LOW
            upto = np.cumsum(low, axis=1)
            want = words[(at[:, None] + upto - 1)[low]]
            x[low] = (x[low] << _32) | want
            at = at + upto[:, -1]
        return out.transpose(1, 0, 2).reshape(-1)[:n]


def tokenize(texts: pa.Array, tokenizer, cache: WordCache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch of texts with a lower-casing tokenizer that drops white space, and the n + 1 offsets.

    The tokenizer splits at white space, and before a full stop or comma that
    follows a letter, whatever stands around: each chunk between is encoded by
    the library once while it is in the cache.
    """
    raw, offsets = text_bytes(texts)
    if b"<|" not in raw.tobytes():  # else a special token could come about
        raw = LOWER[raw]
    mark = np.zeros(256, bool)
    mark[[ord("."), ord(",")]] = True
    letter = np.zeros(256, bool)
    letter[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
    extra = np.zeros(len(raw), bool)
    extra[1:] = mark[raw[1:]] & letter[raw[:-1]]
    starts, ends, _ = spans(raw, offsets, SPACE, extra)

    def encode(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for ids in got for i in ids), np.int32, int(sizes.sum())), sizes

    flat, each = coded_words(raw, starts, ends, cache, encode, CACHE_WORDS)
    upto = np.concatenate([[0], np.cumsum(each)])
    return flat, upto[np.searchsorted(starts, offsets)]


def token_ids(docs: DataFrame, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns key and ids (compressed 32-bit ids with ``end_id`` appended) of every row; map-only.

    Null and empty texts have the end id alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def load():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_cache(f"tokenizer {tokenizer_file}", load)
        cache = worker_cache(f"tokens {tokenizer_file}", WordCache)
        press = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                flat, offsets = tokenize(batch.column(1), tokenizer, cache)
                n = batch.num_rows
                full = np.full(len(flat) + n, end_id, np.uint32)
                bounds = offsets + np.arange(n + 1)
                inner = np.ones(len(full), bool)
                inner[bounds[1:] - 1] = False
                full[inner] = flat
                # The bytes of one rank together: the high ones are mostly zero.
                blobs = [press(np.ascontiguousarray(full[a:b].view(np.uint8).reshape(-1, 4).T).tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["key", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"key {kind}, ids binary")


def _ids(blobs: list[bytes]) -> list[np.ndarray]:
    open_ = zstandard.ZstdDecompressor().decompress
    return [np.ascontiguousarray(np.frombuffer(open_(b), np.uint8).reshape(4, -1).T).view(np.uint32).ravel() for b in blobs]


def write_ids(coded: DataFrame, path: str) -> None:
    """Store the rows of :func:`token_ids` in ascending key order (null keys first, ties by their ids).

    Give a stored frame: it is read twice, for the frequencies and for the blocks.
    """
    spark = coded.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                own = _ids(batch.column(0).slice(at, 1000).to_pylist())
                if own:
                    c = np.bincount(np.concatenate(own))
                    wide = max(len(c), len(total))
                    total = np.pad(total, (0, wide - len(total))) + np.pad(c, (0, wide - len(c)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    counted = coded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    freq = shared_table(np.array([r["id"] for r in counted], np.int64), np.array([r["n"] for r in counted], np.int64))
    table = [(i, int(freq[i])) for i in np.flatnonzero(freq).tolist()]
    spark.createDataFrame(table, "id long, frequency long").coalesce(1).write.parquet(f"{path}/frequencies")
    kind = coded.schema["key"].dataType.simpleString()
    shared = freq.astype("<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(np.frombuffer(shared, "<u4").astype(np.int64))
        names = ["block", "first", "keys", "sizes", "crc32", "stream", "checkpoints"]
        keys, parts, held, block, first = [], [], 0, 0, 0

        def row() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            stream, marks = coder.encode(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    pa.array([first], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.concat_arrays(keys)),
                    pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                    pa.array([zlib.crc32(ids.astype("<u4").tobytes())], pa.int64()),
                    pa.array([stream], pa.binary()),
                    pa.array([marks], pa.binary()),
                ],
                names,
            )

        for batch in batches:
            for i in range(batch.num_rows):
                (ids,) = _ids([batch.column(1)[i].as_py()])
                if held and held + len(ids) > BLOCK_IDS:
                    yield row()
                    block, first = block + 1, first + held
                    keys, parts, held = [], [], 0
                keys.append(batch.column(0).slice(i, 1))
                parts.append(ids)
                held += len(ids)
        if held:
            yield row()

    schema = f"block long, first long, keys array<{kind}>, sizes array<long>, crc32 long, stream binary, checkpoints binary"
    ordered = coded.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "ids")
    blocks = ordered.mapInArrow(encode, schema).withColumn("part", F.spark_partition_id())
    blocks.write.parquet(f"{path}/blocks")
    stored = spark.read.parquet(f"{path}/blocks").select("part", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    stored.groupBy("part").agg(F.sum("n").alias("ids")).coalesce(1).write.parquet(f"{path}/parts")


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Decode stored blocks: one row per document with key, start (ids of all documents before it), n_tokens and ids.

    ``digest`` gives ids_crc32, the checksum of the document's ids, instead of
    the ids. A block whose checksum differs raises an error.
    """
    # One row per part: as many as the write had tasks.
    totals = sorted((r["part"], r["ids"]) for r in spark.read.parquet(f"{path}/parts").collect())
    before, upto = {}, 0
    for part, n in totals:
        before[part], upto = upto, upto + n
    rows = spark.read.parquet(f"{path}/frequencies").collect()
    freq = np.zeros(max((r["id"] for r in rows), default=-1) + 1, "<u4")
    for r in rows:
        freq[r["id"]] = r["frequency"]
    shared = freq.tobytes()
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    last = "ids_crc32 long" if digest else "ids array<long>"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(np.frombuffer(shared, "<u4").astype(np.int64))
        for batch in batches:
            for i in range(batch.num_rows):
                got = {n: batch.column(n)[i] for n in batch.schema.names}
                sizes = np.array(got["sizes"].as_py(), np.int64)
                ids = coder.decode(got["stream"].as_py(), got["checkpoints"].as_py(), int(sizes.sum())).astype("<u4")
                if zlib.crc32(ids.tobytes()) != got["crc32"].as_py():
                    raise ValueError(f"block {got['block']} of part {got['part']} is damaged")
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                starts = before[got["part"].as_py()] + got["first"].as_py() + bounds[:-1]
                if digest:
                    tail = pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])], pa.int64())
                else:
                    tail = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [got["keys"].values, pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), tail],
                    ["key", "start", "n_tokens", last.split()[0]],
                )

    return blocks.mapInArrow(decode, f"key {kind}, start long, n_tokens long, {last}")


def corpus_files(docs: DataFrame, tokenizer_file: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> str:
    """Tokenize and store a corpus; returns its path (a new one in the shared folder where none is given)."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_ids(stage(token_ids(docs, tokenizer_file, end_id, id_col, text_col), "ids"), path)
    return path
