"""Rows packed into chunks of bounded size, and exchange of packed values between chunks and buckets.

A chunk holds the texts of some rows in one compressed value. What a chunk
wants to know about its keys goes to buckets, one row per chunk and bucket, and
the answers come back the same way: far fewer rows than one for every key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampledger.llm.arrays import give_back, pack_small, text_bytes, unpack_small
from ampledger.llm.decontaminate import pieces_of
from ampledger.llm.scratch import stage


def pack_chunks(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """Stored chunks of rows (key, text, flag; the flag of any type): chunk, keys, flags, sizes, body. Null texts are empty.

    A chunk has at most ``chunk_bytes`` bytes of text, or one row.
    """
    kind, mark = (rows.schema[c].dataType.simpleString() for c in ("key", "flag"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for a, b in pieces_of(whole.column(1), chunk_bytes):
                batch = whole.slice(a, b - a)
                raw, offsets = text_bytes(batch.column(1))
                one = pa.array([0, batch.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(one, batch.column(0)),
                        pa.ListArray.from_arrays(one, batch.column(2)),
                        pa.array([_packed_sizes(np.diff(offsets))], pa.binary()),
                        pa.array([press(raw.tobytes())], pa.binary()),
                    ],
                    ["keys", "flags", "sizes", "body"],
                )
        give_back()

    packed = rows.select("key", "text", "flag").mapInArrow(run, f"keys array<{kind}>, flags array<{mark}>, sizes binary, body binary")
    return stage(packed.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


def _packed_sizes(sizes: np.ndarray) -> bytes:
    return pack_small(sizes.astype(np.uint32))


def open_chunk(sizes: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a chunk's texts and their offsets."""
    each = unpack_small(sizes).astype(np.int64)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    return raw, np.concatenate([np.zeros(1, np.int64), np.cumsum(each)])


def bucket_bounds(buckets: int) -> np.ndarray:
    """First 64-bit key of each of the equal ranges."""
    return np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)


def bucket_count(chunks: DataFrame, chunk_bytes: int, bucket_bytes: int, least: int = 64) -> int:
    """Buckets that hold about ``bucket_bytes`` of text's keys each."""
    return max(least, chunks.count() * chunk_bytes // bucket_bytes)
