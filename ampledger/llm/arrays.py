"""Array helpers for tasks: words of a batch, hashes, packed integers, worker caches."""

from __future__ import annotations

import ctypes
import sys
import types

import numpy as np
import pyarrow as pa
import zstandard

#: Bytes that separate words, and the bytes of lower-cased alphanumeric words (UTF-8 beyond ASCII included).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

GOLDEN = np.uint64(0x9E3779B97F4A7C15)

#: Keeps the first n bytes of eight.
TAIL = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def worker_cache(name: str, make):
    """A value that a Python worker keeps from task to task."""
    module = sys.modules.setdefault("_ampledger_worker", types.ModuleType("_ampledger_worker"))
    if name not in module.__dict__:
        module.__dict__[name] = make()
    return module.__dict__[name]


def give_back() -> None:
    """Hand memory that a finished step left unused back to the system: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other and their n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def spans(raw: np.ndarray, offsets: np.ndarray, cut: np.ndarray, extra: np.ndarray | None = None):
    """First byte and end of every word; words end at the bytes of ``cut`` and at text ends.

    ``extra`` marks bytes that begin a word even inside one.
    """
    keep = ~cut[raw]
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    edges = offsets[:-1][offsets[:-1] < len(raw)]
    first[edges] = keep[edges]
    if extra is not None:
        first |= extra & keep
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, starts, keep
    # A word ends where the kept bytes end or the next word begins.
    place = np.cumsum(keep)
    size = np.diff(np.append(place[starts] - 1, place[-1]))
    return starts, starts + size, keep


def word_array(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The words as one Arrow array of strings."""
    sizes = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=sizes[1:])
    data = raw[keep]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(np.ascontiguousarray(data))])


def word_keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, never 0, and its first eight bytes. Words of up to eight bytes have hashes of their own."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    at = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    first = at[starts] & TAIL[np.minimum(size, 8)]
    h = mix(first ^ (np.minimum(size, 8).astype(np.uint64) * GOLDEN))
    left, k = np.flatnonzero(size > 8), 8
    while len(left):
        h[left] = mix((h[left] + size[left].astype(np.uint64)) * GOLDEN + (at[starts[left] + k] & TAIL[np.minimum(size[left] - k, 8)]))
        k += 8
        left = left[size[left] > k]
    return np.where(h == 0, GOLDEN, h), first


def word_hashes(raw: np.ndarray, offsets: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for every word, and the words per text as offsets."""
    starts, ends, _ = spans(raw, offsets, cut)
    return word_keys(raw, starts, ends)[0], np.searchsorted(starts, offsets).astype(np.int64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n values from each place on; len(h) - n + 1 of them."""
    count = len(h) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = mix(out * GOLDEN + h[i : i + count])
    return out


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + sizes[i] of all i, one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(total)


def pack(values: np.ndarray) -> bytes:
    """Compressed integers; meant for sorted or small ones (differences, byte by byte)."""
    values = np.ascontiguousarray(values, np.uint64)
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = steps.view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    """Compressed 32-bit integers in any order, byte by byte."""
    values = np.ascontiguousarray(values, np.uint32)
    if not len(values):
        return b""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack_small(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint32)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()
