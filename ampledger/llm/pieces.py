"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs and always merges the pair
with the highest score, the leftmost first among equals. Where no piece of the
vocabulary has two characters next to each other, nothing can merge across
them, so a text divides there into chunks (words, mostly) that are encoded
each on its own. A chunk is encoded once while it is in a bounded cache, and is
compared with the sentencepiece library then.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from ampledger.llm.arrays import gather, give_back, text_bytes, worker_cache
from ampledger.llm.wordcache import WordCache, coded_words

MARK = "▁"
#: Longer chunks take the heap; shorter ones are merged together, one row of a matrix each.
LONG_CHUNK = 48
CACHE_CHUNKS = 600_000
#: Texts that are encoded at a time; their chunks and ids are Python values for a moment.
SLICE_ROWS = 250


class Pieces:
    """Merge table and agenda of one model file."""

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib = self.library
        n = lib.get_piece_size()
        special = lambda i: lib.is_control(i) or lib.is_byte(i) or lib.is_unknown(i)
        self.id_of = {lib.id_to_piece(i): i for i in range(n) if not special(i)}
        self.bytes_at = lib.piece_to_id("<0x00>")
        # Bytes that stand next to each other in some piece; every other ASCII pair divides a text.
        self.joined = np.ones((256, 256), bool)
        self.joined[:128, :128] = False
        self.joined[:, 0x20] = False
        for p in self.id_of:
            spaced = p.replace(MARK, " ").encode()
            for a, b in zip(spaced, spaced[1:]):
                self.joined[a, b] = True
        if self.joined[0x0A].any(where=np.arange(256) < 128) or self.joined[:128, 0x0A].any():
            raise ValueError("a piece has a line feed next to another character")
        if not lib.is_byte(self.bytes_at):
            raise ValueError("the model has no byte pieces")
        # Symbols: the pieces under their ids, then single characters that only occur inside pieces.
        self.symbol = dict(self.id_of)
        for p in self.id_of:
            for ch in p:
                self.symbol.setdefault(ch, len(self.symbol) + n)
        self.none = len(self.symbol) + n
        self.symbol_of = np.full(0x110000, self.none, np.int32)
        for ch, i in self.symbol.items():
            if len(ch) == 1:
                self.symbol_of[ord(ch)] = i
        self.symbol_of[0x20] = self.symbol_of[ord(MARK)]
        pairs = {}
        for p, i in self.id_of.items():
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs[(a, b)] = i
        self.pairs = pairs
        self.scores = np.array([lib.get_score(i) for i in range(n)], np.float32)
        width = self.none + 1
        self.width = width
        codes = np.array([a * width + b for a, b in pairs], np.int64)
        order = np.argsort(codes)
        # An open-addressing table: one or two probes for a pair instead of a binary search.
        bits = 1 << int(len(codes) * 4).bit_length()
        self.mask = bits - 1
        self.slot_code = np.full(bits, -1, np.int64)
        self.slot_id = np.full(bits, -1, np.int32)
        merged = np.array(list(pairs.values()), np.int32)[order]
        left = np.arange(len(codes))
        codes = codes[order]
        at = self._slot(codes)
        self.probes = 0
        while len(left):
            self.probes += 1
            free = self.slot_code[at[left]] < 0
            slots, one = np.unique(at[left][free], return_index=True)
            put = left[free][one]
            self.slot_code[slots], self.slot_id[slots] = codes[put], merged[put]
            left = np.setdiff1d(left, put)
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & self.mask

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the piece that the pairs merge to, -1 where there is none."""
        codes = a.astype(np.int64) * self.width + b
        at = self._slot(codes)
        out = np.full(len(codes), -1, np.int32)
        left = np.arange(len(codes))
        while len(left):
            seen = self.slot_code[at[left]]
            hit = seen == codes[left]
            out[left[hit]] = self.slot_id[at[left[hit]]]
            left = left[~hit & (seen >= 0)]
            at[left] = (at[left] + 1) & self.mask
        return out

    def ids(self, symbols: list[int], chars: list[str]) -> list[int]:
        """Final ids; a symbol that is no piece becomes the bytes of its character."""
        out = []
        for s, ch in zip(symbols, chars):
            if s < len(self.scores):
                out.append(s)
            else:
                out.extend(self.bytes_at + b for b in ch.encode())
        return out

    def heap_encode(self, chunk: str) -> list[int]:
        """One chunk by a heap of pairs."""
        text = list(chunk.replace(" ", MARK))
        sym = [self.symbol.get(ch, self.none) for ch in text]
        prev, after = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]
        agenda = []

        def push(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (p := self.pairs.get((sym[i], sym[j]))) is not None:
                heapq.heappush(agenda, (-self.scores[p], i, j, sym[i], sym[j], p))

        for i in range(len(sym) - 1):
            push(i, i + 1)
        while agenda:
            _, i, j, a, b, p = heapq.heappop(agenda)
            if sym[i] != a or sym[j] != b or after[i] != j:
                continue
            sym[i], sym[j] = p, -1
            after[i] = after[j]
            if after[j] >= 0:
                prev[after[j]] = i
            push(prev[i], i)
            push(i, after[i])
        alive = [k for k, s in enumerate(sym) if s >= 0]
        return self.ids([sym[k] for k in alive], [text[k] for k in alive])

    def matrix_encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short chunks of one length, and how many each has; row r is the agenda of chunk r."""
        rows, size = len(chunks), len(chunks[0])
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).reshape(rows, size)
        sym = self.symbol_of[points]
        # Symbols stay in place; a merged one leaves -1. right[r, c]: the next symbol's column.
        right = np.tile(np.arange(1, size + 1, dtype=np.int16), (rows, 1))
        left = np.tile(np.arange(-1, size - 1, dtype=np.int16), (rows, 1))
        into = np.full((rows, size), -1, np.int32)
        score = np.full((rows, size), -np.inf, np.float32)
        if size > 1:
            p = self.merged(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(rows, -1)
            into[:, :-1] = p
            score[:, :-1] = np.where(p >= 0, self.scores[p], -np.inf)
        active = np.arange(rows)
        while len(active):
            agenda = score[active]
            best = agenda.argmax(axis=1)
            go = agenda[np.arange(len(active)), best] > -np.inf
            active, best = active[go], best[go]
            if not len(active):
                break
            gone = right[active, best].astype(np.int64)
            beyond = right[active, gone].astype(np.int64)
            sym[active, best] = into[active, best]
            sym[active, gone] = -1
            score[active, gone] = -np.inf
            right[active, best] = beyond
            has = beyond < size
            left[active[has], beyond[has]] = best[has]
            score[active[~has], best[~has]] = -np.inf
            before = left[active, best].astype(np.int64)
            had = before >= 0
            at_r = np.concatenate([active[has], active[had]])
            at_c = np.concatenate([best[has], before[had]])
            nxt = np.concatenate([beyond[has], best[had]])
            p = self.merged(sym[at_r, at_c], sym[at_r, nxt])
            into[at_r, at_c] = p
            score[at_r, at_c] = np.where(p >= 0, self.scores[p], -np.inf)
        alive = sym >= 0
        strange = alive & (sym >= len(self.scores))
        if not strange.any():
            return sym[alive], alive.sum(axis=1)
        # A symbol that is no piece becomes the bytes of its character.
        each = alive.astype(np.int64)
        width = np.ones_like(points)
        for least in (0x80, 0x800, 0x10000):
            width += points >= least
        each[strange] = width[strange]
        flat = np.repeat(sym[alive], each[alive])
        as_bytes = "".join(map(chr, points[strange])).encode()
        flat[np.repeat(strange[alive], each[alive])] = self.bytes_at + np.frombuffer(as_bytes, np.uint8).astype(np.int32)
        return flat, each.sum(axis=1)

    def encode_chunks(self, chunks: list[str], verify: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks one after the other and how many each has, compared with the library in one call."""
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        counts = np.zeros(len(chunks), np.int64)
        parts, members = [], []
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            if size <= LONG_CHUNK:
                flat, counts[at] = self.matrix_encode([chunks[i] for i in at])
            else:
                coded = [self.heap_encode(chunks[i]) for i in at]
                counts[at] = [len(x) for x in coded]
                flat = np.array([y for x in coded for y in x], np.int32)
            parts.append(flat)
            members.append(at)
        order = np.concatenate(members)
        begins = np.zeros(len(chunks), np.int64)
        begins[order] = np.cumsum(counts[order]) - counts[order]
        flat = np.concatenate(parts)[gather(begins, counts)]
        if verify:
            # A line feed keeps the mark that the library puts before a text apart from the chunk.
            theirs = self.library.encode(["\n" + c for c in chunks], num_threads=1)
            sizes = np.fromiter(map(len, theirs), np.int64, len(theirs)) - 2
            ids = np.fromiter(chain.from_iterable(theirs), np.int32, int(sizes.sum()) + 2 * len(chunks))
            inner = ids[gather(np.cumsum(sizes + 2) - sizes, sizes)]
            if not (np.array_equal(sizes, counts) and np.array_equal(inner, flat)):
                raise AssertionError("the sentencepiece library encodes a chunk differently")
        return flat, counts


def _large(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def encode_batch(pieces: Pieces, texts: pa.Array, cache: WordCache, verify: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch of texts, without begin and end, and their n + 1 offsets."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), MARK, " ")
    # The model puts a space mark before every text that isn't empty.
    raw, offsets = text_bytes(pc.if_else(pc.equal(texts, _large("")), texts, pc.binary_join_element_wise(_large(" "), texts, _large(""))))
    if not len(raw):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    first = np.ones(len(raw), bool)
    first[1:] = ~pieces.joined[raw[:-1], raw[1:]]
    first[offsets[:-1][offsets[:-1] < len(raw)]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(raw))
    flat, each = coded_words(raw, starts, ends, cache, lambda new: pieces.encode_chunks(new, verify), CACHE_CHUNKS)
    upto = np.concatenate([[0], np.cumsum(each)])
    return flat, upto[np.searchsorted(starts, offsets)]


def encode_texts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", verify: bool = True) -> DataFrame:
    """Encode and decode every whole text; one output row per input row, without a shuffle.

    Columns: ``id_col``, ids (array, with begin and end ids), decoded (string).
    Null and empty texts have the begin and end ids alone and decode to an
    empty text. Repeated rows and null ids are kept as they are; other columns
    are ignored. ``model_file`` has to exist on every executor.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, flat, offsets, pieces in _coded(batches, model_file, verify):
            rows = [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([keys, ids, pa.array(pieces.library.decode(rows), pa.string())], [id_col, "ids", "decoded"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def encode_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", verify: bool = True) -> DataFrame:
    """As :func:`encode_texts`, with n_tokens and SHA-256 digests of ids and decoded text instead of them."""
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, flat, offsets, pieces in _coded(batches, model_file, verify):
            rows = [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
            decoded = [hashlib.sha256(t.encode()).hexdigest() for t in pieces.library.decode(rows)] if rows else []
            coded = [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.diff(offsets), pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _coded(batches: Iterator[pa.RecordBatch], model_file: str, verify: bool):
    pieces = worker_cache(f"pieces {model_file}", lambda: Pieces(model_file))
    cache = worker_cache(f"chunks {model_file}", WordCache)
    begin, end = pieces.library.bos_id(), pieces.library.eos_id()
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(at, SLICE_ROWS)
            flat, offsets = encode_batch(pieces, batch.column(1), cache, verify)
            n = batch.num_rows
            full = np.empty(len(flat) + 2 * n, np.int32)
            bounds = offsets + 2 * np.arange(n + 1)
            inner = np.ones(len(full), bool)
            inner[bounds[:-1]] = False
            inner[bounds[1:] - 1] = False
            full[inner] = flat
            full[bounds[:-1]], full[bounds[1:] - 1] = begin, end
            yield batch.column(0), full, bounds, pieces
    give_back()
