"""Removal of long byte strings that earlier documents have, by a run-length index.

A window is ``length`` bytes. The smallest hash of the k-grams in it, its
minimizer, is the same wherever the window stands, so windows with a common
minimizer meet in one shard. Only windows whose minimizer stands in two
documents or more go there, as fragments (runs of windows with one minimizer),
each distinct one once for a chunk. A shard builds the Burrows-Wheeler
transform of its distinct fragments, keeps it as runs with a sample at each
run's end, and streams every fragment through it by LF steps: the matching
statistic, cut off at ``length``, tells which windows an earlier document has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampledger.llm.arrays import GOLDEN, gather, give_back, mix, pack, pack_small, unpack, unpack_small, word_keys
from ampledger.llm.chunks import bucket_bounds, bucket_count, open_chunk, pack_chunks

#: Fixed value of the contract: bytes of a window.
LENGTH = 50
#: Bytes of the k-grams whose hashes are compared.
K = 20
#: Most windows in a fragment; their marks are bits of one integer.
WINDOWS = 32
CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
#: A minimizer that more documents have than this is common: its windows are dealt out one by one, by their content.
COMMON = 1000
#: Bytes of fragments that are indexed at a time, or those of one minimizer; building takes about 80 times as much memory.
INDEX_BYTES = 2 << 20
#: Places of an index that are looked at together where each needs several numbers for a moment.
PART = 1 << 20
LAST = np.int64(2**63 - 1)
ALL = np.uint32(0xFFFFFFFF)
LOW16 = np.uint64(0xFFFF)


def window_minimizers(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimizer: first place, windows, and minimizer. A run is within a text."""
    n = len(raw)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    at = np.ndarray((n + 1,), "<u8", padded, strides=(1,))
    grams = n - K + 1
    h = at[:grams] * np.uint64(0x9E3779B97F4A7C15)
    h ^= at[8 : 8 + grams] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= (at[K - 8 : K - 8 + grams] ^ (h >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    # Smallest of length - K + 1 neighbours, by doubling.
    want, least, wide = length - K + 1, h, 1
    while wide * 2 <= want:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < want:
        least = np.minimum(least[: n - length + 1], least[want - wide : want - wide + n - length + 1])
    valid = np.zeros(n + 1, np.int32)
    lasts = np.maximum(offsets[1:] - length + 1, offsets[:-1])
    np.add.at(valid, offsets[:-1], 1)
    np.add.at(valid, lasts, -1)
    inside = np.cumsum(valid[:-1])[: len(least)] > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
    starts = offsets[:-1][offsets[:-1] < len(first)]
    first[starts] = inside[starts]
    begins = np.flatnonzero(first)
    upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(inside)])
    count = upto[np.append(begins[1:], len(inside))] - upto[begins]
    parts = -(-count // WINDOWS)
    step = gather(np.zeros(len(parts), np.int64), parts)
    begins_all = np.repeat(begins, parts) + step * WINDOWS
    return begins_all, np.minimum(np.repeat(count, parts) - step * WINDOWS, WINDOWS), np.repeat(least[begins], parts)


def dense(sorted_ids: np.ndarray) -> np.ndarray:
    """Ascending numbers counted anew from 0; a chunk has fewer than 2**16 texts as long as a window."""
    out = np.zeros(len(sorted_ids), np.uint64)
    out[1:] = np.cumsum(sorted_ids[1:] != sorted_ids[:-1])
    return out


class RunIndex:
    """Run-compressed transform of fragments in document order, with the first document at each run's end."""

    def __init__(self, body: np.ndarray, sizes: np.ndarray, docs: np.ndarray, length: int):
        count = len(sizes)
        total = int(sizes.sum()) + count
        ends = np.cumsum(sizes + 1) - 1
        self.first = ends - sizes
        inner = np.ones(total, bool)
        inner[ends] = False
        # Each fragment has an end of its own (0 here); ends stand before all bytes, in order of the fragments.
        # A shard is far smaller than 2**31 bytes, so places take 32 bits and symbols 16.
        text = np.zeros(total, np.uint16)
        text[inner] = body
        text[inner] += np.uint16(1)
        remain = np.repeat(ends.astype(np.int32), sizes + 1)
        remain -= np.arange(total, dtype=np.int32)
        remain = remain.astype(np.int16)
        order = self._suffixes(text, remain)
        # The text ends with an end, which is also what stands before its first place.
        before = text[order - 1].astype(np.int16) - np.int16(1)
        # Neighbours with the same window form an interval; runs end at its borders too.
        full = remain[order] >= length
        same = full[1:] & full[:-1]
        del text, remain, full
        plain = np.zeros(total + 8, np.uint8)
        plain[:total][inner] = body
        at = np.ndarray((total + 1,), "<u8", plain, strides=(1,))
        for low in range(0, len(same), PART):
            part = same[low : low + PART]
            for k in [*range(0, length - 8, 8), length - 8]:
                near = np.flatnonzero(part)
                part[near] = at[order[low + near] + k] == at[order[low + near + 1] + k]
        del plain, at, inner
        cut = np.ones(total, bool)
        cut[1:] = ~same
        run = cut.copy()
        run[1:] |= before[1:] != before[:-1]
        self.run_start = np.flatnonzero(run)
        # The starts as bits, with the runs before each word: the run of a place is a count of bits.
        words = np.packbits(np.append(run, np.zeros(-total % 64, bool)), bitorder="little").view("<u8")
        ones = np.bitwise_count(words).astype(np.int64)
        self.words, self.ahead = words, np.cumsum(ones) - ones
        head = before[self.run_start]
        run_size = np.diff(np.append(self.run_start, total))
        owner = np.repeat(np.arange(count, dtype=np.int32), sizes + 1)
        sample = np.minimum.reduceat(docs[owner[order]], self.run_start)
        del owner, order
        interval = np.cumsum(cut, dtype=np.int32)[self.run_start] - 1
        least = np.minimum.reduceat(sample, np.flatnonzero(cut[self.run_start]))
        self.earliest = least[interval]
        # LF of a run's first place: places of smaller symbols, then of equal ones in earlier runs.
        by_symbol = np.argsort(head, kind="stable")
        base = np.zeros(len(head), np.int64)
        base[by_symbol] = np.cumsum(run_size[by_symbol]) - run_size[by_symbol]
        # Symbol -1 stands for all ends; they come first, so the bases of bytes need no correction.
        self.base = base
        self.sizes, self.docs, self.length = sizes, docs, length

    @staticmethod
    def _suffixes(text: np.ndarray, remain: np.ndarray) -> np.ndarray:
        """Suffix array by doubling from seven symbols on; only suffixes that are still equal are ordered again."""
        n, width = len(text), 7
        padded = np.concatenate([text, np.zeros(width, np.uint16)])
        key = np.zeros(n, np.uint64)
        for j in range(width):
            key <<= np.uint64(9)
            key |= padded[j : j + n]
        # Nothing counts behind a fragment's end.
        near = np.flatnonzero(remain < width - 1)
        behind = (9 * (width - 1 - remain[near])).astype(np.uint64)
        key[near] = key[near] >> behind << behind
        del padded, near, behind
        order = np.argsort(key).astype(np.int32)
        key = key[order]
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        del key
        begin = np.where(new, np.arange(n, dtype=np.int32), np.int32(0))
        np.maximum.accumulate(begin, out=begin)
        # Suffixes that end within the key differ by their ends alone.
        short = np.flatnonzero(remain[order] < width)
        ended = order[short]
        order[short] = ended[np.argsort(begin[short].astype(np.int64) * n + ended)]
        new[short] = True
        begin[short] = short
        del short, ended
        rank = np.empty(n, np.int32)
        rank[order] = begin
        del begin
        slots = np.flatnonzero(~(new & np.append(new[1:], True))).astype(np.int32)
        while len(slots):
            tied = order[slots]
            pair = rank[tied].astype(np.int64)
            pair *= n + 1
            pair += rank[tied + width]
            by = np.argsort(pair)
            pair, tied = pair[by], tied[by]
            new = np.ones(len(slots), bool)
            new[1:] = pair[1:] != pair[:-1]
            order[slots] = tied
            rank[tied] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots), dtype=np.int32), np.int32(0)))]
            slots = slots[~(new & np.append(new[1:], True))]
            width *= 2
        return order

    def _run_of(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        upto = np.uint64(2**64 - 1) >> (63 - (place & 63)).astype(np.uint64)
        return self.ahead[word] + np.bitwise_count(self.words[word] & upto) - 1

    def early(self) -> np.ndarray:
        """Bits of each fragment's windows that a document before its own has."""
        out = np.zeros(len(self.sizes), np.uint32)
        live = np.arange(len(self.sizes))
        place = live.copy()  # the suffix at the end of fragment i stands in place i
        run = self._run_of(place)
        for step in range(1, int(self.sizes.max(initial=0)) + 1):
            place = self.base[run] + place - self.run_start[run]
            run = self._run_of(place)
            if step >= self.length:
                found = self.earliest[run] < self.docs[live]
                hit = live[found]
                out[hit] |= np.uint32(1) << (self.sizes[hit] - step).astype(np.uint32)
            more = self.sizes[live] > step
            if not more.all():
                live, place, run = live[more], place[more], run[more]
        return out


def cut_out(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes raw[starts[i] : starts[i] + sizes[i]] of all i, one after the other."""
    out = np.empty(int(sizes.sum()), np.uint8)
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        upto = max(int(np.searchsorted(ends, ends[low] + PART)), low + 1)
        some = slice(low, upto)
        out[ends[low] - sizes[low] : ends[upto - 1]] = raw[gather(starts[some], sizes[some])]
        low = upto
    return out


def index_parts(keys: np.ndarray, sizes: np.ndarray) -> list[int]:
    """Bounds of parts of ascending keys: no key in two, and up to ``INDEX_BYTES`` bytes or one key in each."""
    borders = np.append(np.flatnonzero(np.diff(keys, prepend=-1)), len(keys))
    upto = np.append(0, np.cumsum(sizes))[borders]
    bounds, at = [0], 0
    while at < len(borders) - 1:
        at = max(int(np.searchsorted(upto, upto[at] + INDEX_BYTES, side="right")) - 1, at + 1)
        bounds.append(int(borders[at]))
    return bounds


def early_windows(keys: np.ndarray, body: np.ndarray, sizes: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each fragment the bits of its windows that a smaller document of the shard has."""
    if not len(sizes):
        return np.zeros(0, np.uint32)
    starts = np.cumsum(sizes) - sizes
    h, tag = word_keys(body, starts, starts + sizes)
    order = np.lexsort((docs, tag, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (tag[order[1:]] != tag[order[:-1]])
    del h, tag
    group = np.cumsum(new) - 1
    distinct = order[new]
    least = docs[distinct]
    marks = np.zeros(len(distinct), np.uint32)
    # A minimizer with one fragment has no other document's windows; the others are indexed.
    _, key_at, often = np.unique(keys[distinct], return_inverse=True, return_counts=True)
    chosen = np.flatnonzero(often[key_at] > 1)
    # Equal windows have one minimizer, so each goes into an index as a whole, with others up to the bound.
    chosen = chosen[np.lexsort((least[chosen], key_at[chosen]))]
    bounds = index_parts(key_at[chosen], sizes[distinct[chosen]])
    del key_at, often
    for low, high in zip(bounds[:-1], bounds[1:]):
        part = chosen[low:high]
        part = part[np.argsort(least[part], kind="stable")]
        own = distinct[part]
        marks[part] = RunIndex(cut_out(body, starts[own], sizes[own]), sizes[own], least[part], length).early()
    out = np.empty(len(order), np.uint32)
    out[order] = np.where(docs[order] > least[group], ALL, marks[group])
    return out


def _zip(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unzip(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, carry: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """One row per input row: id, columns of ``carry``, n_bytes, n_removed, n_spans, kept (binary).

    ``as_text`` gives ``kept`` as a string, without what is left of cut characters.

    A byte goes if a window over it (``length`` bytes of UTF-8) also starts in
    a document with a smaller id; windows are judged on the input. Ids are
    integers; a null id is greater than all others. Rows with one id are not
    earlier than each other. Null and empty texts, and texts shorter than a
    window, lose nothing. Columns that aren't carried are ignored.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept"]
    columns = [id_col, *(carry or [])]
    if set(columns) & set(results):
        raise ValueError(f"columns are named as results: {sorted(set(columns) & set(results))}")
    if length < K + 1 or length - K + 1 > 256:
        raise ValueError(f"length must be from {K + 1} to {K + 255}")
    key = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)))
    # A null id comes after all others.
    rows = docs.select(key.alias("key"), F.col(text_col).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST))).alias("flag"))
    kind = rows.schema["key"].dataType.simpleString()
    chunks = pack_chunks(rows, CHUNK_BYTES)
    buckets = bucket_count(chunks, CHUNK_BYTES, BUCKET_BYTES)
    bounds = bucket_bounds(buckets)

    def looked_at(sizes: bytes, body: bytes):
        raw, offsets = open_chunk(sizes, body)
        begins, count, least = window_minimizers(raw, offsets, length)
        # Minimizers are small numbers by nature: spread them over the buckets.
        least = mix(least)
        doc = np.searchsorted(offsets, begins, side="right") - 1
        whole, _ = word_keys(raw, offsets[:-1], offsets[1:]) if len(raw) else (np.zeros(len(offsets) - 1, np.uint64), None)
        return raw, offsets, begins, count, least, doc, whole

    def split(sorted_keys: np.ndarray) -> list[slice]:
        cuts = np.append(np.searchsorted(sorted_keys, bounds), len(sorted_keys))
        return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, offsets, _, _, least, doc, whole = looked_at(batch.column("sizes")[i].as_py(), batch.column("body")[i].as_py())
                ids = np.array(batch.column("flags")[i].as_py(), np.int64)
                # Distinct pairs of a minimizer (48 bits tell them apart) and a document with windows, in one sort.
                pairs = np.unique(least & ~LOW16 | dense(doc))
                keys, n = np.unique(pairs & ~LOW16, return_counts=True)
                texts = np.argsort(whole, kind="stable")
                grams, copies = split(keys), split(whole[texts])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(buckets), pa.int32()),
                        pa.array([batch.column("chunk")[i].as_py()] * buckets, pa.int64()),
                        pa.array([pack(keys[s] >> np.uint64(16)) for s in grams], pa.binary()),
                        pa.array([pack_small(n[s]) for s in grams], pa.binary()),
                        pa.array([_zip(whole[texts[s]]) for s in copies], pa.binary()),
                        pa.array([_zip(ids[texts[s]]) for s in copies], pa.binary()),
                    ],
                    ["bucket", "chunk", "grams", "counts", "texts", "ids"],
                )
        give_back()

    def tell(table: pa.Table) -> pa.Table:
        keys = [unpack(x) for x in table.column("grams").to_pylist()]
        counts = [unpack_small(x) for x in table.column("counts").to_pylist()]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(distinct))
        state = (total > 1).astype(np.uint32) + (total > COMMON)
        states = np.split(state[at], np.cumsum([len(k) for k in keys])[:-1])
        texts = [_unzip(x, np.uint64) for x in table.column("texts").to_pylist()]
        ids = [_unzip(x, np.int64) for x in table.column("ids").to_pylist()]
        _, at = np.unique(np.concatenate(texts), return_inverse=True)
        least = np.full(int(at.max(initial=-1)) + 1, LAST)
        np.minimum.at(least, at, np.concatenate(ids))
        firsts = np.split(least[at], np.cumsum([len(t) for t in texts])[:-1])
        del keys, counts, distinct, at, total, state, texts, ids, least
        give_back()
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "bucket": table.column("bucket"),
                "states": pa.array([pack_small(s) for s in states], pa.binary()),
                "firsts": pa.array([_zip(f) for f in firsts], pa.binary()),
            }
        )

    asked = chunks.select("chunk", "flags", "sizes", "body").mapInArrow(ask, "bucket int, chunk long, grams binary, counts binary, texts binary, ids binary")
    told = asked.groupBy("bucket").applyInArrow(tell, "chunk long, bucket int, states binary, firsts binary")

    def cut(own: pa.Table, answers: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        raw, offsets, begins, count, least, doc, whole = looked_at(row["sizes"], row["body"])
        ids = np.array(row["flags"], np.int64)
        answers = answers.sort_by("bucket")
        first_id = np.empty(len(ids), np.int64)
        first_id[np.argsort(whole, kind="stable")] = np.concatenate([_unzip(x, np.int64) for x in answers.column("firsts").to_pylist()])
        copy = (first_id < ids) & (np.diff(offsets) >= length)
        _, at = np.unique(least & ~LOW16, return_inverse=True)
        state = np.concatenate([unpack_small(x) for x in answers.column("states").to_pylist()])[at] if len(least) else np.zeros(0, np.uint32)
        # Copies of an earlier text are settled; so are windows that no other document can have.
        open_ = (state > 0) & ~copy[doc]
        parts = []
        for single in (False, True):
            pick = np.flatnonzero(open_ & ((state == 2) == single))
            place, n, key = begins[pick], count[pick], least[pick]
            if single and len(pick):
                place, key = gather(place, n), np.repeat(key, n)
                n = np.ones(len(place), np.int64)
                key = word_keys(raw, place, place + length)[0]
            parts.append((place, n, key, np.full(len(place), single)))
        place, n, key, alone = (np.concatenate(x) for x in zip(*parts))
        size = n + length - 1
        mine = ids[np.searchsorted(offsets, place, side="right") - 1] if len(place) else np.zeros(0, np.int64)
        h, tag = word_keys(raw, place, place + size) if len(place) else (key, key)
        order = np.lexsort((place, mine, tag, h))
        new = np.ones(len(order), bool)
        new[1:] = (h[order[1:]] != h[order[:-1]]) | (tag[order[1:]] != tag[order[:-1]])
        leader = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
        later = mine[order] > mine[leader]
        # Equal fragments of one document take what its first one gets.
        settled, asking = order[later], order[~later]
        shard = np.searchsorted(bounds, mix(key + GOLDEN), side="right") - 1
        asking = asking[np.argsort(shard[asking], kind="stable")]
        cuts = np.searchsorted(shard[asking], np.arange(buckets + 1))
        table: dict[str, list] = {k: [] for k in ("shard", "keys", "size", "ids", "places", "alone", "body")}
        for s in range(buckets):
            some = asking[cuts[s] : cuts[s + 1]]
            table["shard"].append(s)
            table["keys"].append(_zip(key[some]))
            table["size"].append(pack_small(size[some]))
            table["ids"].append(_zip(mine[some]))
            table["places"].append(_zip(place[some].astype(np.uint32)))
            # A window on its own is compared by its hash, so its bytes stay here.
            shown = some[~alone[some]]
            table["alone"].append(_zip(alone[some]))
            table["body"].append(_zip(raw[gather(place[shown], size[shown])]))
        kinds = {"shard": pa.int32()}
        done_places = np.concatenate([place[settled], begins[copy[doc]]]) if len(copy) else place[settled]
        done_marks = np.concatenate([_bits(n[settled]), _bits(count[copy[doc]])])
        out = {k: pa.array(v, kinds.get(k, pa.binary())) for k, v in table.items()}
        rest = [b""] * (buckets - 1)
        del raw, begins, count, least, doc, h, tag, order, new, leader, later, table
        give_back()
        return pa.table(
            {
                "chunk": pa.array([row["chunk"]] * buckets, pa.int64()),
                **out,
                "done_places": pa.array([_zip(done_places.astype(np.uint32)), *rest], pa.binary()),
                "done_marks": pa.array([_zip(done_marks), *rest], pa.binary()),
            }
        )

    def judge(table: pa.Table) -> pa.Table:
        def column(name: str, kind) -> np.ndarray:
            return np.concatenate([_unzip(x, kind) for x in table.column(name).to_pylist()])

        sizes = [unpack_small(x).astype(np.int64) for x in table.column("size").to_pylist()]
        every = np.concatenate(sizes)
        keys, ids, alone = column("keys", np.uint64), column("ids", np.int64), column("alone", bool)
        marks = np.zeros(len(every), np.uint32)
        marks[~alone] = early_windows(keys[~alone], column("body", np.uint8), every[~alone], ids[~alone], length)
        _, at = np.unique(keys[alone], return_inverse=True)
        least = np.full(int(at.max(initial=-1)) + 1, LAST)
        np.minimum.at(least, at, ids[alone])
        marks[alone] = np.where(ids[alone] > least[at], ALL, 0)
        marks &= _bits(every - length + 1)
        split_marks = np.split(marks, np.cumsum([len(s) for s in sizes])[:-1])
        out_places, out_marks = [], []
        for blob, m in zip(table.column("places").to_pylist(), split_marks):
            out_places.append(_zip(_unzip(blob, np.uint32)[m > 0]))
            out_marks.append(_zip(m[m > 0]))
        del keys, ids, alone, every, sizes, marks, split_marks
        give_back()
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "places": pa.array(out_places, pa.binary()),
                "marks": pa.array(out_marks, pa.binary()),
                "done_places": table.column("done_places"),
                "done_marks": table.column("done_marks"),
            }
        )

    def keep(own: pa.Table, found: pa.Table) -> pa.Table:
        raw, offsets = open_chunk(own.column("sizes")[0].as_py(), own.column("body")[0].as_py())
        places, marks = [], []
        for a, b in (("places", "marks"), ("done_places", "done_marks")):
            for p, m in zip(found.column(a).to_pylist(), found.column(b).to_pylist()):
                if p:
                    places.append(_unzip(p, np.uint32))
                    marks.append(_unzip(m, np.uint32))
        place, mark = (np.concatenate(x) if x else np.zeros(0, np.uint32) for x in (places, marks))
        bits = np.unpackbits(mark.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        r, c = np.nonzero(bits)
        starts = place[r].astype(np.int64) + c
        cover = np.zeros(len(raw) + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        edges = offsets[:-1][offsets[:-1] < len(raw)]
        first[edges] = gone[edges]
        upto, spans = (np.concatenate([np.zeros(1, np.int64), np.cumsum(x)]) for x in (gone, first))
        kept = [raw[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        del cover, gone, first, starts, r, c, bits, raw
        give_back()
        return pa.table(
            {
                "key": own.column("keys").combine_chunks().flatten(),
                "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                "n_removed": pa.array(upto[offsets[1:]] - upto[offsets[:-1]], pa.int64()),
                "n_spans": pa.array(spans[offsets[1:]] - spans[offsets[:-1]], pa.int64()),
                "kept": pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()),
            }
        )

    pieces = "chunk long, shard int, keys binary, size binary, ids binary, places binary, alone binary, body binary, done_places binary, done_marks binary"
    fragments = chunks.select("chunk", "flags", "sizes", "body").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(cut, pieces)
    found = fragments.groupBy("shard").applyInArrow(judge, "chunk long, places binary, marks binary, done_places binary, done_marks binary")
    result = chunks.select("chunk", "keys", "sizes", "body").groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(keep, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}")
    return result.select(*(F.col(f"key.c{i}").alias(c) for i, c in enumerate(columns)), *results)


def _bits(count: np.ndarray) -> np.ndarray:
    """That many low bits set, up to 32."""
    return ((np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
