"""Periodic runs of words, found by a dictionary of basic factors.

The basic factors of a text are its stretches of 1, 2, 4, 8 ... words. Those of
one length get names, equal for equal factors, from the names of their halves;
factors that stand once in their text drop out, as no longer one repeats there.
In a run of period q, a factor of L >= q words has its next occurrence q words
on, and both lie within 2 * L words. Starts in a row whose next occurrences are
equally far form arithmetic progressions: each proposes its distance as a
period, and reaches over the last factor's next occurrence. Every period is
looked for at one length only, the smallest one not below it, so that no run
is proposed twice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampledger.llm.arrays import SPACE, gather, give_back, spans, text_bytes, word_array
from ampledger.llm.decontaminate import pieces_of

#: Fixed values of the contract: words and periods that a run has at least.
LEAST = 24
TIMES = 3
#: Bytes of text that a task looks at together, or one text.
PART_BYTES = 4 << 20


def first_length(least: int, times: int) -> int:
    """The longest basic factor at which every run with a period up to its length still shows a next occurrence."""
    size = 1
    while all(2 * size + q <= max(least, times * q) for q in range(1, 2 * size + 1)):
        size *= 2
    return size


def word_names(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names of all words, equal for equal words of one text; words per text as offsets; bytes, starts, ends."""
    raw, offsets = text_bytes(texts)
    starts, ends, keep = spans(raw, offsets, SPACE)
    per_text = np.searchsorted(starts, offsets).astype(np.int64)
    words = word_array(raw, starts, ends, keep).dictionary_encode()
    owner = np.repeat(np.arange(len(per_text) - 1), np.diff(per_text))
    names = owner * max(len(words.dictionary), 1) + words.indices.to_numpy(zero_copy_only=False)
    return names.astype(np.int64), per_text, raw, starts, ends


def find_runs(names: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, length and smallest period of every maximal run, ordered by place and period.

    No name stands in two texts, so no run crosses texts.
    """
    if times < 3 or least < 1:
        raise ValueError("a run has at least 3 periods and 1 word")
    begin = first_length(least, times)
    found: list[np.ndarray] = []
    place, name = np.arange(len(names)), names
    size = 1
    while len(place):
        order = np.argsort(name, kind="stable")
        ordered = name[order]
        new = np.ones(len(order), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        again = ~new
        often = again.copy()
        often[:-1] |= again[1:]
        label = np.cumsum(new) - 1
        if size >= begin:
            step = np.zeros(len(place), np.int64)
            step[order[:-1]] = np.where(again[1:], place[order[1:]] - place[order[:-1]], 0)
            near = np.flatnonzero((step <= size) & (step > (size // 2 if size > begin else 0)))
            at, step = place[near], step[near]
            if len(at):
                head = np.ones(len(at), bool)
                head[1:] = (at[1:] != at[:-1] + 1) | (step[1:] != step[:-1])
                first = np.flatnonzero(head)
                last = np.append(first[1:], len(at)) - 1
                period = step[first]
                length = at[last] - at[first] + size + period
                long = length >= np.maximum(least, times * period)
                found.append(np.stack([at[first][long], length[long], period[long]]))
        # Names of the factors of twice the length, where both halves stand more than once.
        whole = np.full(len(names) + size, -1, np.int64)
        whole[place[order[often]]] = label[often]
        place = np.sort(place[order[often]])
        second = whole[place + size]
        both = second >= 0
        place, second = place[both], second[both]
        name = whole[place] * (len(names) + 1) + second
        size *= 2
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def best_run(length: np.ndarray, period: np.ndarray) -> int:
    """Index of the run with the greatest exact length / period, the first of equal ones (runs are in order)."""
    ratio = length / period
    near = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-12))
    return int(max(near, key=lambda i: (Fraction(int(length[i]), int(period[i])), -i)))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per input row: id, n_runs, start, length, period, exponent_milli, runs, collapsed.

    Words are separated by ASCII white space and numbered from 0. A run is a
    maximal stretch of words with smallest period q and at least ``least``
    words and ``times`` * q of them. ``start`` to ``exponent_milli`` (floor of
    1000 * length / period) are those of the run with most periods; ties go to
    the smallest start, then period; without a run they are null. ``runs`` is
    an array of (start, length, period) by start, then period. ``collapsed``
    has the words that no run contains after its first q words, joined by one
    space.

    Null and empty texts have no words: no runs, empty ``collapsed``. Texts of
    any length are looked at as a whole. Ids play no part, so null and repeated
    ids and rows each give their row; other columns are ignored. No shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in pieces_of(whole.column(1), PART_BYTES):
                yield _look_at(whole.slice(a, b - a), id_col, least, times)
        give_back()

    schema = f"`{id_col}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def _look_at(batch: pa.RecordBatch, id_col: str, least: int, times: int) -> pa.RecordBatch:
    names, per_text, raw, starts, ends = word_names(batch.column(1))
    start, length, period = find_runs(names, least, times)
    owner = np.searchsorted(per_text, start, side="right") - 1
    edges = np.searchsorted(owner, np.arange(batch.num_rows + 1))
    covered = np.zeros(len(names) + 1, np.int64)
    np.add.at(covered, start + period, 1)
    np.add.at(covered, start + length, -1)
    kept = np.cumsum(covered[:-1]) == 0
    # The kept words with the byte after each, which becomes the space between them.
    sizes = (ends - starts)[kept] + 1
    text = np.append(raw, np.uint8(0x20))[gather(starts[kept], sizes)]
    upto = np.append(0, np.cumsum(sizes))
    text[upto[1:] - 1] = 0x20
    bounds = upto[np.append(0, np.cumsum(kept))[per_text]]
    collapsed = [text[a : max(a, b - 1)].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
    best: list[list[int | None]] = [[], [], [], []]
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        values: tuple = (None,) * 4
        if b > a:
            k = a + best_run(length[a:b], period[a:b])
            values = (int(start[k] - per_text[i]), int(length[k]), int(period[k]), 1000 * int(length[k]) // int(period[k]))
        for column, v in zip(best, values):
            column.append(v)
    parts = [start - per_text[owner], length, period]
    each = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in parts], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(np.diff(edges), pa.int64()),
            *(pa.array(x, pa.int64()) for x in best),
            pa.ListArray.from_arrays(pa.array(edges, pa.int32()), each),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        [id_col, "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"],
    )


def plant_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text, with a run planted in a tenth of the texts, chosen by the id's checksum.

    With h the CRC-32 of the id in decimal, g = h // 10 and n words, the texts
    with h % 10 = 0 repeat the words from a = g % n on with period
    1 + (n - a) // (3 + g % 8) up to their end. Other texts, texts without a
    word and rows without an id stay as they are.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def planted(key, text: str | None) -> str | None:
        h = zlib.crc32(str(key).encode())
        words = (text or "").encode().split()
        if h % 10 or not words:
            return text
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words[a:] = (words[a : a + p] * (-(-(n - a) // p)))[: n - a]
        return b" ".join(words).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            chosen = [i for i, key in enumerate(keys) if key is not None and zlib.crc32(str(key).encode()) % 10 == 0]
            if chosen:
                now = pa.array([planted(keys[i], texts[i].as_py()) for i in chosen], pa.string())
                mask = np.zeros(len(keys), bool)
                mask[chosen] = True
                plain = texts.cast(pa.string())
                texts = pc.replace_with_mask(plain, pa.array(mask), now)
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], [id_col, text_col])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, `{text_col}` string")
