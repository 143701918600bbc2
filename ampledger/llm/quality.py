"""Quality verdicts by divergence from language references.

Each text has a histogram of character classes and one of common words. The
references are the histograms of all texts of a language label that pass the
base rules. The Jensen-Shannon distance to the nearest reference decides, for
texts that are long enough for their histograms to mean something.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampledger.llm.arrays import LOWER, SPACE, ngrams, spans, text_bytes, word_array, word_keys
from ampledger.llm.scratch import stage

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

#: Words per language whose share is compared.
COMMON = 48
MAX_LANGUAGES = 200
#: Texts of fewer words or letters keep the base verdict: their histograms are too rough.
GUARD_WORDS = 50
GUARD_CHARS = 200
#: Largest mean of the two distances (classes, words) from the nearest references that is kept.
MAX_DISTANCE = 0.275
#: Mean of both distances up to which a text counts for the final references.
TRIM = 0.22

#: Character classes by byte: 0 lower, 1 upper, 2 digit, 3 space, 4 sentence mark, 5 symbol,
#: 6 other ASCII mark, 7 control, 8 Latin letters beyond ASCII, 9 other beyond ASCII; -1 continues a character.
CLASSES = 10

#: Marks that may stand behind a word.
MARKS = np.zeros(256, bool)
MARKS[[ord(c) for c in ".,;:!?"]] = True


def class_table() -> np.ndarray:
    out = np.full(256, 6, np.int64)
    out[ord("a") : ord("z") + 1] = 0
    out[ord("A") : ord("Z") + 1] = 1
    out[ord("0") : ord("9") + 1] = 2
    out[:0x20] = 7
    out[0x7F] = 7
    out[SPACE] = 3
    out[[ord(c) for c in ".,;:!?'\"-()"]] = 4
    out[[ord(c) for c in SYMBOLS]] = 5
    out[0x80:0xC0] = -1
    out[0xC0:] = 9
    out[0xC3:0xCA] = 8
    return out


def common_words(docs: DataFrame, lang_col: str, text_col: str) -> list[str]:
    """The most frequent lower-cased words of each label, counted over all of every labelled text."""
    frame = docs.select(F.col(lang_col).alias("_lang"), F.lower(text_col).alias("_text")).dropna(subset=["_lang", "_text"])
    words = frame.select("_lang", F.explode(F.split("_text", r"[\x20\x09-\x0D]+")).alias("_word")).filter(F.col("_word").rlike(r"^\p{L}+$"))
    # Tasks send their sums alone, and of these sums the highest of each label.
    counted = words.groupBy("_lang", "_word").count()
    top = counted.withColumn("_place", F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("count"), "_word"))).filter(F.col("_place") <= COMMON)
    rows = top.select("_word").distinct().orderBy("_word").limit(MAX_LANGUAGES * COMMON + 1).collect()
    if len(rows) > MAX_LANGUAGES * COMMON:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return [r["_word"] for r in rows]


def text_features(texts: pa.Array, vocabulary: tuple[np.ndarray, np.ndarray], classes: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts and both histograms of each text."""
    raw, offsets = text_bytes(texts)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(n), sizes)
    kind = classes[raw]
    seen = kind >= 0
    histogram = np.bincount(doc[seen] * CLASSES + kind[seen], minlength=n * CLASSES).reshape(n, CLASSES)

    began, ended, _ = spans(raw, offsets, SPACE)
    index, per_text = word_keys(raw, began, ended)[0], np.searchsorted(began, offsets)
    n_words = np.diff(per_text)
    owner = np.repeat(np.arange(n), n_words)
    # Words in a window that the text has twice.
    repeated = np.zeros(len(index) + 1, np.int64)
    codes = ngrams(index, WINDOW)
    inside = np.flatnonzero(owner[: len(codes)] == owner[WINDOW - 1 :][: len(codes)]) if len(codes) else np.zeros(0, np.int64)
    if len(inside):
        # Sorted by value with equal ones in text order, two of one text stand next to each other.
        order = inside[np.argsort(codes[inside], kind="stable")]
        same = (codes[order[1:]] == codes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        at = order[twice]
        np.add.at(repeated, at, 1)
        np.add.at(repeated, at + WINDOW, -1)
    covered = np.cumsum(repeated[:-1]) > 0
    n_repeat = np.bincount(owner[covered], minlength=n)

    # Lines with a word, equal to an earlier one.
    feed = np.zeros(256, bool)
    feed[0x0A] = True
    starts, ends, keep = spans(raw, offsets, feed)
    dup = np.zeros(n, np.int64)
    if len(starts):
        solid = np.concatenate([[0], np.cumsum(~SPACE[raw])])
        with_word = solid[ends] > solid[starts]
        lines = word_array(raw, starts, ends, keep).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        at = doc[starts]
        lines, at = lines[with_word], at[with_word]
        pairs = np.unique(at * (int(lines.max(initial=0)) + 1) + lines)
        first = np.bincount(pairs // (int(lines.max(initial=0)) + 1), minlength=n)
        dup = np.bincount(at, minlength=n) - first

    # Shares of common words, compared in lower case and without a mark behind them.
    places, order = vocabulary
    low = LOWER[raw]
    marked = MARKS[low[ended - 1]] & (ended - began > 1)
    spelled = word_keys(low, began, ended - marked)[0]
    spot = np.minimum(np.searchsorted(places, spelled), max(len(places) - 1, 0))
    common = np.where(places[spot] == spelled, order[spot], -1) if len(places) else np.full(len(spelled), -1)
    hit = common >= 0
    width = max(len(order), 1)
    counts = np.bincount(owner[hit] * width + common[hit], minlength=n * width).reshape(n, width)
    return {
        "n_words": n_words,
        "word_chars": np.bincount(doc[seen & ~SPACE[raw]], minlength=n),
        "n_symbols": histogram[:, 5],
        "n_dup_lines": dup,
        "n_repeat_words": n_repeat,
        "classes": histogram,
        "words": counts,
    }


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence (base 2) of each row of p to q; 0 to 1."""
    m = (p + q) / 2

    def part(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0.0).sum(axis=1)

    return np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def shares(classes: np.ndarray, counts: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both histograms as shares; the last place of the second is for all other words."""
    rest = np.maximum(n_words - counts.sum(axis=1), 0)
    both = np.column_stack([counts, rest])
    return classes / np.maximum(classes.sum(axis=1, keepdims=True), 1), both / np.maximum(both.sum(axis=1, keepdims=True), 1)


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_distance: float = MAX_DISTANCE) -> DataFrame:
    """Base counts, distances to the nearest language references, and the verdict, one row per input row.

    Null and empty texts have counts of 0 and fail the base rules. Labels only
    build the references; where no labelled text passes the base rules there is
    no reference, the distances are null, and the base verdict stays. It stays
    for texts below the length guards too. Repeated rows and null ids are kept;
    other columns are ignored.
    """
    common = common_words(docs, lang_col, text_col)
    raw, bounds = text_bytes(pa.array(common, pa.string()))
    spelled = word_keys(raw, bounds[:-1], bounds[1:])[0]
    vocabulary = np.sort(spelled), np.argsort(spelled)
    width = max(len(common), 1)
    table = class_table()
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                f = text_features(batch.column(1), vocabulary, table)
                packed = [pa.array([r.astype("<u4").tobytes() for r in f[k]], pa.binary()) for k in ("classes", "words")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), *(pa.array(f[k], pa.int64()) for k in base), *packed],
                    ["key", "lang", *base, "classes", "words"],
                )

    columns = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted = ", ".join(f"{c} long" for c in base)
    measured = stage(columns.mapInArrow(measure, f"key {kind}, lang string, {counted}, classes binary, words binary"), "quality")
    measured = measured.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
    )

    def unpacked(column: pa.Array, wide: int) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, wide).astype(np.float64)

    def nearest(classes: pa.Array, counts: pa.Array, n_words: np.ndarray, references: list) -> tuple[np.ndarray, np.ndarray]:
        c, w = shares(unpacked(classes, CLASSES), unpacked(counts, width), n_words)
        by_class = np.min([js_distance(c, rc) for rc, _ in references], axis=0)
        return by_class, np.min([js_distance(w, rw) for _, rw in references], axis=0)

    passed = measured.filter(~F.col("base_failed") & F.col("lang").isNotNull()).select("lang", "classes", "words", "n_words")

    def references_of(earlier: list) -> list:
        """Histograms of each label over all texts that pass, and that are near an earlier reference if there is one."""

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[str, np.ndarray] = {}
            for b in batches:
                if earlier and b.num_rows:
                    by_class, by_word = nearest(b.column(1), b.column(2), b.column(3).to_numpy(), earlier)
                    b = b.filter(pa.array(by_class + by_word <= 2 * TRIM))
                parts = np.column_stack([unpacked(b.column(1), CLASSES), unpacked(b.column(2), width), b.column(3).to_numpy()])
                langs = b.column(0).dictionary_encode()
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    mine = parts[langs.indices.to_numpy(zero_copy_only=False) == k].sum(axis=0)
                    sums[lang] = sums[lang] + mine if lang in sums else mine
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "total"])

        parts = passed.mapInArrow(add_up, "lang string, total array<double>").select("lang", F.posexplode("total"))
        totals = parts.groupBy("lang", "pos").agg(F.sum("col").alias("total")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "total"))).alias("v"))
        rows = totals.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
        if len(rows) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages have references")
        out = []
        for row in rows:
            v = np.array([x["total"] for x in row["v"]])
            out.append(shares(v[None, :CLASSES], v[None, CLASSES : CLASSES + width], v[None, -1]))
        return out

    # Once more without the texts that are far from all first references: these blur them.
    first = references_of([])
    references = references_of(first) if first else []
    references = references or first

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            n_words = got["n_words"].to_numpy()
            if references and b.num_rows:
                by_class, by_word = nearest(got["classes"], got["words"], n_words, references)
                shown = [pa.array(by_class, pa.float64()), pa.array(by_word, pa.float64())]
            else:
                by_class = by_word = np.zeros(b.num_rows)
                shown = [pa.nulls(b.num_rows, pa.float64())] * 2
            failed = got["base_failed"].to_numpy(zero_copy_only=False)
            long_enough = (n_words >= GUARD_WORDS) & (got["word_chars"].to_numpy() >= GUARD_CHARS)
            kept = ~failed & ~(long_enough & ((by_class + by_word) / 2 > max_distance))
            yield pa.RecordBatch.from_arrays(
                [got["key"], *(got[k] for k in base), got["base_failed"], pa.array(kept, pa.bool_()), *shown],
                [id_col, *base, "base_failed", "kept", "class_distance", "word_distance"],
            )

    return measured.mapInArrow(decide, f"`{id_col}` {kind}, {counted}, base_failed boolean, kept boolean, class_distance double, word_distance double")
