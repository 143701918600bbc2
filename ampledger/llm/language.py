"""Language identification by compression.

A bounded sample of labelled text per language, in lower case, becomes the
raw-content dictionary of a Zstandard compressor. A text is cut into blocks, every block
is compressed with every dictionary, and the language whose blocks are
smallest in total is predicted. The relative distance to the runner-up is the
score; narrow distances are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampledger.llm.arrays import give_back, text_bytes

UNDETERMINED = "und"
#: The labelled sample that a dictionary is made of: rows and characters of each, per language.
SAMPLE_ROWS = 64
SAMPLE_CHARS = 2000
#: Bytes of text that are compressed at a time.
BLOCK = 1024
LEVEL = 6
#: Scores below this are rejected.
MARGIN = 0.003
#: Most languages that a model may hold; more raise an error.
MAX_LANGUAGES = 500


def learn_dictionaries(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", key_col: str = "doc_id", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """A raw-content dictionary per language from at most ``rows`` texts of ``chars`` characters each.

    Rows without a label or without a letter are passed over. The sample is the
    rows of the smallest key hashes, the same in every run, and its size does
    not depend on the table's.
    """
    frame = labelled.select(F.col(lang_col).alias("_lang"), F.lower(F.substring(text_col, 1, chars)).alias("_text"), F.xxhash64(F.col(key_col)).alias("_h"))
    frame = frame.filter(F.col("_lang").isNotNull() & F.col("_text").rlike(r"\p{L}"))
    ranked = frame.withColumn("_rank", F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_text")))
    texts: dict[str, list[str]] = {}
    for row in ranked.filter(F.col("_rank") <= rows).orderBy("_lang", "_rank").limit(MAX_LANGUAGES * rows + 1).collect():
        texts.setdefault(row["_lang"], []).append(row["_text"])
    if len(texts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {lang: "\n".join(parts).encode() for lang, parts in texts.items()}


def _sizes(raw: np.ndarray, offsets: np.ndarray, compressors: list) -> np.ndarray:
    """Compressed bytes of every text by language."""
    out = np.zeros((len(offsets) - 1, len(compressors)), np.int64)
    data = memoryview(np.ascontiguousarray(raw))
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for at in range(a, b, BLOCK):
            block = data[at : min(at + BLOCK, b)]
            for k, c in enumerate(compressors):
                out[i, k] += len(c.compress(block))
    return out


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """Add lang_pred, score (0 to 1) and rejected to every row; the text alone decides.

    Null and empty texts and texts without a letter are ``und``, score 0 and
    rejected. Equal sizes take the alphabetically first language with score 0,
    which is rejected. With a single learned language every text with a letter
    gets it, score 1. Columns of the input that have one of the three names
    are replaced. No shuffle.
    """
    if not dictionaries:
        raise ValueError("no language was learned")
    names = ["lang_pred", "score", "rejected"]
    rest = docs.drop(*names)
    if text_col not in rest.columns:
        raise ValueError(f"the text column is named as a result: {text_col}")
    columns = rest.columns
    at = columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    langs = sorted(dictionaries)
    model = [dictionaries[k] for k in langs]

    def build() -> list:
        out = []
        for raw in model:
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Made anew for a task: a worker that goes on to other steps would hold them.
        compressors = build()
        for batch in batches:
            texts = batch.column(at)
            has = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            raw, offsets = text_bytes(pc.utf8_lower(texts.filter(pa.array(has))))
            sizes = _sizes(raw, offsets, compressors)
            pred = np.full(len(has), UNDETERMINED, object)
            score = np.zeros(len(has))
            if len(sizes):
                best = sizes.argmin(axis=1)
                pred[has] = np.array(langs, object)[best]
                if len(langs) > 1:
                    two = np.partition(sizes, 1, axis=1)[:, :2]
                    score[has] = (two[:, 1] - two[:, 0]) / np.maximum(two[:, 1], 1)
                else:
                    score[has] = 1.0
            rejected = ~has | (score < margin) & (len(langs) > 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [*columns, *names],
            )
        del compressors
        give_back()

    return rest.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(id_col: str, parts: int = 5) -> Column:
    """Whether a row is in the fold that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == 0, F.lit(False))
