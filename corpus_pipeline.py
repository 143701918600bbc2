"""From raw documents to token ids: each stage works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampledger.llm import decontaminate, jaccard, language, pieces, repeats
from ampledger.llm.queries import LANGUAGE_FOLDS, PIECES, table
from ampledger.llm.scratch import stage
from ampledger.session import staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apart(docs: DataFrame) -> DataFrame:
    """The columns under names that no operator uses for its results; id, text and language keep theirs."""
    known = ("doc_id", "text", "lang")
    return docs.select(*(F.col(f"`{c}`").alias(c if c in known else f"user column {i}") for i, c in enumerate(docs.columns)))


def restored(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, from a frame that has them under the names of :func:`apart`."""
    return found.select(*(F.col(f"`{a}`").alias(c) for a, c in zip(apart(docs).columns, docs.columns)))


def row_key(docs: DataFrame) -> Column:
    """Names a row by all that it holds: rows with one key are equal. Keys order by id, null ids last."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), *(F.xxhash64(F.lit(k), *columns).alias(f"h{k}") for k in (1, 2))
    )


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told apart; learns from the labelled ones at hand.

    Null and empty texts, and texts without a letter, go. Rows are judged one
    by one, so repeated rows and ids and null ids stay or go by their text.
    Without any labelled text nothing can be judged, and all documents stay.
    Columns may have any names.
    """
    model = language.learn_dictionaries(docs.filter(~language.held_out("doc_id", LANGUAGE_FOLDS)))
    if not model:
        return docs
    judged = language.identify(apart(docs), model)
    return restored(judged.filter(~F.col("rejected")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the one with the smallest id.

    Null ids are greater than all others; of different rows with the smallest
    id of a group, the one with the smallest hash of its columns stays, and of
    equal rows one. Rows that repeat an id but not the text are documents of their own. Null
    texts and texts without a word have no duplicates and stay, all of them.
    Columns may have any names, but not the map type.
    """
    with staging(spark):
        found = jaccard.near_duplicates(docs.select(row_key(docs).alias("key"), "text"), id_col="key")
        chosen = found.filter(F.col("key").eqNullSafe(F.col("class_id"))).groupBy("key").agg(F.max("n_shingles").alias("words"), F.count("*").alias("rows"))
        chosen = stage(chosen.select(F.col("key").alias("kept key"), ((F.col("rows") > 1) & (F.col("words") > 0)).alias("repeated row")), "chosen", outlive=True)
    plain = apart(docs)
    # One key holds all columns in their order, whatever their names.
    kept = plain.withColumn("row key", row_key(plain)).join(chosen, F.col("row key").eqNullSafe(F.col("kept key")))
    once = kept.filter("not `repeated row`")
    return restored(once.union(kept.filter("`repeated row`").dropDuplicates(["row key"])), docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the byte strings out that earlier documents have.

    What is left of a character that was cut goes too; n_chars follows the
    text. Rows with one id, and null ids after all others, are not earlier than
    each other. Null texts become empty. Columns may have any names.
    """
    plain = apart(docs)
    others = [c for c in plain.columns if c not in ("doc_id", "text")]
    cleaned = repeats.remove_repeats(plain, carry=others, as_text=True).withColumn("text", F.col("kept"))
    return restored(cleaned, docs).withColumn("n_chars", F.length("text").cast("long")).select(*(F.col(f"`{c}`") for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the benchmark contaminates.

    Rows are judged one by one by their text, so repeated rows and ids and
    null ids stay or go with it; null and empty texts stay. Columns may have
    any names.
    """
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    with staging(spark):
        found = decontaminate.contamination(docs.select(key.alias("key"), "text"), table(spark, sf_dir, "benchmark"), id_col="key")
        bad = stage(found.filter("contaminated").select(F.col("key").alias("bad key")).distinct(), "bad", outlive=True)
    return restored(apart(docs).withColumn("text key", key).join(bad, F.col("text key").eqNullSafe(F.col("bad key")), "left_anti"), docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to: doc_id, ids, decoded, n_tokens.

    The documents' other columns end here. Null and empty texts have the begin
    and end ids alone; repeated rows and null ids are kept.
    """
    return pieces.encode_texts(docs, public_tokenizers.path(PIECES)).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeat_removal", repeat_removal),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: No stage can be expressed in SQL as a whole; the tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage stores for itself goes when it ends, its result when the run ends."""
    docs = table(spark, sf_dir, "documents")
    with staging(spark):
        for name, apply in STAGES[:-1]:
            with staging(spark):
                docs = stage(apply(spark, docs, sf_dir), name, outlive=True)
        name, apply = STAGES[-1]
        return stage(apply(spark, docs, sf_dir), name, outlive=True)
