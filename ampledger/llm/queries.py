"""The registered queries of this package: every operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampledger.llm import decontaminate, dialogue, jaccard, language, licenses, lm, oddsketch, pieces, quality, repeats, runs, tokenfiles, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
LANGUAGE_FOLDS = 5


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language.held_out("doc_id", LANGUAGE_FOLDS)
    model = language.learn_dictionaries(docs.filter(~held))
    return language.identify(docs.select("doc_id", "text", held.alias("held_out")), model).drop("text")


@query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = urls.train(urls.default_labels(spark))
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), weights)
    return judged.select("page_id", "host", "path", "rule", "verdict", "probability")


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenfiles.corpus_files(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))
    return tokenfiles.read_ids(spark, path, digest=True).withColumnRenamed("key", "doc_id")


@query("op10_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_lm_score")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = lm.held_out("doc_id")
    scored = lm.score_texts(table(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op4_repeat_removal")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = dialogue.damage(table(spark, sf_dir, "conversations"))
    repaired = dialogue.repair_conversations(damaged, present=F.col("here"))
    rows = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    digest = F.sha2(F.array_join(rows, "\n").cast("binary"), 256)
    return repaired.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", digest.alias("repaired_sha256"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(runs.plant_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op12_odd_sketches")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.near_duplicate_components(table(spark, sf_dir, "documents"))
