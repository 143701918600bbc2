"""Language-model scores by deleted interpolation.

Maximum-likelihood estimates of a word alone and after its predecessor are
mixed with a uniform share. The mixture weights depend on how often the
predecessor was seen. They are learned by expectation-maximisation on held-out
counts: a tenth of the training texts, chosen by their hash, is held back, and
its tokens are predicted from the counts of the other nine tenths. The scores
then use the counts of the whole training corpus with these weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampledger.llm.arrays import GOLDEN, LOWER, SPACE, mix, pack, pack_small, unpack, unpack_small, word_hashes
from ampledger.llm.chunks import bucket_bounds, bucket_count, open_chunk, pack_chunks
from ampledger.llm.scratch import stage
from ampledger.session import staging

CHUNK_BYTES = 2 << 20
#: Text bytes whose keys one bucket counts.
BUCKET_BYTES = 32 << 20
#: Hashes of the end of a text and of the place before its first word.
END = np.uint64(0xA0761D6478BD642F)
BEGIN = np.uint64(0xE7037ED1A0B428DB)
#: Pairs of words are told apart by their hash's upper bits; single words by all 64.
PAIR_LOW = np.uint64(0xFFFF)
#: Context-frequency buckets: 0 for an unseen context, then one per power of two.
CONTEXTS = 40
#: Steps per power of two in the table of held-out estimates.
STEPS = 4
ROUNDS = 50
#: One in so many training texts is held back to learn the weights from.
FOLDS = 10
#: Marks of texts: not learned from, counted, counted and held back.
UNUSED, COUNTED, HELD_BACK = 0, 1, 2


def held_out(id_col: str, parts: int = 7, part: int = 2) -> Column:
    """Whether a row is in the fold that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def held_back(text_col: str = "text") -> Column:
    """Whether a training text is in the fold that weights are learned from; equal texts share a fold."""
    return F.pmod(F.xxhash64(text_col), F.lit(FOLDS)) == 0


def chunk_tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, the pair key of each with the one before, and token offsets."""
    h, per_text = word_hashes(LOWER[raw], offsets, SPACE)
    n = len(per_text) - 1
    bounds = per_text + np.arange(n + 1)
    tokens = np.full(len(h) + n, END, np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[bounds[1:] - 1] = False
    tokens[inner] = h
    before = np.empty(len(tokens), np.uint64)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = BEGIN
    pairs = mix(before * GOLDEN + mix(tokens)) | PAIR_LOW
    return tokens, pairs, bounds


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64) + 1, CONTEXTS - 1), 0)


def learn_weights(table: list[tuple[int, int, int, int]], p0: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of pair, word and uniform share for each context bucket, by expectation-maximisation.

    ``table``: bucket, pair and word estimates as steps below 1 (-1 for none),
    and how many held-back tokens have them. A bucket that no held-back token
    has takes the weights of the next lower one that has; without any, the
    estimates there are count alike.
    """
    weights = np.full((CONTEXTS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    if not table:
        return weights
    bucket, pair, word, n = np.array(table, np.float64).T
    bucket = bucket.astype(np.int64)
    p = np.stack([np.where(pair >= 0, 2.0 ** (-pair / STEPS), 0), np.where(word >= 0, 2.0 ** (-word / STEPS), 0), np.full(len(n), p0)], axis=1)
    seen = np.bincount(bucket, n, CONTEXTS) > 0
    for _ in range(rounds):
        share = weights[bucket] * p
        share *= (n / share.sum(axis=1))[:, None]
        total = np.stack([np.bincount(bucket, share[:, k], CONTEXTS) for k in range(3)], axis=1)
        weights[seen] = total[seen] / total[seen].sum(axis=1, keepdims=True)
    for b in range(2, CONTEXTS):
        if not seen[b] and seen[1:b].any():
            weights[b] = weights[b - 1]
    return weights


def estimate_steps(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Shares as steps below 1, -1 for those of 0."""
    known = (part > 0) & (whole > 0)
    return np.where(known, np.round(-STEPS * np.log2(np.maximum(part, 1) / np.maximum(whole, 1))), -1).astype(np.int64)


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: id, train, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words (A-Z lower-cased) and one end. Null and empty texts
    have the end alone. A null ``train`` counts as false. ``base_score`` is the
    add-one unigram score; without any training text it and ``score`` use the
    uniform share 1 / (V + 1) = 1. Repeated rows count as often as they occur.
    Where no training text is held back, the estimates are mixed alike.
    """
    spark = docs.sparkSession
    with staging(spark):
        counted = _count(docs, train, id_col, text_col)
    return _score(counted, id_col, rounds)


def _count(docs: DataFrame, train: Column, id_col: str, text_col: str) -> DataFrame:
    """Stored chunks with the counts of each token's word and pair, in training and in its held-back part.

    The held-back counts are those of held-back tokens alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"), F.when(~F.coalesce(train, F.lit(False)), UNUSED).when(held_back(text_col), HELD_BACK).otherwise(COUNTED).alias("flag"))
    chunks = pack_chunks(rows, CHUNK_BYTES)
    buckets = bucket_count(chunks, CHUNK_BYTES, BUCKET_BYTES)
    bounds = bucket_bounds(buckets)

    def opened(sizes: bytes, body: bytes):
        raw, offsets = open_chunk(sizes, body)
        tokens, pairs, upto = chunk_tokens(raw, offsets)
        words, word_at = np.unique(tokens, return_inverse=True)
        both, pair_at = np.unique(pairs, return_inverse=True)
        return words, word_at, both, pair_at, upto

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, word_at, both, pair_at, upto = opened(batch.column("sizes")[i].as_py(), batch.column("body")[i].as_py())
                marks = np.repeat(np.array(batch.column("flags")[i].as_py(), np.int8), np.diff(upto))
                out = []
                for keys, at, low in ((words, word_at, 0), (both, pair_at, 16)):
                    n, back = (np.bincount(at[marks >= least], minlength=len(keys)) for least in (COUNTED, HELD_BACK))
                    cuts = np.append(np.searchsorted(keys, bounds), len(keys))
                    out.append([(pack(keys[a:b] >> np.uint64(low)), pack_small(n[a:b]), pack_small(back[a:b])) for a, b in zip(cuts[:-1], cuts[1:])])
                chunk = batch.column("chunk")[i].as_py()
                single, double = out
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(buckets), pa.int32()),
                        pa.array([chunk] * buckets, pa.int64()),
                        *(pa.array([x[k] for x in column], pa.binary()) for column in (single, double) for k in (0, 1, 2)),
                    ],
                    ["bucket", "chunk", "words", "word_counts", "word_backs", "pairs", "pair_counts", "pair_backs"],
                )

    def add_up(table: pa.Table) -> pa.Table:
        told, facts = {"chunk": table.column("chunk"), "bucket": table.column("bucket")}, {}
        for name in ("word", "pair"):
            keys = [unpack(x) for x in table.column(name + "s").to_pylist()]
            counts, backs = ([unpack_small(x) for x in table.column(f"{name}_{kind}").to_pylist()] for kind in ("counts", "backs"))
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            total, back = (np.bincount(at, np.concatenate(each), len(distinct)).astype(np.int64) for each in (counts, backs))
            places = np.split(at, np.cumsum([len(k) for k in keys])[:-1])
            told[name + "s"] = pa.array([pack_small(np.minimum(total[p], 2**32 - 1)) for p in places], pa.binary())
            # Only held-back tokens ask for the counts without their fold.
            told[name + "_backs"] = pa.array([pack_small(np.minimum(back[p[b > 0]], 2**32 - 1)) for p, b in zip(places, backs)], pa.binary())
            facts = facts or {"tokens": int(total.sum()), "back": int(back.sum()), "distinct": int((total > 0).sum())}
        for name, value in facts.items():
            told[name] = pa.array([value] * table.num_rows, pa.int64())
        return pa.table(told)

    asked = chunks.select("chunk", "sizes", "body", "flags").mapInArrow(ask, "bucket int, chunk long, words binary, word_counts binary, word_backs binary, pairs binary, pair_counts binary, pair_backs binary")
    answered = asked.groupBy("bucket").applyInArrow(add_up, "chunk long, bucket int, words binary, word_backs binary, pairs binary, pair_backs binary, tokens long, back long, distinct long")

    def meet(own: pa.Table, told: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        _, word_at, _, pair_at, upto = opened(row["sizes"], row["body"])
        told = told.sort_by("bucket")
        is_back = np.repeat(np.array(row["flags"], np.int8) == HELD_BACK, np.diff(upto))
        whole = lambda name: np.concatenate([unpack_small(x) for x in told.column(name).to_pylist()])
        made = {"keys": own.column("keys"), "flags": own.column("flags"), "upto": pa.array([pack(upto)], pa.binary())}
        for name, at in (("word", word_at), ("pair", pair_at)):
            asked_at = at[is_back]
            made[name + "s"] = pa.array([pack_small(whole(name + "s")[at])], pa.binary())
            # The answers are in the order of the keys that held-back tokens have.
            made[name + "_backs"] = pa.array([pack_small(whole(name + "_backs")[np.unique(asked_at, return_inverse=True)[1]])], pa.binary())
        for name in ("tokens", "back", "distinct"):
            made[name] = pa.array([sum(told.column(name).to_pylist())], pa.int64())
        return pa.table(made)

    schema = f"keys array<{kind}>, flags array<int>, upto binary, words binary, word_backs binary, pairs binary, pair_backs binary, tokens long, back long, distinct long"
    return stage(chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(meet, schema), "counted", outlive=True)


def _score(counted: DataFrame, id_col: str, rounds: int) -> DataFrame:
    kind = counted.schema["keys"].dataType.elementType.simpleString()
    marked = lambda least: F.sum(F.size(F.filter("flags", lambda f: f >= least)))
    facts = counted.agg(F.max("tokens"), F.max("back"), F.max("distinct"), marked(COUNTED), marked(HELD_BACK)).first()
    total, total_back, distinct, docs_in, docs_back = (x or 0 for x in facts)
    p0 = 1 / (distinct + 1)

    def counts_of(batch: pa.RecordBatch, i: int):
        return (
            unpack(batch.column("upto")[i].as_py()).astype(np.int64),
            *(unpack_small(batch.column(name)[i].as_py()).astype(np.int64) for name in ("words", "pairs")),
            np.array(batch.column("flags")[i].as_py(), np.int8),
        )

    def contexts(word: np.ndarray, starts: np.ndarray, texts: int) -> np.ndarray:
        context = np.empty(len(word), np.int64)
        context[1:] = word[:-1]
        context[starts] = texts
        return context

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Held-back tokens by context bucket and estimates from the other texts."""
        sums = {}
        for batch in batches:
            for i in range(batch.num_rows):
                upto, word, pair, flags = counts_of(batch, i)
                sizes = np.diff(upto)
                is_back = np.repeat(flags == HELD_BACK, sizes)
                word, pair = (x[is_back] - unpack_small(batch.column(name)[i].as_py()) for x, name in ((word, "word_backs"), (pair, "pair_backs")))
                sizes = sizes[flags == HELD_BACK]
                context = contexts(word, np.cumsum(sizes) - sizes, docs_in - docs_back)
                # A pair can't be more frequent than its context but by equal hashes.
                steps = estimate_steps(np.minimum(pair, context), context), estimate_steps(word, np.full(len(word), total - total_back))
                code = (context_bucket(context) * 1024 + steps[0] + 1) * 1024 + steps[1] + 1
                for k, n in zip(*(x.tolist() for x in np.unique(code, return_counts=True))):
                    sums[k] = sums.get(k, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], ["code", "n"])

    # At most CONTEXTS * 1024 * 1024 codes; a few thousand occur.
    cells = counted.select("upto", "words", "word_backs", "pairs", "pair_backs", "flags").mapInArrow(predicted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    weights = learn_weights([(r["code"] >> 20, (r["code"] >> 10 & 1023) - 1, (r["code"] & 1023) - 1, r["n"]) for r in cells], p0, rounds)
    if not total:  # nothing was learned from
        weights[0] = 0, 0, 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                upto, word, pair, flags = counts_of(batch, i)
                begins = upto[:-1]
                context = contexts(word, begins, docs_in)
                base = np.log10((word + 1) / (total + (distinct + 1)))
                w = weights[context_bucket(context)]
                p = w[:, 0] * np.minimum(pair, context) / np.maximum(context, 1) + w[:, 1] * word / max(total, 1) + w[:, 2] * p0
                add = lambda x: np.add.reduceat(x, begins) if len(begins) else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("keys")[i].values,
                        pa.array(flags >= COUNTED, pa.bool_()),
                        pa.array(np.diff(upto), pa.int64()),
                        pa.array(add((word > 0).astype(np.int64)), pa.int64()),
                        pa.array(np.full(len(flags), total), pa.int64()),
                        pa.array(add(base), pa.float64()),
                        pa.array(add(np.log10(p)), pa.float64()),
                    ],
                    [id_col, "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return counted.mapInArrow(score, f"`{id_col}` {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
