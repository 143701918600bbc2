"""Operators over a whole corpus, and the pipeline, against brute force on small fixtures."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
pytest.importorskip("ampledger.llm")

from ampledger.llm import decontaminate, jaccard, lm, repeats  # noqa: E402
from ampledger.llm.components import components  # noqa: E402

RND = random.Random(5)
VOCABULARY = ["the", "of", "and", "Ünd", "x", *("w%d" % i for i in range(400))]


def prose(n):
    return " ".join(RND.choice(VOCABULARY) for _ in range(n))


def edited(text, n):
    words = text.split(" ")
    for _ in range(n):
        words[RND.randrange(len(words))] = "edit%d" % RND.randrange(1000)
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, nulls, empty, short, periodic and long texts, a repeated id, a null id."""
    base, passage = [prose(120) for _ in range(12)], prose(30)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 3]) for i in range(9)]
    rows += [(200 + i, edited(base[3 + i % 2], 1 + i % 4)) for i in range(24)]
    rows += [(300 + i, prose(40) + " " + passage + " " + prose(40)) for i in range(10)]
    rows += [(400, None), (401, ""), (402, " \n "), (403, "one two"), (404, "one two"), (405, "a" * 400), (406, "a" * 300), (407, prose(8000)), (408, "Ünd " * 30)]
    rows += [(5, base[7]), (None, base[0]), (None, prose(20)), (9, base[9])]
    RND.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "mine", 7) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, class_id int").repartition(3)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_classes(rows, words=5, threshold=0.8):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    members = collections.defaultdict(list)
    for k in range(len(rows)):
        members[find(k)].append(rows[k][0])
    least = {k: min((i for i in m if i is not None), default=None) for k, m in members.items()}
    return sorted((str(i), str(least[find(k)]), links[k]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates(docs, texts, monkeypatch, small):
    if small:  # buckets are split again, and dealt in blocks
        monkeypatch.setattr(jaccard, "BUCKET", 4)
        monkeypatch.setattr(jaccard, "BLOCK", 5)
    got = jaccard.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in got) == plain_classes(texts)
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_runs_reach_the_target():
    assert 1 - (1 - jaccard.met(jaccard.DEPTH)) ** jaccard.runs_for(0.999, jaccard.DEPTH) >= 0.999


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_repeats(rows, length=50):
    last = 2**63 - 1
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            first[w] = min(first.get(w, last), last if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < (last if i is None else i):
                gone[k : k + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((str(i), len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), kept.hex()))
    return sorted(out)


@pytest.mark.parametrize("common", [1000, 3])
def test_repeat_removal(docs, texts, monkeypatch, common):
    monkeypatch.setattr(repeats, "COMMON", common)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 4000)
    got = repeats.remove_repeats(docs, carry=["source", "class_id"]).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept"].hex()) for r in got) == plain_repeats(texts)
    assert {(r["source"], r["class_id"]) for r in got} == {("mine", 7)}
    assert repeats.remove_repeats(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs.withColumn("kept", F.lit(1)), carry=["kept"])


def test_indexes_stay_small(monkeypatch):
    """A shard's fragments are indexed in parts of whole minimizers, with the same marks."""
    fragments = [(RND.randrange(40), bytes(RND.choices(b"ab", k=52 + RND.randrange(9))), RND.randrange(30)) for _ in range(600)]
    fragments += [(k, body, RND.randrange(30)) for k, body, _ in RND.sample(fragments, 200)]
    # Windows belong to one minimizer: each has bytes of its own.
    texts = [bytes(b + 2 * k for b in body) for k, body, _ in fragments]
    keys, docs = (np.array([f[i] for f in fragments], kind) for i, kind in ((0, np.uint64), (2, np.int64)))
    sizes, built, plain = np.array([len(t) for t in texts]), [], repeats.RunIndex

    def spied(body, *args):
        built.append(len(body))
        return plain(body, *args)

    monkeypatch.setattr(repeats, "RunIndex", spied)
    found = [repeats.early_windows(keys, np.frombuffer(b"".join(texts), np.uint8), sizes, docs, 50).tolist()]
    assert len(built) == 1
    monkeypatch.setattr(repeats, "INDEX_BYTES", 4000)
    found.append(repeats.early_windows(keys, np.frombuffer(b"".join(texts), np.uint8), sizes, docs, 50).tolist())
    assert found[0] == found[1]
    assert len(built) > 10 and max(built[1:]) <= 4000
    firsts = {}
    for text, doc in zip(texts, docs):
        for at in range(len(text) - 49):
            firsts[text[at : at + 50]] = min(firsts.get(text[at : at + 50], 99), doc)
    for text, doc, marks in zip(texts, docs, found[1]):
        assert [bool(marks >> at & 1) for at in range(len(text) - 49)] == [firsts[text[at : at + 50]] < doc for at in range(len(text) - 49)]


@pytest.fixture(scope="module")
def items(spark, texts):
    by_id = dict(texts)
    rows = [
        ("b", " ".join(by_id[300].split(" ")[35:70])), ("a", " ".join(by_id[4].split(" ")[3:20])), ("a2", " ".join(by_id[4].split(" ")[3:20])),
        ("c", "one two"), ("d", None), ("e", "..."), (None, by_id[407][:400]), ("f", prose(40)), ("g", "ÜND! ünd; ünd"),
    ]
    return spark.createDataFrame([(*r, 1) for r in rows], "item_id string, text string, n_hit int")


def plain_hits(rows, tests):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = collections.defaultdict(set)
    for name, t in tests:
        w = cut(t)
        for k in range(max(1, len(w) - 12)) if w else []:
            windows[tuple(w[k : k + 13])].add(name or "")
    out = []
    for i, t in rows:
        w = cut(t)
        hit, found = set(), set()
        for window, names in windows.items():
            n = len(window)
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) == window:
                    hit.update(range(k, k + n))
                    found |= names
        out.append((str(i), len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WORDS, 40])
def test_contamination(docs, items, texts, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "SEGMENT_BYTES", 3000)
    index = decontaminate.stage(decontaminate.build_index(docs), "postings")
    found = decontaminate.find_phrases(index, items, block_words=block).collect()
    want = plain_hits(texts, [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted((str(r["key"]), r["n_words"], r["n_hit"], r["items"]) for r in found) == [x[:4] for x in want]
    judged = decontaminate.contamination(docs, items).collect()
    assert sorted((str(r["key"]), r["contaminated"]) for r in judged) == sorted((x[0], x[4]) for x in want)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).filter("n_hit > 0").count() == 0


def test_blocks_stay_small(spark):
    """A long item, one that repeats, and many items of one text make no large block; each name is found."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [("long", long), *[("again", "a b c d e f g h i j k l m n")] * 500, *[(f"same{i}", "one two three") for i in range(300)], (None, "one two three"), ("none", None)]
    items = spark.createDataFrame(rows, "item_id string, text string")
    phrases = decontaminate.distinct_phrases(items)
    assert phrases.count() == 30_000 - 12 + 2 + 1
    docs = spark.createDataFrame([(1, "x " + long), (2, "two three"), (3, "ONE two-three x"), (4, None)], "doc_id long, text string")
    index = decontaminate.stage(decontaminate.build_index(docs), "postings")
    for block in (decontaminate.BLOCK_WORDS, 50_000):
        found = {r["key"]: r for r in decontaminate.find_phrases(index, items, block_words=block).collect()}
        assert {k: r["n_hit"] for k, r in found.items()} == {1: 30_000, 2: 0, 3: 3, 4: 0}
        assert (found[1]["starts"], found[1]["ends"]) == ([1], [30_001])
        assert found[3]["items"] == sorted(["", *[f"same{i}" for i in range(300)]])


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha beta y y y gamma"), (3, "gamma beta alpha z")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "alpha beta gamma")], "item_id string, text string")
    index = decontaminate.stage(decontaminate.build_index(docs), "postings")
    near = {r["key"] for r in decontaminate.find_phrases(index, items, slop=1).filter("n_hit > 0").collect()}
    assert near == {1}
    assert decontaminate.find_phrases(index, items).filter("n_hit > 0").count() == 0


def test_language_model(docs, texts, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 3000)
    train = F.col("doc_id") % 3 != 0
    got = lm.score_texts(docs, train).collect()
    used = lambda i: i is not None and i % 3 != 0
    cut = [(i, [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\n"]) for i, t in texts]
    count = collections.Counter(w for i, ws in cut if used(i) for w in ws)
    total, distinct = sum(count.values()), len(count)
    want = sorted((str(i), used(i), len(ws), sum(count[w] > 0 for w in ws), round(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in ws), 6)) for i, ws in cut)
    assert sorted((str(r["doc_id"]), r["train"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {total}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    untrained = lm.score_texts(docs, F.lit(False)).collect()
    assert all(r["score"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in untrained)
    assert lm.score_texts(docs.limit(0), train).count() == 0


def plain_mixture(cut, used, back):
    """Scores by plain dictionaries: weights from held-back texts, counts of all that are learned from."""

    def counts(chosen):
        word, pair = collections.Counter(), collections.Counter()
        for i, ws in cut:
            if chosen(i):
                word.update(["", *ws])
                pair.update(zip(["", *ws], ws))
        return word, pair, sum(n for w, n in word.items() if w)

    word, pair, total = counts(lambda i: used(i) and i not in back)
    table = collections.Counter()
    for i, ws in cut:
        if used(i) and i in back:
            for a, b in zip(["", *ws], ws):
                steps = [round(-lm.STEPS * math.log2(x / y)) if x and y else -1 for x, y in ((pair[a, b], word[a]), (word[b], total))]
                table[(min(word[a].bit_length(), lm.CONTEXTS - 1), *steps)] += 1
    word, pair, total = counts(used)
    p0 = 1 / (len([w for w in word if w]) + 1)
    weights = {}
    for bucket in {k[0] for k in table}:
        w = [1 / 3] * 3 if bucket else [0, 0.5, 0.5]
        cells = [([2 ** (-x / lm.STEPS) if x >= 0 else 0 for x in k[1:]] + [p0], n) for k, n in table.items() if k[0] == bucket]
        for _ in range(lm.ROUNDS):
            parts = [[n * x * y / sum(map(math.prod, zip(w, p))) for x, y in zip(w, p)] for p, n in cells]
            sums = [sum(x) for x in zip(*parts)]
            w = [x / sum(sums) for x in sums]
        weights[bucket] = w
    for bucket in range(1, lm.CONTEXTS):
        weights.setdefault(bucket, weights[bucket - 1] if bucket - 1 in weights and bucket > 1 else [1 / 3] * 3)
    weights.setdefault(0, [0, 0.5, 0.5])
    scores = {}
    for i, ws in cut:
        score = 0
        for a, b in zip(["", *ws], ws):
            w = weights[min(word[a].bit_length(), lm.CONTEXTS - 1)]
            score += math.log10(w[0] * pair[a, b] / max(word[a], 1) + w[1] * word[b] / total + w[2] * p0)
        scores.setdefault(i, []).append(score)
    return scores


def test_mixture_by_brute_force(spark, sf_dir, monkeypatch):
    """Every score anew, with and without a held-back text, chunks smaller than the table."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", 20_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    back = {r["doc_id"] for r in docs.filter(lm.held_back()).collect()}
    cut = [(r["doc_id"], [*re.findall(r"[^\x20\x09-\x0D]+", lower(r["text"] or "")), "\n"]) for r in docs.collect()]
    third = F.col("doc_id") % 3 != 0
    for train, used in ((third, lambda i: i % 3 != 0), (third & ~lm.held_back(), lambda i: i % 3 != 0 and i not in back)):
        want = plain_mixture(cut, used, back)
        got = lm.score_texts(docs, train).collect()
        assert len(got) == len(cut)
        for r in got:
            assert any(abs(r["score"] - x) < 1e-6 * max(1, abs(x)) for x in want[r["doc_id"]]), r["doc_id"]


def test_mixture_beats_its_parts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = lm.held_out("doc_id")
    sums = lm.score_texts(docs, ~held).filter("not train").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_weights_add_up():
    weights = lm.learn_weights([(3, 4, 20, 100), (3, -1, 20, 50), (5, 2, -1, 10)], 1e-6)
    assert abs(weights.sum(axis=1) - 1).max() < 1e-9
    assert weights[3, 0] > weights[3, 2]


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = pipeline.table(spark, sf_dir, "documents")
    columns = docs.columns
    seen = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in pipeline.STAGES]
    for name, apply in pipeline.STAGES:
        docs = pipeline.stage(apply(spark, docs, sf_dir), name)
        rows = docs.collect()
        if name == names[-1]:
            assert [(r["doc_id"], r["decoded"]) for r in rows] == [(r["doc_id"], seen[r["doc_id"]]) for r in rows]
            assert {r["doc_id"] for r in rows} == set(seen)
            break
        assert docs.columns == columns
        now = {r["doc_id"]: r["text"] for r in rows}
        assert len(now) == len(rows)
        if name == "near_duplicates":
            assert set(now) == {int(c) for _, c, _ in plain_classes(list(seen.items()))}
        elif name == "repeat_removal":
            want = {int(x[0]): bytes.fromhex(x[4]).decode("utf-8", "ignore") for x in plain_repeats(list(seen.items()))}
            assert now == want
        elif name == "decontamination":
            tests = [(r["item_id"], r["text"]) for r in pipeline.table(spark, sf_dir, "benchmark").collect()]
            assert set(now) == {int(x[0]) for x in plain_hits(list(seen.items()), [(str(i), t) for i, t in tests]) if not x[4]}
        seen = now
    assert {r["doc_id"] for r in pipeline.run(spark, sf_dir).collect()} == set(seen)


def test_pipeline_on_an_empty_table(spark, sf_dir):
    import corpus_pipeline as pipeline

    docs = pipeline.table(spark, sf_dir, "documents").limit(0)
    for name, apply in pipeline.STAGES:
        docs = pipeline.stage(apply(spark, docs, sf_dir), name)
    assert docs.count() == 0
