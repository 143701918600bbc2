"""Odd sketches and the components they lead to, against brute force."""

import random
import re

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
pytest.importorskip("ampledger.llm")

from pyspark.sql import functions as F  # noqa: E402

from ampledger.llm import oddsketch, queries  # noqa: E402
from ampledger.llm.membership import membership  # noqa: E402

RND = random.Random(12)
VOCABULARY = ["w%d" % i for i in range(600)]


def prose(n):
    return [RND.choice(VOCABULARY) for _ in range(n)]


def chain(words, steps):
    """Texts of which each is near the one before, and the last far from the first."""
    out = [list(words)]
    for k in range(steps):
        now = list(out[-1])
        now[(k * 9) % len(now)] = "step%d" % k
        out.append(now)
    return [" ".join(w) for w in out]


@pytest.fixture(scope="module")
def texts():
    rows = [" ".join(prose(RND.randrange(5, 150))) for _ in range(80)]
    rows += chain(prose(120), 40) + chain(prose(300), 60)
    rows += [rows[0], rows[0], rows[0].upper(), rows[1], None, None, "", " \n\t", "one two", "one two", "ONE two", "one two three", "Ünd " * 40, "ünd " * 40]
    rows += [" ".join(prose(20_000))]
    rows.append(rows[-1] + " more")
    ids = list(range(1000, 1000 + len(rows)))
    RND.shuffle(ids)
    out = list(zip(ids, rows)) + [(ids[3], rows[7]), (None, rows[0]), (None, " ".join(prose(50))), (None, None), (ids[9], rows[9])]
    RND.shuffle(out)
    return out


def plain(rows, percent=85):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                label[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        known = [x for x in (least.get(find(k)), i) if x is not None]
        least[find(k)] = min(known, default=None)
    return sorted(str((i, len(sets[k]), least[find(k)], i == least[find(k)])) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("small", [False, True])
def test_components_equal_brute_force(spark, texts, monkeypatch, small):
    if small:  # members outside the largest component meet the others in several blocks
        monkeypatch.setattr(oddsketch, "BLOCK", 3)
    docs = spark.createDataFrame([(*r, 4, "mine") for r in texts], "doc_id long, text string, c int, bands string").repartition(3)
    got = oddsketch.near_duplicate_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(texts)


def test_other_thresholds_and_empty_tables(spark, texts):
    docs = spark.createDataFrame([(f"d{i}" if i is not None else None, t) for i, t in texts[:90]], "name string, body string")
    got = oddsketch.near_duplicate_components(docs, "name", "body", percent=60).collect()
    assert sorted(str(tuple(r)) for r in got) == plain([tuple(r) for r in docs.collect()], 60)
    assert oddsketch.near_duplicate_components(docs.limit(0), "name", "body").count() == 0
    wordless = docs.select("name").limit(3).withColumn("body", F.lit(None).cast("string"))
    assert oddsketch.near_duplicate_components(wordless, "name", "body").filter("n_shingles = 0 and kept").count() == 3
    assert oddsketch.rows_for(0.85) == 5 and oddsketch.rows_for(0.6) < 3


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_odd_sketches"](spark, sf_dir).collect()
    assert sorted(str(tuple(r)) for r in got) == plain([tuple(r) for r in rows])


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**32, (200, oddsketch.SAMPLES), np.uint64).astype(np.uint32)
    for changed in (0, 10, 25):
        other = base.copy()
        for row in other:
            row[rng.choice(oddsketch.SAMPLES, changed, replace=False)] += np.uint32(1)
        ones = np.bitwise_count(oddsketch.odd_sketches(base) ^ oddsketch.odd_sketches(other)).sum(axis=1)
        told = np.mean([oddsketch.estimate(k) for k in ones])
        assert abs(told - (1 - changed / oddsketch.SAMPLES)) < 0.01
    assert oddsketch.estimate(oddsketch.BITS) == 0
    limit = oddsketch.most_ones(0.85)
    assert 35 < limit < 100 and oddsketch.estimate(limit + 1) < 0.85


def test_membership_has_no_false_negatives(spark):
    frame = spark.range(5000).select(F.xxhash64("id").alias("h"))
    every = np.array([r["h"] for r in frame.collect()])
    wanted = membership(frame.limit(1000), bits=1 << 16)
    seen = wanted.maybe(every)
    assert seen[np.isin(every, [r["h"] for r in frame.limit(1000).collect()])].all()
    assert seen.sum() < 1200
    assert not membership(frame.limit(0)).maybe(every).any()
