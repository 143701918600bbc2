"""The pipeline's stages on odd tables: null and repeated ids, ties, long texts, clashing names."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
pytest.importorskip("ampledger.llm")

import corpus_pipeline as pipeline  # noqa: E402
from ampledger.session import staging  # noqa: E402

RND = random.Random(21)
NAMES = ["doc_id", "text", "lang", "source", "n_chars", "score", "kept", "key", "_bad", "lang_pred", "odd. name", "n_bytes"]
KINDS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, key string, _bad int, lang_pred string, `odd. name` int, n_bytes int"


def prose(n, words="the of and to in is that for it was with as his on be at by had not are but from or have an they which one you were all her".split()):
    return " ".join(RND.choice(words) + RND.choice(["", "s", "ing", "ed"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = [prose(60) for _ in range(20)]
    texts = [(i, t) for i, t in enumerate(base)]
    texts += [(30, base[0]), (None, base[0]), (None, base[1] + " more"), (None, prose(50)), (5, prose(40)), (5, base[6]), (5, base[5])]
    texts += [(31, None), (31, None), (32, ""), (33, " \n"), (None, None), (34, "123 456"), (35, prose(12_000)), (36, "tie word"), (36, "tie word"), (37, "Tie word")]
    twin = base[9] + " twin"
    out = [(i, t, "en" if k % 3 else None, "s%d" % (k % 2), len(t or ""), 7.0, "mine", "k", 1, "xx", 3, 9) for k, (i, t) in enumerate(texts)]
    out += [(40, twin, "en", "first", 1, 1.0, "a", "b", 1, "c", 1, 1), (9, twin, "en", "second", 2, 2.0, "a", "b", 1, "c", 1, 1)]
    out += [out[3], out[3]]
    RND.shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, KINDS).repartition(3)


def counted(frame):
    return Counter(map(repr, map(tuple, frame.collect())))


def test_language_stage_keeps_rows_as_they_are(spark, docs, sf_dir):
    got = pipeline.language_id(spark, docs, sf_dir)
    assert got.columns == NAMES
    kept, given = counted(got), counted(docs)
    assert not kept - given
    assert {tuple(r)[5:] for r in got.collect()} <= {tuple(r)[5:] for r in docs.collect()}
    assert got.filter("text is null or text = '' or doc_id = 34").count() == 0


def plain_groups(rows, words=5):
    def cut(t):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()

    sets = []
    for r in rows:
        w = cut(r[1])
        sets.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                label[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append((rows[k], bool(sets[k])))
    return groups.values()


def test_near_duplicates_lose_no_text(spark, docs, rows, sf_dir):
    got = pipeline.near_duplicates(spark, docs, sf_dir)
    assert got.columns == NAMES
    mine = counted(got)
    assert not mine - counted(docs)
    left = Counter(mine)
    for group in plain_groups(rows):
        if not group[0][1]:  # without a word: stays
            left[repr(group[0][0])] -= 1
            continue
        ids = [r[0] for r, _ in group if r[0] is not None]
        able = {repr(r) for r, _ in group if r[0] == min(ids, default=None)}
        found = [x for x in able if left[x]]
        assert len(found) == 1, group
        left[found[0]] -= 1
    assert not +left
    # An unrelated row changes nothing.
    fewer = counted(pipeline.near_duplicates(spark, docs.filter(~F.col("doc_id").eqNullSafe(35)), sf_dir))
    assert mine - fewer == Counter({repr(r): 1 for r in rows if r[0] == 35})


def test_later_stages_take_any_names(spark, docs, sf_dir, tmp_path):
    clean = pipeline.repeat_removal(spark, docs, sf_dir)
    assert clean.columns == NAMES and clean.count() == docs.count()
    assert {tuple(r)[5:] for r in clean.collect()} == {tuple(r)[5:] for r in docs.collect()}
    assert clean.filter("n_chars <> length(text)").count() == 0
    text = docs.filter("doc_id = 12").first()["text"]
    spark.createDataFrame([("q", text), ("r", None)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = pipeline.decontamination(spark, docs, str(tmp_path))
    assert got.columns == NAMES
    assert counted(docs) - counted(got) == counted(docs.filter("doc_id = 12"))
    assert pipeline.sentencepiece(spark, docs, sf_dir).count() == docs.count()


def tables(spark):
    top = spark.conf.get("spark.checkpoint.dir") + f"/staged-{spark.sparkContext.applicationId}"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_stages_leave_little_behind(spark, docs, sf_dir):
    before = tables(spark)
    with staging(spark):
        result = pipeline.run(spark, sf_dir)
        names = {x.rsplit("-", 1)[0] for x in tables(spark) - before}
        assert names == {"sentencepiece"}
        assert result.count() > 0
    assert tables(spark) == before
    kept = pipeline.near_duplicates(spark, docs, sf_dir)
    assert {x.rsplit("-", 1)[0] for x in tables(spark) - before} == {"chosen"}
    assert kept.count() > 0
