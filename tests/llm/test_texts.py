"""Operators that look at one text at a time, against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
pytest.importorskip("ampledger.llm")

from ampledger.llm import language, licenses, pieces, quality, tokenfiles, urls  # noqa: E402
from ampledger.llm.arrays import pack, pack_small, unpack, unpack_small  # noqa: E402
from ampledger.llm.wordcache import WordCache  # noqa: E402

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "  a  b ", "a\nb\tc", "<s> x </s>", "▁a", "a\0b", "é ﬁ 🙂 𓀀", "x" * 3000, "ab cd" * 200, "It's. the, x.'s", "<|endoftext|> <|ENDOFTEXT|>", "ΑΣ ΣΑΣ. x,.y 12.5", "same", "same"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named as results."""
    rows = [(i if i % 7 else None, t, "xx", 1.5, "mine") for i, t in enumerate(ODD)] + [(3, "  a  b ", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double, kept string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def noise(alphabet, n, most, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(most))) for _ in range(n)]


def test_packed_integers_come_back():
    values = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, np.uint64))
    assert np.array_equal(unpack(pack(values)), values)
    small = np.random.default_rng(2).integers(0, 2**32, 1000, np.uint64).astype(np.uint32)
    assert np.array_equal(unpack_small(pack_small(small)), small)
    assert len(unpack(b"")) == len(unpack_small(b"")) == 0


def test_word_cache_grows_and_finds():
    cache = WordCache(bits=3)
    h = np.arange(1, 2001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for part in np.split(h, 10):
        cache.add(part, part, np.arange(len(part), dtype=np.int32), np.ones(len(part), np.int64))
    assert np.array_equal(cache.find(h, h), np.arange(2000))
    assert (cache.find(h + np.uint64(1), h) == -1).all()


def test_both_agendas_equal_the_library():
    model = pieces.Pieces(PIECES)
    texts = [t or "" for t in ODD] + noise("ab ▁é\n<>s/🙂中the in", 800, 80)
    flat, offsets = pieces.encode_batch(model, pa.array(texts), WordCache())
    for i, t in enumerate(texts):
        want = model.library.encode(t)
        assert flat[offsets[i] : offsets[i + 1]].tolist() == want
        whole = (pieces.MARK + t).replace(" ", pieces.MARK) if t else ""
        assert model.heap_encode(whole) == want


def test_encoded_rows(odd, none):
    rows = pieces.encode_texts(odd, PIECES).collect()
    library = pieces.Pieces(PIECES).library
    assert len(rows) == odd.count()
    want = sorted((str(r["doc_id"]), [1, *library.encode(r["text"] or ""), 2], library.decode(library.encode(r["text"] or ""))) for r in odd.collect())
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in rows) == want
    digests = pieces.encode_digests(odd, PIECES).collect()
    assert sorted(r["ids_sha256"] for r in digests) == sorted(hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest() for r in rows)
    assert pieces.encode_texts(none, PIECES).count() == 0


def test_language_of_odd_texts(spark, odd, none, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.learn_dictionaries(docs.filter(~language.held_out("doc_id")))
    judged = language.identify(odd, model)
    assert judged.columns == ["doc_id", "text", "kept", "lang_pred", "score", "rejected"]
    for r in judged.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert 0 <= r["score"] <= 1
        assert letters or (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        assert not letters or r["lang_pred"] in model
    assert language.identify(none, model).count() == 0
    assert language.learn_dictionaries(docs.limit(0)) == {}
    with pytest.raises(ValueError):
        language.identify(odd, {})


def test_language_of_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = docs.filter(language.held_out("doc_id") & (F.length("text") > 200))
    judged = language.identify(held, language.learn_dictionaries(docs.filter(~language.held_out("doc_id"))))
    right = judged.filter("lang = lang_pred").count()
    assert right >= 0.95 * held.count()
    assert judged.filter("rejected").count() <= 0.05 * held.count()


def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup, windows, covered = set(), 0, {}, set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in windows.values():
        if len(at) > 1:
            covered.update(k for i in at for k in range(i, i + 8))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_quality_counts(spark, sf_dir):
    extra = [(10**6 + i, t, "en") for i, t in enumerate([*ODD, "\n\n a\na\na \n a", "a b c d e f g h " * 3, *noise("a b\n#é", 60, 90)])]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").union(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = quality.judge_quality(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts = plain_quality(texts[r["doc_id"]])
        assert counts == tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert r["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r["base_failed"] and r["kept"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [r for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in good) >= 0.98 * len(good)


def test_common_words_are_counted_over_whole_texts_and_all_rows(spark):
    names = ["".join(chr(97 + int(d)) for d in f"{i:04d}") for i in range(200)]
    # 60 words that come twice, then 48 that come five times, in one text of about 4,900 characters.
    late = " ".join([*(n * 7 for n in names[:60] * 2), *(names[60:108] * 5)])
    # 50 words, one a row; the last two come once less than the others.
    rows = [(i, names[110 + i % 50], "b") for i in range(500 - 52)] + [(1000 + i, names[110 + k], "b") for i, k in enumerate([48, 49])]
    counts = {n: sum(t == n for _, t, _ in rows) for n in names[110:160]}
    best = sorted(counts, key=lambda n: (-counts[n], n))[: quality.COMMON]
    docs = spark.createDataFrame([(-1, late, "a"), *rows, (-2, None, "a"), (-3, "none", None)], "doc_id long, text string, lang string")
    assert quality.common_words(docs, "lang", "text") == sorted([*names[60:108], *best])


def test_quality_without_labels_or_rows(odd, none):
    blank = odd.withColumn("lang", F.lit(None).cast("string"))
    rows = quality.judge_quality(blank).collect()
    assert len(rows) == odd.count()
    assert all(r["kept"] == (not r["base_failed"]) and r["class_distance"] is None for r in rows)
    assert quality.judge_quality(none.withColumn("lang", F.lit("en"))).count() == 0


def test_licenses(spark, none):
    grant = licenses.TEMPLATES["MIT grant"]
    edited = grant.replace("free of charge, ", "at no cost ").replace("without restriction", "with no restriction")
    texts = [
        "é one two " + licenses.TEMPLATES["Apache-2.0"] + " three\nReleased under the MIT License",
        edited,
        "Licensed under the Apache",
        licenses.TEMPLATES["MIT"] + " " + licenses.TEMPLATES["MIT"],
        None,
        "",
        "word " * 5000,
    ]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, coverage double")
    found = {}
    for r in licenses.scan_licenses(docs).collect():
        found.setdefault(r["doc_id"], []).append((r["license"], r["coverage"], texts[r["doc_id"]][r["start_char"] : r["end_char"]]))
    assert ("Apache-2.0", 1.0, "Licensed under the Apache License, Version 2.0") in found[0]
    assert ("MIT", 1.0, "Released under the MIT License") in found[0]
    assert [x[0] for x in found[1]] == ["MIT grant"] and 0.9 < found[1][0][1] < 1
    assert [x[0] for x in found[3]] == ["MIT", "MIT"]
    assert set(found) <= {0, 1, 2, 3} and all(x[1] < 1 for x in found.get(2, []))
    assert licenses.scan_licenses(none).count() == 0
    with pytest.raises(ValueError):
        licenses.scan_licenses(docs, {"x": "a " * (licenses.MAX_TEMPLATE_WORDS + 1)})


def test_a_text_matches_alike_in_any_batch(spark):
    rnd = random.Random(8)
    words = [w for t in licenses.TEMPLATES.values() for w in t.split()]
    texts = [" ".join(licenses.TEMPLATES[rnd.choice(sorted(licenses.TEMPLATES))].split()[: rnd.randrange(1, 60)] + [rnd.choice(words) for _ in range(rnd.randrange(4))]) for _ in range(60)]
    texts += [None, "", "the MIT License", "the MIT", texts[0], texts[0]]

    def scanned(order):
        docs = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id long, text string").coalesce(1)
        return sorted(tuple(r) for r in licenses.scan_licenses(docs).collect())

    order = list(range(len(texts)))
    whole = scanned(order)
    rnd.shuffle(order)
    assert whole and scanned(order) == whole
    alone = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(len(texts), "doc_id")
    assert sorted(tuple(r) for i in range(0, 60, 7) for r in licenses.scan_licenses(alone.filter(F.col("doc_id") == i)).collect()) == [x for x in whole if x[0] % 7 == 0 and x[0] < 60]
    null_ids = spark.createDataFrame([(None, licenses.TEMPLATES["MIT"])] * 2, "doc_id long, text string")
    assert [tuple(r)[:2] for r in licenses.scan_licenses(null_ids).collect()] == [(None, "MIT")] * 2


def test_prints_are_kept_within_texts():
    rng = np.random.default_rng(4)
    for window in (2, 4):
        sizes = rng.integers(0, 9, 50)
        codes = rng.integers(0, 6, sizes.sum()).astype(np.uint64)
        ends = np.cumsum(sizes)
        want = set()
        for a, b in zip(ends - sizes, ends):
            for k in range(a, max(b - window + 1, a + (b > a))):
                part = codes[k : min(k + window, b)]
                want.add(int(k + max(i for i in range(len(part)) if part[i] == part.min())))
        assert licenses.winnow(codes, ends - sizes, ends, window).tolist() == sorted(want)


def test_too_many_languages_are_refused(spark):
    rows = [(i, " ".join("word%d" % (k % 40) for k in range(30 + i % 3)), "l%03d" % i) for i in range(quality.MAX_LANGUAGES + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        quality.judge_quality(docs)
    assert quality.judge_quality(docs.limit(quality.MAX_LANGUAGES)).count() == quality.MAX_LANGUAGES


def test_url_rules_and_model(spark):
    rows = [
        (1, "https://WWW.Example.NET/en/1?x=/de/"), (2, "http://example.net/de/1"), (3, "https://a.example.com/de/x"), (4, "ftp://b.org/fr/#t"),
        (5, None), (6, "no scheme"), (7, "https://example.net"), (8, "https://casino-win.example.com/en/1"), (9, "https://blog.thered.example.com/en/1"),
        (9, "https://blog.thered.example.com/en/1"), (10, ""), (11, "https://notexample.com/de/"), (12, "https://" + "a" * 5000 + ".net/"),
    ]
    pages = spark.createDataFrame([(*r, "taken") for r in rows], "page_id long, url string, verdict string")
    weights = urls.train(urls.default_labels(spark))
    assert weights == urls.train(urls.default_labels(spark))
    got = {r["page_id"]: r for r in urls.judge(pages, weights).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert (got[2]["rule"], got[2]["verdict"]) == ("net/", "block")
    assert (got[3]["rule"], got[3]["verdict"]) == ("example.com/de/", "block")
    assert (got[4]["rule"], got[4]["verdict"], got[4]["path"]) == ("org/fr/", "allow", "/fr/")
    assert all((got[i]["host"], got[i]["path"], got[i]["rule"]) == ("", "", None) for i in (5, 6, 10))
    assert (got[7]["host"], got[7]["path"], got[7]["rule"]) == ("example.net", "", None)
    assert got[8]["verdict"] == "block" and got[9]["verdict"] == "allow"
    assert got[11]["rule"] is None and got[12]["rule"] == "net/"
    assert urls.judge(pages, weights).count() == len(rows) and urls.judge(pages.limit(0), weights).count() == 0


def test_coder_round_trip():
    rnd = np.random.default_rng(3)
    ids = np.minimum(rnd.zipf(1.3, 300_000), 40_000).astype(np.int64)
    used, counts = np.unique(ids, return_counts=True)
    freq = tokenfiles.shared_table(used, counts)
    assert freq.sum() == 1 << tokenfiles.SCALE and (freq[used] > 0).all()
    coder = tokenfiles.Coder(freq)
    for n in (0, 1, 255, 256, 257, 32768, 32769, len(ids)):
        assert np.array_equal(coder.decode(*coder.encode(ids[:n]), n), ids[:n])
    single = tokenfiles.Coder(tokenfiles.shared_table(np.array([5]), np.array([10])))
    assert np.array_equal(single.decode(*single.encode(np.full(1000, 5)), 1000), np.full(1000, 5))


def test_chunked_tokens_equal_the_library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    texts = [t or "" for t in ODD] + noise(".,' aBtΣ́é\n<|>s/🙂0the", 800, 60)
    for group in (texts, [t for t in texts if "<|" not in t]):
        flat, offsets = tokenfiles.tokenize(pa.array(group), tokenizer, WordCache())
        for i, t in enumerate(group):
            assert flat[offsets[i] : offsets[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_token_files(spark, odd, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    path = tokenfiles.corpus_files(odd, WORDS)
    rows = sorted(tokenfiles.read_ids(spark, path).collect(), key=lambda r: r["start"])
    keys = [r["key"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    want = sorted((str(r["doc_id"]), [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]) for r in odd.collect())
    assert sorted((str(r["key"]), r["ids"]) for r in rows) == want
    at = 0
    for r in rows:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        at += len(r["ids"])
    crc = {r["start"]: r["ids_crc32"] for r in tokenfiles.read_ids(spark, path, digest=True).collect()}
    assert all(crc[r["start"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)
    assert tokenfiles.read_ids(spark, tokenfiles.corpus_files(none, WORDS)).count() == 0
