"""Periodic runs and conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
pytest.importorskip("ampledger.llm")

from ampledger.llm import dialogue, queries, runs  # noqa: E402

RND = random.Random(11)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_runs(words, least=24, times=3):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            if len(run) >= max(least, times * q) and not any(run[r:] == run[:-r] for r in range(1, q)):
                out.append((i, len(run), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def plain_row(words):
    found = plain_runs(words)
    best = (None,) * 4
    for s, n, q in found:
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    return (len(found), *best, found, plain_collapsed(words, found))


def noisy(n, kinds):
    words = [RND.choice("abcdefghijklmnopqrstuvwxyz"[:kinds]) for _ in range(n)]
    for _ in range(RND.randrange(3)):
        a = RND.randrange(max(n, 1))
        p = RND.randrange(1, max(2, (n - a) // 3 + 1))
        for i in range(a, RND.randrange(a, n + 1)):
            words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_brute_force():
    for _ in range(400):
        words = noisy(RND.randrange(150), RND.choice([1, 2, 3, 26]))
        start, length, period = runs.find_runs(np.array([ord(w) for w in words], np.int64))
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == plain_runs(words)
    for least, times in ((1, 3), (9, 4), (100, 3)):
        words = noisy(200, 2)
        start, length, period = runs.find_runs(np.array([ord(w) for w in words], np.int64), least, times)
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == plain_runs(words, least, times)
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(3, np.int64), 24, 2)


def test_equal_exponents_are_compared_exactly():
    assert runs.best_run(np.array([30, 60, 31]), np.array([10, 20, 10])) == 2
    assert runs.best_run(np.array([30, 60]), np.array([10, 20])) == 0
    assert runs.best_run(np.array([10**9 + 1, 10**9 + 2]) * 3, np.array([10**9, 10**9 + 1])) == 0


@pytest.fixture(scope="module")
def run_texts():
    texts = [" ".join(noisy(RND.randrange(200), RND.choice([1, 2, 26]))) for _ in range(60)]
    texts += [None, "", " \n\t ", "ü ü\n" * 40, "a b " * 11 + "a", "a b " * 12, " x" * 9000, "one word " * 30, texts[0], texts[0]]
    return [(i if i % 9 else None, t, "mine", 3) for i, t in enumerate(texts)]


def test_periodic_runs(spark, run_texts, monkeypatch):
    docs = spark.createDataFrame(run_texts, "doc_id long, text string, runs string, period int").repartition(3)
    got = runs.periodic_runs(docs).collect()
    want = [(i, *plain_row(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, _ in run_texts if t is None or len(t) < 10000]
    want.append((66 if 66 % 9 else None, 1, 0, 9000, 1, 9_000_000, [(0, 9000, 1)], "x"))
    mine = [(r["doc_id"], r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got]
    assert Counter(map(repr, mine)) == Counter(map(repr, want))
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_a_text_has_the_same_runs_in_any_batch(spark, run_texts, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, (_, t, _, _) in enumerate(run_texts)], "doc_id long, text string").coalesce(1)
    whole = sorted(runs.periodic_runs(docs).collect())
    monkeypatch.setattr(runs, "PART_BYTES", 1)
    assert sorted(runs.periodic_runs(docs).collect()) == whole


def test_periodic_run_query(spark, sf_dir):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        if n < 3000:
            row = plain_row(words)
            assert got[i] == (*row[:5], sha("".join("%d,%d,%d\n" % r for r in row[5])), sha(row[6]))


def plain_repair(rows):
    """Damaged rows (turn, role, text) of a conversation, in order: the contract's columns, by states of the role pattern."""
    seen, kinds, counts = set(), [], Counter()
    for _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        kinds.append(fault)
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def grow(alive):
        for _ in range(4):
            for state, (cost, audit, out) in list(alive.items()):
                for r in "ua":
                    if (state, r) in moves:
                        way = (cost + 5, audit + "I", [*out, names[r] + ":"])
                        if moves[state, r] not in alive or way[:2] < alive[moves[state, r]][:2]:
                            alive[moves[state, r]] = way
        return alive

    alive = grow({"": (0, "", [])})
    for fault, (_, role, text) in zip(kinds, rows):
        then = {}
        for state, (cost, audit, out) in alive.items():
            ways = [(state, (cost + 2, audit + "D", out))]
            if fault in ("", "truncated"):
                more = 5 if fault else 0
                for r, price, edit, name in [(role[:1], 0, "K", role), ("u", 1, "R", "user"), ("a", 1, "R", "assistant")]:
                    if (state, r) in moves:
                        ways.append((moves[state, r], (cost + price + more, audit + edit, [*out, f"{name}:{text}"])))
            for s, way in ways:
                if s not in then or way[:2] < then[s][:2]:
                    then[s] = way
        alive = grow(then)
    cost, audit, out = min(alive[s] for s in ("", "a") if s in alive)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, "\n".join(out)


def plain_damage(row):
    conv, turn, role, text = (" " if x is None else x for x in row)
    k = zlib.crc32(f"{conv}:{turn}".encode()) % 20
    role, text = "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
    return [(row[1], role, text)] * (0 if k == 0 else 2 if k == 3 else 1)


def plain_conversations(rows):
    by = {}
    for row in rows:
        by.setdefault(row[0], []).extend(plain_damage(row[:4]))
    out = []
    for conv, mine in by.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        *counts, text = plain_repair(mine)
        out.append((conv, *counts, sha(text)))
    return Counter(out)


def test_parser_equals_a_plain_search():
    parser = dialogue.RoleParser()
    for _ in range(3000):
        rows = [(k, RND.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), RND.choice(["", "same.", "%d." % k, "%d" % k])) for k in range(RND.randrange(12))]
        seen, kinds = set(), []
        for _, role, text in rows:
            first = role[:1] if role[:1] in ("s", "u", "a") else "?"
            kinds.append("!" if not text or (role, text) in seen else first + ("" if text.endswith(".") else "~"))
            seen.add((role, text))
        want = plain_repair(rows)
        assert parser.repair(kinds) == want[5:7]
        mended = dialogue.repaired_rows(want[6], [r for _, r, _ in rows], [t for _, _, t in rows])
        assert "\n".join(f"{r}:{t}" for r, t in mended) == want[7]
    assert len(parser.nodes) < 20


def test_another_grammar():
    parser = dialogue.RoleParser((("C", "u"), ("C", "Cau")), {"a": "assistant"})
    assert parser.repair(["u", "u"]) == (2, "DK")
    assert parser.repair(["u", "u", "u", "u"]) == (3, "DKRK")
    assert parser.repair(["u", "a~", "u"]) == (4, "DDK")


@pytest.fixture(scope="module")
def odd_rows(spark):
    rows = [(c, t, RND.choice(["user", "assistant", "system", "tool"]), RND.choice(["Hi. ", "no end", "Same.", "", " \n", "Ünd? ", f"{t}!"])) for c in range(150) for t in range(RND.randrange(1, 12))]
    rows += [(None, 1, "user", "x."), (None, None, "assistant", "y."), (500, None, None, None), (500, None, "user", "a."), (500, 9, "assistant", "b."), (500, 3, "user", "a.")]
    rows += [(501, t, "user" if t % 2 else "assistant", "word " * 50 + "%d." % t) for t in range(700)]
    rows += [(502, 1, "user", "twice."), (502, 1, "user", "twice."), (502, 1, "assistant", "twice."), (503, 4, "user", "x" * 100_000 + ".")]
    RND.shuffle(rows)
    return [(*r, 1, "mine") for r in rows]


def test_conversation_query_on_odd_rows(spark, odd_rows, tmp_path):
    frame = spark.createDataFrame(odd_rows, "conv_id long, turn long, role string, text string, cost int, audit string")
    frame.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    assert Counter(tuple(r) for r in got.collect()) == plain_conversations(odd_rows)
    whole = dialogue.repair_conversations(frame)
    assert whole.count() == len({r[0] for r in odd_rows})
    assert whole.filter("conv_id = 503").first()["repaired"] == []
    assert dialogue.repair_conversations(frame.limit(0)).count() == 0
    with pytest.raises(TypeError):
        dialogue.repair_conversations(frame.withColumn("turn", frame["turn"].cast("string")))


def test_conversation_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = queries.QUERIES["op11_conversation_repair"](spark, sf_dir).collect()
    assert Counter(tuple(r) for r in got) == plain_conversations([tuple(r) for r in rows])
