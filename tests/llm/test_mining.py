"""Phrases, the filter audit and repeated passages against plain versions and SQL."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from conftest_rows import ROWS
from pyspark.sql import functions as F

from ledgerpulse.llm import audit, bloom, phrases, suffixes

LABELS = "doc_id bigint, quality int, toxic int, text string"


# 11 phrases
def brute_phrases(rows, support, top, longest=5):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(words[i : i + n])] += 1
    out = set()
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if a >= support}
        scored = []
        for p, a in frequent.items():
            inside = any(
                q[i : i + len(p)] == p and b >= a for q, b in frequent.items() if len(q) > len(p) for i in range(len(q) - len(p) + 1)
            )
            if len(p) > 1 and not inside:
                score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return out


def texts(seed, n):
    r = random.Random(seed)
    words = ["a", "B", "b", "of", "the", "New", "York", "é", "x y", "long-word", "Z"]
    fixed = ["New York", "a b of the Z", "x y é", "of the, of the"]
    join = lambda: r.choice([" ", " ", "  ", "\t", ". ", "\n", "; ", "\r\n", " ? "])
    return [
        (r.choice(["en", "de", "und", None]), "".join(r.choice(words + fixed) + join() for _ in range(r.randint(0, 60)))) for _ in range(n)
    ] + [("en", None), (None, ""), ("en", " .,;\n"), ("fr", "."), ("de", "New York " * 400)]


@pytest.mark.parametrize("shard_words, support, top", [(4_000_000, 12, 50), (300, 12, 50), (50, 5, 7), (1, 9, 2000)])
def test_phrases_against_all_counts(spark, shard_words, support, top):
    rows = texts(shard_words, 120)
    df = spark.createDataFrame([(t, lang, 1, "x") for lang, t in rows], "text string, lang string, n int, phrase string").repartition(3)
    out = phrases.collocations(df, support, top, shard_words=shard_words)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in out.collect()} == brute_phrases(rows, support, top)


def test_shards_are_of_one_language_as_far_as_may_be(spark, monkeypatch):
    monkeypatch.setattr(phrases, "DEALT_WORDS", 1000)
    rows = [(f"w{i % 7} w{i % 5} w{i % 3} x y", "abcd"[i % 4]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    dealt = phrases.by_language(docs, 20_000)
    held = dealt.groupBy(F.spark_partition_id().alias("task"), "lang").count().collect()
    assert sum(r["count"] for r in held) == 4000 and len({r["task"] for r in held}) > 12
    assert len(held) <= len({r["task"] for r in held}) + 3
    made = []
    real = phrases.over_shards
    monkeypatch.setattr(phrases, "over_shards", lambda *a, **k: made.append(a[0]) or real(*a, **k))
    assert {tuple(r) for r in phrases.collocations(docs, 100, 40).collect()} == brute_phrases([(c, t) for t, c in rows], 100, 40)
    # Both passes over the candidates read what was stored by language.
    assert len(made) == 3 and all("texts-" in f for m in made[1:] for f in m.inputFiles())


def test_a_filter_that_passes_everything_changes_no_count(spark, monkeypatch):
    rows = texts(3, 60)
    df = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    monkeypatch.setattr(phrases, "MEMBER_BITS", 64)
    assert {tuple(r) for r in phrases.collocations(df, 8, 40, shard_words=200).collect()} == brute_phrases(rows, 8, 40)


def test_scores_beyond_64_bits(spark):
    grams = [("en", "x", 1, 10**12), ("en", "y", 1, 10**11), ("en", "x y", 2, 10**11)]
    out = phrases.scored(spark.createDataFrame(grams, "lang string, phrase string, words int, f bigint"), {"en": 10**13}).collect()
    assert [(r["phrase"], r["score"]) for r in out] == [("x y", 1000 * 10**11 * 10**13 // 10**23)]


def test_shards_report_only_phrases_whose_bucket_reaches_the_support(spark, monkeypatch):
    # With a share of one in every shard all 2,000 made-up words and their phrases would be reported.
    rows = [(f"often seen here w{i} x{i}", "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(8)
    made = []
    real = phrases.possible
    monkeypatch.setattr(phrases, "possible", lambda mined, *more: made.append(mined.filter("h1 IS NOT NULL").count()) or real(mined, *more))
    want = brute_phrases([(lang, t) for t, lang in rows], 150, 40)
    assert {tuple(r) for r in phrases.collocations(docs, 150, 40, shard_words=20).collect()} == want
    assert made[0] < 20  # six are frequent
    monkeypatch.setattr(phrases, "BUCKET_BITS", 11)  # strangers share buckets, which changes nothing
    assert {tuple(r) for r in phrases.collocations(docs, 150, 40, shard_words=20).collect()} == want


def test_bucket_numbers_come_back_from_bytes():
    rng = np.random.default_rng(12)
    for most in (3, 300, 10**6):
        spots = np.sort(rng.integers(0, most, 5000).astype(np.uint32))
        assert (phrases.unpacked(phrases.packed(spots)) == spots).all()
    assert (phrases.unpacked(phrases.packed(np.array([0, 0, 254, 509, 510, 1020], np.uint32))) == [0, 0, 254, 509, 510, 1020]).all()


def test_phrases_of_nothing(spark, none):
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("", "en"), ("one two", "en")], "text string, lang string")).count() == 0


def test_levels_count_overlaps():
    ids = np.array([1, 1, 1, 0, 1, 1])
    found = {(n, tuple(ids[f : f + n])): c for n, first, counts in phrases.levels(ids, 2, np.array([False, True]), lambda n, f, c: c >= 1, 3) for f, c in zip(first, counts)}
    assert found == {(1, (1,)): 5, (2, (1, 1)): 3, (3, (1, 1, 1)): 1}
    assert bloom.SIEVE_BITS <= phrases.MEMBER_BITS


# 12 audit
def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    fails = []
    for i, part, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {c for c, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            re.search(r"[#$%&*|]", t) is not None, i is not None and i > first[t],
        )) if bad}
        fails.append((part or "", own, i in good, i in toxic))
    out = {}
    for order in permutations("ABCDE"):
        for part in {f[0] for f in fails}:
            here = [f for f in fails if f[0] == part]
            for step, letter in enumerate(order, 1):
                left = [f for f in here if not f[1] & set(order[: step - 1])]
                gone = [f for f in left if letter in f[1]]
                out[part, "".join(order), step] = [
                    len(left) - len(gone), len(gone), sum(letter in f[1] for f in here) - len(gone),
                    sum(f[1] == {letter} for f in here), sum(f[2] for f in gone), sum(f[3] for f in gone),
                ]
    shapley = Counter()
    for (part, order, step), row in out.items():
        shapley[part, order[step - 1]] += row[1]
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("span", [65_536, 3])
def test_audit_against_sets(spark, span, monkeypatch):
    monkeypatch.setattr(audit, "RANGE", span)
    r = random.Random(5)
    pool = [t for _, t in ROWS if not t or len(t) < 5000]
    pool += [" ".join(f"W{i}" for i in range(220)), " ".join(f"w{i}" for i in range(220)) + " #", "same " * 300, "A" * 50]
    rows = [(r.choice([None, *range(40)]) if i % 9 == 0 else i, r.choice(["hot", "hot", "s1", "", None]), r.choice(pool)) for i in range(90)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1]), "x") for i in [*range(60), 5, 5, None, 999]]
    docs = spark.createDataFrame([(*row, "clash", 1) for row in rows], "doc_id bigint, source string, text string, failed string, before int")
    out = audit.audit_filters(docs.repartition(4), spark.createDataFrame(labels, LABELS))
    want = brute_audit(rows, [x[:3] for x in labels])
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(x) for x in out.select(*columns).collect()} == want and len(want) % 600 == 0
    assert audit.audit_filters(docs.limit(0), spark.createDataFrame(labels, LABELS)).count() == 0


def test_galloping_sets():
    r = random.Random(1)
    for _ in range(300):
        lists = [sorted(r.sample(range(60), r.choice([0, 1, 5, 40]))) for _ in range(r.randint(0, 5))]
        assert audit.union(lists) == sorted(set().union(*lists))
        a, b = sorted(r.sample(range(60), 20)), sorted(r.sample(range(60), r.randint(0, 60)))
        assert audit.outside(a, b) == len(set(a) - set(b))


# 13 passages
def brute_passages(rows, passage):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[i : i + passage] for _, t in data for i in range(len(t) - passage + 1))
    out = []
    for doc, t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - passage + 1):
            if seen[t[i : i + passage]] > 1:
                gone[i : i + passage] = b"\1" * passage
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), len(t) - len(kept), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed, passage):
    r = random.Random(seed)
    text = lambda n: "".join(r.choice("abcdefg é") for _ in range(n))
    shared = [text(passage + d) for d in (-9, -1, 0, 1, 3, 9, 20, passage, 3 * passage)]
    rows = []
    for i in range(45):
        parts = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(shared)
            start = r.choice([0, 0, r.randint(0, len(p) // 4)])
            parts.append(r.choice([text(r.randint(1, 2 * passage)), p, p[start : len(p) - r.choice([0, 0, 5])]]))
        rows.append((i, "".join(parts)))
    hot = shared[4]
    rows += [(100 + i, text(r.randint(0, 40)) + hot + text(r.randint(0, 40))) for i in range(25)]
    return rows + [(200, None), (201, ""), (202, "a" * 3 * passage), (203, "ab" * passage), (1, rows[1][1]), (None, rows[2][1]), (None, None)]


@pytest.mark.parametrize("passage, slide, sizes", [
    (48, 16, {}), (40, 8, {"run_bytes": 2000, "range_bytes": 3000}), (64, 32, {"run_bytes": 9000, "range_bytes": 2000}),
])
def test_passages_against_all_windows(spark, passage, slide, sizes):
    rows = passages(passage, passage)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, shared int, core string").repartition(4)
    got = suffixes.repeated_passages(df, passage=passage, slide=slide, **sizes)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_passages(rows, passage)


def test_passages_of_nothing(spark, none):
    assert suffixes.repeated_passages(none).count() == 0


def test_loser_tree_knows_what_is_shared():
    r = random.Random(3)
    for n in range(1, 9):
        runs = [sorted({"".join(r.choice("ab") for _ in range(r.randint(0, 9))).encode() for _ in range(r.randint(0, 30))}) for _ in range(n)]
        places = lambda: np.zeros((1, 7), np.int64)
        coded = [suffixes.Run([suffixes.coded_block(k[i : i + 4], [places() for _ in k[i : i + 4]]) for i in range(0, len(k), 4)]) for k in runs]
        out = list(suffixes.merged([iter(c) for c in coded]))
        assert [k for _, k, _ in out] == sorted(k for run in runs for k in run)
        assert all(s == suffixes.shared_bytes(a[1], b[1], 0) for a, b, s in zip(out, out[1:], [s for s, _, _ in out[1:]]))


def test_every_passage_has_one_anchor_at_the_same_distance():
    r = random.Random(9)
    a, b = ("".join(r.choice("abcd") for _ in range(400)) for _ in range(2))
    same = "".join(r.choice("abcd") for _ in range(150))
    found = suffixes.anchors([(a + same).encode(), b"", (same + b).encode(), None, b"short"], 64, 16)
    owner = {}
    for t, p, back, upto in zip(found["text"], found["p"], found["back"], found["upto"]):
        for distance in range(upto, back + 1):
            assert owner.setdefault((t, p - distance), distance) == distance
    assert {s for t, s in owner if t == 0} == set(range(550 - 63)) and {s for t, s in owner if t == 2} == set(range(550 - 63))
    assert all(owner[0, 400 + i] == owner[2, i] for i in range(150 - 63))


def test_candidates_need_a_bound_that_reaches_the_support(spark):
    mined = spark.createDataFrame([(0, None, None, 90), (0, 1, 1, 9), (0, 2, 2, 10), (1, None, None, 0), (1, 3, 3, 99), (1, 4, 4, 100)], "lang int, h1 bigint, h2 bigint, n bigint")
    out = phrases.possible(mined, {0: 90, 1: 0}, 100)
    assert {r["h1"] for r in out.collect()} == {2, 4}


def test_anchors_are_gone_before_texts_are_gathered(spark, monkeypatch):
    events = []
    drop, gather = suffixes.drop_stored, suffixes._gathered
    monkeypatch.setattr(suffixes, "drop_stored", lambda df: (events.append(sorted(df.columns)), drop(df)))
    monkeypatch.setattr(suffixes, "_gathered", lambda *args: (events.append("gathered"), gather(*args))[1])
    body = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(600))
    rows = [(1, body), (2, "x" + body), (3, "short")]
    out = suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == {1: 600, 2: 600, 3: 0}
    assert "text" not in events[0] and events[1] == "gathered"
