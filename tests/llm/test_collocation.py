"""Collocations next to a plain count of all runs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from tests.llm.conftest import answer
from txlake.llm import collocation, trie

COLUMNS = "doc_id long, text string, lang string, phrase string, n int, trie string"


def brute(rows, most=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    able = {x: a for x, a in counts.items() if a >= 30}
    most_of = Counter()
    for (lang, words), a in able.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                most_of[lang, words[i : i + k]] = max(most_of[lang, words[i : i + k]], a)
    by_lang = {}
    for (lang, w), a in able.items():
        if len(w) > 1 and 100 * most_of[lang, w] < 80 * a:
            score, k = min((2_000_000 * a // (able[lang, w[:k]] + able[lang, w[k:]]), k) for k in range(1, len(w)))
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), able[lang, w[:k]], able[lang, w[k:]]))
    return sorted(
        ((lang, i, p.decode(), -a, x, y, totals[lang], -s) for lang, found in by_lang.items() for i, (s, a, p, x, y) in enumerate(sorted(found)[:most], 1)),
        key=repr,
    )


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, "y") for i, (lang, t) in enumerate(rows)], COLUMNS).repartition(4)


def corpus(n=400):
    drawn = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["É", "\xa0", "\x1c", "The", "the", "a  b", "c\td", "\x00"]
    rows = []
    for i in range(n):
        said = []
        for _ in range(drawn.randrange(60)):
            said.append(drawn.choice(words) if drawn.random() < 0.6 else drawn.choice(["New York city", "of the", "x x x x x", "Ää Öö Üü, ß", "one\x0btwo"]))
            said.append(drawn.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\r\n"]))
        rows.append((drawn.choice(["en", "en", "fr", None, "und", ""]), "".join(said)))
    return rows


def test_phrases_equal_a_plain_count(spark):
    rows = corpus()
    found = collocation.collocations(frame(spark, rows))
    got = answer(found, *found.columns)
    assert got == brute(rows) and len(got) > 20
    few = collocation.collocations(frame(spark, rows), 3)
    assert answer(few, *few.columns) == brute(rows, 3)


def test_many_tries_and_small_blocks_give_the_same(spark, monkeypatch):
    rows = corpus(150) + [("en", "x y " * 3000 + "z" * 2000 + " x y z " * 500)]
    expected = brute(rows)
    for name, value in (("TRIE_PHRASES", 40), ("TRIES", 2)):
        monkeypatch.setattr(collocation, name, value)
    found = collocation.collocations(frame(spark, rows))
    assert answer(found, *found.columns) == expected


def test_long_texts_are_cut_without_losing_a_run():
    drawn = random.Random(1)
    data = b" ".join(drawn.choice([b"a", b"bb", b"c\nd", b"e" * 90, b"\n"]) for _ in range(2000)) + b"f" * 500
    for size in (7, 50, 64, 1000, 10**6):
        runs, n = Counter(), 0
        for part, tail in collocation.segments(data, size):
            tokens = part.replace(b"\n", b" \xff ").split()
            own = len(tokens) - tail
            n += sum(t != b"\xff" for t in tokens[:own])
            runs.update(tuple(tokens[i : i + 4]) for i in range(own) if b"\xff" not in tokens[i : i + 4] and len(tokens[i : i + 4]) == 4)
        whole = Counter()
        for piece in data.split(b"\n"):
            words = piece.split()
            whole.update(tuple(words[i : i + 4]) for i in range(len(words) - 3))
        assert runs == whole and n == len(data.split())


def test_odd_tables(spark, messy, nothing):
    from pyspark.sql import functions as F

    for docs in (messy, nothing):
        assert collocation.collocations(docs.withColumn("lang", F.lit(None).cast("string"))).count() == 0
    rows = [("en", "same words, again")] * 40 + [(None, None), ("fr", ""), ("en", " \t\n.")]
    found = collocation.collocations(frame(spark, rows))
    assert answer(found, *found.columns) == brute(rows) == [("en", 1, "same words", 40, 40, 40, 120, 1_000_000)]


def test_a_trie_knows_its_phrases_and_no_other():
    drawn = np.random.default_rng(3)
    phrases = np.minimum((drawn.pareto(0.6, (20_000, 4)) * 5).astype(np.int64), 200_000)
    phrases[np.arange(4)[None, :] >= drawn.integers(1, 5, 20_000)[:, None]] = -1
    phrases = np.unique(phrases, axis=0)
    built = trie.build(phrases)
    assert len(set(built.ends.tolist())) == len(phrases)
    known = {tuple(p[p >= 0].tolist()) for p in phrases}
    prefixes = {p[:k] for p in known for k in range(1, 5)}
    asked = np.concatenate([np.where(phrases >= 0, phrases, 0), np.minimum((drawn.pareto(0.6, (20_000, 4)) * 5).astype(np.int64), 200_000)])
    at, states = np.arange(len(asked)), np.zeros(len(asked), np.int32)
    ends = {int(e): tuple(p[p >= 0].tolist()) for e, p in zip(built.ends, phrases, strict=True)}
    for k in range(4):
        on, states = built.step(states, asked[at, k])
        at = at[on]
        assert set(at.tolist()) == {i for i, p in enumerate(asked.tolist()) if tuple(p[: k + 1]) in prefixes}
        for i, s in zip(at.tolist(), states.tolist(), strict=True):
            assert ends.get(s, tuple(asked[i, : k + 1].tolist())) == tuple(asked[i, : k + 1].tolist())
    assert len(trie.build(np.zeros((0, 4), np.int64)).ends) == 0


def test_larger_tables_keep_out_what_smaller_ones_let_through(spark, monkeypatch):
    drawn = random.Random(9)
    seldom = [" ".join(f"s{drawn.randrange(4000)}" for _ in range(500)) for _ in range(600)]
    often = ["alpha beta gamma"] * 40
    docs = spark.createDataFrame([(t, "en") for t in [*seldom, *often]], "text string, lang string").repartition(3)
    monkeypatch.setattr(collocation, "LEAST_COUNT", 5)
    rows = docs.select("lang", "text")
    found = {}
    for bits in (16, 22):
        maps = collocation._frequent_buckets(collocation._counted(rows, bits).where("table >= 0"), bits)
        assert {len(m) for m in maps} == {1 << (bits - 3)}
        found[bits] = {r.phrase for r in collocation._candidates(rows, maps).collect()}
    assert found[22] <= found[16] and {"alpha beta", "beta gamma", "alpha beta gamma"} <= found[22]
    assert len(found[22]) * 10 < len(found[16])
    monkeypatch.setattr(collocation, "HELD", 100)
    again = collocation._frequent_buckets(collocation._counted(rows, 22).where("table >= 0"), 22)
    assert all((a == b).all() for a, b in zip(again, maps, strict=True))


def test_buckets_grow_with_the_text(spark, monkeypatch):
    docs = spark.createDataFrame([("x" * 12_800, "en")] * 100, "text string, lang string")
    assert collocation.bucket_bits(docs) == collocation.BITS
    monkeypatch.setattr(collocation, "BITS", 8)
    assert collocation.bucket_bits(docs) == 14  # 10,000 buckets wanted
    monkeypatch.setattr(collocation, "MOST_BITS", 10)
    assert collocation.bucket_bits(docs) == 10
