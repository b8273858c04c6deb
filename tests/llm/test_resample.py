"""Importance resampling next to plain sums over features."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import answer
from txlake.llm import resample


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target):
    source, wanted = Counter(), Counter()
    for _, text in rows:
        source.update(map(bucket, features(text)[1]))
    for text in target:
        wanted.update(map(bucket, features(text)[1]))
    s, t = sum(source.values()), sum(wanted.values())

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((source[b] + 1) * (t + 10_000))))

    out = []
    for i, text in rows:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words) >= 20])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = {}
    for place, r in enumerate(able[: 25 * len(able) // 100], 1):
        drawn.setdefault(tuple(r[:4]), []).append(place)
    return [(*r[:4], drawn[tuple(r[:4])].pop(0) if r[4] and drawn.get(tuple(r[:4])) else None) for r in out]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, rank int, n int").repartition(3)


def test_ranks_equal_plain_sums(spark):
    drawn = random.Random(6)
    words = [f"w{i}" for i in range(400)] + ["É", "ß9", "a_b"]
    rows = [(i, " ".join(drawn.choices(words, k=drawn.randrange(60))) + drawn.choice(["", ".", "\x00x"])) for i in range(-50, 350)]
    target = [" ".join(drawn.choices(words[:80], k=50)) for _ in range(20)] + [None, ""]
    found = resample.resample(frame(spark, rows), spark.createDataFrame([(t, 3) for t in target], "text string, doc_id int"))
    assert answer(found, *found.columns) == sorted(brute(rows, target), key=repr)


def test_odd_tables(spark, messy, nothing):
    target = spark.createDataFrame([("w1x1 w2x2 hello",), (None,)], "text string")
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    found = resample.resample(messy, target)
    assert answer(found, *found.columns) == sorted(brute(rows, ["w1x1 w2x2 hello"]), key=repr)
    assert resample.resample(nothing, target).count() == 0
    assert resample.resample(messy, target.limit(0)).count() == len(rows)


def test_rows_alike_share_their_ranks(spark, monkeypatch):
    monkeypatch.setattr(resample, "COPIES", 7)
    text = " ".join(f"v{i}" for i in range(25))
    rows = [(5, text)] * 100 + [(None, text)] * 3 + [(i, text + f" x{i}") for i in range(10, 60)]
    found = resample.resample(frame(spark, rows), spark.createDataFrame([(text,)], "text string"))
    assert answer(found, *found.columns) == sorted(brute(rows, [text]), key=repr)
    assert sorted(r.rank for r in found.collect() if r.rank is not None) == list(range(1, 39))


@pytest.mark.parametrize("top", [1, 2, 1000, 1 << 40])
def test_bit_planes_weigh_exactly(top):
    drawn = np.random.default_rng(top)
    counts = drawn.integers(0, top + 1, 10_000) * (drawn.random(10_000) < 0.3)
    gains = drawn.integers(-40_000, 40_000, 10_000)
    assert resample.GainPlanes(gains).weighed(counts) == sum(int(c) * int(g) for c, g in zip(counts, gains, strict=True))
    assert resample.GainPlanes(np.zeros(10_000, np.int64)).weighed(counts) == 0
