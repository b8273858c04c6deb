"""SimHash classes, vector links and components, next to all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import answer
from txlake.llm import flatgraph, simhash
from txlake.llm.graph import components


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, i) for i in range(1001, 1200)]
    odd = [(5000, 5000), (None, 7), (8, None), (6003, 6001), (6002, 6003), (6001, 6003), (6001, 6003)]
    found = answer(components(spark.createDataFrame(chain + star + odd, "a long, b long")), "id", "component")
    ids = {i for p in chain + star + odd[3:] for i in p}
    assert dict(found) == brute.classes(ids, chain + star + odd[3:])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_of_odd_texts():
    for text in ["", " \t", "One", "one two", "ÀB ÀB ÀB c", "a b c d e\x0bf\x0cg\x1ch i", "x " * 500, "ǅ İ É"]:
        assert simhash.fingerprint(text) == brute.simhash(text)


def expected_classes(rows):
    prints = [(r.doc_id, brute.simhash(r.text or "")) for r in rows]
    ids = {i for i, _ in prints if i is not None}
    pairs = [(i, j) for i, a in prints for j, b in prints if None not in (i, j) and bin(a ^ b).count("1") <= 2]
    return prints, brute.classes(ids, pairs)


def test_text_classes_equal_brute_force(spark, messy, nothing):
    drawn = random.Random(5)
    base = [" ".join(drawn.choices("abcdefghijklmnop", k=600)) for _ in range(12)]
    texts = []
    for b in base:
        texts.append(b)
        for _ in range(6):  # near copies: some words at the end
            texts.append(b + " " + " ".join(drawn.choices("xyz", k=drawn.randint(0, 3))))
    texts += ["one two", "one two", "", "\n"]
    docs = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string")
    rows = docs.collect()
    prints, classes = expected_classes(rows)
    assert len(set(classes.values())) < len(set(p for _, p in prints))  # some links join different fingerprints
    found = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in found} == classes
    prints, classes = expected_classes(messy.collect())
    found = simhash.near_duplicates(messy).collect()
    assert len(found) == messy.count()
    assert all(r.component_id == classes[r.doc_id] for r in found if r.doc_id is not None)
    assert simhash.near_duplicates(nothing).count() == 0


def test_pivots_lose_no_pair(spark):
    drawn = random.Random(9)
    prints = [drawn.getrandbits(64) for _ in range(40)]
    for p in prints[:20]:
        for _ in range(10):
            q = p
            for _ in range(drawn.randint(1, 3)):
                q ^= 1 << drawn.randrange(64)
            prints.append(q)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(i, simhash._signed(p)) for i, p in enumerate(prints)], "node long, fp long")
    for bits in (0, 1, 2):
        found = {tuple(sorted(p)) for p in answer(simhash.near_pairs(df, bits), "a", "b")}
        there = {(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints) if i < j and bin(a ^ b).count("1") <= bits}
        assert found == there
    with pytest.raises(ValueError):
        simhash.near_pairs(df, 3)


def vectors():
    drawn = np.random.default_rng(4)
    x = drawn.normal(size=(700, 16))
    x[100:180] = x[99] + 0.15 * drawn.normal(size=(80, 16))
    x[300:340:2] = x[301:341:2] + 0.1 * drawn.normal(size=(20, 16))
    x[400:430] = x[400]
    x[500] = 3 * x[501]
    return [(i * 3, [float(v) for v in r]) for i, r in enumerate(x)]


ODD = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] + [1.0] * 15), (9004, [float("inf")] + [1.0] * 15),
       (9005, [None] + [1.0] * 15), (9006, []), (None, [1.0] * 16), (9007, [1e-30] + [0.0] * 15), (9008, [1e30]), (9007, [1e-30] + [0.0] * 15)]


def test_vector_links_equal_brute_force(spark):
    rows = vectors() + ODD
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in rows], "vec_id long, embedding array<float>, label int, node string")
    small = flatgraph.Graph(cluster_rows=64, shard_rows=100, audited=50)  # several shards and blocks
    found = flatgraph.near_duplicates(df, 0.9, small).collect()
    assert len(found) == len(rows)
    usable = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([np.pad(v, (0, 16 - len(v))) for _, v in usable], np.float32).astype(float)
    x /= np.abs(x).max(axis=1)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = x @ x.T >= 0.9
    links = {i: close[k].sum() - 1 for k, (i, _) in enumerate(usable)}
    classes = brute.classes({i for i, _ in usable}, [(usable[a][0], usable[b][0]) for a, b in np.argwhere(close)])
    there = sum(links.values())
    got = {r.vec_id: r for r in found}
    assert all(got[i].n_links <= n for i, n in links.items())
    assert sum(got[i].n_links for i in links) >= 0.98 * there
    assert sum(got[i].component_id == classes[i] for i in links) >= 0.98 * len(links)
    for i, _ in ODD[:6]:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[9008].component_id == 9007 and not got[9008].kept
    assert flatgraph.near_duplicates(df.limit(0)).count() == 0


def test_the_audit_sees_what_is_missed(spark):
    rows = [(i, 1, v) for i, v in vectors()[:200]]
    classes = spark.createDataFrame(rows, "node long, weight long, vec array<float>")
    none = spark.createDataFrame([], "node long, links long")
    assert flatgraph.audit(classes, none, 16, 0.9, flatgraph.Graph()) == 0.0
    alone = spark.createDataFrame([(1, 1, [1.0, 0.0]), (2, 1, [0.0, 1.0])], "node long, weight long, vec array<float>")
    assert flatgraph.audit(alone, none, 2, 0.9, flatgraph.Graph()) == 1.0
