from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from txlake.llm import labelled, quality, toxicity

LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(n, seed):
    """Prose; a quarter has rude words, a quarter is shouted or marked."""
    drawn, rows = random.Random(seed), []
    for i in range(n):
        w = ["".join(drawn.choices(["th", "er", "an", "in", "on", "re"], k=drawn.randint(1, 3))) for _ in range(drawn.randint(20, 90))]
        rude, junk = i % 4 == 0, i % 8 in (1, 2)
        if rude:
            for _ in range(3):
                w[drawn.randrange(len(w))] = drawn.choice(["scumbag", "moronic", "IDIOT,"])
        if junk:
            w = [x.upper() + "!!" if i % 2 else x + "***" for x in w]
        rows.append((i, " ".join(w) + ".", 1 - int(junk), int(rude)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus(800, 2)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _, _ in rows], "doc_id long, text string, y string, score int").repartition(4)
    labels = spark.createDataFrame([(i, q, t, "l") for i, _, q, t in rows if i % 10 < 8], LABELS)
    return docs, labels, rows


@pytest.mark.parametrize(("module", "place", "folds", "out"), [(toxicity, 3, 5, 0), (quality, 2, 4, 2)])
def test_held_out_rows_are_told_apart(tables, module, place, folds, out):
    docs, labels, rows = tables
    found = {r.doc_id: r for r in module.classify(docs, labels).collect()}
    assert len(found) == len(rows)
    right = []
    for row in rows:
        r = found[row[0]]
        assert r.held_out == (zlib.crc32(str(row[0]).encode()) % folds == out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD)
        if r.held_out:
            right.append(r.predicted == row[place])
    assert np.mean(right) > 0.95


@pytest.mark.parametrize("module", [toxicity, quality])
def test_labels_of_the_held_out_fold_do_not_matter(tables, module):
    docs, labels, _ = tables
    name = "toxic" if module is toxicity else "quality"
    out = labelled.fold(F.col("doc_id"), module.FOLDS) == module.HELD_OUT
    flipped = labels.withColumn(name, F.when(out, 1 - F.col(name)).otherwise(F.col(name)))
    plain, other = (sorted(map(tuple, module.classify(docs, x).collect())) for x in (labels, flipped))
    assert plain == other


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows_have_scores(spark, tables, messy, nothing, module):
    docs, labels, _ = tables
    both = docs.select("doc_id", "text").union(messy.select("doc_id", "text"))
    odd = labels.union(spark.createDataFrame([(1, None, None, ""), (None, 1, 1, ""), (3, 0, 1, ""), (1, 1, 1, ""), (10**9, 1, 1, "")], LABELS))
    found = module.classify(both, odd)
    assert found.count() == 800 + messy.count() and found.where("score IS NULL OR isnan(score)").isEmpty()
    assert module.classify(nothing, odd).count() == 0
    unlabelled = module.classify(messy, labels.limit(0))
    assert unlabelled.count() == messy.count() and unlabelled.select("score").distinct().count() == 1


def test_the_sample_is_bounded(tables):
    docs, labels, _ = tables
    assert labelled.training_rows(docs, labels, "toxic", 5, 0, 37).count() == 37


def test_ngram_scores_equal_a_plain_sum(tables):
    docs, labels, rows = tables
    model = toxicity.fit(labelled.training_rows(docs, labels, "toxic", 5, 0, 100), 50)
    for text in ["", "a", rows[0][1], rows[5][1] * 3, "é" * 70_000 + " scumbag"]:
        held = {int(b) for part in toxicity.ngrams(text) for b in part}
        z = model.bias + sum(model.weight[model.number[b]] for b in held if model.number[b] >= 0)
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-z)))


def test_ngrams_do_not_depend_on_the_block(monkeypatch):
    text = " ".join(f"wörd{i}" for i in range(500))
    whole = sorted(int(b) for part in toxicity.ngrams(text) for b in part)
    monkeypatch.setattr(toxicity, "BLOCK", 97)
    assert sorted(int(b) for part in toxicity.ngrams(text) for b in part) == whole
    line = f" {text} "
    assert len(whole) == sum(len(line) - n + 1 for n in toxicity.SIZES)


def test_tables_learn_an_interaction():
    drawn = np.random.default_rng(0)
    x = drawn.uniform(-1, 1, (4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.fit_tables(x, y)
    assert (0, 1) in model.pairs
    fresh = drawn.uniform(-1, 1, (2000, 3))
    assert np.mean((model.score(fresh) >= 0.5) == (fresh[:, 0] * fresh[:, 1] > 0)) > 0.9
    b = model.bins(fresh)
    z = model.bias + sum(t[b[:, j]] for j, t in enumerate(model.tables)) + sum(t[b[:, i], b[:, j]] for (i, j), t in model.pairs.items())
    assert model.score(fresh) == pytest.approx(1 / (1 + np.exp(-z)))


def test_keep_good_keeps_columns_and_good_rows(tables):
    docs, labels, rows = tables
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema
    good = {r.doc_id for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == good
