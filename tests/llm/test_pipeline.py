"""The pipeline's stages next to plain forms of each decision, each on its own input."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm import brute
from tests.llm.test_decontaminate import brute_overlaps
from tests.llm.test_shingles import alike, copies, sets
from txlake.llm import quality, shingles
from txlake.llm.common import table
from txlake.sources.shared import stage

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_decide_as_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    expected = {}
    predicted = quality.classify(docs, table(spark, SF_DIR, "labels")).where("predicted = 1")
    expected["quality"] = {r.doc_id for r in predicted.collect()}
    for name, apply in cp.STAGES:
        docs = stage(apply(spark, docs, SF_DIR), "test")
        if name == "packing":
            break
        assert docs.columns == COLUMNS
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows)
        if name == "near_duplicates":
            said = {i: sets(r.text) for i, r in before.items()}
            pairs = [(i, j) for i in said for j in said if i < j and alike(said[i], said[j])]
            expected[name] = set(brute.classes(said, pairs).values())
        if name == "decontamination":
            items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
            leaks = brute_overlaps([(i, r.text) for i, r in before.items()], items)
            expected[name] = before.keys() - {i for i, _ in leaks}
        if name == "secrets":
            expected[name] = set(before)
            for i, r in after.items():
                spans = brute.secret_spans(before[i].text)
                assert (r.text == before[i].text) == (not spans) and r.n_chars == len(r.text)
        else:
            assert all(before[i] == r for i, r in after.items())
        assert set(after) == expected[name], name
        before = after
    assert {r.doc_id for r in docs.select("doc_id").collect()} == set(before)
    assert docs.agg(F.count_distinct("doc_id", "start")).first()[0] == docs.count()


def test_stages_take_odd_tables(spark, messy):
    odd = messy.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars"), "blob")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for name, apply in cp.STAGES:
            docs = stage(apply(spark, docs, SF_DIR), "odd")
            if name != "packing":
                assert docs.columns == odd.columns


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, Leak string, first_copy int").repartition(3)


def test_near_duplicates_are_decided_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, b), (2, b + " end"), (None, c), (None, c), (3, c), (None, "no id"), (None, "no  ID"), (4, None), (5, "")]
    kept = cp.one_of_each(spark, frame(spark, rows), "")
    assert kept.columns == ["doc_id", "text", "Leak", "first_copy"]
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    nameless = [r for r in found if r[0] is None]
    assert len(nameless) == 1 and nameless[0][1] in ("no id", "no  ID")
    assert [r for r in found if r[0] is not None] == [(1, a), (1, b), (3, c), (4, None)]


def test_texts_that_share_no_band_are_compared_too(spark, monkeypatch):
    texts = copies()
    said = dict(enumerate(map(sets, texts)))
    expected = brute.classes(said, [(i, j) for i in said for j in said if i < j and alike(said[i], said[j])])
    monkeypatch.setattr(shingles, "bands", lambda found: [shingles._hash(found)])
    kept = cp.one_of_each(spark, spark.createDataFrame(list(enumerate(texts)) * 2, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_leaks_are_decided_by_row(spark):
    leak = table(spark, SF_DIR, "benchmark").where("length(text) > 100").first().text
    rows = [(1, "clean text"), (1, f"x {leak}"), (None, leak), (None, "clean too"), (2, None), (None, None)]
    kept = cp.no_benchmark(spark, frame(spark, rows), SF_DIR)
    assert kept.columns == ["doc_id", "text", "Leak", "first_copy"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, "clean text"), (None, "clean too"), (2, None), (None, None)], key=repr)


def test_secrets_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "password=abcdef12", "B", "s", 3)], "doc_id long, text string, Blob string, spans string, blob_ int")
    assert tuple(cp.no_secrets(spark, docs, "").first()) == (1, "[assign]", "B", "s", 3)


def test_run_gives_the_last_stage(spark):
    assert cp.run(spark, SF_DIR).columns[:4] == ["doc_id", "start", "length", "ids"]
