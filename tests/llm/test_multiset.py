"""Multiset fingerprints next to plain sums, and their algebra."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.conftest import answer
from txlake.llm import multiset


def parts(text):
    return [p for p in re.split(r"(?<=\n)|(?<=[.!?] )", text) if p]


def lanes(text):
    """The number of paragraphs, and how many of them have each bit."""
    ones = [0] * 240
    for p in parts(text):
        digits = hashlib.sha256(p.encode()).hexdigest()
        for w in range(4):
            word = int(digits[15 * w : 15 * w + 15], 16)
            for i in range(60):
                ones[60 * w + i] += word >> i & 1
    return len(parts(text)), ones


def shown(text):
    n, ones = lanes(text)
    packed = [sum(ones[60 * w + s + 20 * j] % (1 << 19) << 20 * j for j in range(3)) for w in range(4) for s in range(20)]
    return "".join(f"{x:015x}" for x in [n, *packed])


def near(a, b):
    (n, x), (m, y) = lanes(a), lanes(b)
    x, y = [2 * v - n for v in x], [2 * v - m for v in y]
    squares = sum(v * v for v in x) + sum(v * v for v in y)
    return min(1.0, max(0.0, 2 * sum(p * q for p, q in zip(x, y, strict=True)) / squares)) if squares else 1.0


def said(drawn, n):
    return "".join(f"word{drawn.randrange(10**6)} é" + drawn.choice([". ", "!", "\n", "? ", ".\n", " "]) for _ in range(n))


def shown_rows(docs):
    found = multiset.compared(docs)
    return found.select("doc_id", "text", "edited", multiset.shown(F.col("print")), multiset.shown(F.col("edited_print")), "near_edited", "near_next").collect()


def test_every_row_equals_plain_sums(spark):
    drawn = random.Random(2)
    # far enough apart for several ranges, in no order
    rows = {drawn.randrange(-(1 << 62), 1 << 62): said(drawn, drawn.randrange(12)) for _ in range(1500)}
    docs = spark.createDataFrame([(i, t, "p", 3) for i, t in rows.items()], "doc_id long, text string, print string, grp int").repartition(5)
    order = sorted(rows)
    found = shown_rows(docs)
    assert len(found) == len(rows)
    behind = dict(zip(order, [*order[1:], order[0]], strict=True))
    for i, text, edited, fp, edited_fp, like, like_next in found:
        other, half = rows[behind[i]], len(text) // 2
        assert text == rows[i] and edited == text[: len(text) - half] + other[:half]
        assert (fp, edited_fp) == (shown(text), shown(edited))
        assert (like, like_next) == (near(text, edited), near(text, other))


def test_order_does_not_count_and_paragraphs_come_and_go(spark):
    a, b, c = "One. ", "two\n", "three é? "
    rows = spark.createDataFrame([(a + b + c, c + a + b, b)], "x string, y string, z string")
    x, y, z = (multiset.fingerprint(F.col(n)) for n in "xyz")
    gone = multiset.deleted(x, multiset.paragraphs(F.col("z")))
    back = multiset.inserted(gone, multiset.paragraphs(F.col("z")))
    nothing = multiset.joined(z, multiset.inverse(z))
    row = rows.select(*[multiset.shown(v) for v in (x, y, gone, back, nothing)]).first()
    assert row[0] == row[1] == row[3] == shown(a + b + c)
    assert row[2] == shown(a + c) and row[4] == shown("")


def test_sums_wrap_without_touching_their_neighbours(spark):
    many = spark.range(1).select(F.array_repeat(F.lit("same"), (1 << 19) + 5).alias("p"))
    lane = multiset.shown(multiset.multiset(F.col("p")))
    five = multiset.shown(multiset.multiset(F.slice("p", 1, 5)))
    wrapped, plain = many.select(lane, five).first()
    assert wrapped[15:] == plain[15:] and int(wrapped[:15], 16) == (1 << 19) + 5


def test_odd_tables(spark, messy, nothing):
    found = shown_rows(messy)
    assert len(found) == messy.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r[0], []).append(r)
    assert len(by_id[1]) == 2 and by_id[1][0] == by_id[1][1] and len(by_id[None]) == 1
    assert by_id[2][0][2:] == ("", shown(""), shown(""), 1.0, 1.0)  # null, followed by the empty text
    whole = by_id[4][0][1]
    assert by_id[4][0][2] == whole[: len(whole) - len(whole) // 2] + "hello world, foo bar baz!"
    first = "Hello world, foo bar baz!"
    for last in (by_id[7][0], by_id[None][0]):  # behind the last comes the first
        assert last[2] == last[1][: len(last[1]) - len(last[1]) // 2] + first[: len(last[1]) // 2]
    assert shown_rows(nothing) == []
    alone = spark.createDataFrame([(None, "abcd. efgh")], "doc_id long, text string")
    assert shown_rows(alone)[0][2:5] == ("abcd.", shown("abcd. efgh"), shown("abcd."))


def test_an_id_of_a_third_of_all_rows_is_dealt_over_shards(spark):
    same = [(7, f"row {i % 900}. and more") for i in range(1500)] + [(7, "twin. twin")] * 1500
    docs = spark.createDataFrame(same + [(i, f"text {i}. end") for i in range(1000, 7000)] + [(1, "low. end")], "doc_id long, text string")
    starts, shards = multiset._cuts(docs)
    assert max(shards) > 5
    found = multiset.with_next(docs).select("doc_id", "text", F.col("next.text").alias("behind"))
    got = answer(found, "doc_id", "text", "behind")
    lowest = docs.where("doc_id = 7").select(F.min(F.struct(F.xxhash64("text"), "text"))["text"]).first()[0]
    behind = {i: f"text {i + 1}. end" for i in range(1000, 6999)} | {6999: "low. end", 1: lowest, 7: "text 1000. end"}
    assert got == sorted(((i, t, behind[i]) for i, t in docs.collect()), key=repr)
