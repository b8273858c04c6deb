"""Order-independent document fingerprints: homomorphic multiset hashes of paragraphs.

A paragraph's SHA-256 gives 240 lanes of one bit; a fingerprint is the number of
paragraphs and the sum of their lanes modulo 2^19. Texts of the same paragraphs in
any order have equal fingerprints, and paragraphs are inserted into a fingerprint,
or deleted from it, without the rest of the text. Lanes count ones, so twice a
lane less the number of paragraphs is a sum of random signs: the inner product of
two fingerprints estimates how many paragraphs they share. Only built-in functions.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txlake.llm.common import texts

#: A paragraph ends behind a line feed, or behind a full stop, question or exclamation mark and a space;
#: it keeps them, so the paragraphs of a text joined are the text.
PARAGRAPH = r"[^\n]*?(?:\n|[.!?] )|[^\n]+"
#: A hash gives four words of 60 bits. Bit s + 20 j of a word is its lane (s, j), and the three lanes of one
#: s are summed in one long, 20 bits apart and modulo 2^19, so that no sum runs over into the next.
WORDS, SHIFTS, LANES, STRIDE = 4, 20, 3, 20
ONES = sum(1 << (STRIDE * j) for j in range(LANES))
LOW = (1 << (STRIDE - 1)) - 1
MASK = LOW * ONES
COUNT = (1 << 59) - 1
#: Documents are put in order in so many ranges of ids; where they are cut changes the balance alone.
MOST_CUTS = 1024
ROWS_A_CUT = 256
#: Shards of the rows without an id.
NULL_SHARDS = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text in order; none for the empty text."""
    return F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))


def multiset(parts: Column) -> Column:
    """``struct<n, lanes>`` of an array of paragraphs."""

    def word(hashes: Column, w: int) -> Column:
        digits = F.transform(hashes, lambda h: F.conv(F.substring(h, 15 * w + 1, 15), 16, 10))
        return F.transform(digits, lambda d: d.cast("long"))

    def lane(words: Column, i: Column) -> Column:
        shift = F.pmod(i, F.lit(SHIFTS))
        bits = words[F.floor(i / SHIFTS).cast("int")]
        return F.aggregate(
            bits,
            F.lit(0).cast("long"),
            lambda total, b: (total + F.call_function("shiftright", b, shift).bitwiseAND(F.lit(ONES))).bitwiseAND(F.lit(MASK)),
        )

    hashes = F.transform(parts, lambda p: F.sha2(p, 256))
    words = _let(hashes, lambda h: F.array(*[word(h, w) for w in range(WORDS)]))
    every = F.sequence(F.lit(0), F.lit(WORDS * SHIFTS - 1))
    lanes = _let(words, lambda ws: F.transform(every, lambda i: lane(ws, i)))
    return F.struct(F.size(parts).cast("long").alias("n"), lanes.alias("lanes"))


def fingerprint(text: Column) -> Column:
    """``struct<n, lanes>`` of a text's paragraphs."""
    return multiset(paragraphs(text))


def joined(a: Column, b: Column) -> Column:
    """The fingerprint of all paragraphs of two."""
    lanes = F.zip_with(a["lanes"], b["lanes"], lambda x, y: (x + y).bitwiseAND(F.lit(MASK)))
    return F.struct((a["n"] + b["n"]).bitwiseAND(F.lit(COUNT)).alias("n"), lanes.alias("lanes"))


def inverse(a: Column) -> Column:
    """What, joined with ``a``, gives the fingerprint of the empty text."""
    lanes = F.transform(a["lanes"], lambda x: (F.lit(MASK + ONES) - x).bitwiseAND(F.lit(MASK)))
    return F.struct((F.lit(COUNT + 1) - a["n"]).bitwiseAND(F.lit(COUNT)).alias("n"), lanes.alias("lanes"))


def inserted(a: Column, parts: Column) -> Column:
    return joined(a, multiset(parts))


def deleted(a: Column, parts: Column) -> Column:
    return joined(a, inverse(multiset(parts)))


def shown(a: Column) -> Column:
    """A fingerprint as lowercase hex: the count and each long in 15 digits."""

    def digits(x: Column) -> Column:
        return F.lpad(F.lower(F.hex(x)), 15, "0")

    return F.concat(digits(a["n"]), F.array_join(F.transform(a["lanes"], digits), ""))


def signs(a: Column) -> Column:
    """Each lane as a sum of random signs, from its residue next to zero."""
    half = (LOW + 1) // 2

    def lane(x: Column, n: Column, j: int) -> Column:
        ones = F.shiftright(x, STRIDE * j).bitwiseAND(F.lit(LOW))
        return (ones * 2 - n + half).bitwiseAND(F.lit(LOW)) - half

    return F.flatten(F.transform(a["lanes"], lambda x: F.array(*[lane(x, a["n"], j) for j in range(LANES)])))


def likeness(x: Column, y: Column) -> Column:
    """Of two arrays of ``signs``: twice their inner product over the sum of their squares, within 0 to 1.

    It estimates twice the shared paragraphs over all of both, with a deviation of
    about 0.06. Equal fingerprints have 1, also two of empty texts.
    """

    def product(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0).cast("long"), lambda s, p: s + p)

    def ratio(p: Column) -> Column:
        squares = p["xx"] + p["yy"]
        value = F.lit(2) * p["xy"] / F.nullif(squares, F.lit(0))
        return F.when(squares == 0, 1.0).otherwise(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))

    return _let(F.struct(product(x, y).alias("xy"), product(x, x).alias("xx"), product(y, y).alias("yy")), ratio)


def _cuts(rows: DataFrame) -> tuple[list[int], list[int]]:
    """First ids of the groups but the first, and how many shards each group has.

    Cuts come from a sketch of the ids; an id that fills several of them is a group
    of its own with as many shards.
    """
    n = min(MOST_CUTS, rows.where("doc_id IS NOT NULL").count() // ROWS_A_CUT)
    found = []
    if n > 1:
        shares = [i / n for i in range(1, n)]
        found = rows.agg(F.percentile_approx("doc_id", shares, 10 * n).alias("c")).first()["c"]
    starts, shards = [], [1]
    for cut, times in sorted(Counter(found).items()):
        starts.append(cut)
        shards.append(times)
        if times > 1 and cut + 1 < 1 << 63 and cut + 1 not in found:
            starts.append(cut + 1)
            shards.append(1)
    return starts, shards


def _placed(rows: DataFrame, starts: list[int], shards: list[int]) -> DataFrame:
    """Add ``grp``, the group of an id by binary search, and ``shard``."""
    bounds = F.from_json(F.lit(json.dumps(starts)), "array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(starts).bit_length()))])
    found = F.aggregate(
        steps, F.lit(0), lambda low, step: F.when(F.get(bounds, low + step - 1) <= F.col("doc_id"), low + step).otherwise(low)
    )
    group = F.when(F.col("doc_id").isNull(), len(shards)).otherwise(found) if starts else F.when(F.col("doc_id").isNull(), len(shards)).otherwise(0)
    many = F.get(F.from_json(F.lit(json.dumps([*shards, NULL_SHARDS])), "array<int>"), F.col("grp"))
    return rows.withColumn("grp", group).withColumn("shard", F.pmod(F.monotonically_increasing_id(), many).cast("int"))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, print`` and ``next``, the document with the next larger id, as a struct of text and print.

    After the largest id follows the smallest. Of rows that share an id the one with
    the smallest hash of its text is the next of the id before; all of them have the
    same next. Rows without an id come behind the largest and are no one's next; a
    table of only such rows has a null ``next``.

    Texts are shuffled once, by ranges of ids. A range also gets the first document
    of the range behind it; at most ``2 * MOST_CUTS`` ids and hashes come to the driver.
    """
    spark = docs.sparkSession
    rows = texts(docs)
    starts, shards = _cuts(rows)
    placed = _placed(rows, starts, shards).withColumn("h", F.xxhash64("text"))
    firsts = placed.where("doc_id IS NOT NULL").groupBy("grp").agg(F.min(F.struct("doc_id", "h")).alias("f"))
    firsts = sorted((r.grp, r.f.doc_id, r.f.h) for r in firsts.collect())
    asked = []  # which row goes to which range
    for i, (_, doc_id, h) in enumerate(firsts):
        to = firsts[i - 1][0]
        asked += [(doc_id, h, to, s) for s in range(shards[to])]
        if i == 0:
            asked += [(doc_id, h, len(shards), s) for s in range(NULL_SHARDS)]
    asked = spark.createDataFrame(asked, "doc_id long, h long, grp int, shard int")
    named = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(asked), ["doc_id", "h"])
    guests = named.groupBy("grp", "shard", "doc_id", "h").agg(F.min("text").alias("text"))
    columns = ["grp", "shard", "doc_id", "h", "text", fingerprint(F.col("text")).alias("print")]
    every = placed.select(*columns, F.lit(False).alias("guest")).unionByName(guests.select(*columns, F.lit(True).alias("guest")))
    back = W.partitionBy("grp", "shard").orderBy(F.desc("guest"), F.desc("doc_id"), F.desc("h"), F.desc("text"))
    before = F.lag(F.struct("guest", "doc_id", "text", "print")).over(back)
    every = every.withColumn("before", before)
    other = F.col("before.guest") | ~F.col("before.doc_id").eqNullSafe(F.col("doc_id"))
    every = every.withColumn("turn", F.when(other, F.struct("before.text", "before.print")))
    carried = F.last("turn", ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, 0))
    return every.withColumn("next", carried).where("NOT guest").select("doc_id", "text", "print", "next")


def edited(docs: DataFrame) -> DataFrame:
    """Each text next to an edited form: its last half replaced by as much of the beginning of the next document.

    ``doc_id, text, edited, print, edited_print, next_print``: the edited fingerprint
    comes from the text's by deleting the paragraphs that went and inserting those
    that came. A null text is the empty one, whose fingerprint is zero throughout;
    halves are of code points, rounded down; repeated rows are kept, null ids too
    (see ``with_next``); other columns are ignored; an empty table gives no rows.
    """
    rows = with_next(docs)
    n = F.length("text")
    cut = F.floor(n / 2).cast("int")
    rows = rows.withColumn("kept", F.left("text", n - cut)).withColumn(
        "edited", F.concat("kept", F.left(F.coalesce("next.text", F.lit("")), cut))
    )
    last = F.coalesce(F.length(F.get(paragraphs(F.col("kept")), F.size(paragraphs(F.col("kept"))) - 1)), F.lit(0))
    rows = rows.withColumn("same", F.length("kept") - last)  # up to here both texts have the same whole paragraphs
    went = paragraphs(F.expr("substring(text, same + 1)"))
    came = paragraphs(F.expr("substring(edited, same + 1)"))
    rows = rows.withColumn("went", multiset(went)).withColumn("came", multiset(came))
    return rows.select(
        "doc_id",
        "text",
        "edited",
        "print",
        joined(joined(F.col("print"), inverse(F.col("went"))), F.col("came")).alias("edited_print"),
        F.coalesce("next.print", fingerprint(F.lit(""))).alias("next_print"),
    )


def compared(docs: DataFrame) -> DataFrame:
    """``edited`` with ``near_edited`` and ``near_next``, the likeness of a text's fingerprint to the two others."""
    rows = edited(docs)
    for name in ("print", "edited_print", "next_print"):
        rows = rows.withColumn(f"{name}_signs", signs(F.col(name)))
    return (
        rows.withColumn("near_edited", likeness(F.col("print_signs"), F.col("edited_print_signs")))
        .withColumn("near_next", likeness(F.col("print_signs"), F.col("next_print_signs")))
        .drop("print_signs", "edited_print_signs", "next_print_signs")
    )
