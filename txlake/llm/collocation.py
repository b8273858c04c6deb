"""Phrase collocations, counted with broadcast double-array tries.

Three passes over the texts. The first counts all runs of one to four words in two
tables of hash buckets of a fixed size; a run that occurs often lies in a bucket of
either that is counted often (runs are told apart by 64-bit hashes there). The second takes as candidates the runs that lie in such buckets
themselves and whose parts all do (no frequent run is left out, as its parts occur
at least as often). The third counts the candidates: they are cut into tries of a
fixed size, which are broadcast a few at a time, and in each task numpy advances
the states of all text positions word by word through a trie and counts the states
it ends in; the counts of all tasks are summed. Scores and the choice are joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txlake.llm import trie
from txlake.llm.common import slices
from txlake.sources.shared import discard, stage

MOST_WORDS = 4
LEAST_COUNT = 30
#: A phrase goes if a longer one has at least so many hundredths of its count.
COVERED = 80
MOST_PHRASES = 2000
SCALE = 2_000_000

#: Tables of a level, and the buckets of each, in bits; they are written and summed in blocks.
TABLES, BITS, BLOCK_BITS = 2, 23, 16
#: Characters for each bucket of a table: with many more all buckets are counted often and tell nothing, so large inputs get more
#: buckets, up to so many bits (64 MB of maps in all).
BUCKET_CHARS, MOST_BITS = 128, 26
#: Candidates of one trie, and tries broadcast at once.
TRIE_PHRASES, TRIES = 200_000, 8
#: Text of one language that is cut into words at once.
SEGMENT = 1 << 20
#: Hashes counted, states counted and candidates sent in one go, and hashes of candidates remembered.
HELD = 1 << 21
SEEN = 1 << 22
#: Numbers that candidates are dealt by, and phrases whose counts are sent and summed as one block.
DEALS = 4096
COUNTS = 4096
#: Blocks of buckets sent as one batch.
SENT = 512
#: Parts of a language that its first phrases are chosen in.
SALTS = 32

#: A-Z become a-z, what ends a piece a line feed, a tab a space.
_CHARS = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\v\f\r" else 32 if b == 9 else b for b in range(256))
_TAIL = re.compile(rb"(?: +[^ \n]+){0,%d}" % (MOST_WORDS - 1))
_END = re.compile(rb"[ \n]")
#: Stands between pieces; no byte of UTF-8.
_BREAK = b"\xff"

_FACTOR = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def segments(data: bytes, size: int = SEGMENT) -> Iterator[tuple[bytes, int]]:
    """Cut text at pieces, or inside a long one at words: then its next words follow, and how many is given."""
    at = 0
    while len(data) - at > size:
        cut = data.rfind(b"\n", at, at + size)
        if cut < 0:
            cut = data.rfind(b" ", at, at + size)
            if cut < 0:
                met = _END.search(data, at + size)
                if met is None:
                    break
                cut = met.start()
        end = _TAIL.match(data, cut).end()
        yield data[at:end], len(data[cut:end].split())
        at = cut + 1
    yield data[at:], 0


def by_language(batch: pa.RecordBatch) -> dict[str, bytes]:
    """The texts of a batch as one piece-wise text a language."""
    said: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        said.setdefault(lang, []).append(text.encode().translate(_CHARS))
    return {lang: b"\n".join(t) for lang, t in said.items()}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a fixed odd number and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) <= n:
        for i, x in enumerate((_FACTOR, pow(_FACTOR, -1, 1 << 64))):
            run = np.full(max(n + 1, SEGMENT), x, np.uint64)
            run[0] = 1
            _POWERS[i] = np.multiply.accumulate(run)
    return _POWERS[0], _POWERS[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def runs(data: bytes, lang: str) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Begin and end of every word, and for each level the hash of the run that begins there and whether it is within a piece."""
    chars = np.frombuffer(data, np.uint8)
    broken = chars == 10
    word = np.zeros(len(chars) + 2, np.int8)
    word[1:-1] = ~(broken | (chars == 32))
    turns = np.diff(word)
    begins, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    piece = np.cumsum(broken, dtype=np.int32)[begins] if len(begins) else np.zeros(0, np.int32)
    power, inverse = _powers(len(chars))
    sums = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * power[: len(chars)], out=sums[1:])
    seed = np.uint64(int.from_bytes(lang.encode()[:64].ljust(8, b"\0"), "little") % (1 << 64))
    one = _mixed((sums[ends] - sums[begins]) * inverse[begins] + seed)
    levels = [(one, np.ones(len(one), bool))]
    for k in range(1, MOST_WORDS):
        h, _ = levels[-1]
        n = max(len(one) - k, 0)
        levels.append((_mixed(h[:n] * np.uint64(0xA0761D6478BD642F) + one[k:]), piece[:n] == piece[k:]))
    return begins, ends, levels


def _buckets(h: np.ndarray, bits: int = BITS) -> list[np.ndarray]:
    """The bucket of each run in each table."""
    return [((h >> np.uint64(64 - (t + 1) * bits)) & np.uint64((1 << bits) - 1)).astype(np.uint32) for t in range(TABLES)]


def bucket_bits(rows: DataFrame) -> int:
    """Bits of a table's buckets for all the texts."""
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(BITS, (chars // BUCKET_CHARS).bit_length()), MOST_BITS)


class BucketCounts:
    """How often each bucket of each table was met, up to ``LEAST_COUNT``; the tables of a level follow each other."""

    def __init__(self) -> None:
        self.counts = np.zeros((MOST_WORDS * TABLES, 1 << BITS), np.uint8)
        self.waiting: list[list[np.ndarray]] = [[] for _ in range(MOST_WORDS * TABLES)]
        self.n = 0

    def add(self, levels: list[tuple[np.ndarray, np.ndarray]]) -> None:
        for level, (h, valid) in enumerate(levels):
            for t, buckets in enumerate(_buckets(h[valid])):
                self.waiting[level * TABLES + t].append(buckets)
        self.n += len(levels[0][0])
        if self.n > HELD:
            self.settle()

    def settle(self) -> None:
        for counts, found in zip(self.counts, self.waiting, strict=True):
            if found:
                met, n = np.unique(np.concatenate(found), return_counts=True)
                counts[met] = np.minimum(counts[met] + np.minimum(n, LEAST_COUNT), LEAST_COUNT)
                found.clear()
        self.n = 0

    def blocks(self) -> Iterator[tuple[int, int, int, bytes]]:
        """Table, block, its size and its counts, compressed."""
        self.settle()
        for number, counts in enumerate(self.counts):
            for block, part in enumerate(counts.reshape(-1, 1 << BLOCK_BITS)):
                if part.any():
                    yield number, block, part.nbytes, pa.compress(part.tobytes(), codec="zstd", asbytes=True)


def _block_bits(bits: int) -> int:
    """Bits of a block: larger tables have 1,024 blocks each, so that what a task sends of one is small."""
    return BLOCK_BITS if bits == BITS else bits - 10


class SparseCounts(BucketCounts):
    """``BucketCounts`` of larger tables, which one task meets few buckets of: what has gathered is given out and forgotten."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.waiting: list[list[np.ndarray]] = [[] for _ in range(MOST_WORDS * TABLES)]
        self.n = 0

    def add(self, levels: list[tuple[np.ndarray, np.ndarray]]) -> None:
        for level, (h, valid) in enumerate(levels):
            for t, buckets in enumerate(_buckets(h[valid], self.bits)):
                self.waiting[level * TABLES + t].append(buckets)
        self.n += len(levels[0][0])

    def blocks(self) -> Iterator[tuple[int, int, int, bytes]]:
        """Table, block, size, and the buckets met in it followed by their counts."""
        for number, found in enumerate(self.waiting):
            met, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            found.clear()
            if not len(met):
                continue
            size = _block_bits(self.bits)
            block, begins = np.unique(met >> size, return_index=True)
            at, n = (met & ((1 << size) - 1)).astype(np.uint16), np.minimum(n, LEAST_COUNT).astype(np.uint8)
            for b, i, j in zip(block.tolist(), begins.tolist(), [*begins[1:].tolist(), len(met)], strict=True):
                yield number, b, 3 * (j - i), pa.compress(at[i:j].tobytes() + n[i:j].tobytes(), codec="zstd", asbytes=True)
        self.n = 0


def _dense(size: int, counts: bytes, bits: int) -> np.ndarray:
    """A block's counts, of ``size`` bytes before they were compressed: all of them, or in larger tables three bytes for each bucket met."""
    raw = np.frombuffer(pa.decompress(counts, size, codec="zstd"), np.uint8)
    if bits == BITS:
        return raw
    part, met = np.zeros(1 << _block_bits(bits), np.uint8), size // 3
    part[raw[: 2 * met].view(np.uint16)] = raw[2 * met :]
    return part


def _counted(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """First pass: words by language (``table`` -1), and for each task its buckets in compressed blocks."""
    names = ["table", "block", "size", "counts", "lang", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, words = BucketCounts() if bits == BITS else SparseCounts(bits), {}
        for batch in slices(batches):
            for lang, data in by_language(batch).items():
                for part, tail in segments(data):
                    begins, _, levels = runs(part, lang)
                    words[lang] = words.get(lang, 0) + len(begins) - tail
                    buckets.add(levels)
            if bits != BITS and buckets.n > HELD:
                yield from sent(buckets)
        yield pa.RecordBatch.from_pylist([{"table": -1, "block": -1, "lang": k, "n": n} for k, n in words.items()], pa.schema(fields))
        yield from sent(buckets)

    def sent(buckets: BucketCounts) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], [], []]
        for row in buckets.blocks():
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            if len(columns[0]) == SENT:
                yield batch_of(columns)
                columns = [[], [], [], []]
        yield batch_of(columns)

    def batch_of(columns: list[list]) -> pa.RecordBatch:
        n = len(columns[0])
        arrays = [pa.array(c, t) for c, (_, t) in zip([*columns, [None] * n, [None] * n], fields, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    fields = list(zip(names, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.int64()), strict=True))
    return rows.mapInArrow(run, "table int, block int, size int, counts binary, lang string, n long")


def _frequent_buckets(blocks: DataFrame, bits: int = BITS) -> list[np.ndarray]:
    """For each table a bit per bucket, set where all tasks together met it ``LEAST_COUNT`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in slices(batches):
            for number, block, size, counts in zip(*(batch.column(c).to_pylist() for c in ("table", "block", "size", "counts")), strict=True):
                part = _dense(size, counts, bits)
                so_far = sums.get((number, block))
                sums[number, block] = part if so_far is None else np.minimum(so_far + part, LEAST_COUNT)
        for (number, block), s in sums.items():
            columns = [pa.array([number], pa.int32()), pa.array([block], pa.int32()), pa.array([np.packbits(s >= LEAST_COUNT).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["table", "block", "bits"])

    maps = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(MOST_WORDS * TABLES)]
    dealt = blocks.select("table", "block", "size", "counts").repartition("table", "block")
    found = stage(dealt.mapInArrow(run, "table int, block int, bits binary"), "maps")
    for row in found.toLocalIterator():  # 8 MB in all, or up to 64
        size = 1 << (_block_bits(bits) - 3)
        maps[row.table][row.block * size : (row.block + 1) * size] = np.frombuffer(row.bits, np.uint8)
    discard(found)
    return maps


def _safe(levels: list[tuple[np.ndarray, np.ndarray]], maps: list[np.ndarray]) -> list[np.ndarray]:
    """For each level where a run begins that lies in frequent buckets as all its parts do."""
    found: list[np.ndarray] = []
    for level, (h, valid) in enumerate(levels):
        ok = valid.copy()
        for bits, at in zip(maps[level * TABLES :], _buckets(h, (8 * len(maps[0])).bit_length() - 1), strict=False):
            ok &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        if found:
            ok &= found[-1][:-1] & found[-1][1:] if len(found[-1]) else False
        found.append(ok)
    return found


def _candidates(rows: DataFrame, maps: list[np.ndarray]) -> DataFrame:
    """Second pass: ``lang, phrase`` of every candidate and of the words in them, once each.

    A task sends a phrase once, as part of a list for each hash of phrases: the lists
    are dealt by that number, and where they meet each phrase is kept once.
    """
    sent = rows.sparkSession.sparkContext.broadcast(maps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint64)
        dealt: dict[int, list[str]] = {}
        n = 0
        for batch in slices(batches):
            fresh: list[np.ndarray] = []
            for lang, data in by_language(batch).items():
                for part, _ in segments(data):
                    begins, ends, levels = runs(part, lang)
                    safe = _safe(levels, sent.value)
                    in_pair = np.zeros(len(begins), bool)
                    in_pair[: len(safe[1])] = safe[1]
                    in_pair[1:] |= in_pair[:-1].copy() if len(in_pair) else False
                    safe[0] = in_pair
                    for k, ((h, _), ok) in enumerate(zip(levels, safe, strict=True)):
                        hashes, first = np.unique(h[ok] + np.uint64(k), return_index=True)
                        at = np.searchsorted(seen, hashes)
                        new = np.flatnonzero(np.append(seen, 0)[at] != hashes) if len(seen) else np.arange(len(hashes))
                        where = np.flatnonzero(ok)[first[new]]
                        for i, deal in zip(where.tolist(), (hashes[new] >> np.uint64(32)).astype(np.int64).tolist(), strict=True):
                            phrase = b" ".join(part[begins[i] : ends[i + k]].split()).decode()
                            dealt.setdefault(deal % DEALS, []).append(f"{lang}\n{phrase}")
                        n += len(new)
                        fresh.append(hashes[new])
            seen = np.sort(np.concatenate([seen, *fresh]))
            if len(seen) > SEEN:
                seen = np.zeros(0, np.uint64)
            if n > HELD:
                yield lists(dealt)
                dealt, n = {}, 0
        yield lists(dealt)

    def lists(dealt: dict[int, list[str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(dealt.keys(), pa.int32()), pa.array(dealt.values(), pa.list_(pa.string()))], names=["deal", "phrases"]
        )

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, set[str]] = {}
        for batch in batches:
            for deal, phrases in zip(batch.column("deal").to_pylist(), batch.column("phrases"), strict=True):
                met.setdefault(deal, set()).update(phrases.as_py())
        for phrases in met.values():
            split = [p.rsplit("\n", 1) for p in sorted(phrases)]
            langs, said = zip(*split, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(said, pa.string())], names=["lang", "phrase"])

    lists_of_tasks = rows.mapInArrow(run, "deal int, phrases array<string>")
    return lists_of_tasks.repartition("deal").mapInArrow(once, "lang string, phrase string")


_TRIE = "trie string, langs array<string>, phrase_lang array<int>, phrases array<string>, vocabulary binary, base binary, check binary, ends binary"


def build_trie(name: str, langs: list[str], phrases: list[str]) -> dict:
    """One row of ``_TRIE``; words are numbered by how many phrases hold them, each language its own."""
    known = sorted(set(langs))
    number = {x: i for i, x in enumerate(known)}
    of_phrase = [number[x] for x in langs]
    split = [[b"%d %s" % (n, w) for w in p.encode().split(b" ")] for n, p in zip(of_phrase, phrases, strict=True)]
    held: dict[bytes, int] = {}
    for words in split:
        for w in words:
            held[w] = held.get(w, 0) + 1
    vocabulary = sorted(held, key=lambda w: (-held[w], w))
    index = {w: i for i, w in enumerate(vocabulary)}
    ids = np.full((len(phrases), MOST_WORDS), -1, np.int64)
    for row, words in zip(ids, split, strict=True):
        row[: len(words)] = [index[w] for w in words]
    built = trie.build(ids)
    return {
        "trie": name, "langs": known, "phrase_lang": of_phrase, "phrases": phrases, "vocabulary": b"\n".join(vocabulary),
        "base": built.base.tobytes(), "check": built.check.tobytes(), "ends": built.ends.tobytes(),
    }


def _tries(candidates: DataFrame) -> DataFrame:
    """Candidates dealt by hash into groups, and each group into tries of at most ``TRIE_PHRASES``."""
    groups = -(-candidates.count() * 10 // (9 * TRIE_PHRASES)) or 1

    def run(table: pa.Table) -> pa.Table:
        group = table.column("grp")[0].as_py()
        langs, phrases = (table.column(c).to_pylist() for c in ("lang", "phrase"))
        made = [
            build_trie(f"{group}-{i}", langs[i : i + TRIE_PHRASES], phrases[i : i + TRIE_PHRASES])
            for i in range(0, len(phrases), TRIE_PHRASES)
        ]
        return pa.Table.from_pylist(made, schema)

    strings, ints, raw = pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary()
    schema = pa.schema(zip([f.split()[0] for f in _TRIE.split(", ")], (pa.string(), strings, ints, strings, raw, raw, raw, raw), strict=True))
    dealt = candidates.withColumn("grp", F.pmod(F.xxhash64("lang", "phrase"), F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(run, _TRIE)


class Vocabulary:
    """The words of several tries in a task, each looked up once for all of them."""

    def __init__(self, rows: list[dict]):
        self.words: dict[str, dict[bytes, int]] = {}
        n, held = 0, []
        for row in rows:
            numbers = []
            for entry in row["vocabulary"].split(b"\n"):
                lang, _, word = entry.partition(b" ")
                known = self.words.setdefault(row["langs"][int(lang)], {})
                if word not in known:
                    known[word], n = n, n + 1
                numbers.append(known[word])
            held.append(numbers)
        self.counters = []
        for row, numbers in zip(rows, held, strict=True):
            own = np.full(n + 1, -1, np.int32)  # the last one is for words that no trie holds
            own[numbers] = np.arange(len(numbers))
            self.counters.append(Counter(row, own))

    def add(self, lang: str, tokens: list[bytes], first: int) -> None:
        """Count what begins at the first so many positions."""
        known = self.words.get(lang)
        if known:
            ids = np.fromiter(map(known.get, tokens, repeat(-1)), np.int32, len(tokens))
            for c in self.counters:
                c.add(c.own[ids], first)


class Counter:
    """One trie in a task, and how often each of its states was met."""

    def __init__(self, row: dict, own: np.ndarray):
        self.name, self.own = row["trie"], own
        self.trie = trie.Trie(*[np.frombuffer(row[c], np.int32) for c in ("base", "check", "ends")])
        self.met = np.zeros(len(self.trie.base), np.int64)
        self.waiting: list[np.ndarray] = []
        self.n = 0

    def add(self, ids: np.ndarray, first: int) -> None:
        """Advance the states of all positions together, a word at each level."""
        at = np.flatnonzero(ids[:first] >= 0)
        states = np.full(len(at), trie.ROOT, np.int32)
        ids = np.append(ids, np.int32(-1))
        for _ in range(MOST_WORDS):
            words = ids[at]
            inside = np.flatnonzero(words >= 0)
            if not len(inside):
                break
            on, states = self.trie.step(states[inside], words[inside])
            at = at[inside[on]] + 1
            self.waiting.append(states)
            self.n += len(states)
        if self.n > HELD:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            self.met += np.bincount(np.concatenate(self.waiting), minlength=len(self.met))
        self.waiting, self.n = [], 0

    def found(self) -> pa.RecordBatch:
        """The phrases' counts in compressed blocks."""
        self.settle()
        counts = self.met[self.trie.ends]
        blocks = [counts[i : i + COUNTS] for i in range(0, len(counts), COUNTS)]
        packed = [pa.compress(b.tobytes(), codec="zstd", asbytes=True) for b in blocks]
        columns = [pa.array([self.name] * len(blocks), pa.string()), pa.array(range(len(blocks)), pa.int32()), pa.array([len(b) for b in blocks], pa.int32()), pa.array(packed, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["trie", "block", "size", "counts"])


def _shard_counts(rows: DataFrame, shards: list[dict]) -> DataFrame:
    """Third pass for some tries: ``trie, nth, n``, the occurrences of each trie's nth phrase that reach ``LEAST_COUNT``."""
    sent = rows.sparkSession.sparkContext.broadcast(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(sent.value)
        for batch in slices(batches):
            for lang, data in by_language(batch).items():
                for part, tail in segments(data):
                    tokens = part.replace(b"\n", b" " + _BREAK + b" ").split()
                    words.add(lang, tokens, len(tokens) - tail)
        for c in words.counters:
            yield c.found()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in slices(batches):
            for name, block, size, packed in zip(*(batch.column(c).to_pylist() for c in ("trie", "block", "size", "counts")), strict=True):
                part = np.frombuffer(pa.decompress(packed, 8 * size, codec="zstd"), np.int64)
                sums[name, block] = sums[name, block] + part if (name, block) in sums else part
        for (name, block), n in sums.items():
            often = np.flatnonzero(n >= LEAST_COUNT)
            columns = [pa.array([name] * len(often), pa.string()), pa.array((block * COUNTS + often).astype(np.int32)), pa.array(n[often])]
            yield pa.RecordBatch.from_arrays(columns, names=["trie", "nth", "n"])

    dealt = rows.mapInArrow(run, "trie string, block int, size int, counts binary").repartition("trie", "block")
    summed = stage(dealt.mapInArrow(add, "trie string, nth int, n long"), "trie-counts")
    sent.destroy()
    return summed


def frequent_phrases(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, a`` of every word and phrase that counts, and ``lang, n``, all words of a language."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    bits = bucket_bits(rows)
    counted = stage(_counted(rows, bits), "buckets")
    maps = _frequent_buckets(counted.where("table >= 0"), bits)
    totals = stage(counted.where("table < 0").groupBy("lang").agg(F.sum("n").alias("n")), "words")
    discard(counted)
    candidates = stage(_candidates(rows, maps), "candidates")
    tries = stage(_tries(candidates), "tries")
    discard(candidates)
    names = sorted(r.trie for r in tries.select("trie").collect())  # one for 200,000 candidates
    parts = []
    for i in range(0, len(names), TRIES):
        wave = tries.where(F.col("trie").isin(names[i : i + TRIES]))
        shards = wave.select("trie", "langs", "vocabulary", "base", "check", "ends").collect()  # of a fixed size
        parts.append(_shard_counts(rows, [r.asDict() for r in shards]))
    named = tries.select("trie", F.col("langs"), F.posexplode(F.arrays_zip("phrase_lang", "phrases")).alias("nth", "p"))
    named = named.select("trie", "nth", F.get("langs", F.col("p.phrase_lang")).alias("lang"), F.col("p.phrases").alias("phrase"))
    counts = parts[0] if parts else rows.sparkSession.createDataFrame([], "trie string, nth int, n long")
    for part in parts[1:]:
        counts = counts.unionByName(part)
    words = F.size(F.split("phrase", " "))
    found = named.join(counts, ["trie", "nth"]).select("lang", "phrase", words.alias("words"), F.col("n").alias("a"))
    return stage(found, "phrases"), totals


def _part(begin: Column, words: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), begin, words), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of every candidate at its lowest-scoring cut, ties to the first."""
    able = phrases.where("words > 1")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = able.select("lang", "phrase", "words", "a", cut)
    cuts = cuts.withColumn("left", _part(F.lit(1), F.col("k"))).withColumn("right", _part(F.col("k") + 1, F.col("words")))
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("a").alias(count)), ["lang", side])
    score = F.expr(f"(cast(a as decimal(19,0)) * {SCALE}) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def uncovered(candidates: DataFrame) -> DataFrame:
    """Without those that lie inside a longer candidate which has most of their occurrences."""
    spans = [(b, n) for n in range(2, MOST_WORDS) for b in range(1, MOST_WORDS - n + 2)]
    inside = F.array(*[F.when(F.col("words") >= F.greatest(F.lit(b + n - 1), F.lit(n + 1)), _part(F.lit(b), F.lit(n))) for b, n in spans])
    longer = candidates.where("words > 2").select("lang", F.explode(inside).alias("phrase"), "a").where("phrase IS NOT NULL")
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    covered = F.col("most") * 100 >= F.col("a") * COVERED
    return candidates.join(most, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("most")


def collocations(docs: DataFrame, most: int = MOST_PHRASES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first phrases of each language by score.

    A null ``lang`` is ``und``, a null text empty; texts without words, empty tables
    and languages without a phrase of two to four words that occurs ``LEAST_COUNT``
    times give no rows; repeated rows count each; other columns are ignored. A task
    holds 64 MB of buckets, one million characters of text and ``TRIES`` tries.
    """
    phrases, totals = frequent_phrases(docs)
    kept = uncovered(scored(phrases))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    kept = kept.withColumn("nth", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).where(F.col("nth") <= most)
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return kept.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
