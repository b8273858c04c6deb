"""Token counts and packing, next to the library and to plain reassembly."""

from __future__ import annotations

import random
import string

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tests.llm.conftest import answer
from txlake.llm import packing, tokencount
from txlake.llm.wordbpe import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_are_the_librarys(messy, nothing, library):
    counted = answer(tokencount.count_tokens(messy, PATH, 3000, 40), "doc_id", "n_bytes", "n_tokens")
    expected = [
        (r.doc_id, len((r.text or "").encode()), len(ids_of(library, r.text))) for r in messy.collect()
    ]
    assert counted == sorted(expected, key=repr)
    assert tokencount.count_tokens(nothing, PATH).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        "a" * 900 + " tail",  # no boundary inside the overlap: it must widen
        "x" * 2500,  # none at all: the chunks become one
        "one two three " * 300,
        "né é́ " * 200 + "<|endoftext|>" * 30,
        "don't we'll it's " * 100 + "\n\n\n" * 50,
        "天地玄黄宇宙洪荒。日月盈昃，辰宿列张" * 60,
        "aGVsbG8gd29ybGQ+L1/x9Zk0Q7" * 90,
        "if(a1!='s'&&b2['ll']){c('ve')};" * 60,
        "İ,İ1é́e̋,2x̂3 " * 80 + "İİ.." * 99,
        "ab1<|startoftext|>c2<|endoftext|>" * 60,
    ],
)
def test_splicing_gives_the_whole_texts_count(library, text):
    encode = tokencount.library_encoding(library)
    for chunk, overlap in ((64, 8), (100, 99), (333, 16)):
        assert tokencount.spliced_count(text, encode, chunk, overlap) == len(ids_of(library, text))


def test_long_texts_without_spaces_are_encoded_few_times(library):
    encoded = []

    def encode(text):
        encoded.append(len(text))
        return tokencount.library_encoding(library)(text)

    drawn = random.Random(3)
    chinese = "".join(drawn.choice("，。天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏") for _ in range(200_000))
    base64 = "".join(drawn.choices(string.ascii_letters + string.digits + "+/", k=200_000))
    for text in (chinese, base64, "".join(drawn.choices(string.ascii_letters, k=200_000))):
        encoded.clear()
        assert tokencount.spliced_count(text, encode, 20_000, 512) == len(ids_of(library, text))
        assert sum(encoded) < 1.6 * len(text)


def test_words_give_the_texts_ids(library):
    text = "It's ÀB, (x)... <|startoftext|> ΑΣ ß 1st no.0 #tag_x  wide naïve… l'été ½a ⅷ"
    assert encoder(PATH).ids(text) == brute.np.array(ids_of(library, text), "<u4").tobytes()


def test_words_that_look_like_another_ones_bytes(library):
    for text in ["é Ã©", "Ã© é", "naïve naÃ¯ve", "Ä Ġ ĠĠ Ä", "ñ, Ã±, Ã± ñ"]:
        assert encoder(PATH).ids(text) == brute.np.array(ids_of(library, text), "<u4").tobytes()


def pieces_hold(pieces, whole, capacity):
    """Each id once, sequences without gaps and within the limit; gives tokens and padding."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc_id, parts in by_doc.items():
        copies = whole[doc_id]
        parts.sort(key=lambda p: (p.start, p.length))
        assert sum(p.length for p in parts) == sum(map(len, copies))
        assert {p.doc_tokens for p in parts} <= set(map(len, copies))
        if len(copies) == 1:
            at = 0
            for p in parts:
                assert p.start == at and bytes(p.ids) == brute.np.array(copies[0][at : at + p.length], "<u4").tobytes()
                at += p.length
    assert set(by_doc) == {k for k, v in whole.items() if any(v)}
    padding = total = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return total, padding


def test_texts_are_packed_whole(messy, nothing, library):
    whole = {}
    for r in messy.collect():
        whole.setdefault(r.doc_id, []).append([*ids_of(library, r.text), 1])
    pieces = packing.pack_texts(messy, PATH).collect()
    pieces_hold(pieces, whole, 2048)
    assert packing.pack_texts(nothing, PATH).count() == 0


def test_packing_keeps_every_limit(spark):
    limits = packing.Limits(tokens=64, segments=3, loss_tokens=20, slack=2, pool=8)
    rows = [(i, [i * 100 + j for j in range(1 + i * 7 % 150)], [j % 3 == 0 for j in range(1 + i * 7 % 150)]) for i in range(60)]
    rows += [(90, [], []), (91, None, None), (92, list(range(200)), None)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>, loss array<boolean>").coalesce(1)
    pieces = packing.pack_tokens(df, limits).collect()
    pieces_hold(pieces, {i: [ids] if ids else [] for i, ids, _ in rows}, 64)
    loss, by_sequence = {i: m for i, _, m in rows}, {}
    for p in pieces:
        mask = loss[p.doc_id]
        assert p.loss_tokens == (p.length if mask is None else sum(mask[p.start : p.start + p.length]))
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for parts in by_sequence.values():
        assert len(parts) <= 3 and sum(p.loss_tokens for p in parts) <= 20


def test_packing_leaves_little_padding(spark):
    drawn = brute.np.random.default_rng(1)
    rows = [(i, [7] * int(n), None) for i, n in enumerate(drawn.lognormal(5, 1.2, 1500))]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>, loss array<boolean>").repartition(2)
    total, padding = pieces_hold(packing.pack_tokens(df).collect(), {i: [ids] for i, ids, _ in rows}, 2048)
    assert padding < 0.005 * total


def test_a_mask_of_another_length_is_refused(spark):
    df = spark.createDataFrame([(1, [1, 2], [True])], "doc_id long, ids array<int>, loss array<boolean>")
    with pytest.raises(Exception, match="loss marks"):
        packing.pack_tokens(df).collect()


def test_the_memo_is_bounded(monkeypatch, library):
    from txlake.llm import wordbpe

    own = wordbpe.WordEncoder(PATH)
    monkeypatch.setattr(wordbpe, "MEMO_WORDS", 50)
    monkeypatch.setattr(wordbpe, "MEMO_CHARS", 4000)
    for text in [" ".join(f"word{i} other{i}, é{'ab' * (i % 7)}." for i in range(n, n + 40)) for n in range(0, 400, 40)] + ["x" * 9000 + " y"]:
        own.prepare([text])
        assert own.ids(text) == brute.np.array(ids_of(library, text), "<u4").tobytes()
        assert len(own.memo) <= 200 and own.chars <= 9100
