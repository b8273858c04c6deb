"""A public tokenizer with a memo of words.

The tokenizers used here end every pre-token at white space, so a text cut at
ASCII spaces and line feeds has the ids of its words, one after the other. Words
repeat; each worker keeps the ids of those it has met, up to a fixed number. The
library itself encodes what is new.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

import numpy as np

#: Fewer words and characters than this are kept; at the bound the memo starts again.
MEMO_WORDS = 300_000
MEMO_CHARS = 16_000_000
#: New words are joined into texts of this many for one call of the library.
JOINED = 400

_LETTERS_THEN_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-^`{-~]+)\Z")
_OPEN: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder of a tokenizer file."""
    if path not in _OPEN:
        _OPEN[path] = WordEncoder(path)
    return _OPEN[path]


def _byte_characters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            setup = json.load(file)
        stages = setup["pre_tokenizer"].get("pretokenizers", [])
        if not any("\\s" in str(s.get("pattern", "")) and s.get("behavior") == "Removed" for s in stages):
            raise ValueError(f"{path}: its pre-tokens may span white space, words can't be encoded alone")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.separator = self.library.encode("0", add_special_tokens=False).ids
        # NFC and lower case, letters as one pre-token, bytes as characters: then the model can take a word of letters as it is
        kinds = [n["type"] for n in (setup["normalizer"] or {}).get("normalizers", [])]
        self.plain = kinds == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in stages] == ["Split", "ByteLevel"]
        self.shown = _byte_characters()
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, bytes] = {"": b""}
        self.letters: dict[str, bytes] = {}  # by what the model takes, which may look like another word
        self.stems: dict[str, bytes] = {"": b""}  # by the text itself
        self.chars = 0

    def _full(self) -> bool:
        return max(len(self.memo), len(self.letters), len(self.stems)) > MEMO_WORDS or self.chars > MEMO_CHARS

    def ids(self, text: str) -> bytes:
        """All ids of a text as little-endian 32-bit integers."""
        return b"".join(self._words(text))

    def count(self, text: str) -> int:
        return sum(map(len, self._words(text))) // 4

    def prepare(self, texts: list[str]) -> None:
        """Learn the words of many texts with few calls of the library."""
        if self._full():
            self._forget()
        self._learn({w for t in texts for w in t.replace("\n", " ").split(" ")}.difference(self.memo))

    def _words(self, text: str) -> list[bytes]:
        words = text.replace("\n", " ").split(" ")
        memo = self.memo
        try:
            return [memo[w] for w in words]
        except KeyError:
            self._learn({w for w in words if w not in memo})
        found = [memo[w] for w in words]
        if self._full():
            self._forget()
        return found

    def _learn(self, words: set[str]) -> None:
        """Letters followed by ASCII marks are two pre-tokens, each encoded and kept alone."""
        self.chars += sum(map(len, words))
        letters, stems, memo = self.letters, self.stems, self.memo
        model, marked = self.library.model, _LETTERS_THEN_MARKS.match
        later: list[str] = []
        cut: list[tuple[str, str, str]] = []
        for word in words:
            stem, marks = word, ""
            if not word.isalpha() and (m := marked(word)) and "<|" not in word:
                stem, marks = m[1], m[2]
            if stem.isalpha():
                stem = self._letters(stem)
                if stem and stem not in letters:
                    letters[stem] = array("I", [t.id for t in model.tokenize(stem)]).tobytes()
            else:
                stem = ""
            if not stem:
                later.append(word)
            elif marks:
                if marks not in stems:
                    later.append(marks)
                cut.append((word, stem, marks))
            else:
                memo[word] = letters[stem]
        self._encode(sorted(set(later).difference(stems)))
        memo.update((w, letters[a] + stems[b]) for w, a, b in cut)
        memo.update((w, stems[w]) for w in later)

    def _letters(self, word: str) -> str:
        """What the tokenizer's normalizer and byte map make of a word of letters; nothing if it isn't one pre-token then."""
        if word.isascii():
            return word.lower() if self.plain else ""
        plain = unicodedata.normalize("NFC", word)
        if not self.plain or "\u03a3" in plain or not (plain := plain.lower()).isalpha():
            return ""
        return plain.encode().decode("latin-1").translate(self.shown)

    def _encode(self, words: list[str]) -> None:
        """Joined by a digit, which is a pre-token of its own; words that hold it go alone."""
        plain = [w for w in words if "0" not in w]
        texts = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        alone = [w for w in words if "0" in w]
        joined = self.library.encode_batch_fast([" 0 ".join(t) for t in texts], add_special_tokens=False)
        for group, encoded in zip(texts, joined, strict=True):
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(ids == self.separator[0])
            if len(self.separator) != 1 or len(ends) != len(group) - 1:
                alone += group
                continue
            raw, begin = ids.tobytes(), 0
            for word, end in zip(group, [*(4 * ends).tolist(), len(raw)], strict=True):
                self.stems[word] = raw[begin:end]
                begin = end + 4
        for word, encoded in zip(alone, self.library.encode_batch_fast(alone, add_special_tokens=False), strict=True):
            self.stems[word] = np.array(encoded.ids, "<u4").tobytes()
