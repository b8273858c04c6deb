"""Token counts of whole texts; huge ones by overlap resynchronisation.

A text beyond ``chunk_chars`` is encoded in overlapping chunks with offsets. Two
neighbours are spliced at a position in their overlap that both encodings start a
token at, that is a boundary of pre-tokens whatever stands before and after it, and
from which on both give the same ids. Where the overlap holds no such position it
is doubled; where a chunk holds none at all, the chunk is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import slices, texts
from txlake.llm.wordbpe import encoder

#: Ids that both encodings must share from a splice on, or all up to the left chunk's last word.
AGREEING = 4

#: (ids, start of each id in the chunk's text)
Encoded = tuple[np.ndarray, np.ndarray]


def library_encoding(library) -> Callable[[str], Encoded]:
    def encode(text: str) -> Encoded:
        e = library.encode(text, add_special_tokens=False)
        return np.array(e.ids, np.int64), np.array([o[0] for o in e.offsets], np.int64)

    return encode


#: Positions that end every pre-token: behind a space or line feed, and where letters, numbers and marks
#: meet, numbers among themselves too. Not before a combining mark, which a normal form may draw into the
#: character before it, nor behind an apostrophe, which may take letters along, nor behind the capital I
#: with a dot, whose lower case ends in a mark.
_BOUNDARY = regex.compile(
    r"(?<=[ \n])(?=\S)|(?<=\p{N})(?=[^\s\p{M}])|(?<=[^\s\p{M}])(?=\p{N})"
    r"|(?<=[^\P{L}\u0130])(?=[^\s\p{L}\p{N}\p{M}])|(?<=[^\s\p{L}\p{N}\p{M}'])(?=\p{L})"
)
#: No boundary this near to the opening of a special token, which may be one across it.
_SPECIAL, _SPECIAL_REACH = "<|", 32


def boundaries(text: str, begin: int, end: int) -> list[int]:
    """Positions in ``text[begin + 1:end]`` that are boundaries of pre-tokens whatever stands around them."""
    found = [m.start() for m in _BOUNDARY.finditer(text, begin, min(end + 1, len(text))) if begin < m.start() < end]
    if _SPECIAL in text[max(0, begin - _SPECIAL_REACH) : end + _SPECIAL_REACH]:
        found = [p for p in found if _SPECIAL not in text[max(0, p - _SPECIAL_REACH) : p + _SPECIAL_REACH]]
    return found


def splice_point(stable: list[int], left: Encoded, right: Encoded) -> int | None:
    """The first of the stable positions that both encodings start at and agree from; starts are positions in the text."""
    (a_ids, a_at), (b_ids, b_at) = left, right
    whole = stable[-1]  # beyond it the left chunk may end inside a pre-token
    for at in np.intersect1d(np.intersect1d(a_at, b_at), np.array(stable[:-1], np.int64)):
        i, j = np.searchsorted(a_at, at), np.searchsorted(b_at, at)
        n = min(AGREEING, np.searchsorted(a_at, whole) - i)
        if n > 0 and np.array_equal(a_ids[i : i + n], b_ids[j : j + n]) and np.array_equal(a_at[i : i + n], b_at[j : j + n]):
            return int(at)
    return None


def spliced_count(text: str, encode: Callable[[str], Encoded], chunk: int, overlap: int) -> int:
    """Tokens of a text, from chunks of ``chunk`` characters that overlap by ``overlap`` at first.

    What is encoded again grows by halves at most: a chunk without a boundary is
    first made twice as long and only then encoded.
    """

    def part(begin: int, end: int) -> Encoded:
        ids, at = encode(text[begin:end])
        return ids, at + begin

    total, settled, end = 0, 0, min(chunk, len(text))
    left: Encoded | None = None
    while end < len(text):
        wide, after, at = overlap, min(len(text), end + chunk), None
        while at is None:
            begin = max(settled, end - wide)
            stable = boundaries(text, begin, end)
            if len(stable) > 1:
                left = left or part(settled, end)
                right = part(begin, after)
                at = splice_point(stable, left, right)
            if begin == settled:
                break
            wide *= 2
        if at is None:
            end, left = min(len(text), max(2 * end - settled, after)), None
        else:
            total += int(np.count_nonzero(left[1] < at))
            keep = right[1] >= at
            settled, left, end = at, (right[0][keep], right[1][keep]), after
    return total + len((left or part(settled, end))[0])


def count_tokens(
    docs: DataFrame, tokenizer_path: str, chunk_chars: int = 50_000, overlap_chars: int = 512
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row; a null text counts as empty (0, 0).

    Rows are independent: no shuffle, repeated rows are counted each, a null
    ``doc_id`` is kept, other columns are ignored, an empty table gives no rows.
    ``tokenizer_path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        encode = library_encoding(words.library)
        for batch in slices(batches):
            whole = batch.column("text").to_pylist()
            words.prepare([t for t in whole if len(t) <= chunk_chars])
            counts = [
                words.count(t) if len(t) <= chunk_chars else spliced_count(t, encode, chunk_chars, overlap_chars)
                for t in whole
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    source = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return source.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
