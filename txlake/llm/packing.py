"""Vector bin packing of token sequences by the dot-product heuristic.

Every sequence has three limits: tokens, segments, and tokens that bear loss. A
sequence is filled by the waiting example whose demand has the largest dot product
with what is left of the limits, each dimension weighted by how much of it the
waiting examples ask for. When nothing fits any more and more than ``slack``
tokens are free, the best example is cut to fill them and its rest waits on.

Each task packs its own partition from a pool of fixed size, so memory doesn't
follow the input and nothing is shuffled. Sequence ids hold the partition and a
counter: a task that runs again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import slices, texts
from txlake.llm.wordbpe import encoder

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"
_ARROW = pa.schema(
    [(n, pa.binary() if n == "ids" else pa.int64()) for n in (c.split()[0] for c in PIECES.split(", "))]
)
#: Sequences that one partition can have.
PER_PARTITION = 1 << 36


@dataclass(frozen=True)
class Limits:
    """What a sequence can hold, free tokens that aren't worth a cut, and how many examples wait at most."""

    tokens: int = 2048
    segments: int = 128
    loss_tokens: int = 2048
    slack: int = 8
    pool: int = 192


@dataclass
class Example:
    """Part of a document: ids from ``start`` on, and how many of the first i bear loss (None: all do)."""

    doc_id: int | None
    ids: np.ndarray
    doc_tokens: int
    start: int = 0
    loss: np.ndarray | None = None

    def demand(self) -> tuple[int, int, int]:
        return len(self.ids), 1, self.loss_of(len(self.ids))

    def loss_of(self, n: int) -> int:
        return n if self.loss is None else int(self.loss[n] - self.loss[0])

    def fitting(self, tokens: int, loss: int) -> int:
        """The longest head within both limits."""
        n = min(tokens, len(self.ids))
        if self.loss is None:
            return min(n, loss)
        return min(n, int(np.searchsorted(self.loss, self.loss[0] + loss, "right")) - 1)

    def cut(self, n: int) -> tuple[Example, Example]:
        head = Example(self.doc_id, self.ids[:n], self.doc_tokens, self.start, None if self.loss is None else self.loss[: n + 1])
        rest = Example(self.doc_id, self.ids[n:], self.doc_tokens, self.start + n, None if self.loss is None else self.loss[n:])
        return head, rest


class Packer:
    def __init__(self, limits: Limits):
        if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
            raise ValueError("a limit below 1 leaves no room for any example")
        self.limits = limits
        self.size = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.waiting: list[Example] = []
        self.demand = np.zeros((2 * limits.pool + 2, 3))

    def _wait(self, example: Example) -> None:
        if len(self.waiting) == len(self.demand):
            self.demand = np.vstack([self.demand, np.zeros_like(self.demand)])
        self.demand[len(self.waiting)] = example.demand()
        self.waiting.append(example)

    def _take(self, i: int) -> Example:
        """Out of the pool; the last one moves into its place."""
        example, last = self.waiting[i], self.waiting.pop()
        if i < len(self.waiting):
            self.waiting[i] = last
            self.demand[i] = self.demand[len(self.waiting)]
        return example

    def feed(self, example: Example) -> Iterator[list[Example]]:
        """Add one example; gives the sequences that are full by now."""
        while len(example.ids):
            n = example.fitting(self.limits.tokens, self.limits.loss_tokens)
            head, example = example.cut(n) if n < len(example.ids) else (example, example.cut(n)[1])
            if n == self.limits.tokens:
                yield [head]
            else:
                self._wait(head)
        if len(self.waiting) >= 2 * self.limits.pool:
            while len(self.waiting) > self.limits.pool:
                yield self.fill()

    def fill(self) -> list[Example]:
        """One sequence from the pool."""
        left, inside = self.size.copy(), []
        weight = self.demand[: len(self.waiting)].sum(axis=0) / self.size**2
        while self.waiting and left.min() >= 1:
            demand = self.demand[: len(self.waiting)]
            value = demand @ (weight * left)
            fits = (demand <= left).all(axis=1)
            if fits.any():
                inside.append(self._take(int(np.where(fits, value, -1.0).argmax())))
                left -= inside[-1].demand()
                continue
            if inside and left[0] <= self.limits.slack:
                break
            i = int(value.argmax())
            n = self.waiting[i].fitting(int(left[0]), int(left[2]))
            if n < 1:
                break
            head, rest = self._take(i).cut(n)
            inside.append(head)
            self._wait(rest)
            break
        return inside

    def finish(self) -> Iterator[list[Example]]:
        """The rest of the pool; a last sequence with room left is cut at powers of two, which need no padding."""
        while self.waiting:
            sequence = self.fill()
            if self.waiting:
                yield sequence
                continue
            while sequence:
                total = sum(len(e.ids) for e in sequence)
                room, part = (total if total == self.limits.tokens else 1 << (total.bit_length() - 1)), []
                while room:
                    head, rest = sequence[0].cut(min(room, len(sequence[0].ids)))
                    part.append(head)
                    room -= len(head.ids)
                    sequence = [rest, *sequence[1:]] if len(rest.ids) else sequence[1:]
                yield part


def pack_stream(examples: Iterable[Example], limits: Limits, first_id: int) -> Iterator[pa.RecordBatch]:
    """Pieces of one task's examples."""
    packer, rows, number = Packer(limits), [], first_id

    def sequences() -> Iterator[list[Example]]:
        for example in examples:
            yield from packer.feed(example)
        yield from packer.finish()

    def batch() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
        )

    for sequence in sequences():
        offset = 0
        for e in sequence:
            n = len(e.ids)
            rows.append((e.doc_id, e.start, n, e.ids.tobytes(), e.doc_tokens, e.loss_of(n), number, offset))
            offset += n
        number += 1
        if len(rows) >= 1000:
            yield batch()
            rows = []
    if rows:
        yield batch()


def _first_id() -> int:
    return TaskContext.get().partitionId() * PER_PARTITION


def pack_tokens(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Pack ``doc_id, ids array<int>, loss array<boolean>`` (null: all ids bear loss).

    Null or empty ``ids`` give no piece; a null ``doc_id``, repeated rows and ties
    are kept as they are; other columns are ignored; an empty table gives no rows.
    A ``loss`` of another length than ``ids`` is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Example]:
            for batch in slices(batches):
                for doc_id, ids, loss in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if not ids:
                        continue
                    if loss is not None and len(loss) != len(ids):
                        raise ValueError(f"document {doc_id}: {len(loss)} loss marks for {len(ids)} ids")
                    before = None if loss is None else np.concatenate([[0], np.cumsum(np.array(loss, bool))])
                    yield Example(doc_id, np.array(ids, "<u4"), len(ids), 0, before)

        yield from pack_stream(rows(), limits, _first_id())

    return examples.select(F.col("doc_id").cast("long"), "ids", "loss").mapInArrow(run, PIECES)


def pack_texts(docs: DataFrame, tokenizer_path: str, end_id: int = 1, limits: Limits = Limits()) -> DataFrame:
    """Encode ``text`` and pack it in one pass: every document is its ids and then ``end_id``.

    A null or empty text is the end id alone; repeated rows are packed each, a null
    ``doc_id`` is kept, other columns are ignored, an empty table gives no rows.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)

        def rows() -> Iterator[Example]:
            for batch in slices(batches):
                words.prepare(batch.column(1).to_pylist())
                for doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                    ids = np.frombuffer(words.ids(text) + end, "<u4")
                    yield Example(doc_id, ids, len(ids))

        yield from pack_stream(rows(), limits, _first_id())

    return texts(docs).mapInArrow(run, PIECES)
