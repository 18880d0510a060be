"""Packing documents into windows of tokens by minimum bin slack.

A document longer than a window gives whole windows first; what remains of it, shorter than a window, is packed with the
remainders of other documents. Each window starts with the longest remainder there is; of all multisets of the other
lengths, bounded by how many remainders of each length are held, the one that comes closest to the capacity joins it. Sums
that lengths can make are bit sets in one integer: a length shifts and joins the set of the lengths below it, as often as
it is held (by doubling), and walking back from the best sum tells how many of each length are taken. Where even the best
multiset leaves slack, a remainder is cut to fill it, so no window has padding. The last tokens of a task, fewer than a
window, fill windows of powers of two, which need no padding either.

Every task packs its own rows in one pass, without a shuffle, and holds a bounded number of remainders; a sequence never
reaches over tasks, so a task that is run again replaces whole sequences.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsieve.llm.vocabulary import ByteLevel

#: Remainders held by a task before windows are filled; half of them stay for the next time.
HELD = 16384
#: Bytes of ids in a batch of pieces.
BATCH_BYTES = 1 << 22
#: Sequences of a task have numbers from its partition's number times this.
TASK_SEQUENCES = 1 << 36


class Lengths:
    """A multiset of lengths up to a window, and the fullest window that can be made of them."""

    def __init__(self, window: int):
        self.window = window
        self.every = (1 << window + 1) - 1
        self.counts = [0] * (window + 1)
        self.present: list[int] = []
        #: sums[i]: bit s is set where some of the lengths present[:i + 1] sum up to s; as far as known, or until all bits are set.
        self.sums: list[int] = []

    def add(self, length: int, by: int) -> None:
        """More (or fewer) of a length."""
        before, now = self.counts[length], self.counts[length] + by
        self.counts[length] = now
        most = self.window // length
        if min(before, most) != min(now, most):
            i = bisect_left(self.present, length)
            del self.sums[i:]
            if not before:
                self.present.insert(i, length)
            elif not now:
                del self.present[i]

    def _reach(self, n: int) -> int:
        """The sums of the n shortest lengths."""
        while len(self.sums) < n and (not self.sums or self.sums[-1] != self.every):
            length = self.present[len(self.sums)]
            found, copies, step = self.sums[-1] if self.sums else 1, min(self.counts[length], self.window // length), 1
            while copies:
                step = min(step, copies)
                found |= found << length * step
                copies -= step
                step *= 2
            self.sums.append(found & self.every)
        return 1 if not n else self.sums[min(n, len(self.sums)) - 1]

    def closest(self, room: int) -> dict[int, int]:
        """How many of each length: the multiset of the largest sum up to room, longest lengths first among equals."""
        n = bisect_right(self.present, room)
        left = (self._reach(n) & (1 << room + 1) - 1).bit_length() - 1
        taken = {}
        while left:
            n = bisect_right(self.present, left, hi=n) - 1
            length, below = self.present[n], self._reach(n)
            copies = min(self.counts[length], left // length)
            while not below >> left - copies * length & 1:
                copies -= 1
            if copies:
                taken[length] = copies
                left -= copies * length
        return taken


class Packer:
    """The remainders of one task. A remainder is (row, start, ids as bytes)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.lengths, self.held, self.tokens = Lengths(window), [[] for _ in range(window + 1)], 0
        self.n = 0

    def add(self, item: tuple) -> None:
        length = len(item[2]) // 4
        self.held[length].append(item)
        self.lengths.add(length, 1)
        self.n += 1
        self.tokens += length

    def _take(self, length: int) -> tuple:
        self.lengths.add(length, -1)
        self.n -= 1
        self.tokens -= length
        return self.held[length].pop()

    def _cut(self, length: int, at: int) -> tuple:
        row, start, ids = self._take(length)
        self.add((row, start + at, ids[4 * at :]))
        return row, start, ids[: 4 * at]

    def _window(self, capacity: int) -> Iterator[tuple]:
        longest = self.lengths.present[-1]
        if longest > capacity:
            items, room = [self._cut(longest, capacity)], 0
        else:
            items = [self._take(longest)]
            room = capacity - longest
        for length, copies in self.lengths.closest(room).items():
            items += [self._take(length) for _ in range(copies)]
            room -= length * copies
        if room:  # all that is left is longer than the slack
            items.append(self._cut(self.lengths.present[0], room))
        offset = 0
        for item in items:
            yield *item, self.sequence, offset
            offset += len(item[2]) // 4
        self.sequence += 1

    def single(self, row: tuple, start: int, ids: bytes) -> tuple:
        """A whole window of one document."""
        self.sequence += 1
        return row, start, ids, self.sequence - 1, 0

    def fill(self, held: int) -> Iterator[tuple]:
        """Whole windows until no more than so many remainders are held."""
        while self.n > held and self.tokens >= self.window:
            yield from self._window(self.window)

    def finish(self) -> Iterator[tuple]:
        """Everything that is still held; the last tokens in windows of powers of two."""
        yield from self.fill(0)
        while self.tokens:
            yield from self._window(1 << self.tokens.bit_length() - 1)


def pack(docs: DataFrame, vocabulary: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", held: int = HELD) -> DataFrame:
    """One row per piece: id, start (ids of its row before it), length, ids (little-endian unsigned 32-bit), doc_tokens
    (ids of its row, end_id included), sequence_id, offset (ids of the sequence before it).

    vocabulary: a byte-level tokenizer file; its special tokens are recognised inside texts. window: a power of two.
    Every id of every row lies in exactly one piece. Null texts count as empty and give end_id alone. Null and repeated
    ids stay as they are: rows, not ids, are packed, and pieces of equal rows can be told by sequence and offset. Other
    columns, whatever their names, are not read. An empty table gives no rows. Sequence numbers leave gaps between tasks.
    """
    encoder = docs.sparkSession.sparkContext.broadcast(ByteLevel(vocabulary, special=True))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        packer, end = Packer(window, TaskContext.get().partitionId() * TASK_SEQUENCES), struct.pack("<I", end_id)
        for part in parts:
            for doc_id, text in zip(part.column(0), part.column(1), strict=True):
                ids = encoder.value.ids(text.as_py() or "").astype("<u4").tobytes() + end
                n = len(ids) // 4
                for start in range(0, n - window + 1, window):
                    yield packer.single((doc_id, n), start, ids[4 * start : 4 * (start + window)])
                if n % window:
                    packer.add(((doc_id, n), n - n % window, ids[4 * (n - n % window) :]))
                if packer.n > held:
                    yield from packer.fill(held // 2)
        yield from packer.finish()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size, names = [], 0, ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

        def batch() -> pa.RecordBatch:
            doc_ids = pa.array([row[0].as_py() for row, *_ in found], found[0][0][0].type)
            long = lambda values: pa.array(values, pa.int64())
            columns = [doc_ids, long([x[1] for x in found]), long([len(x[2]) // 4 for x in found]), pa.array([x[2] for x in found], pa.binary())]
            return pa.RecordBatch.from_arrays([*columns, long([x[0][1] for x in found]), long([x[3] for x in found]), long([x[4] for x in found])], names=names)

        for piece in pieces(parts):
            found.append(piece)
            size += len(piece[2]) + 64
            if size >= BATCH_BYTES:
                yield batch()
                found, size = [], 0
        if found:
            yield batch()

    shape = f"id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(batches, shape).withColumnRenamed("id", id_col)
