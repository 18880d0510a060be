"""Byte-level BPE encoding and decoding with a two-tier lookup.

Whole pre-tokens that are in the vocabulary are resolved by a minimal perfect hash, many at a time; the rest merge
their bytes by rank with a heap over a doubly linked list of parts, so a pre-token of n bytes takes n log n steps
however long it is. Spark cuts the work by rows: both functions are Arrow UDFs, and the tables (a megabyte or two, set
by the vocabulary and not by the data) go out once as a broadcast.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

#: Bytes of text whose pre-tokens are held at once.
SLICE_BYTES = 1 << 20
#: Distinct pre-tokens whose ids a worker keeps between slices.
KNOWN = 400_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (max(int(rank) for _, rank in pairs) + 1)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def unicode_pattern(pattern: str) -> str:
    """The pattern with white space as Unicode defines it, as the tokenizer's own engine reads it; Python's \\s adds U+001C-1F."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class PerfectHash:
    """Minimal perfect hash of a fixed set of byte strings: hash, displace, and compare with the key kept at the slot."""

    PER_BUCKET = 4

    def __init__(self, keys: list[bytes], values: list[int]):
        self.n = len(keys)
        self.buckets = max(1, self.n // self.PER_BUCKET)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, self.n)
        self.displace = np.zeros(self.buckets, np.uint64)
        taken = np.zeros(self.n, bool)
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, b in enumerate((hashes % np.uint64(self.buckets)).tolist()):
            members[b].append(i)
        where = np.zeros(self.n, np.int64)
        tries = np.arange(256, dtype=np.uint64)
        for b in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            own = hashes[members[b]]
            if len(own) < 2:
                break
            for first in range(0, 1 << 24, len(tries)):
                slots = self._slots(own[None, :], (tries + np.uint64(first))[:, None])
                free = ~taken[slots].any(1)
                free[free] = [len(set(x)) == len(own) for x in slots[free].tolist()]
                if free.any():
                    d = int(free.argmax())
                    taken[slots[d]], where[members[b]], self.displace[b] = True, slots[d], first + d
                    break
        open_slots = iter(np.flatnonzero(~taken).tolist())
        for b in range(self.buckets):
            if len(members[b]) == 1:  # a lone key takes any slot that is left, by its number
                where[members[b][0]] = slot = next(open_slots)
                self.displace[b] = (1 << 63) | slot
        self.keys: list[bytes] = [b""] * self.n
        self.values = np.zeros(self.n, np.int64)
        for i, slot in enumerate(where.tolist()):
            self.keys[slot], self.values[slot] = keys[i], values[i]

    def _slots(self, hashes: np.ndarray, displace) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (hashes >> np.uint64(20)) + displace * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            x = x ^ (x >> np.uint64(29))
        direct = displace >> np.uint64(63) != 0
        return np.where(direct, displace & np.uint64((1 << 63) - 1), x % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """The value of each key, -1 for strings that are not in the set."""
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
        slots = self._slots(hashes, self.displace[(hashes % np.uint64(self.buckets)).astype(np.int64)])
        there = map(self.keys.__getitem__, slots.tolist())
        return [v if k == t else -1 for k, t, v in zip(keys, there, self.values[slots].tolist(), strict=True)]


def merge_by_rank(piece: bytes, rank_of: dict[bytes, int], pairs: list[int]) -> list[int]:
    """The ids of one pre-token: lowest rank first, leftmost of equals, until no two neighbours merge.

    Parts are linked by where the next and the last one start; merges[i] is the rank of joining the part at i with the
    next, so a heap entry (rank and place in one number) whose rank is no longer there is out of date. pairs: the ranks
    of all pairs of bytes, -1 for none.
    """
    n, get = len(piece), rank_of.get
    after, before = list(range(1, n + 1)), list(range(-1, n))
    merges = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
    merges.append(-1)
    heap = [rank << 40 | i for i, rank in enumerate(merges) if rank >= 0]
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        i = top & 0xFFFFFFFFFF
        if merges[i] != top >> 40:
            continue
        j = after[i]
        end = after[i] = after[j]
        merges[j] = merges[i] = -1
        if end < n:
            before[end] = i
            merges[i] = rank = get(piece[i : after[end]], -1)
            if rank >= 0:
                heapq.heappush(heap, rank << 40 | i)
        h = before[i]
        if h >= 0:
            merges[h] = rank = get(piece[h:end], -1)
            if rank >= 0:
                heapq.heappush(heap, rank << 40 | h)
    out, i = [], 0
    while i < n:
        out.append(rank_of[piece[i : after[i]]])
        i = after[i]
    return out


class Codec:
    """Tables of one vocabulary; ids go as little-endian unsigned 32-bit integers."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, unicode_pattern(pattern)
        self._ids: dict[str, bytes] = {}
        self.rank_of = {t: i for i, t in enumerate(tokens) if t}
        self.pairs = [self.rank_of.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        self.whole = PerfectHash(list(self.rank_of), list(self.rank_of.values()))
        self._split = None

    def __getstate__(self):
        return self.__dict__ | {"_split": None, "_ids": {}}

    def split(self, text: str) -> list[str]:
        if self._split is None:
            self._split = regex.compile(self.pattern).findall
        return self._split(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes. Pre-tokens met before are kept, KNOWN at most; then all are forgotten."""
        pieces = [self.split(t) for t in texts]
        if len(self._ids) > KNOWN:
            self._ids.clear()
        new = list(set().union(*pieces).difference(self._ids))
        raw = [p.encode() for p in new]
        for piece, key, value in zip(new, raw, self.whole.find(raw), strict=True):
            one = [value] if value >= 0 else merge_by_rank(key, self.rank_of, self.pairs)
            self._ids[piece] = struct.pack(f"<{len(one)}I", *one)
        return [b"".join(map(self._ids.__getitem__, p)) for p in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _slices(values: Iterable, size=len) -> Iterator[list]:
    part, held = [], 0
    for v in values:
        part.append(v)
        held += size(v)
        if held >= SLICE_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part


class Bpe:
    """BPE of one vocabulary as column functions."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        shared = spark.sparkContext.broadcast(Codec(read_ranks(path), pattern))

        @F.arrow_udf(BinaryType())
        def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = shared.value
            for part in parts:
                yield pa.array([x for some in _slices([t or "" for t in part.to_pylist()]) for x in codec.encode(some)], pa.binary())

        @F.arrow_udf(BinaryType())
        def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = shared.value
            for part in parts:
                yield pa.array([codec.decode(x or b"") for x in part.to_pylist()], pa.binary())

        def both(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = shared.value
            for part in parts:
                at = 0
                for some in _slices(part.column(1), lambda t: len(t.as_py() or "")):
                    ids = codec.encode([t.as_py() or "" for t in some])
                    back = [codec.decode(x) for x in ids]
                    carried = [part.column(i).slice(at, len(some)) for i in (0, *range(2, part.num_columns))]
                    yield pa.RecordBatch.from_arrays([*carried, pa.array(ids, pa.binary()), pa.array(back, pa.binary())], names=[str(i) for i in range(len(carried) + 2)])
                    at += len(some)

        self._encode, self._decode, self._both = encode, decode, both

    def encode(self, text: Column) -> Column:
        """Binary: the ids of a whole text, four little-endian bytes each; null and empty texts give no ids."""
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        """Binary: the bytes that ids stand for; null gives none."""
        return self._decode(ids)

    def round_trip(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
        """One row per row of docs: id, the columns carry, text, ids (as encode gives them), decoded (the bytes these
        decode to), in one pass; text only with carry.

        Null texts count as empty; ids may be null or repeat; other columns are not read; an empty table gives no rows.
        """
        text = F.col(text_col).cast("string")
        more = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)] + ([text.alias("text")] if carry else [])
        rows = docs.select(F.col(id_col).alias("id"), text.alias("t"), *more)
        shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "t")
        out = rows.mapInArrow(self._both, f"{shape}, ids binary, decoded binary")
        return out.withColumnsRenamed({"id": id_col} | {f"c{i}": c for i, c in enumerate(carry)})
