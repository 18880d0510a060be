"""Quality rules with suffix-array repetition.

A text's bytes are the alphabet: the suffixes of many documents are sorted at once by prefix doubling, from their first
PACK bytes on (a document's number leads its keys, so repeats never cross documents). Adjacent suffixes give longest
common prefixes; a suffix's larger neighbour prefix is the longest repeat that starts there, which is what the LCP
intervals of maximal repeats cover. The union of the spans of repeats that are longer than chance makes them, as a share
of the bytes, and the longest of them are limited. Words serve the base counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that ranks start with, and bytes of the shortest repeat that counts in any text.
PACK, MIN_BYTES = 8, 11
#: Most of a document's bytes that repeats may cover, and the longest repeat in bytes that is tolerated.
MAX_COVERED, MAX_REPEAT = 0.12, 500
#: Bytes sorted at once, about; a longer document is sorted alone.
BLOCK_BYTES = 1 << 19
SYMBOLS = b"#*$%&|<>"
#: Everything but word characters' first bytes: white space and UTF-8 continuation bytes.
_NOT_COUNTED = bytes(range(0x09, 0x0E)) + b" " + bytes(range(0x80, 0xC0))
_NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """order that sorts keys; for each sorted place where its group starts; whether the group has more than one."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    return order, first[group], np.diff(np.append(first, len(s)))[group] > 1


class Repeats:
    """Repeats inside each of several word sequences laid end to end. words: numbers; ends: for each word, where its document ends; doc: its number."""

    def __init__(self, words: np.ndarray, doc: np.ndarray, ends: np.ndarray):
        self.n, self.doc, self.ends = len(words), doc, ends
        order, start, several = _groups(doc.astype(np.int64) * (int(words.max(initial=0)) + 1) + words)
        self.rank = np.empty(self.n, np.int64)
        self.rank[order] = start
        self.levels = [self.rank.copy()]
        self.live = np.sort(order[several])

    def _next(self, at: np.ndarray, h: int, rank: np.ndarray) -> np.ndarray:
        to = at + h
        return np.where(to < self.ends[at], rank[np.minimum(to, self.n - 1)] + 1, 0)

    def _refine(self, rank: np.ndarray, live: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks after a further key for the places that are not alone yet, and those that still are not."""
        new = rank.copy()
        if len(live):
            old = rank[live]
            order, start, several = _groups(old * (self.n + 2) + second)
            s = old[order]
            begins = np.ones(len(s), bool)
            begins[1:] = s[1:] != s[:-1]
            base = np.maximum.accumulate(np.where(begins, np.arange(len(s)), 0))
            new[live[order]] = s + start - base
            live = np.sort(live[order[several]])
        return new, live

    def repeated_thirds(self) -> np.ndarray:
        """Whether a word lies in a window of three words that its document has twice or more."""
        first = self.levels[0]
        order, _, several = _groups(first)
        live = np.sort(order[several])
        live = live[live + 2 < self.ends[live]]
        for h in (1, 2):
            if len(live):
                key = self._next(live, h, first)
                code = (self._pair if h == 2 else first[live]) * (self.n + 2) + key
                order, start, several = _groups(code)
                inverse = np.empty(len(live), np.int64)
                inverse[order] = start
                keep = np.zeros(len(live), bool)
                keep[order[several]] = True
                live, self._pair = live[keep], inverse[keep]
        hit = np.zeros(self.n + 3, np.int64)
        np.add.at(hit, live, 1)
        np.add.at(hit, live + 3, -1)
        return np.cumsum(hit[: self.n]) > 0


def shortest(n_bytes: np.ndarray) -> np.ndarray:
    """Bytes of the shortest repeat that counts in texts of so many bytes: MIN_BYTES, or log2 of the size (rounded down) where that
    is more, as the chance repeats of a long text are longer."""
    return np.maximum(MIN_BYTES, np.frexp(np.maximum(n_bytes, 1).astype(np.float64))[1] - 1)


class ByteRepeats(Repeats):
    """Repeats of bytes: ranks start with the first PACK bytes of each suffix, taken as one number."""

    def __init__(self, data: np.ndarray, doc: np.ndarray, ends: np.ndarray):
        inside = np.arange(PACK)[:, None] + np.arange(len(data)) < ends
        padded = np.concatenate([data, np.zeros(PACK, np.uint8)])
        packed = np.zeros(len(data), np.uint64)
        for k in range(PACK):
            packed = packed << np.uint64(8) | np.where(inside[k], padded[k : k + len(data)], 0).astype(np.uint64)
        order, start, _ = _groups(packed)
        dense = np.empty(len(data), np.int64)
        dense[order] = start
        super().__init__(dense, doc, ends)
        self.data, self.least = padded, shortest(np.bincount(doc))[doc]

    def sort(self) -> None:
        h = PACK
        while len(self.live):
            self.rank, self.live = self._refine(self.rank, self.live, self._next(self.live, h, self.rank))
            h *= 2
            self.levels.append(self.rank)

    def longest(self) -> np.ndarray:
        """For each place, the bytes of the longest repeat that counts and starts there, or 0: the larger of the
        common prefixes with its two neighbours in the suffix array."""
        out = np.zeros(self.n, np.int64)
        order, _, several = _groups(self.levels[0])
        some = order[several]
        some = some[np.argsort(self.rank[some], kind="stable")]
        a, b = some[:-1], some[1:]
        room = np.minimum(self.ends[a] - a, self.ends[b] - b)
        near = (self.levels[0][a] == self.levels[0][b]) & (room >= self.least[a])
        a, b, room = a[near], b[near], room[near]
        lcp = np.full(len(a), PACK, np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            rank, h = self.levels[k], PACK << k
            fits = lcp + h <= room
            x, y = np.where(fits, a + lcp, 0), np.where(fits, b + lcp, 0)
            lcp += h * (fits & (rank[x] == rank[y]))
        for _ in range(PACK - 1):  # what is left is shorter than PACK
            more = lcp < room
            more[more] = self.data[a[more] + lcp[more]] == self.data[b[more] + lcp[more]]
            if not more.any():
                break
            lcp += more
        good = lcp >= self.least[a]
        np.maximum.at(out, a[good], lcp[good])
        np.maximum.at(out, b[good], lcp[good])
        return out


def _covered(longest: np.ndarray) -> np.ndarray:
    """Whether a place lies in one of the repeats that start at each place."""
    n = len(longest)
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(longest)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + longest[at], -1)
    return np.cumsum(edge[:n]) > 0


def _measure(texts: list[bytes], split: list[list[bytes]]) -> dict[str, np.ndarray]:
    lengths = np.array([len(w) for w in split], np.int64)
    ends_of = np.cumsum(lengths)
    n = int(lengths.sum())
    number: dict[bytes, int] = {}
    words = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64, n)
    doc = np.repeat(np.arange(len(split)), lengths)
    third = Repeats(words, doc, np.repeat(ends_of, lengths)).repeated_thirds() if n else np.zeros(0, bool)
    sizes = np.array([len(t) for t in texts], np.int64)
    at = np.repeat(np.arange(len(texts)), sizes)
    longest = np.zeros(len(at), np.int64)
    if len(at):
        r = ByteRepeats(np.frombuffer(b"".join(texts), np.uint8), at, np.repeat(np.cumsum(sizes), sizes))
        r.sort()
        longest = r.longest()
    most = np.zeros(len(split), np.int64)
    np.maximum.at(most, at, longest)
    return {
        "n_words": lengths,
        "word_chars": np.array([len(t.translate(None, _NOT_COUNTED)) for t in texts], np.int64),
        "n_symbols": np.array([len(t.translate(None, _NOT_SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([_repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": np.bincount(doc[third], minlength=len(split)).astype(np.int64),
        "n_bytes": sizes,
        "covered_bytes": np.bincount(at[_covered(longest)], minlength=len(split)).astype(np.int64),
        "longest_repeat": most,
    }


def _repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines))


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "covered_bytes", "longest_repeat")


def _stats(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        texts, split, first, held = [], [], 0, 0
        raw = part.column(1).cast(pa.binary())
        for i in range(part.num_rows):
            t = raw[i].as_py() or b""
            texts.append(t)
            split.append(t.split())
            held += len(t)
            if held >= BLOCK_BYTES or i == part.num_rows - 1:
                got = _measure(texts, split)
                columns = [part.column(0).slice(first, len(texts)), *(pa.array(got[f], pa.int64()) for f in _FIELDS)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *_FIELDS])
                texts, split, first, held = [], [], i + 1, 0


def repetition_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, counts of words, word characters, symbols, repeated lines and words, n_bytes, covered_bytes, longest_repeat (bytes)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_stats, f"id {kind}, " + ", ".join(f"{f} long" for f in _FIELDS)).withColumnRenamed("id", id_col)


def quality_rules(docs: DataFrame, max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, the counts, base_failed, kept.

    base_failed: under 50 words, or over half of the words in repeated three-word windows. A document is kept if the
    base passes, repeats (of MIN_BYTES bytes, or of log2 of the text's size where that is more) cover at most max_covered
    of its bytes and none is longer than max_repeat bytes. Null and empty texts have no words and fail the base. Ids may
    be null or repeat; other columns are not read; an empty table gives no rows.
    """
    s = repetition_stats(docs, id_col, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = (F.col("covered_bytes") <= max_covered * F.col("n_bytes")) & (F.col("longest_repeat") <= max_repeat)
    return s.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & within)
