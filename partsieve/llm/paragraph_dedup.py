"""Substring deduplication by paragraphs: MinHash banding, exact verification, clusters.

A text is cut into paragraphs of two kinds. Lines of LINE_WORDS words or more, and runs of shorter lines between them
that have so many together, are paragraphs as they stand. Besides, wherever lines end, content picks its own: among the
hashes of the five-word shingles, the least of each SPREAD neighbours starts a paragraph of WINDOW words; the text's
first and last WINDOW words are two more, and a shorter text is one. Equal passages pick equal starts, so every passage
of WINDOW + SPREAD - 1 = 51 words holds a whole picked paragraph wherever it stands, inside a longer line, across line
ends or in short lines.

Equal paragraphs are one node; each distinct one gets keys of BAND_ROWS minima over its word shingles. Bands are tuned
for recall: two lines of similarity 0.8 share no key with probability (1 - 0.8 ** 3) ** 8, three in a thousand. Picked
paragraphs have at most 16 shingles, so different ones of 0.8 or more have 15 of 17: three bands miss three in a
hundred of those, and none that is equal. Colliding paragraphs are verified by the exact Jaccard similarity of their
shingles, links are clustered by connected components, and of each cluster all but the first paragraph are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsieve.llm.ngram_join import SEEN, U, _mixed, grams, word_hashes
from partsieve.llm.shared import Tables, bit_set, filter_pages, with_hit, written
from partsieve.llm.similarity import FINE, SimilarityJoin
from partsieve.llm.suffix_dedup import PLACE_BITS, _least

#: Words of a shingle; words of the shortest line that is a paragraph alone; words of a picked paragraph.
SHINGLE, LINE_WORDS, WINDOW = 5, 20, 20
#: Neighbouring places of which the one with the least shingle is picked.
SPREAD = 32
#: Minima of a key; keys of a line and of a picked paragraph.
BAND_ROWS, LINE_BANDS, WINDOW_BANDS = 3, 8, 3
#: Words of texts that are cut at once, about; a longer text is cut alone.
BLOCK = 1 << 16
LINES, PICKED = 0, 1


class WordHashes:
    """64-bit hashes of the words of a text, and how many words each of its lines has."""

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        lines = [line.split() for line in text.lower().split(b"\n")]
        return word_hashes(list(chain.from_iterable(lines))), np.array([len(x) for x in lines], np.int64)


def lines_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of the paragraphs that lines make, by the words of each line."""
    start, out, run, held = 0, [], 0, 0
    for n in counts.tolist():
        if n >= LINE_WORDS:
            out += [(run, held)] * (held >= LINE_WORDS) + [(start, n)]
            held = 0
        elif n:
            run = run if held else start
            held += n
        start += n
    out += [(run, held)] * (held >= LINE_WORDS)
    both = np.array(out, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _shingles(a: np.ndarray, base: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of the shingle at each place of texts laid end to end; those that would cross a text's end mean nothing."""
    out = np.zeros(len(a), np.uint64)
    every = grams(a, SHINGLE) if len(a) >= SHINGLE else np.zeros(0, np.uint64)
    out[: len(every)] = every
    for i in np.flatnonzero((lengths > 0) & (lengths < SHINGLE)):  # few words are one shingle together
        out[base[i]] = grams(a[base[i] : base[i] + lengths[i]], SHINGLE)[0]
    return out


def picked(shingles: np.ndarray, base: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """First words of the picked paragraphs of texts laid end to end."""
    low = U((1 << PLACE_BITS) - 1)
    starts = lengths - WINDOW + 1
    x = (_mixed(shingles) & ~low) | np.arange(len(shingles), dtype=np.uint64)
    found = [base[lengths > 0], (base + starts - 1)[starts > 0]]
    if len(x) >= SPREAD:
        end = np.repeat(base + starts, lengths)[: len(x) - SPREAD + 1]
        inside = np.arange(len(end)) + SPREAD <= end
        found.append((_least(x, SPREAD)[inside] & low).astype(np.int64))
    return np.unique(np.concatenate(found))


def _sets(shingles: np.ndarray, at: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each paragraph, end to end, and how many each has."""
    n = np.maximum(n_words - SHINGLE + 1, 1)
    first, which, every = np.cumsum(n) - n, np.repeat(np.arange(len(at)), n), np.empty(n.sum(), np.uint64)
    for k in np.unique(n):  # those of one length are sorted as rows of a matrix
        i, r = np.flatnonzero(n == k)[:, None], np.arange(k)
        every[first[i] + r] = np.sort(shingles[at[i] + r], axis=1)
    new = np.append(True, (every[1:] != every[:-1]) | (which[1:] != which[:-1]))
    return every[new], np.bincount(which[new], minlength=len(at))


def _numbers(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit number of the content of each set."""
    with np.errstate(over="ignore"):
        each = _mixed(sets * U(0x9E3779B97F4A7C15) + U(0x632BE59BD9B4E019))
        return _mixed(np.add.reduceat(each, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64) * U(0xD6E8FEB86659FD93)).view(np.int64)


def band_keys(sets: np.ndarray, sizes: np.ndarray, bands: int, kind: int) -> np.ndarray:
    """One row of keys a set; kinds have keys of their own."""
    r = np.random.default_rng(20)
    factors = r.integers(1, 1 << 31, LINE_BANDS * BAND_ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    first = np.cumsum(sizes) - sizes
    every = (sets ^ (sets >> U(32))).astype(np.uint32)
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64) + U(1000 * kind), (len(sizes), 1))
    with np.errstate(over="ignore"):
        for k, f in enumerate(factors[: bands * BAND_ROWS] if len(sizes) else ()):
            x = every * f
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            b = k // BAND_ROWS
            keys[:, b] = _mixed(keys[:, b] * U(0x9E3779B97F4A7C15) + np.minimum.reduceat(x, first))
    return keys.view(np.int64)


def paragraphs(texts: list[bytes], hashes: WordHashes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind: the kind, then of each paragraph its text's number, first word and words, the sets end to end, their sizes and nodes."""
    words, counts = zip(*map(hashes, texts), strict=True)
    lengths = np.array([len(w) for w in words], np.int64)
    base = np.cumsum(lengths) - lengths
    a = np.concatenate(words)
    if not len(a):
        return
    shingles, text_of = _shingles(a, base, lengths), np.repeat(np.arange(len(texts)), lengths)
    lines = [lines_of(c) for c in counts]
    at = np.concatenate([x + b for (x, _), b in zip(lines, base.tolist(), strict=True)])
    for kind, at, n in ((LINES, at, np.concatenate([n for _, n in lines])), (PICKED, picked(shingles, base, lengths), None)):
        if len(at):
            which = text_of[at]
            n = np.minimum(WINDOW, lengths[which]) if n is None else n
            sets, sizes = _sets(shingles, at, n)
            nodes = _numbers(sets, sizes)
            if kind == PICKED:  # where words repeat, every place is a pick: of a run of equal paragraphs one for every WINDOW words
                run = np.cumsum(np.append(True, (nodes[1:] != nodes[:-1]) | (which[1:] != which[:-1])))
                step = (at - at[np.searchsorted(run, run)]) // WINDOW
                stay = np.append(True, (run[1:] != run[:-1]) | (step[1:] != step[:-1]))
                sets, which, at, n, sizes, nodes = sets[np.repeat(stay, sizes)], which[stay], at[stay], n[stay], sizes[stay], nodes[stay]
            yield kind, which, at - base[which], n, sets, sizes, nodes


def _batches(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Number of the first and content of texts of BLOCK words together, about (six bytes a word)."""
    some, held = [], 0
    for i, t in enumerate(texts.cast(pa.binary())):
        some.append(t.as_py() or b"")
        held += len(some[-1])
        if held >= 6 * BLOCK or i == len(texts) - 1:
            yield i + 1 - len(some), some
            some, held = [], 0


def _signatures(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tx, text) -> id, tx, kind, start, n_words, size, node, keys; a node's keys come once a task (and again after SEEN others)."""
    hashes, seen = WordHashes(), set()
    for part in parts:
        for first, texts in _batches(part.column(2)):
            for kind, which, at, n, sets, sizes, nodes in paragraphs(texts, hashes):
                new = np.array([x not in seen and not seen.add(x) for x in nodes.tolist()])
                keys = band_keys(sets[np.repeat(new, sizes)], sizes[new], LINE_BANDS if kind == LINES else WINDOW_BANDS, kind)
                ends = np.append(0, np.cumsum(new * keys.shape[1]))
                rows = pa.array(which + first)
                columns = [part.column(0).take(rows), part.column(1).take(rows), pa.array(np.full(len(at), kind), pa.int8()), pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(sizes, pa.int64()), pa.array(nodes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "tx", "kind", "start", "n_words", "size", "node", "keys"])
            if len(seen) > SEEN:
                seen.clear()


def _packed(bits: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Bytes laid end to end as binary values that end at ends."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(bits)]).cast(pa.binary())


def parities(sets: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """parity() of each of the sets that lie end to end."""
    bits = np.maximum(64, FINE << np.ceil(np.log2((sizes | 1) + 1)).astype(np.int64))
    ends = np.cumsum(bits)
    at = (sets >> U(6)).astype(np.int64) & np.repeat(bits - 1, sizes)
    odd = np.bincount(at + np.repeat(ends - bits, sizes), minlength=ends[-1] if len(ends) else 0) & 1
    return _packed(np.packbits(odd.astype(np.uint8), bitorder="little"), ends // 8)


def _members(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, nodes: structs of node, start, n_words) -> (node, size, sketch, payload: the hashes of the set) of the asked paragraphs of each text."""
    for part in parts:
        for first, texts in _batches(part.column(0)):
            asked = part.column(1).slice(first, len(texts))
            each = np.diff(asked.offsets.to_numpy()).tolist()
            start, n_words = (asked.flatten().field(k).to_numpy() for k in ("start", "n_words"))
            words, at, spans = [], 0, list(zip(start.tolist(), (start + n_words).tolist(), strict=True))
            for text, n in zip(texts, each, strict=True):
                all_words = text.lower().split()
                for lo, hi in spans[at : at + n]:
                    words += all_words[lo:hi]
                at += n
            lengths = n_words.astype(np.int64)
            base = np.cumsum(lengths) - lengths
            sets, sizes = _sets(_shingles(word_hashes(words), base, lengths), base, lengths)
            columns = [pa.array(_numbers(sets, sizes)), pa.array(sizes, pa.int64()), parities(sets, sizes), _packed(sets, 8 * np.cumsum(sizes))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "sketch", "payload"])


def _hashes(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, np.uint64)


def _clusters(docs: DataFrame, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """id, tx, kind, start, n_words, first (id, tx, start, n_words), cluster_size, removed of the paragraphs with a near copy."""
    tables, text = Tables(docs.sparkSession, "paragraph"), F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tx"), text.alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    shape = f"id {kind}, tx long, kind byte, start int, n_words int, size long, node long, keys array<long>"
    sets = tables.write(texts.mapInArrow(_signatures, shape), "signatures")
    joined = SimilarityJoin(sets, texts, _members, _hashes, num, den, tables, first=0, where=("start", "n_words")).links()
    several = sets.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    several = several if joined is None else several.unionByName(joined.select("node"))
    several = tables.write(several.distinct(), "several")
    pages = filter_pages(several.count())
    rows = with_hit(sets.select("id", "tx", "kind", "start", "n_words", "node"), bit_set(several, ["node"], pages), ["node"], pages).where("hit").drop("hit")
    rows = rows.distinct().join(several, "node", "left_semi")  # distinct first, else the join could not split a node of very many places
    rows = rows.withColumn("component", F.col("node")) if joined is None else rows.join(joined, "node", "left")
    rows = tables.write(rows.withColumn("group", F.coalesce("component", "node")).drop("component", "node"), "rows")
    tables.drop(sets, joined, several)
    here = F.struct("id", "tx", "start", "n_words")
    groups = rows.groupBy("group").agg(F.count("*").alias("cluster_size"), F.min(here).alias("first"), F.max(here).alias("last"))
    alike = lambda x: x["id"].eqNullSafe(F.col("first.id")) & (x["tx"] == F.col("first.tx")) & (x["start"] < F.col("first.start") + F.col("first.n_words"))
    groups = written(groups.where(~alike(F.col("last"))).drop("last"), "paragraph-groups")
    out = rows.join(groups, "group").withColumn("at", here)
    return out.withColumn("removed", ~alike(F.col("at"))).drop("at", "group")


def paragraph_clusters(docs: DataFrame, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph that has a near copy elsewhere: id, kind (line or picked), start (word number from 0), n_words,
    first_id and first_start (the cluster's first place in id, start order: it stays), cluster_size, removed.

    Paragraphs that overlap the first place in its own text stay with it, and a cluster whose places all do is none. Null
    and empty texts have no paragraphs. A-Z are lower-cased, words are cut at ASCII white space. Null ids come first; rows
    that share an id and a text are the same document, whose paragraphs are counted once. Other columns, whatever their
    names, are not read; an empty table gives no rows.
    """
    out = _clusters(docs, num, den, id_col, text_col)
    kind = F.when(F.col("kind") == LINES, "line").otherwise("picked").alias("kind")
    return out.select(F.col("id").alias(id_col), kind, "start", "n_words", F.col("first.id").alias("first_id"), F.col("first.start").alias("first_start"), "cluster_size", "removed")


def _cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tx, text, gone: first word and number of words of each span) -> (id, tx, text without them)."""
    word = re.compile(rb"[^\x20\x09-\x0D]+")
    for part in parts:
        out = []
        for text, gone in zip(part.column(2).cast(pa.binary()), part.column(3), strict=True):
            text = text.as_py()
            spans = [m.span() for m in word.finditer(text)]
            lost = np.zeros(len(spans) + 1, np.int64)
            for g in gone.as_py():
                lost[g["start"]] += 1
                lost[g["start"] + g["n_words"]] -= 1
            keep, last, kept = np.cumsum(lost)[:-1] == 0, 0, []
            for i, (lo, hi) in enumerate(spans):
                if not keep[i]:
                    kept.append(text[last:lo] if i == 0 or keep[i - 1] else b"")
                    last = hi
            out.append(b"".join([*kept, text[last:]]))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary()).cast(pa.string())], names=["id", "tx", "text"])


def paragraph_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs, all rows and columns, with the words of removed paragraphs, and the white space between them, cut out of their texts.

    Documents that lose nothing come through as they are, null texts included; rows that share an id and a text lose the
    same. Columns may have any names.
    """
    tables, names = Tables(docs.sparkSession, "paragraph"), docs.columns
    lost = _clusters(docs, how.pop("num", 80), how.pop("den", 100), id_col, text_col).where("removed")
    lost = tables.write(lost.groupBy("id", "tx").agg(F.collect_set(F.struct("start", "n_words")).alias("gone")), "lost")
    at, text_at = names.index(id_col), names.index(text_col)
    kind = docs.schema[text_at].dataType
    plain = docs.toDF(*(f"c{i}" for i in range(len(names)))).withColumn("tx", F.xxhash64(F.col(f"c{text_at}").cast("string")))
    texts = plain.select(F.col(f"c{at}").alias("id"), F.col("tx").alias("tx0"), F.col(f"c{text_at}").cast("string").alias("text"))
    asked = texts.join(lost.withColumnRenamed("id", "lost_id"), F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("tx0") == F.col("tx")))
    asked = asked.groupBy("lost_id", "tx").agg(F.first("text").alias("text"), F.first("gone").alias("gone"))
    new = asked.select(F.col("lost_id").alias("id"), "tx", "text", "gone").mapInArrow(_cut, f"id {docs.schema[at].dataType.simpleString()}, tx long, text string")
    new = tables.write(new, "cut").toDF("new_id", "new_tx", "new_text")
    both = plain.join(new, F.col(f"c{at}").eqNullSafe(F.col("new_id")) & (F.col("tx") == F.col("new_tx")), "left")
    text = F.when(F.col("new_tx").isNull(), F.col(f"c{text_at}")).otherwise(F.col("new_text").cast(kind))
    return both.select(*(text.alias(f"c{i}") if i == text_at else F.col(f"c{i}") for i in range(len(names)))).toDF(*names)
