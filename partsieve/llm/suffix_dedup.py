"""Suffix-array deduplication: every byte covered by a string of LENGTH bytes that also starts anywhere else goes.

Suffixes of all documents cannot be sorted in one place, so starts are first cut into stretches that equal strings cut
alike: among the hashes of its CORE-byte windows, a string of LENGTH bytes picks the least (leftmost of equals) as its
anchor; neighbouring starts with the same anchor are one stretch. Equal strings pick the same anchor content, so only
stretches whose anchor content occurs twice go on. Equal stretches are pre-aggregated to one content with its count;
contents that meet under an anchor go to a shard, whose suffixes are sorted by external induced sorting
(induced_sort), and starts whose suffix shares LENGTH bytes with another one are repeats. Shards are cut by anchor, not
by document, and are of SHARD_BYTES on average: a task holds its strings in memory; the sorter's queues can spill.

An anchor under which very many contents meet is split before sorting: two equal strings that hold its CORE bytes share
half of the remaining bytes at its right or at its left, so each content goes to one group by the bytes at the right
and one by those at the left, and both find between them every pair. Contents at the edge of a passage that many texts
share agree there and would still meet in one group, which grows with the copies. Under an anchor of more than HOT
contents each string of LENGTH bytes is therefore hashed and counted in Spark instead; no other group is larger than
HOT contents, each of at most 2 * LENGTH - CORE bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsieve.llm.induced_sort import SuffixSorter
from partsieve.llm.shared import bit_set, filter_pages, with_hit, written

#: Bytes of a repeated string, and of the windows that anchor it.
LENGTH, CORE = 200, 100
#: Contents under an anchor from which on they are split by the bytes around it.
MANY = 64
#: Contents under an anchor from which on their strings are counted, not sorted: bounds a group at a few MB.
HOT = 1 << 14
#: Bytes of a shard, about.
SHARD_BYTES = 6 << 20
#: Bytes of text whose windows are hashed at once.
BLOCK = 1 << 18
U = np.uint64
PLACE_BITS = 36
RUNS = "tx long, at int, starts int, core int, key long, digest long"


def _doubled(x: np.ndarray, step: int, factor: int) -> np.ndarray:
    y = x[:-step] * U(factor)
    y += x[step:]
    y ^= y >> U(31)
    return y


def _windows(data: np.ndarray) -> np.ndarray:
    """Hash of the CORE bytes (64 + 32 + 8, overlapping) at each place."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1)).copy().view(np.uint64).ravel()
    n = len(data) - CORE + 1
    with np.errstate(over="ignore"):
        eight = eight * U(0x9E3779B97F4A7C15)
        eight ^= eight >> U(29)
        many = _doubled(_doubled(eight, 8, 0xBF58476D1CE4E5B9), 16, 0x94D049BB133111EB)
        most = _doubled(many, 32, 0xD6E8FEB86659FD93)
        out = most[:n] * U(0xA0761D6478BD642F)
        out += many[64 : 64 + n]
        out ^= out >> U(32)
        out *= U(0xE7037ED1A0B428DB)
        out += eight[CORE - 8 : CORE - 8 + n]
        out ^= out >> U(29)
        out *= U(0xBF58476D1CE4E5B9)
    return out ^ (out >> U(32))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each width neighbours."""
    k = 1
    while 2 * k <= width:
        x, k = np.minimum(x[:-k], x[k:]), 2 * k
    return np.minimum(x[: len(x) - width + k], x[width - k :]) if k < width else x


def stretches(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last start, anchor place and anchor hash of each stretch of texts laid end to end. ends: where the text of each byte ends."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.view(np.uint64)
    hashes = _windows(data)
    low = U((1 << PLACE_BITS) - 1)
    anchor = (_least((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), LENGTH - CORE + 1) & low).astype(np.int64)
    start = np.flatnonzero(np.arange(LENGTH, len(anchor) + LENGTH) <= ends[: len(anchor)])
    anchor = anchor[start]
    if not len(start):
        return none, none, none, none.view(np.uint64)
    new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    return start[new], start[np.append(new[1:], len(start)) - 1], anchor[new], hashes[anchor[new]]


def _text_stretches(text: bytes) -> Iterator[tuple]:
    """Stretches of one long text, block by block; starts at a block's edge are one stretch cut in two only where anchors change."""
    first = 0
    while first + LENGTH <= len(text):
        last = min(len(text), first + BLOCK + LENGTH - 1)
        data = np.frombuffer(text, np.uint8, last - first, first)
        lo, hi, at, key = stretches(data, np.full(len(data), len(data)))
        if last < len(text) and len(lo) > 1:  # the last stretch may go on in the next block
            step = int(lo[-1])
            lo, hi, at, key = lo[:-1], hi[:-1], at[:-1], key[:-1]
        else:
            step = len(data) - LENGTH + 1
        yield lo + first, hi + first, at + first, key
        first += step


def _runs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        texts, rows, held = [], [], 0
        raw = part.column(2).cast(pa.binary())
        for row in range(part.num_rows):
            text = raw[row].as_py() or b""
            if len(text) > BLOCK:
                for lo, hi, at, key in _text_stretches(text):
                    yield _batch(part, np.full(len(lo), row), lo, hi, at, key, text, lo)
            elif len(text) >= LENGTH:
                texts.append(text)
                rows.append(row)
                held += len(text)
            if texts and (held >= BLOCK or row == part.num_rows - 1):
                sizes = np.array([len(t) for t in texts])
                ends, whole = np.cumsum(sizes), b"".join(texts)
                lo, hi, at, key = stretches(np.frombuffer(whole, np.uint8), np.repeat(ends, sizes))
                which = np.searchsorted(ends, lo, "right")
                base = (ends - sizes)[which]
                yield _batch(part, np.array(rows)[which], lo - base, hi - base, at - base, key, whole, lo)
                texts, rows, held = [], [], 0


def _batch(part: pa.RecordBatch, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, key: np.ndarray, text: bytes, where: np.ndarray) -> pa.RecordBatch:
    starts = hi - lo + 1
    digest = [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(where.tolist(), (where + starts + LENGTH - 1).tolist(), strict=True)]
    row = pa.array(row, pa.int64())
    columns = [part.column(0).take(row), part.column(1).take(row), *(pa.array(x.astype(np.int32)) for x in (lo, starts, at - lo)), pa.array(key.view(np.int64)), pa.array(np.array(digest, np.uint64).view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["id", "tx", "at", "starts", "core", "key", "digest"])


def _sorted_shard(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, digest, bytes) of a shard -> (key, digest, from, to): starts from..to of the content are repeated."""
    keys, digests, strings, seen = [], [], [], set()
    for part in parts:
        for row in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            if row[:2] not in seen:  # both groups of a split content can come here
                seen.add(row[:2])
                keys.append(row[0])
                digests.append(row[1])
                strings.append(row[2])
    if not strings:
        return
    flags = SuffixSorter(strings, LENGTH).repeated()
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    ends = np.cumsum([len(x) + 1 for x in strings])
    which = np.searchsorted(ends, first, "right")
    base = (ends - [len(x) + 1 for x in strings])[which]
    which = pa.array(which, pa.int64())
    columns = [pa.array(keys, pa.int64()).take(which), pa.array(digests, pa.int64()).take(which), pa.array((first - base).astype(np.int32)), pa.array((last - base).astype(np.int32))]
    yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "from", "to"])


def _strings(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, digest, data) -> (key, digest, off, string): a hash for each string of LENGTH bytes of each content."""
    for part in parts:
        rows, off, string = [], [], []
        for row, data in enumerate(part.column(2).to_pylist()):
            n = len(data) - LENGTH + 1
            rows += [row] * n
            off += range(n)
            string += [xxhash.xxh3_64_intdigest(data[i : i + LENGTH]) for i in range(n)]
        rows = pa.array(rows, pa.int64())
        columns = [part.column(0).take(rows), part.column(1).take(rows), pa.array(off, pa.int32()), pa.array(np.array(string, np.uint64).view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "off", "string"])


def repeated_starts(rows: DataFrame) -> DataFrame:
    """rows: id, tx (hash of the text), text. For each text that has repeats: id, tx, ranges (from, to) of starts."""
    kind = rows.schema["id"].dataType.simpleString()
    runs = written(rows.mapInArrow(_runs, f"id {kind}, {RUNS}"), "suffix-runs")
    several = written(runs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "suffix-anchors")
    pages = filter_pages(several.count())
    asked = with_hit(runs, bit_set(several, ["key"], pages), ["key"], pages).where("hit").drop("hit")
    places = written(asked.join(several, "key", "left_semi").select("id", "tx", "at", "starts", "core", "key", "digest"), "suffix-places")
    one = F.min(F.struct("id", "tx", "at", "starts", "core")).alias("one")
    contents = written(places.groupBy("key", "digest").agg(F.count("*").alias("n"), one), "suffix-contents")
    met = contents.groupBy("key").agg(F.count("*").alias("met")).where("met > 1")
    open_ = written(contents.join(met, "key").select("key", "digest", "met", "one.*"), "suffix-open")
    pages = filter_pages(open_.count())
    wanted = with_hit(rows, bit_set(open_, ["id", "tx"], pages), ["id", "tx"], pages).where("hit").drop("hit")
    wanted = wanted.dropDuplicates(["id", "tx"]).withColumnsRenamed({"id": "_id", "tx": "_tx"})
    cut = open_.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tx") == F.col("_tx")))
    data = F.encode("text", "utf-8")
    cut = cut.select("key", "digest", "met", "core", F.substring(data, F.col("at") + 1, F.col("starts") + LENGTH - 1).alias("data"))
    half = (LENGTH - CORE) // 2
    right = F.xxhash64("key", F.lit("right"), F.substring("data", F.col("core") + 1, F.lit(CORE + half)))
    left = F.xxhash64("key", F.lit("left"), F.when(F.col("core") >= half, F.substring("data", F.col("core") - half + 1, F.lit(CORE + half))).otherwise(F.col("data")))
    counted = F.array(F.lit(None).cast("long"))
    groups = F.when(F.col("met") > HOT, counted).when(F.col("met") > MANY, F.array(right, left)).otherwise(F.array("key"))
    cut = written(cut.select("key", "digest", F.explode(groups).alias("group"), "data"), "suffix-cut")
    strings = cut.where("group is null").select("key", "digest", "data").mapInArrow(_strings, "key long, digest long, off int, string long")
    strings = written(strings, "suffix-strings")
    twice = strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    hot = strings.join(twice, "string", "left_semi").select("key", "digest", F.col("off").alias("from"), F.col("off").alias("to"))
    live = cut.where("group is not null").groupBy("group").agg(F.count("*").alias("n"), F.sum(F.length("data")).alias("size")).where("n > 1")
    live = written(live, "suffix-groups")
    total = live.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    dealt = cut.join(live.select("group"), "group", "left_semi").repartition(int(shards), "group").select("key", "digest", "data")
    found = written(dealt.mapInArrow(_sorted_shard, "key long, digest long, from int, to int"), "suffix-sorted")
    alike = contents.where("n > 1").select("key", "digest", F.lit(0).alias("from"), (F.col("one.starts") - 1).alias("to"))
    ranges = found.unionByName(hot).unionByName(alike).groupBy("key", "digest").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))
    ranges = written(ranges, "suffix-ranges")  # so that the join exchanges both sides and a content of very many places is split
    hit = places.join(ranges, ["key", "digest"]).select("id", "tx", "at", F.explode("ranges").alias("r"))
    hit = hit.select("id", "tx", F.struct((F.col("at") + F.col("r.from")).alias("from"), (F.col("at") + F.col("r.to")).alias("to")).alias("range"))
    return hit.groupBy("id", "tx").agg(F.collect_list("range").alias("ranges"))


def cut_ranges(text: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What stays of a text without the LENGTH bytes from each of the starts, and how many stretches go."""
    kept, end, spans = [], -1, 0
    for first, last in sorted(ranges):
        if first > end:
            kept.append(text[max(end, 0) : first])
            spans += 1
        end = max(end, last + LENGTH)
    kept.append(text[max(end, 0) :])
    return b"".join(kept), spans


def _cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        raw, ranges = part.column(1).cast(pa.binary()), part.column(2)
        for first in range(0, part.num_rows, 256):
            n = min(256, part.num_rows - first)
            sizes, kept, spans = [], [], []
            for i in range(first, first + n):
                text, own = raw[i].as_py() or b"", ranges[i].as_py()
                stays, k = cut_ranges(text, [(r["from"], r["to"]) for r in own]) if own else (text, 0)
                sizes.append(len(text))
                kept.append(stays)
                spans.append(k)
            columns = [part.column(0).slice(first, n), pa.array(sizes, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "n_spans", "kept"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans (stretches removed), kept (the bytes that stay).

    Texts are UTF-8 bytes, null counts as empty; texts under LENGTH bytes lose nothing. Strings are judged on the texts
    as they come, all copies of a repeated string go, overlaps within a document count, and matches never cross
    documents. Ids may be null or repeat: each row counts as a document. Other columns are not read. An empty table
    gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tx"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    gone = repeated_starts(rows).select(F.col("id").alias("_id"), F.col("tx").alias("_tx"), "ranges")
    both = rows.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tx") == F.col("_tx")), "left")
    out = both.select("id", "text", "ranges").mapInArrow(_cut, f"id {kind}, n_bytes long, n_spans long, kept binary")
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long")
    return out.select(F.col("id").alias(id_col), "n_bytes", removed.alias("n_removed"), "n_spans", "kept")
