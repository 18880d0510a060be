"""N-gram Jaccard join with parity sketches.

A document's set holds 64-bit hashes of its distinct word n-grams. Sets of equal content are one node from the start.
Sizes fall into bands; a pair is looked for in the band of its larger set, whose bound on the sizes bounds the
symmetric difference D of any two sets that reach the threshold. A sketch has more than D blocks of 64 bits; each member
is XORed, as a hash, into one block, so two sketches differ in at most D blocks and at least one must be equal: blocks
are the join keys. Equal blocks hold equal members (but for a collision of hashes, which only costs a comparison), so a
key says that two sets share members, however few a block has. Blocks without members say nothing; a tenth more blocks
than D + 1 make up for those, and a set with more empty blocks than that sends them too, so no pair is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsieve.llm.shared import Tables, keep_one_of, written
from partsieve.llm.similarity import SimilarityJoin, parity

#: Nodes that a task remembers to have sent.
SEEN = 1 << 19
U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def grams(a: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words at each place of a text's word hashes; fewer words than n are one gram together."""
    n = min(n, len(a))
    if not n:
        return a
    with np.errstate(over="ignore"):
        out = np.full(len(a) - n + 1, U(n))
        for k in range(n):
            out = _mixed(out * U(0x9E3779B97F4A7C15) + a[k : len(a) - n + 1 + k])
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    """The 64-bit hash of each word; it takes less time than to look the word up."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Shingler:
    """Sorted distinct n-gram hashes of a text."""

    def __init__(self, n: int):
        self.n = n

    def __call__(self, text: bytes) -> np.ndarray:
        return np.unique(grams(word_hashes(text.lower().split()), self.n))


class Bands:
    """Size bands and the number of sketch blocks of each, for a similarity of num / den."""

    def __init__(self, num: int, den: int, largest: int = 1 << 32):
        self.num, self.den = num, den
        self.low = [1]
        while self.low[-1] <= largest:
            self.low.append(max(self.low[-1] + 1, self.low[-1] * 3 // 2, self.low[-1] * den // num + 1))
        self.starts = np.array(self.low)

    def blocks(self, band: int) -> tuple[int, int]:
        """Blocks of a sketch in a band, and how many of them may be empty and not sent. Two sets of a and b members that share o reach the threshold if den * o >= num * (a + b - o)."""
        top = self.low[band + 1] - 1
        differ = 2 * top * (self.den - self.num) // (self.num + self.den)
        spare = 2 + differ // 10 if differ else 0
        return differ + 1 + spare, spare

    def of(self, size: int) -> list[int]:
        """The bands in which a set of this size is looked for: its own, and the next if a partner can be there."""
        band = int(np.searchsorted(self.starts, size, "right")) - 1
        return [band, band + 1] if self.den * size >= self.num * self.low[band + 1] else [band]


def sketch(members: np.ndarray, blocks: int) -> np.ndarray:
    """Parity sketch: each member flips the bits of its hash in one 64-bit block; 0 stands for an empty block."""
    words = np.zeros(blocks, np.uint64)
    np.bitwise_xor.at(words, ((members >> U(6)) % U(blocks)).astype(np.int64), _mixed(members))
    return words


def _keys(members: np.ndarray, bands: Bands) -> np.ndarray:
    """The join keys of a set."""
    out = []
    for band in bands.of(len(members)):
        blocks, spare = bands.blocks(band)
        if blocks > 1:  # else only equal sets are near enough, and those are one node
            words = sketch(members, blocks)
            with np.errstate(over="ignore"):
                keys = _mixed(words + U(band + 1) * U(0xD6E8FEB86659FD93) + np.arange(blocks, dtype=np.uint64) * U(0xA0761D6478BD642F))
            said = words != 0
            out.append(keys[said] if blocks - said.sum() <= spare else keys)
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def set_number(members: np.ndarray) -> int:
    """64-bit number of a set's content."""
    return xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63)


def _signatures(n: int, num: int, den: int):
    """(id, tx, text) -> (id, tx, size, node, keys); a node's keys come once a task (and again after SEEN others)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bands, seen, none = Shingler(n), Bands(num, den), set(), np.zeros(0, np.int64)
        for part in parts:
            raw, sizes, nodes, keys = part.column(2).cast(pa.binary()), [], [], []
            for t in raw:
                s = shingles(t.as_py() or b"")
                sizes.append(len(s))
                nodes.append(set_number(s))
                keys.append(_keys(s, bands) if len(s) and nodes[-1] not in seen else none)
                seen.add(nodes[-1])
            if len(seen) > SEEN:
                seen.clear()
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*keys, none])))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), lists], names=["id", "tx", "size", "node", "keys"])

    return run


def _members(n: int):
    """(text) -> (node, size, sketch, payload) of the text's set; the payload is the text itself, packed, a third of the set's hashes."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        for part in parts:
            texts = [t.as_py() or b"" for t in part.column(0).cast(pa.binary())]
            sets = [shingles(t) for t in texts]
            columns = [pa.array([set_number(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([parity(s) for s in sets], pa.binary()), pa.array([zlib.compress(t, 1) for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "sketch", "payload"])

    return run


def _unpacked(n: int):
    """The set of a payload."""
    shingles = Shingler(n)
    return lambda payload: shingles(zlib.decompress(payload))


def _rows(docs: DataFrame, tables: Tables, n: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """id, tx, size, node, group of each row of docs: rows of one group are linked; the group of an empty set is null."""
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tx"), text.alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    sets = tables.write(texts.mapInArrow(_signatures(n, num, den), f"id {kind}, tx long, size long, node long, keys array<long>"), "signatures")
    joined = SimilarityJoin(sets, texts, _members(n), _unpacked(n), num, den, tables, single=True).links()
    rows = sets.select("id", "tx", "size", "node")
    rows = rows.withColumn("component", F.col("node")) if joined is None else rows.join(joined, "node", "left")
    group = F.when(F.col("size") > 0, F.coalesce("component", "node")).alias("group")
    out = tables.write(rows.select("id", "tx", "size", "node", group), "rows")
    tables.drop(sets, joined)
    return out


def ngram_components(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (least id that links of similarity num/den or more reach).

    A-Z are lower-cased; words are cut at ASCII white space; a text of fewer than n words has one n-gram, all of it. Null
    and empty texts have none and are linked with nothing. Equal sets are linked whatever their number. Null ids can be
    linked but are never a component's id unless it has no other. Rows that repeat come out as often as they came in.
    Other columns, whatever their names, are not read; empty tables give no rows.
    """
    rows = _rows(docs, Tables(docs.sparkSession, "ngram"), n, num, den, id_col, text_col)
    least = written(rows.where("group is not null").groupBy("group").agg(F.min("id").alias("component_id")), "ngram-groups")
    linked = rows.where("group is not null").join(least, "group").select("id", "size", "component_id")
    alone = rows.where("group is null").select("id", "size", F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id")


def ngram_dedup(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of linked documents, all its columns: the one with the least id (null after all others; of
    rows that share it, an arbitrary but fixed text).

    A row is told by its id and its text, so rows of other texts stay even if they share the id of one that goes. Rows
    that repeat id and text are one document and one of them stays. Texts without words are linked with nothing and all
    stay, copies too. Columns may have any names. An empty table gives no rows.
    """
    tables = Tables(docs.sparkSession, "ngram")
    rows = _rows(docs, tables, n, num, den, id_col, text_col).where("group is not null")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "tx")).alias("first")
    several = tables.write(rows.groupBy("group").agg(F.count("*").alias("n"), first).where("n > 1"), "groups")
    told = rows.join(several, "group").select("id", "tx", (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tx") == F.col("first.tx"))).alias("stays"))
    return keep_one_of(docs, told.distinct(), id_col, text_col)
