"""Similarity join of sets under candidate keys that emits links, not all pairs of a group.

Sets of equal content are one node, and a node sends its keys once a task. Where nodes have many keys, each is first
verified against one node that shares one of its few least keys; that joins most near copies. Then every key is reduced,
before the shuffle, to the least and greatest component under it: only keys under which two components meet stay open,
and only their members are gathered. Members of an open group that are not in its largest component are compared with
all others by parity sketches inside a task, in tiles of bounded size, and each component's nearest pairs leave it,
more of them from round to round and all at last; those that pass the exact test merge components, and groups close.
Only groups of which a round left near pairs out are compared again.
Of keys with the same members one is compared. Long sketches go to the groups folded, and the pairs that are near by
those meet once more by the whole sketches, each pair once, however many keys it shares.
Every pair that shares a key is in the end linked, ruled out by its sketches or tested, or lies in one component:
components come out exactly, however a group's pairs are spread.

The Hamming distance of parity sketches is at most the symmetric difference, so it only rules pairs out; the exact test
compares whole sets, which are read from one text of each asked node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from partsieve.llm.shared import Tables, bit_set, filter_pages, with_hit
from partsieve.operators.components import components

#: Least keys of a node under which it is first tested against one other.
FIRST = 6
#: Members of a group that is compared pair by pair, many groups at once.
SMALL = 8
#: Members of a side of a tile.
TILE = 2048
#: Bits of a sketch for each member, at least; a power of 2.
FINE = 4
#: A sketch goes to groups folded so often, but not to fewer bytes than SHORT: it goes under every key of its node.
FOLDS, SHORT = 4, 128
#: Nearest pairs of a component that leave a tile, round by round; None: all.
ROUNDS = (1, 16, None)
SETS = "node long, size long, sketch binary, payload binary"


def shared_members(set_of: Callable[[bytes], np.ndarray]):
    """A column function of two payloads: how many members their sets share. set_of gives the sorted members of a payload."""

    @F.arrow_udf(LongType())
    def shared(left: pa.Array, right: pa.Array) -> pa.Array:
        last, first, out = None, None, []
        for x, y in zip(left, right, strict=True):
            x, y = x.as_py(), y.as_py()
            if x != last:
                last, first = x, set_of(x)
            out.append(len(np.intersect1d(first, set_of(y), assume_unique=True)))
        return pa.array(out, pa.int64())

    return shared


def parity(members: np.ndarray) -> bytes:
    """Parity sketch for comparing: member h flips bit h mod 2 ** k, with FINE to 2 * FINE bits a member.

    Members that differ and share a bit hide each other; with few bits so many do that sets which are not near enough, but
    almost, pass for near ones, every pair of them.
    """
    bits = max(64, FINE << (len(members) | 1).bit_length())
    odd = np.bincount((members >> np.uint64(6) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


@F.arrow_udf(BinaryType())
def folded(sketches: pa.Array) -> pa.Array:
    """Sketches folded FOLDS times, or to SHORT bytes: their distances only get less."""
    out = []
    for s in sketches:
        s = s.as_py()
        out.append(np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(max(1, min(FOLDS, len(s) // SHORT)), -1), axis=0).tobytes())
    return pa.array(out, pa.binary())


@F.arrow_udf(LongType())
def distances(left: pa.Array, right: pa.Array) -> pa.Array:
    """Bits in which two sketches differ."""
    return pa.array([_distance(x.as_py(), y.as_py()) for x, y in zip(left, right, strict=True)], pa.int64())


class SimilarityJoin:
    """Components of sets that meet under a common key.

    rows: id, tx (a hash of the text), size, node (a number for the set's content), keys; sets of size 0 are left out.
    texts: id, tx, text. members: a function for mapInArrow from (text, nodes) to (node, size, sketch, payload), which
    gives the wanted nodes of the text, once each; set_of gives the sorted 64-bit hashes of the set that a payload stands
    for. nodes are structs of a node and the columns of rows in where, which tell where the text has it. single: a text has
    one node, and the function takes (text) alone. Two sets are linked if they share num/den of their union or more.
    """

    def __init__(self, rows: DataFrame, texts: DataFrame, members: Callable, set_of: Callable, num: int, den: int, tables: Tables, first: int = FIRST, single: bool = False, where: tuple[str, ...] = ()):
        self.rows, self.texts, self.members, self.num, self.den, self.tables, self.first, self.single, self.where = rows, texts, members, num, den, tables, first, single, where
        self.shared = shared_members(set_of)
        self.joined: DataFrame | None = None

    def _sets(self, nodes: DataFrame) -> DataFrame:
        """node, size, sketch, payload of the asked nodes (and of few others), each read from one text that has it, in place where texts are single."""
        nodes = self.tables.write(nodes.distinct(), "asked")
        pages = filter_pages(nodes.count())
        rows = self.rows.select("node", F.xxhash64("id", "tx").alias("pick"), *self.where)
        rows = with_hit(rows, bit_set(nodes, ["node"], pages), ["node"], pages).where("hit").drop("hit")
        if self.single:
            picks = rows.groupBy("node").agg(F.min("pick").alias("pick")).join(nodes, "node", "left_semi").select("pick").distinct()
        else:
            rows = rows.groupBy("node").agg(F.min(F.struct("pick", *self.where)).alias("p")).join(nodes, "node", "left_semi")
            picks = rows.groupBy("p.pick").agg(F.collect_list(F.struct("node", *(f"p.{c}" for c in self.where))).alias("nodes"))
        picks = self.tables.write(picks, "picks")
        texts = self.texts.select(F.xxhash64("id", "tx").alias("pick"), "text")
        texts = with_hit(texts, bit_set(picks, ["pick"], pages), ["pick"], pages).where("hit").select("pick", "text")
        if self.single:
            sets = self._once(self.tables.write(texts.select("text").mapInArrow(self.members, SETS), "sets"))
        else:
            found = texts.join(picks, "pick").groupBy("pick").agg(F.first("text").alias("text"), F.first("nodes").alias("nodes"))
            sets = self.tables.write(found.select("text", "nodes").mapInArrow(self.members, SETS), "sets")
        self.tables.drop(nodes, picks)
        return sets

    def _once(self, sets: DataFrame) -> DataFrame:
        """Sets with one row of each node: copies of a text, which the filter passes for nothing or which repeat an id, would multiply its pairs. Only they are shuffled."""
        several = self.tables.write(sets.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node"), "several")
        out, pages = sets, filter_pages(several.count())
        if not several.isEmpty():
            marked = with_hit(sets, bit_set(several, ["node"], pages), ["node"], pages)
            one = marked.where("hit").groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "sketch", "payload")])
            out = self.tables.write(marked.where("not hit").select(one.columns).unionByName(one), "sets")
            self.tables.drop(sets)
        self.tables.drop(several)
        return out

    def _both(self, pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
        """a, b with the sizes n, m of their sets and a column of theirs as left, right."""
        pages = filter_pages(2 * pairs.count())
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node"))
        some = with_hit(sets.select("node", "size", column), bit_set(nodes, ["node"], pages), ["node"], pages).where("hit").drop("hit")
        return pairs.join(some.toDF("b", "m", "right"), "b").join(some.toDF("a", "n", "left"), "a")

    def _sketched(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs that are near enough by their whole sketches."""
        near = (self.den + self.num) * distances("left", "right") <= (self.den - self.num) * (F.col("n") + F.col("m"))
        return self.tables.write(self._both(pairs, sets, "sketch").where(near).select("a", "b"), "sketched")

    def _linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the pairs of nodes a, b that reach the threshold, by the exact size of the intersection."""
        both = self._both(pairs, sets, "payload")
        n, m = F.col("n"), F.col("m")
        both = both.where(self.den * F.least(n, m) >= self.num * F.greatest(n, m)).withColumn("shared", self.shared("left", "right"))
        return self.tables.write(both.where(self.den * F.col("shared") >= self.num * (n + m - F.col("shared"))).select("a", "b"), "links")

    def _merge(self, links: DataFrame) -> None:
        """Joins the components that the links connect."""
        if links.isEmpty():
            self.tables.drop(links)
            return
        edges = links if self.joined is None else links.unionByName(self.joined.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")))
        new = self.tables.write(components(edges), "components")
        self.tables.drop(links, self.joined)
        self.joined = new

    def _named(self, rows: DataFrame) -> DataFrame:
        """rows with column c: the component of their node so far."""
        if self.joined is None:
            return rows.withColumn("c", F.col("node"))
        return rows.join(self.joined, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")

    def _first_links(self) -> None:
        """Tests each node against the least of the nodes that come first under its least keys."""
        few = F.explode(F.slice(F.sort_array("keys"), 1, self.first)).alias("key")
        low = self.tables.write(self.rows.where("size > 0").select("node", few), "least-keys")
        hubs = low.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top").select("key", "hub")
        hubs = self.tables.write(hubs, "hubs")
        pairs = low.join(hubs, "key").where("node <> hub").groupBy("node").agg(F.min("hub").alias("hub"))
        pairs = self.tables.write(pairs.select(F.col("hub").alias("a"), F.col("node").alias("b")), "pairs")
        self.tables.drop(low, hubs)
        sets = self._sets(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))))
        self._merge(self._linked(pairs, sets))
        self.tables.drop(pairs, sets)
        self.tables.free()

    def _open(self) -> DataFrame:
        """key, node of all members of the keys under which two components meet."""
        rows = self.rows.where("size > 0").select("node", "keys")
        if self.joined is not None:
            pages = filter_pages(self.joined.count())
            marked = with_hit(rows, bit_set(self.joined, ["node"], pages), ["node"], pages)
            some = self._named(marked.where("hit").drop("hit"))
            rows = some.unionByName(marked.where("not hit").drop("hit").withColumn("c", F.col("node")))
        else:
            rows = self._named(rows)
        sent = rows.select(F.explode("keys").alias("key"), "node", "c")
        met = sent.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("key")
        met = self.tables.write(met, "open-keys")
        pages = filter_pages(met.count())
        sent = self.rows.where("size > 0").select("node", F.explode("keys").alias("key"))
        asked = with_hit(sent, bit_set(met, ["key"], pages), ["key"], pages).where("hit").select("key", "node")
        out = self.tables.write(asked.join(met, "key", "left_semi").distinct(), "open")
        self.tables.drop(met)
        self.tables.free()
        return out

    def links(self) -> DataFrame | None:
        """node, component (the least node that links reach) of every node that has a link; None if there are no links."""
        if self.first:
            self._first_links()
        members = self._open()
        sets = self._sets(members.select("node"))
        self.tables.free()
        drawn = sets.select("node", "size", folded("sketch").alias("sketch") if self.single else "sketch")
        tested = None
        for nearest in ROUNDS:
            named = self.tables.write(self._named(members), "members")
            self.tables.drop(members)
            marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mark{i}") for i in (0, 1)]
            parts = named.groupBy("key", "c").agg(F.count("*").alias("n"), *marks)
            marks = [F.bit_xor(f"mark{i}").alias(f"mark{i}") for i in (0, 1)]
            groups = parts.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "c")).alias("major"), F.count("*").alias("parts"), *marks).where("parts > 1")
            if tested is not None:  # all pairs of small groups have been compared
                groups = groups.where(F.col("n") > SMALL)
            else:  # groups of the same members are one: two numbers of 64 bits tell them apart
                groups = groups.groupBy("n", "mark0", "mark1").agg(F.min("key").alias("key"), F.first("major").alias("major"))
            groups = self.tables.write(groups.select("key", "n", F.col("major.n").alias("n_major"), F.col("major.c").alias("major")), "groups")
            opened = self.tables.write(named.join(groups, "key"), "opened")
            members = opened.select("key", "node")
            if opened.isEmpty():
                break
            found = self.tables.write(self._near(opened.join(drawn, "node"), nearest).distinct(), "near")
            pairs, cut = found.where("key is null").select("a", "b"), found.where("key is not null").select("key")
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = self.tables.write(pairs, "pairs")
            self.tables.drop(named, groups)
            if not pairs.isEmpty():
                near = self._sketched(pairs, sets) if self.single else pairs
                self._merge(self._linked(near, sets))
            self.tables.free()
            if cut.isEmpty():  # no component had more near pairs than have been tested
                break
            members = members.join(cut, "key", "left_semi")  # all near pairs of other groups have been tested
            tested = pairs if tested is None else tested.unionByName(pairs)
        return self.joined

    def _near(self, opened: DataFrame, nearest: int | None) -> DataFrame:
        """Pairs a, b of members of a group that are in different components, near enough in size and in sketch; of each component but the
        largest of a group above SMALL only so many of the nearest a tile. Rows with a key instead name the groups where that cut any off."""
        hashed, n_minor = F.xxhash64("node"), F.col("n") - F.col("n_major")
        p, q = (F.ceil(x / TILE).cast("int") for x in (n_minor, F.col("n_major")))
        r = opened.withColumn("is_major", F.col("c") == F.col("major")).withColumn("p", p).withColumn("q", q)
        r = r.withColumn("tile", F.pmod(hashed, F.when(F.col("is_major"), F.col("q")).otherwise(F.col("p"))).cast("int"))
        spot = lambda x, y, side: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), side.cast("int").alias("side"))
        zero, one, two = F.lit(0), F.lit(1), F.lit(2)
        with_minors = F.transform(F.sequence(zero, F.col("p") - 1), lambda k: spot(k, F.col("tile"), one))
        with_majors = F.transform(F.sequence(zero, F.col("q") - 1), lambda k: spot(F.col("tile"), k, zero))
        among = F.transform(F.sequence(zero, F.col("p") - 1), lambda k: spot(F.least("tile", k), F.col("q") + F.greatest("tile", k), F.when(k == F.col("tile"), two).when(k > F.col("tile"), zero).otherwise(one)))
        spots = F.when(F.col("n") <= TILE, F.array(spot(zero, zero, two))).when(F.col("is_major"), with_minors).otherwise(F.concat(with_majors, among))
        dealt = r.withColumn("at", F.explode(spots)).select("key", "at.x", "at.y", "at.side", "node", "c", "is_major", "size", "sketch")
        dealt = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
        return dealt.mapInArrow(_compared(self.num, self.den, nearest), "a long, b long, key long")


def _folded(drawn: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the length of the shortest."""
    n = min(map(len, drawn)) // 8
    out = np.empty((len(drawn), n), np.uint64)
    for i, s in enumerate(drawn):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, n), axis=0)
    return out


def _distance(x: bytes, y: bytes) -> int:
    """Bits in which two parity sketches differ; the longer one is folded to the length of the other."""
    short, long = sorted((x, y), key=len)
    a, b, bits = int.from_bytes(short, "little"), int.from_bytes(long, "little"), 8 * len(long)
    while bits > 8 * len(short):
        bits //= 2
        b = (b >> bits) ^ (b & ((1 << bits) - 1))
    return (a ^ b).bit_count()


def _compared(num: int, den: int, nearest: int | None):
    """Tiles compared by their sketches, in blocks; small groups pair by pair, many at once."""

    def tile(t: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, c, size, side, is_major = (t.column(k).to_numpy(zero_copy_only=False) for k in ("node", "c", "size", "side", "is_major"))
        words = _folded(t.column("sketch").to_pylist())
        coarse = np.bitwise_xor.reduce(words.reshape(len(words), min(FINE, words.shape[1]), -1), axis=1)
        ask = np.flatnonzero((side == 0) | ((side == 2) & ~is_major))
        step, found = max(1, (1 << 20) // (len(node) * coarse.shape[1])), []
        for first in range(0, len(ask), step):
            i = ask[first : first + step]
            near = (c[i, None] != c[None, :]) & (den * np.minimum(size[i, None], size[None, :]) >= num * np.maximum(size[i, None], size[None, :]))
            near &= (side[i, None] == 2) | (side[None, :] == 1)
            x, y = np.nonzero(near)
            for drawn in (coarse, words) if coarse.shape[1] < words.shape[1] else (words,):
                differ = np.bitwise_count(drawn[i[x]] ^ drawn[y]).sum(1, dtype=np.int64)
                good = (den + num) * differ <= (den - num) * (size[i[x]] + size[y])
                x, y, differ = x[good], y[good], differ[good]
            found.append(few(i[x], y, differ, c, 1)[:3])
        x, y, _, cut = few(*(np.concatenate(k) for k in zip(*found, strict=True)), c, 0) if found else (np.zeros(0, int),) * 4
        return np.minimum(node[x], node[y]), np.maximum(node[x], node[y]), cut

    def few(x: np.ndarray, y: np.ndarray, differ: np.ndarray, c: np.ndarray, more: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The nearest pairs of each component of x, and some more; whether it has others."""
        if not nearest:
            return x, y, differ, np.zeros(len(x), bool)
        order = np.lexsort((differ, c[x]))
        x, y, differ, held = x[order], y[order], differ[order], c[x[order]]
        begin = np.searchsorted(held, held)
        first = np.arange(len(x)) - begin < nearest + more
        cut = np.searchsorted(held, held, "right") - begin > nearest + more
        return x[first], y[first], differ[first], cut[first]

    def small(t: pa.RecordBatch, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        node, c, size = (t.column(k).to_numpy() for k in ("node", "c", "size"))
        drawn, a, b = t.column("sketch"), [np.zeros(0, int)], [np.zeros(0, int)]
        for d in range(1, SMALL):
            i = np.flatnonzero(group[:-d] == group[d:])
            near = (c[i] != c[i + d]) & (den * np.minimum(size[i], size[i + d]) >= num * np.maximum(size[i], size[i + d]))
            a.append(i[near])
            b.append(i[near] + d)
        i, j = np.concatenate(a), np.concatenate(b)
        differ = [_distance(drawn[x].as_py(), drawn[y].as_py()) for x, y in zip(i.tolist(), j.tolist(), strict=True)]
        good = (den + num) * np.array(differ, np.int64) <= (den - num) * (size[i] + size[j])
        return np.minimum(node[i], node[j])[good], np.maximum(node[i], node[j])[good]

    def compare(t: pa.RecordBatch, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = t.column("key").to_numpy()
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(starts, len(group)))
        rows = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
        pairs, cut = [small(t.take(pa.array(rows)), group[rows])] if len(rows) else [], []
        for k in np.flatnonzero(sizes > SMALL):
            a, b, more = tile(t.slice(int(starts[k]), int(sizes[k])))
            pairs.append((a, b))
            cut += [int(keys[starts[k]])] * bool(more.any())
        if pairs:
            a, b = np.unique(np.stack([np.concatenate(k).astype(np.int64) for k in zip(*pairs, strict=True)]), axis=1)
            none = pa.nulls(len(cut), pa.int64())
            columns = [pa.concat_arrays([pa.array(a), none]), pa.concat_arrays([pa.array(b), none]), pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(cut, pa.int64())])]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "key"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in parts:
            if held is not None and held.num_rows:
                part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
            key, x, y = (part.column(k).to_numpy() for k in ("key", "x", "y"))
            group = np.cumsum(np.append(True, (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))) if len(key) else np.zeros(0, np.int64)
            last = int(np.searchsorted(group, group[-1])) if len(group) else 0  # the last group may go on in the next batch
            if last:
                yield from compare(part.slice(0, last), group[:last])
            held, rest = part.slice(last), group[last:]
        if held is not None and held.num_rows > 1:
            yield from compare(held, rest)

    return run
