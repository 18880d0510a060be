"""Alignment of two tokenizers over the same texts: byte-level BPE (A) and sentence pieces (B).

Tokens are intervals of bytes. Inside a task, the texts of an Arrow batch are laid end to end, in slices of bounded size,
and DuckDB joins their interval tables: ends that both tokenizers share get numbers by a window sum, and an ASOF join
gives every token the first shared end at or behind its own, which is its group. Groups give the links; a task hands on
the pairs of ids of every document and, for each slice, in how many documents each pair occurs.

Spark adds these partial counts up. Pairs in the most documents (MANY at most, found by a histogram of powers of two) are
broadcast, so the rows of frequent pairs are never shuffled; rows of all other pairs meet their counts in a join whose
keys are rare by construction.
"""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsieve.llm.shared import Tables
from partsieve.llm.vocabulary import ByteLevel, Pieces

#: Characters of a slice, unless one text is longer.
SLICE = 1 << 20
#: Pairs that are broadcast at most: 16 bytes each.
MANY = 1 << 17
#: A single space between two other characters.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Characters of the stretches whose ids a worker remembers, about; then it forgets all.
KNOWN = 1 << 24
#: Memory of DuckDB in one task; beyond it it spills into the task's own temporary folder, which goes with the slice.
MEMORY = "400MB"

GROUPS = """
CREATE TEMP TABLE ends AS SELECT a.doc, e, sum(1) OVER (ORDER BY e ROWS UNBOUNDED PRECEDING)::INT AS g FROM a JOIN b USING (e);
CREATE TEMP TABLE ga AS SELECT ends.doc, a.e, a.id, g FROM a ASOF JOIN ends ON a.e <= ends.e;
CREATE TEMP TABLE gb AS SELECT b.e, b.id, g FROM b ASOF JOIN ends ON b.e <= ends.e;
"""
#: Links of groups with few tokens are joined as they are; a group of very many is counted by ids before it meets the other side.
FEW = 4096
LINKS = "CREATE TEMP TABLE pairs AS SELECT x.doc, x.id AS a, y.id AS b, count(*)::BIGINT AS n FROM ga x JOIN gb y USING (g) GROUP BY ALL"
COUNTED_LINKS = """
CREATE TEMP TABLE pairs AS
SELECT x.doc, x.id AS a, y.id AS b, sum(x.n * y.n)::BIGINT AS n
FROM (SELECT doc, g, id, count(*) AS n FROM ga GROUP BY ALL) x JOIN (SELECT g, id, count(*) AS n FROM gb GROUP BY ALL) y USING (g)
GROUP BY ALL
"""


def _intervals(ids: list[np.ndarray], sizes: np.ndarray) -> pa.Table:
    """doc, id, e: the end of every token in all texts laid end to end."""
    every = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in ids])
    ends = np.cumsum(sizes[every], dtype=np.int64)
    return pa.table({"doc": doc, "id": every, "e": ends.astype(np.int32) if len(ends) and ends[-1] < 1 << 31 else ends})


@lru_cache(maxsize=8)
def _names(n: int, sign: str) -> np.ndarray:
    """Decimal ids with the sign behind them."""
    return np.array([f"{i}{sign}" for i in range(n)], object)


def _written_groups(ga: dict, gb: dict, of_a: np.ndarray, of_b: np.ndarray, n_docs: int, n_ids: int) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of every document: each token's decimal id and the sign behind it, joined in order. of_a, of_b:
    tokens up to each group."""
    g, h = ga["g"], gb["g"]
    every = np.empty(len(g) + len(h), object)
    for ids, at, last, sign in ((ga["id"], np.arange(len(g)) + of_b[g - 1], of_a[1:] - 1, "|"), (gb["id"], np.arange(len(h)) + of_a[h], of_b[1:] - 1, ";")):
        every[at] = _names(n_ids, ",")[ids]
        every[at[last]] = _names(n_ids, sign)[ids[last]]
    last = np.searchsorted(ga["doc"], np.arange(n_docs), "right")  # A tokens up to the end of each document
    ends = np.where(last > 0, last + of_b[g[np.maximum(last, 1) - 1]] if len(g) else 0, 0).tolist()
    names = every.tolist()
    return ["".join(names[i:j])[:-1] for i, j in zip([0, *ends[:-1]], ends, strict=True)]


def _lists(offsets: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Array:
    """A column of lists of structs out of flat columns."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(v) for v in columns.values()], names=list(columns)))


class Aligner:
    """Both tokenizers of a worker."""

    def __init__(self, byte_level: str, pieces: str):
        self.a, self.b = ByteLevel(byte_level), Pieces(pieces)
        self.size_a, self.tokens_b = self.a.sizes(), self.b.tokens()
        self.size_b = np.array([len(t) for t in self.tokens_b])
        self.ids_a: dict[str, bytes] = {}
        self.ids_b: dict[str, bytes] = {}
        self.unlike: set[str] = set()
        self.known = 0

    def _remember(self, part: str, a: bytes, b: bytes) -> None:
        self.ids_a[part], self.ids_b[part] = a, b
        self.known += len(part) + 64

    def _alone(self, part: str) -> None:
        raw, a, b = (" " + part).encode(), self.a.ids(" " + part), self.b.ids(part)
        if self.size_a[a].sum() != len(raw) or b"".join(map(self.tokens_b.__getitem__, b.tolist())) != raw:
            self.unlike.add(part)
        self._remember(part, a.tobytes(), b.tobytes())

    def _together(self, parts: list[str]) -> bool:
        """Ids of stretches that begin and end with no white space, encoded as one text; False if the text does not fall apart."""
        text = " ".join(parts)
        raw, ends = (" " + text).encode(), np.cumsum([len(p.encode()) + 1 for p in parts])
        cuts = []
        for ids, sizes in ((self.a.ids(" " + text), self.size_a), (self.b.ids(text), self.size_b)):
            at = np.cumsum(sizes[ids])
            cut = np.searchsorted(at, ends)
            if at[-1] != len(raw) or (at[cut] != ends).any():
                return False
            cuts.append((ids.astype("<u4").tobytes(), (4 * (cut + 1)).tolist(), ids))
        if b"".join(map(self.tokens_b.__getitem__, cuts[1][2].tolist())) != raw:
            return False
        (a, to_a, _), (b, to_b, _) = cuts
        for part, i, j, k, m in zip(parts, [0, *to_a], to_a, [0, *to_b], to_b, strict=False):
            self._remember(part, a[i:j], b[k:m])
        return True

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for each text; none where a tokenizer does not give back the bytes of the text behind a space.

        No token of either reaches over a single space between two other characters, so a text is its stretches between
        such spaces, each behind one, and stretches met before are not encoded again.
        """
        parts = [BETWEEN.split(t) if t else [] for t in texts]
        if self.known > KNOWN:
            self.ids_a, self.ids_b, self.unlike, self.known = {}, {}, set(), 0
        new = set().union(*parts).difference(self.ids_a)
        words = [p for p in new if p and not p[0].isspace() and not p[-1].isspace() and "▁" not in p]
        if words and self._together(words):
            new.difference_update(words)
        for part in new:
            self._alone(part)
        out = []
        for own in parts:
            own = own if not self.unlike or self.unlike.isdisjoint(own) else []
            out.append(tuple(np.frombuffer(b"".join(map(ids.__getitem__, own)), np.uint32) for ids in (self.ids_a, self.ids_b)))
        return out

    def align(self, texts: list[str | None]) -> list[pa.Array]:
        """Columns n_a, n_b, n_groups, n_links, groups, pairs, counts: a row for each text, then one of the slice's counts."""
        import duckdb

        both = self.tokens(texts)
        ids_a, ids_b = [a for a, _ in both], [b for _, b in both]
        folder = tempfile.mkdtemp()
        try:
            with duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": folder}) as con:
                con.register("a", _intervals(ids_a, self.size_a))
                con.register("b", _intervals(ids_b, self.size_b))
                con.execute(GROUPS)
                ga, gb = (con.sql(f"SELECT * FROM {t} ORDER BY e").fetchnumpy() for t in ("ga", "gb"))
                in_a, in_b = (np.bincount(t["g"], minlength=1)[1:] for t in (ga, gb))
                con.execute(LINKS if (in_a * in_b).max(initial=0) <= FEW else COUNTED_LINKS)
                pairs = con.sql("SELECT * FROM pairs ORDER BY doc, a, b").fetchnumpy()
                counts = con.sql("SELECT a, b, count(*) AS docs FROM pairs GROUP BY ALL ORDER BY a, b").fetchnumpy()
                groups = con.sql("SELECT doc, count(*) AS n FROM ends GROUP BY doc").fetchnumpy()
        finally:
            shutil.rmtree(folder, ignore_errors=True)
        n = len(texts)
        n_groups = np.zeros(n, np.int64)
        n_groups[groups["doc"]] = groups["n"]
        numbers = [np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b)]
        starts = np.searchsorted(pairs["doc"], np.arange(n + 1))
        n_links = np.diff(np.concatenate([[0], np.cumsum(pairs["n"])])[starts])
        offsets = np.append(starts, starts[-1])  # the last row has the counts and no pairs
        held = _lists(offsets, {c: pairs[c] for c in ("a", "b", "n")})
        added = _lists(np.array([0] * (n + 1) + [len(counts["a"])]), {c: counts[c] for c in ("a", "b", "docs")})
        of_a, of_b = (np.concatenate([[0], np.cumsum(x)]) for x in (in_a, in_b))
        groups_of = _written_groups(ga, gb, of_a, of_b, n, max(len(self.size_a), len(self.size_b)))
        longs = [pa.array(np.append(v, 0), pa.int64()) for v in (*numbers, n_groups, n_links)]
        return [*longs, pa.array([*groups_of, None], pa.string()), held, added]


SHAPE = "of_text boolean, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<struct<a:int,b:int,n:bigint>>, counts array<struct<a:int,b:int,docs:bigint>>"


def _aligned(docs: DataFrame, byte_level: str, pieces: str, id_col: str, text_col: str) -> DataFrame:
    """id and SHAPE: a row for each row of docs, and rows that are no text's (of_text false) with partial counts."""
    shared = docs.sparkSession.sparkContext.broadcast(Aligner(byte_level, pieces))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, at, held = [], 0, 0
            for i, t in enumerate(part.column(1)):
                texts.append(t.as_py())
                held += len(texts[-1] or "")
                if held >= SLICE or i + 1 == part.num_rows:
                    ids = pa.concat_arrays([part.column(0).slice(at, len(texts)), pa.nulls(1, part.column(0).type)])
                    of_text = pa.array([True] * len(texts) + [False])
                    names = ["id", *(f.split()[0] for f in SHAPE.split(", "))]
                    yield pa.RecordBatch.from_arrays([ids, of_text, *shared.value.align(texts)], names=names)
                    texts, at, held = [], i + 1, 0

    return rows.mapInArrow(slices, f"id {rows.schema['id'].dataType.simpleString()}, {SHAPE}")


def align(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[Column] | None = None) -> DataFrame:
    """One row per row of docs: id, n_a, n_b, n_groups, n_links, n_best, count_sum, then carry (groups, if not given).

    byte_level, pieces: the files of the two tokenizers; special tokens inside texts are plain text. Groups are the
    stretches between bytes where a token of both ends; a link is a token of A and one of B in one group; the count of a
    pair of ids is the number of rows that hold it linked. n_best: links whose count is the highest of their A id, ties
    included; count_sum: the counts of all links. groups reads `a1,a2|b1;a3|b2,b3`; carry are expressions over id, n_a,
    n_b, n_groups, n_links and groups.

    Texts that are null or empty, or that a tokenizer does not give back byte by byte, have no tokens: zeros and an empty
    string. Rows are documents: equal rows count twice, null and repeated ids stay as they are, other columns, whatever
    their names, are not read. An empty table gives no rows. A long text is one slice, spilled by DuckDB if need be.
    """
    spark = docs.sparkSession
    tables = Tables(spark, "alignment")
    carry = [F.col("groups")] if carry is None else list(carry)
    found = _aligned(docs, byte_level, pieces, id_col, text_col)
    told = ["id", "n_a", "n_b", "n_groups", "n_links"]
    found = found.select("of_text", *told, F.struct(*carry).alias("carry"), "pairs", "counts").withColumn("row", F.monotonically_increasing_id())
    found = tables.write(found, "pairs")
    of_text = found.where("of_text")

    key = F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")
    counts = found.where("not of_text").select(F.inline("counts")).groupBy(key.alias("key")).agg(F.sum("docs").alias("docs"))
    counts = tables.write(counts, "counts")
    first = F.shiftright("key", 32).alias("a")
    most = counts.groupBy(first).agg(F.max("docs").alias("most"))  # a row for each id of A: as many as its vocabulary has
    counts = counts.join(F.broadcast(most), first == F.col("a")).select("key", "docs", (F.col("docs") == F.col("most")).alias("best"))
    powers = {r["k"]: r["n"] for r in counts.groupBy(F.floor(F.log2("docs")).cast("int").alias("k")).agg(F.count("*").alias("n")).collect()}
    least, held = 64, 0
    for k in range(63, -1, -1):
        held += powers.get(k, 0)
        if held > MANY:
            break
        least = k
    frequent = F.floor(F.log2("docs")) >= least

    links = of_text.select("row", F.inline("pairs")).select("row", key.alias("key"), "n")
    sums = lambda df: df.groupBy("row").agg(F.sum(F.col("n") * F.col("docs")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"))
    told_links = sums(links.join(F.broadcast(counts.where(frequent)), "key"))
    if held > MANY:
        rare = links.join(F.broadcast(counts.where(frequent).select("key")), "key", "left_anti")
        told_links = told_links.unionByName(sums(rare.join(counts.where(~frequent), "key")))
    told_links = told_links.groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    out = of_text.drop("pairs", "counts").join(told_links, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.col("id").alias(id_col), *told[1:], zero("n_best"), zero("count_sum"), "carry.*")
