"""Many substrings in many texts: one automaton over all patterns, one scan of each text.

The automaton (Aho-Corasick) finds all patterns that end at a character while it reads the text once, so time does not
grow with the number of patterns. Patterns that fit into one dictionary of bounded size go to every task by a broadcast.
More of them are dealt by their first characters into several such dictionaries: texts meet each dictionary in a cogroup,
in groups of bounded size, so neither the patterns nor the texts pass through one task or the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from partsieve.staging import Stages

#: Characters of the patterns of one dictionary; an automaton takes some 40 bytes for each.
DICTIONARY = 1 << 21
#: Characters of the texts that meet a dictionary in one group.
GROUP = 1 << 24
#: First characters of a pattern that say which dictionary it goes to.
PREFIX = 8


class Automaton:
    """The patterns of one dictionary, empty ones left out; built where it is first used."""

    def __init__(self, patterns: Sequence[str]):
        self.patterns, self._built = list(patterns), None

    def __getstate__(self):
        return self.__dict__ | {"_built": None}

    def count(self, text: str) -> dict[int, tuple[int, int]]:
        """Number of a pattern to (occurrences without overlap, taken from the left; where the first begins), of those that occur."""
        if self._built is None:
            import ahocorasick

            self._built = ahocorasick.Automaton()
            numbers: dict[str, list[int]] = {}
            for i, p in enumerate(self.patterns):
                if p:
                    numbers.setdefault(p, []).append(i)
            for p, same in numbers.items():
                self._built.add_word(p, (len(p), same))
            self._built.make_automaton()
        found: dict[int, list[int]] = {}  # by the first pattern of equal ones: occurrences, end of the last, begin of the first
        groups: dict[int, list[int]] = {}
        if not len(self._built):
            return {}
        for last, (size, same) in self._built.iter(text):
            begin = last + 1 - size
            seen = found.get(same[0])
            if seen is None:
                found[same[0]] = [1, last + 1, begin]
                groups[same[0]] = same
            elif begin >= seen[1]:
                seen[0] += 1
                seen[1] = last + 1
        return {i: (n, first) for k, (n, _, first) in found.items() for i in groups[k]}


def pattern_counts(text: Column, patterns: Sequence[str]) -> Column:
    """Array of how often each pattern occurs in a text, without overlap; for a fixed list of patterns. Null counts as empty."""
    automaton = Automaton(patterns)

    @F.arrow_udf(ArrayType(IntegerType()))
    def counts(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out = []
            for t in part.to_pylist():
                found = automaton.count(t or "")
                out.append([found[i][0] if i in found else 0 for i in range(len(patterns))])
            yield pa.array(out, pa.list_(pa.int32()))

    return counts(text)


def _hits(automaton: Automaton, rows: list[int], texts: Iterator, ids: list) -> tuple[list, list, list, list]:
    at, which, n, first = [], [], [], []
    for row, text in zip(rows, texts, strict=True):
        for i, (times, begin) in automaton.count(text.as_py()).items():
            at.append(row)
            which.append(ids[i])
            n.append(times)
            first.append(begin)
    return at, which, n, first


def contains_join(texts: DataFrame, patterns: DataFrame, text_id: str, text: str, pattern_id: str, pattern: str, fold: bool = False) -> DataFrame:
    """text_id, pattern_id, n, first: every pair of a row of texts that contains a row of patterns; n occurrences without
    overlap, the first of which begins at character first (from 0).

    fold: A-Z of both count as a-z. Null texts and patterns, and empty patterns, are in no pair; rows that repeat an id or a
    pattern are pairs of their own. Columns may have any names but must not share the ids' one. Empty tables give no rows.
    """
    spark = texts.sparkSession
    folded = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if fold else F.col(c)
    wanted = patterns.select(F.col(pattern_id).alias("pattern_id"), folded(pattern).alias("pattern")).where("pattern <> ''")
    rows = texts.select(F.col(text_id).alias("text_id"), folded(text).alias("text")).where("text is not null")
    text_type, pattern_type = (df.schema[0].dataType.simpleString() for df in (rows, wanted))
    shape = f"text_id {text_type}, pattern_id {pattern_type}, n long, first long"
    size = wanted.agg(F.sum(F.length("pattern"))).first()[0] or 0
    n_dictionaries = -(-size // DICTIONARY)

    def found(ids: pa.Array, hits: tuple, pattern_ids: pa.DataType) -> dict:
        at, which, n, first = hits
        return {"text_id": ids.take(pa.array(at, pa.int64())), "pattern_id": pa.array(which, pattern_ids), "n": pa.array(n, pa.int64()), "first": pa.array(first, pa.int64())}

    if n_dictionaries <= 1:
        listed = wanted.toArrow()  # at most DICTIONARY characters
        id_type, ids = listed.schema.field("pattern_id").type, listed.column("pattern_id").to_pylist()
        shared = spark.sparkContext.broadcast(Automaton(listed.column("pattern").to_pylist()))

        def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                yield pa.RecordBatch.from_pydict(found(part.column(0), _hits(shared.value, range(part.num_rows), part.column(1), ids), id_type))

        out = rows.mapInArrow(scan, shape)
    else:
        stages = Stages(spark, "contains")
        rows = stages.write(rows.withColumn("slot", F.xxhash64("text_id", "text", F.monotonically_increasing_id())), "texts")
        slots = -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 1) // GROUP)
        dealt = wanted.withColumn("dictionary", F.pmod(F.xxhash64(F.substring("pattern", 1, PREFIX)), F.lit(n_dictionaries)))
        left = rows.withColumn("slot", F.pmod("slot", F.lit(slots))).withColumn("dictionary", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_dictionaries - 1).cast("long"))))
        right = dealt.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))

        def meet(own: pa.Table, words: pa.Table) -> pa.Table:
            ids = own.column("text_id").combine_chunks()
            hits = _hits(Automaton(words.column("pattern").to_pylist()), range(own.num_rows), own.column("text"), words.column("pattern_id").to_pylist())
            return pa.table(found(ids, hits, words.schema.field("pattern_id").type))

        out = left.groupBy("dictionary", "slot").cogroup(right.groupBy("dictionary", "slot")).applyInArrow(meet, shape)
    return out.select(F.col("text_id").alias(text_id), F.col("pattern_id").alias(pattern_id), "n", "first")
