"""Packing: the public tokenizer's ids, each in one piece; gapless windows; the fullest multiset against all of them."""

import itertools
import random
import zlib
from collections import defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from partsieve.llm.packing import Lengths, Packer, pack
from partsieve.llm.queries import op13_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def padding(lengths):
    return sum(0 if n & (n - 1) == 0 else 1024 - n for n in lengths)


def check(pieces, texts):
    """pieces: (key, start, length, ids, doc_tokens, sequence, offset); keys are unique."""
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for key, start, length, ids, n, sequence, offset in pieces:
        assert length > 0 and len(ids) == 4 * length
        by_doc[key].append((start, ids, n))
        by_sequence[sequence].append((offset, length))
    assert by_doc.keys() == texts.keys()
    for key, text in texts.items():
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for start, ids, n in sorted(by_doc[key]):
            assert start == at and n == len(want)
            at += len(ids) // 4
        assert b"".join(i for _, i, _ in sorted(by_doc[key])) == b"".join(x.to_bytes(4, "little") for x in want)
    sizes = []
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
        sizes.append(at)
    return sizes


def test_query_on_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = pack(docs.repartition(4), PATH).collect()
    sizes = check([tuple(r) for r in got], texts)
    assert padding(sizes) == 0 and sum(n < 1024 for n in sizes) <= 4 * 10
    q = op13_packing(spark, "/root/testdata/sf0.01")
    assert dict(q.dtypes) == {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    crcs = defaultdict(list)
    for r in q.collect():
        crcs[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
    tokenizer = Tokenizer.from_file(PATH)
    for key, found in crcs.items():
        raw = b"".join(x.to_bytes(4, "little") for x in tokenizer.encode(texts[key] or "", add_special_tokens=False).ids + [0])
        assert all(zlib.crc32(raw[4 * s : 4 * (s + n)]) == c for s, n, c in found)


def test_edges(spark):
    rows = [(None, "a b"), (None, "a b"), (1, None), (1, ""), (2, "x" * 50_000), (3, " " * 200_000 + "end"), (4, "cut <|endoftext|> here"), (5, "漢字 é" * 9_000), (6, "w " * 100_000)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k long")
    docs = docs.withColumns({c: F.lit(7) for c in ("id", "ids", "start", "sequence_id", "offset")})
    got = pack(docs, PATH, id_col="k").collect()
    sizes = check([tuple(r) for r in got], {k: t for k, (_, t) in enumerate(rows)})
    assert padding(sizes) == 0
    by_id = pack(docs, PATH).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"] for r in by_id} == {None, 1, 2, 3, 4, 5, 6} and next(r["n"] for r in by_id if r["doc_id"] == 1) == 2
    assert pack(docs.limit(0), PATH).count() == 0


def brute(counts, room):
    best = 0
    for some in itertools.product(*(range(n + 1) for n in counts.values())):
        total = sum(k * length for k, length in zip(some, counts, strict=True))
        if best < total <= room:
            best = total
    return best


def test_closest_against_all_multisets():
    r = random.Random(5)
    for _ in range(300):
        window = r.choice([16, 32, 64])
        held = Lengths(window)
        counts = {}
        for _ in range(12):
            length = r.randrange(1, window)
            if r.random() < 0.3 and counts.get(length):
                held.add(length, -1)
                counts[length] -= 1
            elif len(counts) < 5 or length in counts:
                held.add(length, 1)
                counts[length] = counts.get(length, 0) + 1
            room = r.randrange(window + 1)
            taken = held.closest(room)
            assert all(n <= counts[k] for k, n in taken.items())
            assert sum(k * n for k, n in taken.items()) == brute(counts, room)


def test_no_padding_where_nothing_fits_and_bounded_holding():
    for lengths in ([600] * 500, [1023] * 50, [1] * 3000, [513, 700, 900] * 70, [3]):
        p, out = Packer(1024, 5), []
        for i, n in enumerate(lengths):
            p.add((i, 0, bytes(4 * n)))
            if p.n > 64:
                out += p.fill(32)
                assert p.n <= 32 or p.tokens < 1024
        out += p.finish()
        by = defaultdict(int)
        for _, _, ids, sequence, _ in out:
            by[sequence] += len(ids) // 4
        assert sum(by.values()) == sum(lengths) and padding(by.values()) == 0 and sum(n < 1024 for n in by.values()) <= 10
