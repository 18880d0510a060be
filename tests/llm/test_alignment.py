"""Alignment of two tokenizers against the libraries themselves and plain counts."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from partsieve.llm import alignment as module
from partsieve.llm.alignment import align
from partsieve.llm.queries import op11_tokenizer_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def tokenized():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    p = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}

    def both(text):
        if not text:
            return [], []
        a = [(i, bytes(back[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()) for i in p.encode(text)]
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])

    return both


def plain(texts):
    """The rows that the contract asks for, one a text."""
    both, groups, docs = tokenized(), [], Counter()
    for text in texts:
        a, b = both(text)
        ends = []
        for tokens in (a, b):
            at, found = 0, []
            for i, raw in tokens:
                at += len(raw)
                found.append((at, i))
            ends.append(found)
        shared = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        own, low = [], 0
        for e in shared:
            own.append(tuple([i for at, i in side if low < at <= e] if len(text) < 3000 else None for side in ends))
            low = e
        if len(text or "") >= 3000:  # the same by walking once
            own, k = [([], []) for _ in shared], 0
            for side in (0, 1):
                k = 0
                for at, i in ends[side]:
                    while shared[k] < at:
                        k += 1
                    own[k][side].append(i)
        groups.append(own)
        docs.update({(x, y) for g in own for x in g[0] for y in g[1]})
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    out = []
    for own in groups:
        links = [(x, y) for g in own for x in g[0] for y in g[1]]
        line = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in own)
        n_best, total = sum(docs[x] == best[x[0]] for x in links), sum(docs[x] for x in links)
        out.append((sum(len(g[0]) for g in own), sum(len(g[1]) for g in own), len(own), len(links), n_best, total, hashlib.sha256(line.encode()).hexdigest() if own else ""))
    return out


def test_large_groups_are_counted_first(monkeypatch):
    """Both ways to the links of a slice give the same columns."""
    texts = ["漢字🙂" * 300 + " ab" * 50, None, "plain words here", "yyyyyyyyy" * 100]
    direct = module.Aligner(A, B).align(texts)
    monkeypatch.setattr(module, "FEW", 0)
    assert [c.to_pylist() for c in module.Aligner(A, B).align(texts)] == [c.to_pylist() for c in direct]


@pytest.mark.parametrize("many", [module.MANY, 50])
def test_query(spark, monkeypatch, many):
    """Whole table, with all pairs broadcast and with nearly all pairs rare."""
    monkeypatch.setattr(module, "MANY", many)
    got = op11_tokenizer_alignment(spark, "/root/testdata/sf0.001")
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == {r["doc_id"]: x for r, x in zip(rows, plain([r["text"] for r in rows]), strict=True)}


def test_edges(spark):
    texts = [None, "", " ", "a", "a", "\n\n x", "has ▁ inside", "<s> and <|endoftext|> </s>", "漢字かな🙂 é́", "y" * 4001, " " * 5000 + "z", "null \x00 byte", "tab\tand\r\n", "123 456,789", "ab cd " * 60_000]
    rows = [(None if i % 4 == 0 else i % 3, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k long").withColumns({c: F.lit(1) for c in ("id", "row", "pairs", "groups", "carry", "n_a")})
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256)).alias("digest")
    got = align(docs.repartition(3), A, B, id_col="k", carry=[digest]).collect()
    assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r["k"])] == plain(texts)
    by_id = align(docs, A, B).select("doc_id", "groups").collect()
    assert Counter(r["doc_id"] for r in by_id) == Counter(r[0] for r in rows)
    assert align(docs.limit(0), A, B).count() == 0
