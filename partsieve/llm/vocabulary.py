"""Two public vocabularies as whole-text encoders: byte-level BPE and sentence pieces.

The files are read once on the driver and broadcast (a few MB each, whatever the corpus); each Python worker builds its
encoders from them on first use.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: The pattern that byte-level BPE cuts texts by.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The bytes that byte-level vocabularies write as themselves; the others are written as U+0100 and on, in order.
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: White space as byte-level patterns know it, in runs so long that their regular expression would run out of stack.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{65536,}")
#: Characters of a stretch of a long text that is encoded at once.
STRETCH = 1 << 18


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for."""
    others = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Token bytes to ids, and special tokens to ids, of a tokenizer file whose merges stand in the order of their ids."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    as_byte, special = byte_of_character(), {t["content"]: t["id"] for t in found["added_tokens"] if t["special"]}
    vocab = {t: i for t, i in found["model"]["vocab"].items() if t not in special}
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in found["model"]["merges"]]
    if made != sorted(made):
        raise ValueError(f"{path}: the ids do not follow the order of the merges")
    return {bytes(as_byte[c] for c in t): i for t, i in vocab.items()}, special


def stretches(text: str) -> list[str]:
    """A long text cut before single spaces between two characters that are no white space: no token of either vocabulary
    reaches over such a place, and what stands before and behind it is cut as it is in the whole text."""
    out, at = [], 0
    while len(text) - at > STRETCH:
        cut = re.compile(r"\S(?= \S)").search(text, at + STRETCH)
        if cut is None:
            break
        out.append(text[at : cut.end()])
        at = cut.end()
    out.append(text[at:])
    return out


class ByteLevel:
    """Byte-level BPE. Special tokens inside texts are plain text unless special is set."""

    def __init__(self, path: str, special: bool = False):
        self.ranks, names = byte_level_ranks(path)
        self.names = names if special else {}
        self._encoding = None

    def __getstate__(self):
        return self.__dict__ | {"_encoding": None}

    def ids(self, text: str) -> np.ndarray:
        """The ids of a whole text, unsigned 32-bit."""
        if self._encoding is None:
            import tiktoken

            self._encoding = tiktoken.Encoding("byte level", pat_str=BYTE_LEVEL, mergeable_ranks=self.ranks, special_tokens=self.names)
        parts = [p for s in stretches(text) for p in self._parts(s)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _parts(self, text: str) -> Iterator[np.ndarray]:
        at = 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))  # the last space goes with what follows
            yield self._encoding.encode_to_numpy(text[at : run.start()], allowed_special="all", disallowed_special=())
            yield np.array(self._encoding._encode_single_piece(text[run.start() : end]), np.uint32)
            at = end
        yield self._encoding.encode_to_numpy(text[at:], allowed_special="all", disallowed_special=())

    def sizes(self) -> np.ndarray:
        """Bytes of each token, by id."""
        out = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for token, i in self.ranks.items():
            out[i] = len(token)
        return out


@lru_cache(maxsize=4)
def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


class Pieces:
    """Sentence pieces with byte fallback; the encoder puts a space before every text."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.model = f.read()

    def ids(self, text: str) -> np.ndarray:
        """The ids of a whole text. A stretch behind the first begins with a space, which the encoder puts there itself."""
        encode = _processor(self.model).encode
        first, *others = stretches(text)
        parts = [np.asarray(encode(s), np.uint32) for s in (first, *(s[1:] for s in others))]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def tokens(self) -> list[bytes]:
        """The bytes of each piece, by id: U+2581 is a space, <0xHH> is a byte; control pieces have none."""
        p = _processor(self.model)
        return [bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else b"" if p.is_control(i) or p.is_unknown(i) else p.id_to_piece(i).replace("▁", " ").encode() for i in range(p.get_piece_size())]
