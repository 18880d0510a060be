"""Quality classifier: a byte-level convolutional network in numpy.

A document is its UTF-8 bytes, cut into chunks of WIDTH bytes that overlap by half and cover all of it. Learned
filters over the embedded bytes of a chunk give FILTERS activations, the maximum over all chunks of the document keeps
one of each, and a logistic layer combines these into one probability. Fitting takes a bounded sample of labelled
documents, whole texts, on the driver; scoring is an Arrow UDF over every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

WIDTH, STEP = 16, 8
DIMS, FILTERS = 4, 24
#: Most labelled documents that fitting uses.
SAMPLE = 3000
#: Bytes of the longest text that a network is fitted on.
LONGEST = 1 << 16
#: Batches of the fit.
STEPS = 800
#: Bytes of text scored at once.
BLOCK_BYTES = 1 << 19


def _pack(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer of all texts, each padded with zeros to whole steps and one more; its chunks' rows; first row of each text."""
    steps = np.array([max(1, -(-len(t) // STEP)) for t in texts])
    starts = np.concatenate([[0], np.cumsum(steps + 1)])
    buffer = np.zeros(int(starts[-1]) * STEP, np.uint8)
    for t, s in zip(texts, starts.tolist(), strict=False):
        buffer[s * STEP : s * STEP + len(t)] = np.frombuffer(t, np.uint8)
    rows = np.ones(int(starts[-1]), bool)
    rows[starts[1:] - 1] = False
    return buffer, np.flatnonzero(rows), np.concatenate([[0], np.cumsum(steps)[:-1]])


class ByteConv:
    """embed: 256 x DIMS (row 0 stays zero: padding); conv: WIDTH*DIMS x FILTERS; a ReLU; head: FILTERS."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        self.p = {
            "embed": r.normal(0, 0.5, (256, DIMS)).astype(np.float32),
            "conv": r.normal(0, (2 / (WIDTH * DIMS)) ** 0.5, (WIDTH * DIMS, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "head": r.normal(0, 0.3, FILTERS).astype(np.float32),
            "out": np.zeros(1, np.float32),
        }
        self.p["embed"][0] = 0

    def _chunks(self, buffer: np.ndarray) -> np.ndarray:
        e = self.p["embed"][buffer]
        return np.lib.stride_tricks.as_strided(e, (len(buffer) // STEP - 1, WIDTH * DIMS), (STEP * DIMS * 4, 4))

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Maximum activation of each filter over all chunks of each text."""
        buffer, rows, first = _pack(texts)
        a = (self._chunks(buffer) @ self.p["conv"])[rows]
        return np.maximum(np.maximum.reduceat(a, first, axis=0) + self.p["bias"], 0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        z = self.pooled(texts) @ self.p["head"] + self.p["out"]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def _gradient(self, texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
        buffer, rows, first = _pack(texts)
        a = (self._chunks(buffer) @ self.p["conv"])[rows]
        last = np.append(first[1:], len(rows))
        best = np.stack([first[i] + a[first[i] : last[i]].argmax(0) for i in range(len(texts))])
        top = np.take_along_axis(a, best, 0) + self.p["bias"]
        h = np.maximum(top, 0)
        z = np.clip(h @ self.p["head"] + self.p["out"], -30, 30)
        dz = ((1 / (1 + np.exp(-z)) - y) / len(y)).astype(np.float32)
        dh = dz[:, None] * self.p["head"] * (top > 0)
        at = rows[best][:, :, None] * STEP + np.arange(WIDTH)  # text, filter, byte of the winning chunk
        seen = buffer[at]
        x = self.p["embed"][seen].reshape(*best.shape, WIDTH * DIMS)
        g = {"head": h.T @ dz, "out": dz.sum(keepdims=True), "bias": dh.sum(0), "conv": np.einsum("tfk,tf->kf", x, dh), "embed": np.zeros_like(self.p["embed"])}
        dx = (dh[:, :, None] * self.p["conv"].T[None]).reshape(*at.shape, DIMS)
        np.add.at(g["embed"], seen.ravel(), dx.reshape(-1, DIMS))
        g["embed"][0] = 0
        return g

    def fit(self, texts: list[bytes], labels: np.ndarray, steps: int = STEPS, batch: int = 64, rate: float = 0.02, decay: float = 1e-4) -> "ByteConv":
        """Adam on the logistic loss, about steps batches, both classes weighted as they occur; deterministic."""
        epochs = -(-steps * batch // len(texts))
        r = np.random.default_rng(1)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, y = 0, labels.astype(np.float32)
        self.p["out"][:] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        for epoch in range(epochs):
            order = r.permutation(len(texts))
            now = rate * (1 - epoch / epochs)
            for i in range(0, len(order), batch):
                some = order[i : i + batch]
                step += 1
                for k, g in self._gradient([texts[j] for j in some], y[some]).items():
                    g = g + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def held_out(id_col: Column) -> Column:
    """Documents that fitting must not see: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """At most limit labelled documents that are not held out, the first in the order of a hash of their ids: id, text, label.

    Of these, texts of more than LONGEST bytes are left out of fitting (never of scoring), so that what comes to the
    driver is bounded in bytes too; an id that docs repeats counts with the least of its texts.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    chosen = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(limit)
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id")
    found = found.where(F.octet_length(F.coalesce("text", F.lit(""))) <= LONGEST)
    return found.groupBy("id", "label").agg(F.min("text").alias("text"))


def fit(sample: DataFrame) -> ByteConv:
    """A network fitted on the rows of training_rows (at most SAMPLE documents come to the driver). Without rows of both labels its score is constant."""
    rows = sorted(sample.collect(), key=lambda r: (r["id"], r["text"] or ""))
    y = np.array([r["label"] for r in rows])
    net = ByteConv()
    if len(rows) and 0 < y.sum() < len(y):
        return net.fit([(r["text"] or "").encode() for r in rows], y)
    net.p["head"][:] = 0
    net.p["out"][:] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1)) if len(rows) else 0
    return net


def scorer(docs: DataFrame, net: ByteConv):
    """A column function text -> probability; null counts as empty, and empty texts get the score of one chunk of padding."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf(DoubleType())
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for part in parts:
            out, some, held = [np.zeros(0)], [], 0
            for t in part.cast(pa.binary()):
                some.append(t.as_py() or b"")
                held += len(some[-1])
                if held >= BLOCK_BYTES:
                    out.append(model.score(some))
                    some, held = [], 0
            if some:
                out.append(model.score(some))
            yield pa.array(np.concatenate(out), pa.float64())

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", limit: int = SAMPLE) -> DataFrame:
    """One row per row of docs: id, held_out, score (0 to 1, higher: better), predicted (1 if score >= threshold).

    Only texts are inputs of a score. Labels of ids that docs does not have, null labels and null ids teach nothing;
    a null id is not held out. Other columns are not read. Empty tables give no rows.
    """
    net = fit(training_rows(docs, labels, limit, id_col, text_col))
    scored = docs.select(F.col(id_col), scorer(docs, net)(F.col(text_col)).alias("score"))
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", limit: int = SAMPLE) -> DataFrame:
    """The rows of docs that are not predicted bad, all their columns."""
    net = fit(training_rows(docs, labels, limit, id_col, text_col))
    return docs.where(scorer(docs, net)(docs[text_col]) >= threshold)
