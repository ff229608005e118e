"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal.

Tokens are runs of word characters and runs of other characters, in their own case; unigrams and bigrams
are hashed to 2**18 weights (a token that repeats one of the last two is hashed as a repetition), and a text is the sum of its n-grams over the square root of their number.
Training takes ``max_train_docs`` labelled documents at most, the lowest by a hash of their id (a
documented bound: the list of their ids is broadcast). Their features are dealt to a fixed number of
learners; each runs follow-the-regularised-leader updates over its share in a fixed order, and their
weights are averaged. Scoring is a sparse dot product per text against the broadcast weights.

Defined results: a null or empty text scores the bias alone; labels that contradict each other count as
their mean, 0.5 as good; labels without a document and null labels are ignored; with no label to learn
from every score is 0.5; of several texts of one id the one with the smallest list of n-grams is learned from; repeated rows are repeated; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import staged

BITS = 18
SIZE = 1 << BITS
_TOKENS = re.compile(r"\w+|[^\w\s]+").findall
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Token to hash, bounded."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[token] = h = crc32(token.encode("utf-8", "surrogatepass"))
        return h


def features(text: str | None, hashes: _Hashes) -> np.ndarray:
    """Indices of the unigrams and bigrams, repeats included."""
    tokens = _TOKENS(text or "")
    h = np.fromiter(map(hashes.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    # a token that repeats the last one, or the one before that, counts as the repetition it is, whatever its word
    back = [np.append(np.zeros(k, bool), h[k:] == h[:-k]) if len(h) > k else np.zeros(len(h), bool) for k in (1, 2)]
    h = np.where(back[0], np.uint64(1 << 33), np.where(back[1], np.uint64(1 << 34), h))
    two = (h[:-1] * np.uint64(31) + h[1:] + np.uint64(7)) if len(h) > 1 else h[:0]
    return ((np.concatenate([h, two]) * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, float]], epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights after ``epochs`` passes in the given order; the last one is the bias."""
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(i: np.ndarray) -> np.ndarray:
        s = np.abs(z[i]) - l1 * (i < SIZE)
        return np.where(s > 0, -np.sign(z[i]) * s / ((beta + np.sqrt(n[i])) / alpha + l2), 0.0)

    packed = []
    for idx, y in rows:
        i, c = np.unique(idx, return_counts=True)
        packed.append((np.append(i, SIZE), np.append(c / np.sqrt(max(1, len(idx))), 1.0), y))
    for _ in range(epochs):
        for i, x, y in packed:
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(SIZE + 1))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train_docs: int = 12_000,
    learners: int = 4,
    epochs: int = 3,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.0,
) -> np.ndarray:
    """Weights, the bias last. ``labels`` has ``id_col`` and ``label_col``; choose the rows to learn from before."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.avg(label_col).alias("y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(max_train_docs)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            idx = [features(t.as_py(), hashes).astype(np.int32) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(idx, pa.list_(pa.int32()))], ["_id", "y", "idx"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = staged(rows.select("_id", "_text", "y").mapInArrow(featurise, f"_id {kind}, y double, idx array<int>"), "quality-features")

    def learn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "_id"])
        w = ftrl([(np.asarray(i, dtype=np.int64), float(y >= 0.5)) for i, y in zip(pdf.idx, pdf.y)], epochs, alpha, beta, l1, l2)
        return pd.DataFrame({"n": [len(pdf)], "w": [w.astype("<f8").tobytes()]})

    one = rows.groupBy("_id").agg(F.min(F.struct("y", "idx")).alias("r")).select("_id", "r.y", "r.idx")
    dealt = one.withColumn("h", F.xxhash64("_id", F.lit(1)))
    dealt = dealt.withColumn("learner", F.pmod("h", F.lit(learners)))
    parts = dealt.groupBy("learner").applyInPandas(learn, "n long, w binary").collect()  # `learners` rows
    total = sum(p.n for p in parts)
    if not total:
        return np.zeros(SIZE + 1)
    return sum(np.frombuffer(p.w, dtype="<f8") * (p.n / total) for p in parts)


def _score(texts: pa.Array, hashes: _Hashes, w: np.ndarray) -> np.ndarray:
    out = np.full(len(texts), w[SIZE])
    for k, t in enumerate(texts):
        idx = features(t.as_py(), hashes)
        if len(idx):
            out[k] += w[idx].sum() / np.sqrt(len(idx))
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def accepted(docs: DataFrame, weights: np.ndarray, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, as they are."""
    sent, at = docs.sparkSession.sparkContext.broadcast(weights), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            yield b.filter(pa.array(_score(b.column(at), hashes, sent.value) >= least))

    return docs.mapInArrow(run, docs.schema)


def scores(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_score(b.column(1), hashes, sent.value), pa.float64())], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")
