"""Operator 8: quality classifier on learned subword embeddings.

A chunk (a word with what clings to it) has hashed features: itself and its character
n-grams.  Each feature has a learned vector; a chunk is the mean of its features' vectors,
a document the mean of its chunks', and a softmax layer turns that into the probability of
each class.  Vectors and layer are learned by stochastic gradient descent in numpy on a
bounded sample of labelled documents.

Scoring needs no vectors: the layer is linear in the mean, so each feature has one
number, the layer applied to its vector, and a document's margin is a mean of means of
those.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from screenspark.llm.chunks import ChunkTable, in_groups
from screenspark.llm.common import bucket_of, kept, map_batches


@dataclass(frozen=True)
class QualityParams:
    """``sample`` bounds the documents that the model is fitted on, ``longest`` their characters."""

    sample: int = 4000
    longest: int = 20_000
    buckets: int = 1 << 16
    dim: int = 10
    grams: tuple[int, ...] = (2, 3, 4)
    epochs: int = 6
    rate: float = 0.7
    seed: int = 8
    threshold: float = 0.7


def features(chunks: list[str], buckets: int, grams: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, bucket) of all hashed features of some chunks; owners are in order."""
    raw = [b"<" + c.encode("utf-8", "surrogatepass") + b">" for c in chunks]
    text = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    length = np.array([len(r) for r in raw])
    owner = np.repeat(np.arange(len(raw)), length)
    owners = [np.arange(len(raw))]
    hashes = [np.array([zlib.crc32(r) for r in raw], dtype=np.uint64)]
    for n in grams:
        if len(text) < n:
            continue
        h = np.full(len(text) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + text[k : len(text) - n + 1 + k]
        whole = owner[: len(h)] == owner[n - 1 :]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        owners.append(owner[: len(h)][whole])
        hashes.append((h >> np.uint64(32))[whole])
    return np.concatenate(owners), (np.concatenate(hashes) % np.uint64(buckets)).astype(np.int64)


def document_features(text: str | None, params: QualityParams) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, weight) such that the document's vector is their weighted sum."""
    chunks = (text or "").split()
    if not chunks:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    distinct, times = np.unique(np.array(chunks, dtype=object), return_counts=True)
    owner, bucket = features(distinct.tolist(), params.buckets, params.grams)
    share = times / times.sum() / np.bincount(owner, minlength=len(distinct))
    found, at = np.unique(bucket, return_inverse=True)
    return found, np.bincount(at, weights=share[owner])


@dataclass(frozen=True)
class QualityModel:
    params: QualityParams
    vectors: np.ndarray  # buckets x dim
    layer: np.ndarray  # dim x 2
    bias: np.ndarray  # 2

    def margins(self) -> np.ndarray:
        """By bucket, what it adds to the log-odds of class 1."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32)


def train(texts: list[str | None], classes: list[int], params: QualityParams = QualityParams()) -> QualityModel:
    """Stochastic gradient descent on the cross entropy, a document at a time.

    Without documents of both classes the model gives the share of class 1, or 0.5.
    """
    rng = np.random.default_rng(params.seed)
    vectors = rng.uniform(-1, 1, (params.buckets, params.dim)) / params.dim
    layer, bias = np.zeros((params.dim, 2)), np.zeros(2)
    if len(set(classes)) < 2:
        bias[1] = 0 if not classes else 3.0 if classes[0] else -3.0
        return QualityModel(params, np.zeros_like(vectors), layer, bias)
    docs = [document_features(t, params) for t in texts]
    target = np.eye(2)[classes]
    steps, done = params.epochs * len(docs), 0
    for _ in range(params.epochs):
        for i in rng.permutation(len(docs)):
            bucket, weight = docs[i]
            rate = params.rate * (1 - done / steps)
            done += 1
            mean = weight @ vectors[bucket]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            wrong = p / p.sum() - target[i]
            back = np.clip(layer @ wrong, -1, 1)
            layer -= rate * np.outer(mean, wrong)
            bias -= rate * 0.1 * wrong
            vectors[bucket] -= rate * weight[:, None] * back
    return QualityModel(params, vectors, layer, bias)


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), hold_out: bool = True) -> QualityModel:
    """Fit on at most ``sample`` labelled documents, in the order of a hash of doc_id, of at
    most ``longest`` characters each.

    With ``hold_out`` rows whose crc32(doc_id) mod 4 is 2 are never learned from.  Rows
    with a null label, id or text teach nothing; of several labels of a document each
    counts.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    if hold_out:
        known = known.filter(bucket_of("doc_id", 4) != 2)
    order = [F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "quality"]
    chosen = known.orderBy(*order).limit(params.sample)
    rows = docs.select("doc_id", "text").filter(F.length("text") <= params.longest).join(F.broadcast(chosen), "doc_id")
    rows = rows.orderBy(*order, "text").limit(params.sample).collect()
    return train([r.text for r in rows], [r.quality for r in rows], params)


class Scorer:
    def __init__(self, margins: np.ndarray, bias: float, grams: tuple[int, ...]):
        def compute(chunks: list[str]) -> np.ndarray:
            owner, bucket = features(chunks, len(margins), grams)
            total = np.bincount(owner, weights=margins[bucket], minlength=len(chunks))
            return (total / np.bincount(owner, minlength=len(chunks)))[:, None]

        self.table, self.bias = ChunkTable(compute, 1), bias

    def __call__(self, texts: list[str | None]) -> list[float]:
        out = []
        for group in in_groups(texts):
            found = self.table.indices(group)
            rows = self.table.rows[:, 0]
            margin = np.array([rows[i].mean() if len(i) else 0.0 for i in found])
            out += (1 / (1 + np.exp(-np.clip(margin + self.bias, -50, 50)))).tolist()
        return out


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with ``score`` (probability of class 1) and ``predicted`` (0 or 1).

    A null or empty text gets the model's bias alone.  All columns and rows stay, in
    place of columns of those two names.
    """
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*rest)
    margins, bias, grams, least = model.margins(), float(model.bias[1] - model.bias[0]), model.params.grams, model.params.threshold
    sent = docs.sparkSession.sparkContext.broadcast(margins)
    key = f"quality {zlib.crc32(margins.tobytes())} {bias!r} {grams!r}"

    def make():
        scorer = kept(key, lambda: Scorer(sent.value, bias, grams))

        def step(cols):
            scores = scorer(cols["text"])
            return cols | {"score": scores, "predicted": [int(s >= least) for s in scores]}

        return step

    return map_batches(docs, make, StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())]))
