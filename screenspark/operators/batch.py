"""Batch correction of embeddings (Korsunsky et al. 2019).

Cells are assigned softly to clusters, favouring clusters in which their batch is rare, and
per cluster what the batches differ by is taken off.  The assignment is updated a block of
cells at a time against running counts by batch and cluster.  A cell's memberships follow
from its vector, the centres and its block's weights, so they are never stored: a block is
one pass over its own partition of a table, which gives sums by batch and cluster alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.operators.embed import summed
from screenspark.operators.hvg import uniform_sample
from screenspark.sources.matrix import clean_up
from screenspark.sources.storage import new_path

#: Passes of k-means, at most, from which the clusters start.
START_PASSES = 8


@dataclass(frozen=True)
class Round:
    """Unit centres (k x d), weights (block x batch x k), shifts (batch x k x d)."""

    centres: np.ndarray
    weights: np.ndarray
    shift: np.ndarray


@dataclass(frozen=True)
class HarmonyModel:
    """What corrects a cell, round by round; ``objective`` has each round's passes."""

    batches: tuple[str, ...]
    blocks: int
    sigma: float
    rounds: tuple[Round, ...] = ()
    objective: tuple[tuple[float, ...], ...] = ()


def unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.linalg.norm(z, axis=-1, keepdims=True), 1e-12)


def memberships(z: np.ndarray, centres: np.ndarray, weight: np.ndarray, sigma: float) -> np.ndarray:
    """Shares of clusters by distance on the sphere, times ``weight``; sigma 0 takes the nearest."""
    near = unit(z) @ centres.T
    if sigma == 0:
        return np.eye(len(centres))[near.argmax(axis=1)]
    score = 2 * (near - 1) / sigma + np.log(np.maximum(weight, 1e-300))
    share = np.exp(score - score.max(axis=1, keepdims=True))
    return share / share.sum(axis=1, keepdims=True)


def weights_of(counts: np.ndarray, share: np.ndarray, theta: float) -> np.ndarray:
    """Batch x cluster: expected against found counts, large where the batch is rare."""
    return ((share[:, None] * counts.sum(axis=0) + 1) / (counts + 1)) ** theta


def shifts(counts: np.ndarray, raw: np.ndarray, ridge: float) -> np.ndarray:
    """Batch x cluster x d: each cluster's ridge regression on a free constant and its batches.

    ``raw`` has the sums of vectors.  As every cell has one batch, the normal equations give
    the constant as a ratio of sums, and each batch's shift by it alone.
    """
    held = 1 / (counts + ridge)
    constant = np.einsum("bk,bkd->kd", held, raw) / np.maximum((counts * held).sum(axis=0), 1e-300)[:, None]
    return (raw - counts[:, :, None] * constant) * held[:, :, None]


def _places(codes: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(block, batch, the rows of both)."""
    pairs = blocks.astype(np.int64) << 32 | codes
    for pair in np.unique(pairs):
        yield int(pair >> 32), int(pair & 0xFFFFFFFF), np.flatnonzero(pairs == pair)


def corrected(z: np.ndarray, codes: np.ndarray, blocks: np.ndarray, fixed: np.ndarray, rounds: tuple[Round, ...], sigma: float) -> np.ndarray:
    """Each round assigns the vectors as corrected so far, and corrects the first ones."""
    for r in rounds:
        out = np.empty_like(z)
        for block, code, at in _places(codes, blocks):
            out[at] = z[at] - memberships(fixed[at], r.centres, r.weights[block, code], sigma) @ r.shift[code]
        fixed = out
    return fixed


@dataclass
class Tally:
    """Sums by block: counts and sums of first and of unit vectors by batch and cluster."""

    counts: np.ndarray
    raw: np.ndarray
    unit: np.ndarray
    loss: np.ndarray

    @classmethod
    def nothing(cls, blocks: int, b: int, k: int, d: int) -> Tally:
        return cls(np.zeros((blocks, b, k)), np.zeros((blocks, b, k, d)), np.zeros((blocks, k, d)), np.zeros(blocks))

    def take(self, block: int, other: Tally) -> None:
        for mine, new in ((self.counts, other.counts), (self.raw, other.raw), (self.unit, other.unit), (self.loss, other.loss)):
            mine[block] = new[block]

    def centres(self, before: np.ndarray) -> np.ndarray:
        total = self.unit.sum(axis=0)
        return np.where(np.linalg.norm(total, axis=1, keepdims=True) > 1e-9, unit(total), before)

    def objective(self, share: np.ndarray, sigma: float, theta: float) -> float:
        """Distances and entropy of the memberships, and how far batches are from their share."""
        counts = self.counts.sum(axis=0)
        expected = share[:, None] * counts.sum(axis=0)
        return float(self.loss.sum() + sigma * theta * (counts * np.log((counts + 1) / (expected + 1))).sum())


def tally(cells: DataFrame, centres: np.ndarray, weights: np.ndarray, sigma: float) -> Tally:
    """One pass over cells (block, code, v, fixed).  A task emits a row for each block and
    batch that it has seen, and no others."""
    blocks, b, k = weights.shape
    d = centres.shape[1]
    sent = cells.sparkSession.sparkContext.broadcast((centres, weights))

    def sums(frames):
        centres, weights = sent.value
        found: dict[int, np.ndarray] = {}
        for frame in frames:
            if not len(frame):
                continue
            z, fixed = np.stack(frame["v"].to_numpy()), np.stack(frame["fixed"].to_numpy())
            for block, code, at in _places(frame["code"].to_numpy(), frame["block"].to_numpy()):
                r, u = memberships(fixed[at], centres, weights[block, code], sigma), unit(fixed[at])
                loss = (r * 2 * (1 - u @ centres.T)).sum() + sigma * (r * np.log(np.maximum(r, 1e-300))).sum()
                part = np.concatenate([r.sum(axis=0), (r.T @ z[at]).ravel(), (r.T @ u).ravel(), [loss]])
                row = block * b + code
                found[row] = found[row] + part if row in found else part
        if found:  # a task without rows has no sums, and a frame without rows no lists
            yield pd.DataFrame({"row": pd.Series(list(found), dtype="int32"), "sums": list(found.values())})

    out = Tally.nothing(blocks, b, k, d)
    for row in summed(cells.select("block", "code", "v", "fixed").mapInPandas(sums, "row int, sums array<double>")):
        block, code = divmod(row.row, b)
        part = np.array(row.sums)
        out.counts[block, code], out.raw[block, code] = part[:k], part[k : k + k * d].reshape(k, d)
        out.unit[block] += part[k + k * d : -1].reshape(k, d)
        out.loss[block] += part[-1]
    sent.destroy()
    return out


def first_centres(vectors: DataFrame, k: int, seed: int = 42) -> np.ndarray:
    """A farthest-first choice of k among 50 * k cells drawn from all by the md5 order."""
    start = unit(np.stack([r.v for r in uniform_sample(vectors, 50 * k, seed).select("v").collect()]))
    chosen = [0]
    while len(chosen) < min(k, len(start)):
        chosen.append(int((start @ start[chosen].T).max(axis=1).argmin()))
    return start[chosen]


def _place(batch: str, model: HarmonyModel) -> tuple[F.Column, F.Column]:
    """A cell's batch by number, -1 if unknown, and its block by a hash of its id."""
    names = F.array(*[F.lit(n) for n in model.batches])
    code = F.array_position(names, F.coalesce(F.col(batch).cast("string"), F.lit(""))) - 1
    return code.cast("int"), F.pmod(F.xxhash64("cell_id"), F.lit(model.blocks)).cast("int")


def _fixing(model: HarmonyModel, rounds: tuple[Round, ...]):
    @F.pandas_udf("array<double>")
    def fix(v: pd.Series, fixed: pd.Series, code: pd.Series, block: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        return pd.Series(list(corrected(np.stack(v.to_numpy()), code.to_numpy(), block.to_numpy(), np.stack(fixed.to_numpy()), rounds, model.sigma)))

    return fix


def fit(vectors: DataFrame, batch: str = "batch", clusters: int | None = None, rounds: int = 20, sigma: float = 0.1, theta: float = 2.0, ridge: float = 1.0, tolerance: float = 1e-4, blocks: int = 5, passes: int = 3, pass_tolerance: float = 1e-3) -> HarmonyModel:
    """A model from all of vectors (cell_id, batch, v).

    The clusters start by k-means.  In a round up to ``passes`` passes move the centres and
    then update the blocks, one after the other, until the objective falls by less than the
    share ``pass_tolerance``; then vectors are corrected.  Rounds end when the objective no
    longer falls by the share ``tolerance`` from one to the next.  A null batch is a batch of its own.  With a
    single batch the model has no rounds.  The table that the passes read is removed again.
    """
    spark = vectors.sparkSession
    name = F.coalesce(F.col(batch).cast("string"), F.lit(""))
    sizes = vectors.groupBy(name.alias("name")).count().orderBy("name").collect()
    model = HarmonyModel(tuple(r["name"] for r in sizes), blocks, sigma)
    if len(sizes) < 2:
        return model
    share = np.array([r["count"] for r in sizes], dtype=float)
    k = clusters or int(max(2, min(100, share.sum() // 30)))
    share /= share.sum()
    centres = first_centres(vectors, k)
    k, d, b = len(centres), centres.shape[1], len(sizes)
    weights = np.ones((blocks, b, k))
    made, objective, done = [], [], []
    path = new_path(spark, "harmony")

    def written(rows: DataFrame) -> DataFrame:
        made.append(f"{path}/{len(made)}")
        rows.select("block", "code", "v", "fixed").write.partitionBy("block").parquet(made[-1])
        return spark.read.schema("code int, v array<double>, fixed array<double>, block int").parquet(made[-1])

    try:
        code, block = _place(batch, model)
        cells = written(vectors.select(code.alias("code"), block.alias("block"), "v", F.col("v").alias("fixed")))
        loss = np.inf
        for _ in range(START_PASSES):
            found = tally(cells, centres, weights, 0.0)
            centres = found.centres(centres)
            if loss - found.loss.sum() <= 1e-3 * abs(found.loss.sum()):
                break
            loss = found.loss.sum()
        for _ in range(rounds):
            now = tally(cells, centres, weights, sigma)
            values = [now.objective(share, sigma, theta)]
            for _ in range(passes):
                centres = now.centres(centres)
                for block in range(blocks):
                    others = now.counts.sum(axis=0) - now.counts[block]
                    weights[block] = weights_of(others, share, theta)
                    now.take(block, tally(cells.filter(F.col("block") == block), centres, weights, sigma))
                values.append(now.objective(share, sigma, theta))
                if values[-2] - values[-1] < pass_tolerance * abs(values[-2]):
                    break
            done.append(Round(centres, weights.copy(), shifts(now.counts.sum(axis=0), now.raw.sum(axis=0), ridge)))
            objective.append(tuple(values))
            if len(done) == rounds or len(objective) > 1 and objective[-2][-1] - values[-1] < tolerance * abs(objective[-2][-1]):
                break
            cells = written(cells.withColumn("fixed", _fixing(model, (done[-1],))("v", "fixed", "code", "block")))
            clean_up(spark, made[-2:-1], dry_run=False)
    finally:
        clean_up(spark, [path], dry_run=False)
    return HarmonyModel(model.batches, blocks, sigma, tuple(done), tuple(objective))


def apply(vectors: DataFrame, model: HarmonyModel, batch: str = "batch") -> DataFrame:
    """vectors with ``corrected``, in one pass; a batch that the model doesn't know stays as it is."""
    if not model.rounds:
        return vectors.withColumn("corrected", F.col("v"))
    code, block = _place(batch, model)
    fixed = _fixing(model, model.rounds)("v", "v", F.greatest(code, F.lit(0)), block)
    return vectors.withColumn("corrected", F.when(code >= 0, fixed).otherwise(F.col("v")))


def harmony(vectors: DataFrame, batch: str = "batch", **settings) -> DataFrame:
    """vectors (cell_id, batch, v, ...) with ``corrected``; ``settings`` are those of ``fit``.

    Without the batch column, or with a single batch, it equals ``v``.  Blocks and the start
    go by hashes of ids, so results don't vary.
    """
    if batch not in vectors.columns:
        return vectors.withColumn("corrected", F.col("v"))
    return apply(vectors, fit(vectors, batch, **settings), batch)
