"""Embeddings: truncated SVD of sparse counts, PCA of dense vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.model import CountMatrix
from screenspark.sources.storage import settled


def signed(components: np.ndarray) -> np.ndarray:
    """Rows turned so that their largest loading is positive."""
    big = np.abs(components).argmax(axis=1)
    return components * np.where(components[np.arange(len(components)), big] < 0, -1.0, 1.0)[:, None]


@dataclass(frozen=True)
class Basis:
    """``components`` (k x features) and the mean to take off first."""

    names: list[str]
    components: np.ndarray
    mean: np.ndarray
    variance_ratio: np.ndarray


def summed(parts: DataFrame) -> list:
    """Rows (row, sums) of the parts' arrays, added up; a task's rows go to tasks by row."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return parts.groupBy("row").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).collect()


def _gram_times(cells: DataFrame, q: np.ndarray) -> np.ndarray:
    """The Gramian times ``q`` (features x few), a sum over cells (i, v) of their sparse rows.

    A task emits a sum of the size of ``q``; products are taken over stored entries alone.
    """
    sent = cells.sparkSession.sparkContext.broadcast(q)

    def add(batches):
        q = sent.value
        total = np.zeros(q.shape)
        for batch in batches:
            ends = np.cumsum(batch["i"].map(len).to_numpy())
            cuts = [0, *(np.flatnonzero(np.diff(ends // 50_000)) + 1).tolist(), len(batch)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    at, v = np.concatenate(batch["i"].iloc[lo:hi].to_list()), np.concatenate(batch["v"].iloc[lo:hi].to_list())
                    size = batch["i"].iloc[lo:hi].map(len).to_numpy()
                    scores = np.add.reduceat(v[:, None] * q[at], np.cumsum(size) - size)  # no cell is without entries
                    order = np.argsort(at, kind="stable")
                    genes, first = np.unique(at[order], return_index=True)
                    total[genes] += np.add.reduceat((v[:, None] * np.repeat(scores, size, axis=0))[order], first)
        yield pd.DataFrame({"row": np.arange(len(total)), "sums": list(total)})

    out = np.zeros(q.shape)
    for row in summed(cells.mapInPandas(add, "row int, sums array<double>")):
        out[row.row] = row.sums
    sent.destroy()
    return out


def truncated_svd(fit: CountMatrix, k: int, extra: int = 10, passes: int = 30, tolerance: float = 1e-11) -> Basis:
    """The first k right singular vectors of the uncentred matrix, without its Gramian.

    A random block of k + ``extra`` directions is multiplied by the Gramian in one pass over
    the cells; what is new in the product is the next block (block Krylov).  After each pass
    the best k directions in all blocks are taken, until their residual is less than
    ``tolerance`` of the largest eigenvalue.  The driver holds blocks of features x (k + extra)
    and decides; the features are the selected ones, thousands at most.
    """
    names = [r.gene_name for r in fit.var.select("gene_name").distinct().orderBy("gene_name").collect()]
    g = len(names)
    index = fit.x.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "gene_name string, i int")
    entries = fit.x.filter("value <> 0").join(F.broadcast(index), "gene_name").select("cell_id", "i", F.col("value").cast("double").alias("v"))  # as many rows as features
    cells = settled(entries.groupBy("cell_id").agg(F.collect_list("i").alias("i"), F.collect_list("v").alias("v")).select("i", "v"))
    squares = cells.select(F.sum(F.expr("aggregate(v, 0D, (s, x) -> s + x * x)"))).first()[0] or 0.0
    k = min(k, g)
    block = np.linalg.qr(np.random.default_rng(0).normal(size=(g, min(g, k + extra))))[0]
    basis, image = np.zeros((g, 0)), np.zeros((g, 0))
    values, vectors = np.zeros(k), np.eye(g)[:, :k]
    for _ in range(passes if squares else 0):
        product = _gram_times(cells, block)
        basis, image = np.hstack([basis, block]), np.hstack([image, product])
        small = basis.T @ image
        found, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = found[::-1][:k], turn[:, ::-1][:, :k]
        vectors = basis @ turn
        if basis.shape[1] >= g or np.linalg.norm(image @ turn - vectors * values, axis=0).max() <= tolerance * values[0]:
            break
        for _ in range(2):
            product = product - basis @ (basis.T @ product)
        left, sizes, _ = np.linalg.svd(product, full_matrices=False)
        block = left[:, sizes > 1e-13 * values[0]][:, : g - basis.shape[1]]
        if not block.shape[1]:
            break
    return Basis(names, signed(vectors.T), np.zeros(g), np.maximum(values, 0) / max(squares, 1e-300))


def project_sparse(m: CountMatrix, basis: Basis) -> DataFrame:
    """(cell_id, v): scores of all cells, also of those without entries."""
    spark = m.x.sparkSession
    loadings = spark.createDataFrame([(n, [float(c) for c in basis.components[:, i]]) for i, n in enumerate(basis.names)], "gene_name string, w array<double>")
    k = len(basis.components)
    terms = m.x.join(F.broadcast(loadings), "gene_name")
    scores = terms.groupBy("cell_id").agg(F.array(*[F.sum(F.col("value").cast("double") * F.col("w")[i]) for i in range(k)]).alias("v"))
    return m.obs.select("cell_id").join(scores, "cell_id", "left").withColumn("v", F.coalesce("v", F.array(*[F.lit(0.0)] * k)))


def pca(vectors: DataFrame, k: int) -> Basis:
    """Principal components of the array column ``v``, from sums and the Gramian."""
    size = len(vectors.select("v").first().v)

    def add(batches):
        s, gram, n = np.zeros(size), np.zeros((size, size)), 0
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_numpy())
                s, gram, n = s + x.sum(axis=0), gram + x.T @ x, n + len(x)
        yield pd.DataFrame({"row": np.arange(size + 1), "sums": list(np.vstack([np.concatenate([[n], s]), np.hstack([np.zeros((size, 1)), gram])]))})

    total = np.zeros((size + 1, size + 1))
    for row in summed(vectors.select("v").mapInPandas(add, "row int, sums array<double>")):
        total[row.row] = row.sums
    n, mean = total[0, 0], total[0, 1:] / total[0, 0]
    cov = total[1:, 1:] / n - np.outer(mean, mean)
    values, eigen = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][: min(k, size)]
    return Basis([str(i) for i in range(size)], signed(eigen[:, order].T), mean, np.maximum(values[order], 0) / max(np.trace(cov), 1e-300))


def project_dense(vectors: DataFrame, basis: Basis, out: str = "pcs") -> DataFrame:
    """(v - mean) on the components, for any split; the basis comes from training."""
    components, mean = basis.components.copy(), basis.mean.copy()

    @F.pandas_udf("array<double>")
    def score(v: pd.Series) -> pd.Series:
        return pd.Series(list((np.stack(v.to_numpy()) - mean) @ components.T)) if len(v) else pd.Series([], dtype=object)

    return vectors.withColumn(out, score("v"))
