"""Highly variable genes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from screenspark.functions.statistics import md5_order, rank_by
from screenspark.model import CountMatrix
from screenspark.spec import ScreenSpec


def stratified_sample(obs: DataFrame, n: int, seed: int, column: str = "pert") -> DataFrame:
    """Of each group rint(size * n / all), at least 1, in an order fixed by the seed."""
    total = obs.agg(F.count("*").alias("all"))
    sizes = obs.groupBy(column).agg(F.count("*").alias("size")).crossJoin(F.broadcast(total))
    take = sizes.select(column, F.greatest(F.lit(1), F.least(F.rint(F.col("size") * F.least(F.lit(1.0), n / F.col("all"))).cast("bigint"), F.col("size"))).alias("take"))
    ranked = rank_by(obs, md5_order(seed, "cell_id"), "cell_id", column, name="_rank")
    return ranked.join(take, column).filter("_rank <= take").select(*obs.columns)


def uniform_sample(obs: DataFrame, n: int, seed: int) -> DataFrame:
    """N rows, without replacement, by the same order."""
    return obs.orderBy(md5_order(seed, "cell_id"), "cell_id").limit(n)


def moments(m: CountMatrix) -> DataFrame:
    """(gene_name, n_cells, mean, variance), the variance with n - 1, zeros counted."""
    v = F.col("value").cast("double")
    sums = m.x.groupBy("gene_name").agg(F.sum(v).alias("s"), F.sum(v * v).alias("s2"))
    out = m.var.select("gene_name").join(sums, "gene_name", "left").fillna(0.0, ["s", "s2"]).crossJoin(F.broadcast(m.n_cells()))
    out = out.withColumn("mean", F.try_divide("s", "n_cells"))
    return out.withColumn("variance", F.greatest(F.lit(0.0), F.try_divide(F.col("s2") - F.col("n_cells") * F.col("mean") * F.col("mean"), F.col("n_cells") - 1))).select("gene_name", "n_cells", "mean", "variance")


def loess(x: np.ndarray, y: np.ndarray, span: float = 0.3) -> np.ndarray:
    """Local quadratic fit with tricube weights, at each x; for tens of thousands of genes."""
    n = len(x)
    k = min(n, max(4, int(np.ceil(span * n))))
    order = np.argsort(x, kind="stable")
    xs, ys = x[order], y[order]
    out = np.empty(n)
    lo = 0
    for i in range(n):
        while lo + k < n and xs[lo + k] - xs[i] < xs[i] - xs[lo]:
            lo += 1
        wx, wy = xs[lo : lo + k] - xs[i], ys[lo : lo + k]
        reach = max(np.abs(wx).max(), 1e-12) * 1.0000001
        w = np.sqrt((1 - (np.abs(wx) / reach) ** 3) ** 3)
        design = np.stack([np.ones(k), wx, wx * wx], axis=1) * w[:, None]
        out[order[i]] = np.linalg.lstsq(design, wy * w, rcond=None)[0][0]
    return out


def normalised_variance(m: CountMatrix) -> DataFrame:
    """(gene_name, mean, variance, score): variance of clipped, standardised counts
    (Stuart et al. 2019).

    The moments of genes come to the driver, which fits the trend; one more pass sums the
    clipped counts.  A constant gene scores 0.
    """
    spark = m.x.sparkSession
    stats = moments(m).toPandas()
    if not len(stats):
        return spark.createDataFrame([], "gene_name string, mean double, variance double, score double")
    live = (stats["variance"] > 0).to_numpy() & (stats["mean"] > 0).to_numpy()
    fit = np.zeros(len(stats))
    if live.sum() >= 4:
        fit[live] = loess(np.log10(stats["mean"][live].to_numpy()), np.log10(stats["variance"][live].to_numpy()))
    elif live.any():
        fit[live] = np.log10(stats["variance"][live].to_numpy())
    stats["sd"] = np.where(live, np.sqrt(10**fit), 0.0)
    return clipped_variance(m, spark.createDataFrame(stats[["gene_name", "n_cells", "mean", "variance", "sd"]]))


def clipped_variance(m: CountMatrix, trend: DataFrame) -> DataFrame:
    """The score, given each gene's expected deviation ``sd``: variance of the counts over
    it, clipped at the root of the number of cells; 0 where ``sd`` is."""
    trend = trend.withColumn("cap", F.col("mean") + F.col("sd") * F.sqrt("n_cells"))
    c = F.least(F.col("value").cast("double"), F.col("cap"))
    sums = m.x.join(F.broadcast(trend.select("gene_name", "cap")), "gene_name").groupBy("gene_name").agg(F.sum(c).alias("c1"), F.sum(c * c).alias("c2"))
    out = trend.join(sums, "gene_name", "left").fillna(0.0, ["c1", "c2"])
    score = (F.col("n_cells") * F.col("mean") * F.col("mean") + F.col("c2") - 2 * F.col("mean") * F.col("c1")) / ((F.col("n_cells") - 1) * F.col("sd") * F.col("sd"))
    return out.select("gene_name", "mean", "variance", F.when(F.col("sd") > 0, score).otherwise(0.0).alias("score"))


def top_genes(scores: DataFrame, n: int) -> DataFrame:
    """Scores with ``is_hvg``; ties by name."""
    best = scores.orderBy(F.desc("score"), "gene_name").limit(n).select("gene_name").withColumn("is_hvg", F.lit(True))
    return scores.join(best, "gene_name", "left").withColumn("is_hvg", F.coalesce("is_hvg", F.lit(False)))


def swap_targets(ranked: DataFrame, targets: DataFrame, cycle: DataFrame) -> DataFrame:
    """Ranked with ``status``, ``is_core`` and ``selected``.

    Target genes that aren't variable enough take the places of the least variable genes
    that are neither targets nor of the cell cycle; with too few of those they are
    stacked on top.  Genes of the cell cycle ride along, but aren't core.
    """
    marks = ranked
    for frame, name in ((targets, "is_target"), (cycle, "is_cycle")):
        marks = marks.join(frame.select("gene_name").distinct().withColumn(name, F.lit(True)), "gene_name", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    safe = F.col("is_hvg") & ~F.col("is_target") & ~F.col("is_cycle")
    counts = marks.agg(F.count_if(F.col("is_target") & ~F.col("is_hvg")).alias("missing"), F.count_if(safe).alias("safe"))
    lowest = F.row_number().over(W.partitionBy(safe).orderBy("score", F.desc("gene_name")))
    out = marks.withColumn("_low", F.when(safe, lowest)).crossJoin(F.broadcast(counts))
    dropped = F.coalesce((F.col("missing") <= F.col("safe")) & (F.col("_low") <= F.col("missing")), F.lit(False))
    core = (F.col("is_hvg") & ~dropped) | F.col("is_target")
    status = F.when(F.col("is_target") & ~F.col("is_hvg"), "rescued_target").when(dropped, "swapped_out").when(F.col("is_hvg"), "variable").when(F.col("is_cycle"), "ghost").otherwise("dropped")
    out = out.withColumn("status", status).withColumn("is_core", core).withColumn("selected", core | F.col("is_cycle"))
    return out.drop("_low", "missing", "safe")


def status_summary(selected: DataFrame) -> DataFrame:
    """(status, n, mean, low, high) of the scores."""
    return selected.groupBy("status").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), F.min("score").alias("low"), F.max("score").alias("high"))


def select_genes(m: CountMatrix, spec: ScreenSpec, targets: DataFrame, cycle: DataFrame) -> DataFrame:
    """The stage: fit on a stratified sample of the cells, rank, rescue."""
    fit = m.keep_cells(stratified_sample(m.obs, spec.fit_cells, spec.seed))
    return swap_targets(top_genes(normalised_variance(fit), spec.n_top_genes), targets, cycle)


def gene_manifest(selected: DataFrame) -> dict:
    """The names of the selected genes, and of the core ones."""
    rows = selected.filter("selected").select("gene_name", "is_core").orderBy("gene_name").collect()
    return {"hvg_names": [r.gene_name for r in rows], "core_features": [r.gene_name for r in rows if r.is_core]}


def excise_ghosts(m: CountMatrix, selected: DataFrame) -> CountMatrix:
    """Core genes alone, once the embedding is made."""
    return m.keep_genes(selected.filter("is_core"))
