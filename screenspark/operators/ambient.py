"""Ambient expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.functions.statistics import md5_order, quantile
from screenspark.model import CountMatrix
from screenspark.spec import ScreenSpec

FLOOR = 1e-10


def global_profile(m: CountMatrix) -> DataFrame:
    """(gene_name, ambient): mean of each gene over all cells, the empty ones too."""
    sums = m.x.groupBy("gene_name").agg(F.sum(F.col("value").cast("double")).alias("s"))
    return sums.crossJoin(F.broadcast(m.n_cells())).select("gene_name", (F.col("s") / F.col("n_cells")).alias("ambient"))


def empty_droplet_profile(raw: CountMatrix, cells: DataFrame, seed: int = 42, most: int = 10_000) -> DataFrame:
    """Mean over at most ``most`` droplets of ``raw`` that are no cells, in an
    order fixed by the seed."""
    empty = raw.obs.select("cell_id").join(cells.select("cell_id"), "cell_id", "left_anti")
    chosen = empty.orderBy(md5_order(seed, "cell_id"), "cell_id").limit(most)
    return global_profile(raw.keep_cells(chosen))


def ambient_scores(m: CountMatrix, profile: DataFrame) -> DataFrame:
    """(cell_id, ambient_score): cosine of each cell with the profile, over the
    genes of both; 0 where either has no length."""
    common = profile.join(m.var.select("gene_name"), "gene_name", "left_semi")
    length = common.agg(F.sqrt(F.sum(F.col("ambient") * F.col("ambient"))).alias("length"))
    v = F.col("value").cast("double")
    sums = m.x.join(common, "gene_name").groupBy("cell_id").agg(F.sum(v * F.col("ambient")).alias("dot"), F.sqrt(F.sum(v * v)).alias("norm"))
    scored = m.obs.select("cell_id").join(sums, "cell_id", "left").crossJoin(F.broadcast(length))
    score = F.when(F.col("length") < FLOOR, 0.0).otherwise(F.col("dot") / (F.greatest("norm", F.lit(FLOOR)) * F.col("length")))
    return scored.select("cell_id", F.coalesce(score, F.lit(0.0)).alias("ambient_score"))


def flag_ambient(metrics: DataFrame, scores: DataFrame, spec: ScreenSpec) -> DataFrame:
    """Metrics with ambient_score and ambient_flagged; flagged rows go only if
    the configuration says so."""
    bound = quantile(metrics, "total_counts", spec.min_umi_percentile, "bound")
    out = metrics.join(scores, "cell_id").crossJoin(F.broadcast(bound))
    out = out.withColumn("ambient_flagged", (F.col("ambient_score") > spec.flag_threshold) & (F.col("total_counts") <= F.col("bound"))).drop("bound")
    return out.filter("NOT ambient_flagged") if spec.remove_flagged else out
