"""Zero-shot splits, stratified by effect size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from screenspark.functions.statistics import md5_order, rank_by
from screenspark.model import CountMatrix
from screenspark.spec import ScreenSpec


def mean_shift(m: CountMatrix, spec: ScreenSpec) -> DataFrame:
    """(pert, shift): sum over all genes of the distance of a perturbation's mean from
    the control mean.

    Where a perturbation has no entry of a gene its distance is the control mean itself,
    so it's enough to know the control's total and what its entries change about it.
    """
    sizes = m.obs.groupBy("pert").agg(F.count("*").alias("size"))
    sums = m.x.join(m.obs.select("cell_id", "pert"), "cell_id").groupBy("pert", "gene_name").agg(F.sum(F.col("value").cast("double")).alias("s"))
    means = sums.join(sizes, "pert").select("pert", "gene_name", (F.col("s") / F.col("size")).alias("mean"))
    control = means.filter(F.col("pert") == spec.control_label).select("gene_name", F.col("mean").alias("control_mean"))
    total = control.agg(F.coalesce(F.sum(F.abs("control_mean")), F.lit(0.0)).alias("total"))
    own = means.filter(F.col("pert") != spec.control_label).join(control, "gene_name", "left").fillna(0.0, ["control_mean"])
    changed = own.groupBy("pert").agg(F.sum(F.abs(F.col("mean") - F.col("control_mean")) - F.abs("control_mean")).alias("change"))
    labels = sizes.filter(F.col("pert") != spec.control_label).select("pert")
    out = labels.join(changed, "pert", "left").crossJoin(F.broadcast(total))
    return out.select("pert", (F.col("total") + F.coalesce("change", F.lit(0.0))).alias("shift"))


def effect_bins(shifts: DataFrame, spec: ScreenSpec) -> DataFrame:
    """Shifts with ``bin``: between linear quantiles, right-closed, equal edges merged.

    The number of inner edges below a score is its bin; with all scores equal that is 0.
    """
    inner = [i / spec.bins for i in range(spec.bins + 1)]
    edges = shifts.agg(F.array_distinct(F.percentile("shift", F.array(*[F.lit(q) for q in inner]))).alias("edges"))
    edges = edges.select(F.expr("if(size(edges) > 2, slice(edges, 2, size(edges) - 2), cast(array() as array<double>))").alias("edges"))
    return shifts.crossJoin(F.broadcast(edges)).withColumn("bin", F.expr("size(filter(edges, e -> e < shift))")).drop("edges")


def split_labels(binned: DataFrame, spec: ScreenSpec, seed: int | None = None) -> DataFrame:
    """Binned with ``split``: in each bin, in a seeded order, a share is test, then
    a share of the rest is validation."""
    seed = spec.seed if seed is None else seed
    ordered = binned.withColumn("rank", F.row_number().over(W.partitionBy("bin").orderBy(md5_order(seed, "pert"), "pert")))
    n = F.count("*").over(W.partitionBy("bin"))
    sized = ordered.withColumn("n", n)
    sized = sized.withColumn("n_test", F.when(F.col("n") > 3, F.greatest(F.lit(1), F.floor(F.col("n") * spec.test_ratio))).otherwise(F.lit(1)))
    sized = sized.withColumn("rest", F.col("n") - F.col("n_test"))
    sized = sized.withColumn("n_val", F.when(F.col("rest") > 2, F.greatest(F.lit(1), F.floor(F.col("rest") * spec.val_ratio))).otherwise(F.lit(1)))
    split = F.when(F.col("rank") <= F.col("n_test"), "test").when(F.col("rank") <= F.col("n_test") + F.col("n_val"), "val").otherwise("train")
    return sized.withColumn("split", split).select(*binned.columns, "split")


def split_controls(obs: DataFrame, labels: DataFrame, spec: ScreenSpec, seed: int | None = None) -> DataFrame:
    """(cell_id, split) of the control cells, in the proportions of the labels.

    The one large group isn't sorted in one place.
    """
    seed = spec.seed if seed is None else seed
    cells = obs.filter(F.col("pert") == spec.control_label).select("cell_id")
    ranked = rank_by(cells, md5_order(seed, "cell_id"), "cell_id")
    shares = labels.agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t"), F.count_if(F.col("split") == "val").alias("v"))
    total = cells.agg(F.count("*").alias("cells"))
    bounds = shares.crossJoin(total).select(F.floor(F.col("cells") * F.col("t") / F.col("n")).alias("test"), F.floor(F.col("cells") * F.col("v") / F.col("n")).alias("val"))
    out = ranked.crossJoin(F.broadcast(bounds))
    return out.select("cell_id", F.when(F.col("rank") <= F.col("test"), "test").when(F.col("rank") <= F.col("test") + F.col("val"), "val").otherwise("train").alias("split"))


def zero_shot(m: CountMatrix, spec: ScreenSpec, seed: int | None = None) -> DataFrame:
    """Obs with ``split``: no perturbation is in two splits, controls are in all."""
    labels = split_labels(effect_bins(mean_shift(m, spec), spec), spec, seed)
    cells = m.obs.filter(F.col("pert") != spec.control_label).join(F.broadcast(labels.select("pert", "split")), "pert").select("cell_id", "split")
    return m.obs.join(cells.unionByName(split_controls(m.obs, labels, spec, seed)), "cell_id")


def cell_wise(obs: DataFrame, spec: ScreenSpec, seed: int | None = None) -> DataFrame:
    """Obs with ``split`` drawn cell by cell, the shares by a hash of each cell."""
    seed = spec.seed if seed is None else seed
    u = F.conv(F.substring(md5_order(seed, "cell_id"), 1, 8), 16, 10).cast("double") / float(1 << 32)
    val = spec.test_ratio + (1 - spec.test_ratio) * spec.val_ratio
    return obs.withColumn("split", F.when(u < spec.test_ratio, "test").when(u < val, "val").otherwise("train"))


def split_summary(obs: DataFrame, spec: ScreenSpec) -> DataFrame:
    """(split, n_cells, n_targets, pct_cells)."""
    rows = obs.groupBy("split").agg(F.count("*").alias("n_cells"), F.count_distinct(F.when(F.col("pert") != spec.control_label, F.col("pert"))).alias("n_targets"))
    return rows.withColumn("pct_cells", 100.0 * F.col("n_cells") / F.sum("n_cells").over(W.partitionBy()))


def leakage(obs: DataFrame, spec: ScreenSpec) -> DataFrame:
    """(split_a, split_b, n_shared) for each two splits; all must be 0."""
    labels = obs.filter(F.col("pert") != spec.control_label).select("pert", "split").distinct()
    pairs = labels.select("split").distinct()
    pairs = pairs.select(F.col("split").alias("split_a")).crossJoin(pairs.select(F.col("split").alias("split_b"))).filter("split_a < split_b")
    both = labels.select("pert", F.col("split").alias("split_a")).join(labels.select("pert", F.col("split").alias("split_b")), "pert")
    shared = both.filter("split_a < split_b").groupBy("split_a", "split_b").agg(F.count("*").alias("n_shared"))
    return pairs.join(shared, ["split_a", "split_b"], "left").fillna(0, ["n_shared"])
