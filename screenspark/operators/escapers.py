"""Cells that escaped their perturbation, and its efficiency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenspark.functions.statistics import sparse_percentile
from screenspark.model import CountMatrix
from screenspark.spec import ScreenSpec


def target_genes(separator: str | None) -> Column:
    """The genes that a label names."""
    if separator is None:
        return F.array("pert")
    quoted = "concat('\\\\Q', '" + separator.replace("'", "''") + "', '\\\\E')"
    return F.expr(f"filter(transform(split(pert, {quoted}), p -> trim(p)), p -> p <> '')")


def alias_map(var: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """(alias, gene_name): a gene's name, and the string columns that hold other ids;
    an alias of several genes means the name first, then the later column."""
    ranked = [var.select(F.col("gene_name").alias("alias"), "gene_name", F.lit(len(columns)).alias("rank"))]
    ranked += [var.select(F.col(c).alias("alias"), "gene_name", F.lit(i).alias("rank")) for i, c in enumerate(columns)]
    every = ranked[0]
    for r in ranked[1:]:
        every = every.unionByName(r)
    return every.filter("alias IS NOT NULL").groupBy("alias").agg(F.max_by("gene_name", F.struct("rank", "gene_name")).alias("gene_name"))


def targets(m: CountMatrix, spec: ScreenSpec, separator: str | None = None, aliases: DataFrame | None = None) -> DataFrame:
    """(pert, gene_name): the genes of the matrix that each perturbation targets."""
    labels = m.obs.select("pert").filter(F.col("pert") != spec.control_label).distinct()
    named = labels.select("pert", F.explode(target_genes(separator)).alias("alias"))
    return named.join(alias_map(m.var) if aliases is None else aliases, "alias").select("pert", "gene_name").distinct()


def control_percentiles(m: CountMatrix, genes: DataFrame, spec: ScreenSpec) -> DataFrame:
    """(gene_name, threshold) over the control cells; activation looks from above."""
    control = m.obs.filter(F.col("pert") == spec.control_label)
    x = m.x.join(control.select("cell_id"), "cell_id", "left_semi").join(genes.select("gene_name").distinct(), "gene_name", "left_semi")
    q = spec.escaper_percentile / 100
    out = sparse_percentile(x, genes, control.agg(F.count("*").alias("n_cells")), 1 - q if spec.activates() else q)
    if spec.activates():
        out = out.withColumn("threshold", F.when(F.col("threshold") == 0, 1e-5).otherwise(F.col("threshold")))
    return out


def judged_cells(m: CountMatrix, spec: ScreenSpec, separator: str | None = None) -> DataFrame:
    """Obs with n_genes_checked and ``kept``: whether all target genes that are in the
    matrix are where the perturbation should have brought them."""
    want = targets(m, spec, separator)
    limits = want.join(control_percentiles(m, want, spec), "gene_name")
    cells = m.obs.select("cell_id", "pert").join(limits, "pert").join(m.x, ["cell_id", "gene_name"], "left")
    value = F.coalesce(F.col("value").cast("double"), F.lit(0.0))
    passes = value >= F.col("threshold") if spec.activates() else value <= F.col("threshold")
    verdict = cells.groupBy("cell_id").agg(F.bool_and(passes).alias("kept"), F.count("*").alias("n_genes_checked"))
    out = m.obs.join(verdict, "cell_id", "left")
    return out.withColumn("kept", F.coalesce("kept", F.lit(True))).fillna(0, ["n_genes_checked"])


def knockdown_depth(m: CountMatrix, spec: ScreenSpec, separator: str | None = None) -> DataFrame:
    """(pert, depth): mean over targets of perturbed over control mean, of all
    cells; targets that controls don't express say nothing."""
    want = targets(m, spec, separator)
    sizes = m.obs.groupBy("pert").agg(F.count("*").alias("size"))
    wanted_x = m.x.join(want.select("gene_name").distinct(), "gene_name", "left_semi")
    sums = wanted_x.join(m.obs.select("cell_id", "pert"), "cell_id").groupBy("pert", "gene_name").agg(F.sum(F.col("value").cast("double")).alias("s"))
    own = want.join(sums, ["pert", "gene_name"], "left").join(sizes, "pert").select("pert", "gene_name", (F.coalesce("s", F.lit(0.0)) / F.col("size")).alias("mean"))
    control = sums.filter(F.col("pert") == spec.control_label).join(sizes, "pert").select("gene_name", (F.col("s") / F.col("size")).alias("control_mean"))
    ratio = F.when(F.col("control_mean") > 1e-10, F.col("mean") / F.col("control_mean"))
    return own.join(control, "gene_name", "left").groupBy("pert").agg(F.avg(ratio).alias("depth"))


def escaper_stats(m: CountMatrix, spec: ScreenSpec, separator: str | None = None) -> DataFrame:
    """One row per perturbation: counts, efficiency, depth and status."""
    judged = judged_cells(m, spec, separator).filter(F.col("pert") != spec.control_label)
    rows = judged.groupBy("pert").agg(F.count("*").alias("n_total"), F.count_if(~F.col("kept")).alias("n_escaped"), F.count_if("kept").alias("n_kept"), F.max("n_genes_checked").alias("n_genes_checked"))
    rows = rows.withColumn("efficiency", F.col("n_kept") / F.greatest("n_total", F.lit(1)))
    rows = rows.withColumn("low_efficiency", F.col("efficiency") < spec.efficiency_threshold)
    status = F.when(F.col("n_genes_checked") == 0, "bypassed").otherwise("filtered")
    return rows.withColumn("status", status).join(knockdown_depth(m, spec, separator), "pert", "left")


def efficiency_per_cell(obs: DataFrame, stats: DataFrame, spec: ScreenSpec) -> DataFrame:
    """Obs with its perturbation's efficiency and depth; controls have 1 and none."""
    small = stats.select("pert", "efficiency", "depth")
    out = obs.join(small, "pert", "left")
    control = F.col("pert") == spec.control_label
    return out.withColumn("efficiency", F.when(control, 1.0).otherwise(F.coalesce("efficiency", F.lit(1.0)))).withColumn("depth", F.when(control, F.lit(None)).otherwise(F.col("depth")))


def group_sizes(obs: DataFrame, column: str = "pert") -> DataFrame:
    """A10."""
    return obs.groupBy(column).agg(F.count("*").alias("n_cells"))


def drop_undersized(obs: DataFrame, spec: ScreenSpec) -> DataFrame:
    """Without perturbations of too few cells; controls always stay."""
    small = group_sizes(obs).filter((F.col("n_cells") < spec.min_cells_per_perturbation) & (F.col("pert") != spec.control_label))
    return obs.join(small, "pert", "left_anti")


def filter_escapers(m: CountMatrix, spec: ScreenSpec, separator: str | None = None) -> CountMatrix:
    """The whole stage: escapers go, then perturbations that are left too small."""
    return m.keep_cells(drop_undersized(judged_cells(m, spec, separator).filter("kept"), spec))
