"""Gene triage with rescues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.model import CountMatrix
from screenspark.operators.qc import counts_per_gene
from screenspark.spec import ScreenSpec

# Marker genes of the cell cycle (Tirosh et al. 2016).
S_PHASE = (
    "MCM5", "PCNA", "TYMS", "FEN1", "MCM2", "MCM4", "RRM1", "UNG", "GINS2", "MCM6", "CDCA7", "DTL", "PRIM1", "UHRF1", "MLF1IP", "HELLS", "RFC2", "RPA2", "NASP",
    "RAD51AP1", "GMNN", "WDR76", "SLBP", "CCNE2", "UBR7", "POLD3", "MSH2", "ATAD2", "RAD51", "RRM2", "CDC45", "CDC6", "EXO1", "TIPIN", "DSCC1", "BLM", "CASP8AP2",
    "USP1", "CLSPN", "POLA1", "CHAF1B", "BRIP1", "E2F8",
)
G2M_PHASE = (
    "HMGB2", "CDK1", "NUSAP1", "UBE2C", "BIRC5", "TPX2", "TOP2A", "NDC80", "CKS2", "NUF2", "CKS1B", "MKI67", "TMPO", "CENPF", "TACC3", "FAM64A", "SMC4", "CCNB2",
    "CKAP2L", "CKAP2", "AURKB", "BUB1", "KIF11", "ANP32E", "TUBB4B", "GTSE1", "KIF20B", "HJURP", "CDCA3", "HN1", "CDC20", "TTK", "CDC25C", "KIF2C", "RANGAP1", "NCAPD2",
    "DLGAP5", "CDCA2", "CDCA8", "ECT2", "KIF23", "HMMR", "AURKA", "PSRC1", "ANLN", "LBR", "CKAP5", "CENPE", "CTCF", "NEK2", "G2E3", "GAS2L3", "CBX5", "CENPA",
)


def triage(m: CountMatrix, spec: ScreenSpec, target_names: DataFrame | None = None, cycle: tuple[str, ...] = (*S_PHASE, *G2M_PHASE)) -> DataFrame:
    """Every gene with its counts, ``removed_rare``, ``removed_low``, its rescues
    and ``kept``.

    Rare: in fewer cells than ``min_cells_expressing``.  Low: in fewer than the larger of
    that and ``cell_share`` of all cells, and of a mean below ``mean_umi``.  Targets of
    perturbations and genes of the cell cycle, whatever their case, are never removed.
    """
    stats = counts_per_gene(m)
    least = F.greatest(F.lit(spec.min_cells_expressing), F.floor(F.col("n_cells") * spec.cell_share))
    stats = stats.withColumn("removed_rare", F.col("n_cells_expr") < spec.min_cells_expressing)
    stats = stats.withColumn("removed_low", (F.col("n_cells_expr") < least) & (F.col("mean") < spec.mean_umi))
    if target_names is not None:
        marked = target_names.select("gene_name").distinct().withColumn("is_target", F.lit(True))
        stats = stats.join(marked, "gene_name", "left").withColumn("is_target", F.coalesce("is_target", F.lit(False)))
    else:
        stats = stats.withColumn("is_target", F.lit(False))
    stats = stats.withColumn("is_cycle", F.upper("gene_name").isin(*cycle))
    return stats.withColumn("kept", ~(F.col("removed_rare") | F.col("removed_low")) | F.col("is_target") | F.col("is_cycle"))


def gene_waterfall(triaged: DataFrame) -> DataFrame:
    """(step, name, n_genes): start, after the floor on cells, before and after rescue."""
    row = triaged.agg(
        F.count("*").alias("c0"), F.count_if(~F.col("removed_rare")).alias("c1"),
        F.count_if(~(F.col("removed_rare") | F.col("removed_low"))).alias("c2"), F.count_if("kept").alias("c3"),
    )
    return row.selectExpr("stack(4, 0, 'start', c0, 1, 'after_floor', c1, 2, 'pre_rescue', c2, 3, 'post_rescue', c3) AS (step, name, n_genes)")


def penetrance_boost(triaged: DataFrame) -> DataFrame:
    """Sparsity before and after, from penetrance alone."""
    mean = lambda c: F.avg(c) / 100
    return triaged.agg((1 - mean("penetrance")).alias("sparsity_before"), (1 - mean(F.when(F.col("kept"), F.col("penetrance")))).alias("sparsity_after"))


def triage_genes(m: CountMatrix, spec: ScreenSpec, target_names: DataFrame | None = None) -> CountMatrix:
    return m.keep_genes(triage(m, spec, target_names).filter("kept"))
