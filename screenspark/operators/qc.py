"""Cell triage: quality metrics, filters and their waterfall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenspark.model import CountMatrix
from screenspark.spec import ScreenSpec


def qc_metrics(m: CountMatrix, spec: ScreenSpec) -> DataFrame:
    """Obs with n_genes_by_counts, total_counts, total_counts_mt, pct_counts_mt.

    A cell without entries has zeros, and no percentage.
    """
    value = F.col("value").cast("double")
    per_cell = m.x.groupBy("cell_id").agg(
        F.count_if(F.col("value") != 0).alias("n_genes_by_counts"),
        F.sum(value).alias("total_counts"),
        F.sum(F.when(F.col("gene_name").startswith(spec.mt_prefix), value)).alias("total_counts_mt"),
    )
    out = m.obs.join(per_cell, "cell_id", "left").fillna(0, ["n_genes_by_counts", "total_counts", "total_counts_mt"])
    return out.withColumn("pct_counts_mt", F.try_divide(100 * F.col("total_counts_mt"), F.col("total_counts")))


def cell_filters(spec: ScreenSpec) -> list[tuple[str, Column]]:
    """The filters in their order; a missing percentage fails the first."""
    mt = F.lit(True) if spec.skip_mt else F.coalesce(F.col("pct_counts_mt") <= spec.mt_threshold * 100, F.lit(False))
    return [
        ("mt", mt),
        ("min_genes", F.col("n_genes_by_counts") >= spec.min_genes),
        ("max_genes", F.col("n_genes_by_counts") <= spec.max_genes),
        ("min_counts", F.col("total_counts") >= spec.min_counts),
        ("max_counts", F.col("total_counts") <= spec.max_counts),
    ]


def good_cells(metrics: DataFrame, spec: ScreenSpec) -> DataFrame:
    for _, passes in cell_filters(spec):
        metrics = metrics.filter(passes)
    return metrics


def cell_waterfall(metrics: DataFrame, spec: ScreenSpec) -> DataFrame:
    """(step, name, n_cells): survivors after each filter, counted in one pass."""
    so_far, counts = F.lit(True), [F.count("*").alias("c0")]
    names = ["start"]
    for name, passes in cell_filters(spec):
        so_far = so_far & passes
        counts.append(F.count_if(so_far).alias(f"c{len(names)}"))
        names.append(name)
    rows = ", ".join(f"{i}, '{n}', c{i}" for i, n in enumerate(names))
    return metrics.agg(*counts).selectExpr(f"stack({len(names)}, {rows}) AS (step, name, n_cells)")


def drop_ribosomal(var: DataFrame, spec: ScreenSpec) -> DataFrame:
    """Genes whose name begins, in capitals, with none of the prefixes."""
    for prefix in spec.ribosomal_prefixes:
        var = var.filter(~F.upper("gene_name").startswith(prefix.upper()))
    return var


def triage_cells(m: CountMatrix, spec: ScreenSpec) -> CountMatrix:
    """The filters on cells, then on genes; metrics stay as they were before."""
    kept = good_cells(qc_metrics(m, spec), spec)
    out = m.keep_cells(kept)
    return CountMatrix(kept, out.var, out.x).keep_genes(drop_ribosomal(m.var, spec))


def sparsity(m: CountMatrix) -> DataFrame:
    """One row of sizes: bytes are those of 4-byte values, dense and compressed."""
    nnz = m.x.agg(F.count_if(F.col("value") != 0).alias("nnz"))
    sizes = m.n_cells().crossJoin(m.var.agg(F.count("*").alias("n_genes"))).crossJoin(nnz)
    cells = F.col("n_cells") * F.col("n_genes")
    return sizes.select(
        "n_cells", "n_genes", "nnz", (1 - F.try_divide(F.col("nnz"), cells)).alias("sparsity"),
        (4 * cells).alias("dense_bytes"), (8 * F.col("nnz") + 4 * (F.col("n_cells") + 1)).alias("sparse_bytes"),
    )


def counts_per_gene(m: CountMatrix) -> DataFrame:
    """Cells, sum, mean over all cells and penetrance of each gene."""
    sums = m.x.groupBy("gene_name").agg(F.count_if(F.col("value") != 0).alias("n_cells_expr"), F.sum(F.col("value").cast("double")).alias("total"))
    out = m.var.join(sums, "gene_name", "left").fillna(0, ["n_cells_expr", "total"]).crossJoin(F.broadcast(m.n_cells()))
    return out.withColumn("mean", F.try_divide("total", "n_cells")).withColumn("penetrance", F.try_divide(100.0 * F.col("n_cells_expr"), F.col("n_cells")))
