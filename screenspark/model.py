"""The data model: a sparse observations x features matrix with labels on both sides."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CountMatrix:
    """``obs`` (cell_id, labels), ``var`` (gene_name, annotations) and the stored entries
    ``x`` (cell_id, gene_name, value).  An entry that isn't stored is a zero: every
    statistic over cells counts the cells of ``obs``, not the rows of ``x``."""

    obs: DataFrame
    var: DataFrame
    x: DataFrame

    def keep_cells(self, cells: DataFrame) -> CountMatrix:
        """The rows of the cells in ``cells``, in all tables."""
        keep = cells.select("cell_id")
        return replace(self, obs=self.obs.join(keep, "cell_id", "left_semi"), x=self.x.join(keep, "cell_id", "left_semi"))

    def keep_genes(self, genes: DataFrame) -> CountMatrix:
        """The columns of the genes in ``genes``; names stay as they are."""
        keep = genes.select("gene_name")
        return replace(self, var=self.var.join(keep, "gene_name", "left_semi"), x=self.x.join(keep, "gene_name", "left_semi"))

    def subset(self, cells: DataFrame | None = None, genes: DataFrame | None = None) -> CountMatrix:
        """Both at once; None keeps all."""
        out = self if cells is None else self.keep_cells(cells)
        return out if genes is None else out.keep_genes(genes)

    def ensure_sparse(self) -> CountMatrix:
        """No stored zeros, so that stored entries are non-zero entries."""
        return replace(self, x=self.x.filter("value <> 0"))

    def n_cells(self) -> DataFrame:
        return self.obs.agg(F.count("*").alias("n_cells"))


def stacked(parts: list[CountMatrix]) -> CountMatrix:
    """Matrices of other cells, one below the other; features of any of them once."""
    first, *rest = parts
    for part in rest:
        first = CountMatrix(first.obs.unionByName(part.obs, True), first.var.unionByName(part.var, True).distinct(), first.x.unionByName(part.x))
    return first
