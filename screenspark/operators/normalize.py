"""Library-size normalisation, log and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.functions.statistics import quantile
from screenspark.model import CountMatrix
from screenspark.sources.storage import settled
from screenspark.spec import ScreenSpec


def library_sizes(m: CountMatrix) -> DataFrame:
    return m.x.groupBy("cell_id").agg(F.sum(F.col("value").cast("double")).alias("total"))


def _median(sizes: DataFrame, by: str) -> DataFrame:
    return quantile(sizes.filter("total > 0"), "total", 0.5, "median_size", by)


def median_size(m: CountMatrix, by: str = "split") -> DataFrame:
    """(split, median_size) of the cells that have any counts."""
    return _median(m.obs.select("cell_id", by).join(library_sizes(m), "cell_id"), by)


def normalise(m: CountMatrix, spec: ScreenSpec, by: str = "split") -> CountMatrix:
    """Each cell scaled to the target, by default the median of its split, then
    log(1 + v); cells without counts stay as they are.  The sizes are summed up once."""
    sizes = library_sizes(m)
    if spec.target_sum is None:
        sizes = settled(sizes.join(m.obs.select("cell_id", by), "cell_id"))
        goal = sizes.join(F.broadcast(_median(sizes, by)), by).select("cell_id", "total", F.col("median_size").alias("target"))
    else:
        goal = sizes.withColumn("target", F.lit(float(spec.target_sum)))
    factor = F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(1.0)
    value = F.col("value").cast("double") * factor
    x = m.x.join(goal, "cell_id").select("cell_id", "gene_name", (F.log1p(value) if spec.log else value).alias("value"))
    return CountMatrix(m.obs, m.var, x)


def gene_std(m: CountMatrix) -> DataFrame:
    """(gene_name, std) over all cells, of the population; next to nothing counts as 1."""
    v = F.col("value").cast("double")
    sums = m.x.groupBy("gene_name").agg(F.sum(v).alias("s"), F.sum(v * v).alias("s2"))
    out = m.var.select("gene_name").join(sums, "gene_name", "left").fillna(0.0, ["s", "s2"]).crossJoin(F.broadcast(m.n_cells()))
    mean = F.col("s") / F.col("n_cells")
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("s2") / F.col("n_cells") - mean * mean))
    return out.select("gene_name", F.when(std < 1e-10, 1.0).otherwise(std).alias("std"))


def scale(m: CountMatrix, spec: ScreenSpec) -> CountMatrix:
    """Divided by the gene's deviation and clipped, never centred, so zeros stay."""
    x = m.x.join(gene_std(m), "gene_name")
    value = F.least(F.greatest(F.col("value").cast("double") / F.col("std"), F.lit(0.0)), F.lit(spec.clip))
    return CountMatrix(m.obs, m.var, x.select("cell_id", "gene_name", value.alias("value")))


def value_summary(m: CountMatrix, by: str = "split") -> DataFrame:
    """(split, mean_nonzero, max_nonzero) of the stored entries."""
    rows = m.x.filter("value <> 0").join(m.obs.select("cell_id", by), "cell_id")
    return rows.groupBy(by).agg(F.avg(F.col("value").cast("double")).alias("mean_nonzero"), F.max(F.col("value").cast("double")).alias("max_nonzero"))
