"""Tables behind the reports: drops, histograms, attrition, verdicts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from screenspark.functions.statistics import average_ranks, cumulative
from screenspark.operators.neighbours import nearest
from screenspark.sources.storage import settled


def density(values: DataFrame, column: str, points: int = 512, adjust: float = 1.0, cut: float = 3.0) -> DataFrame:
    """(x, density): a Gaussian kernel estimate of a column on a grid of so many points.

    The bandwidth is Scott's, n^(-1/5) sample deviations, times ``adjust``; the grid goes
    ``cut`` bandwidths beyond the values (0 for a violin).  Values are counted by grid point,
    in shares of the two that they lie between, so one pass makes at most ``points`` rows;
    these are spread over the grid by the kernel, up to six bandwidths.  Missing values count
    for nothing; fewer than two different values have no density.
    """
    v = F.col("_v")
    rows = values.select(F.col(column).cast("double").alias("_v")).filter(v.isNotNull() & ~F.isnan(v))
    ends = rows.agg(F.count("*").alias("_n"), F.stddev_samp(v).alias("_s"), F.min(v).alias("_min"), F.max(v).alias("_max")).filter("_s > 0")
    ends = ends.withColumn("_bw", F.col("_s") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)) * adjust)
    ends = ends.withColumn("_low", F.col("_min") - cut * F.col("_bw")).withColumn("_step", (F.col("_max") + cut * F.col("_bw") - F.col("_low")) / (points - 1))
    place = rows.crossJoin(F.broadcast(ends.select("_low", "_step"))).select(((v - F.col("_low")) / F.col("_step")).alias("_p"))  # one row
    place = place.withColumn("_i", F.least(F.floor("_p"), F.lit(points - 2)).cast("int"))
    shares = F.explode(F.array(F.struct(F.col("_i").alias("i"), (1 - (F.col("_p") - F.col("_i"))).alias("w")), F.struct((F.col("_i") + 1).alias("i"), (F.col("_p") - F.col("_i")).alias("w"))))
    bins = place.select(shares.alias("_b")).groupBy(F.col("_b.i").alias("i")).agg(F.sum("_b.w").alias("w")).crossJoin(F.broadcast(ends))  # one row
    reach = F.ceil(6 * F.col("_bw") / F.col("_step")).cast("int")
    spread = bins.select("i", "w", "_n", "_bw", "_low", "_step", F.explode(F.sequence(F.greatest(F.lit(0), F.col("i") - reach), F.least(F.lit(points - 1), F.col("i") + reach))).alias("g"))
    kernel = F.exp(-0.5 * F.pow((F.col("g") - F.col("i")) * F.col("_step") / F.col("_bw"), F.lit(2.0))) / (F.col("_n") * F.col("_bw") * float(np.sqrt(2 * np.pi)))
    spread = spread.groupBy("g", "_low", "_step").agg(F.sum(F.col("w") * kernel).alias("density"))
    grid = ends.select("_low", "_step", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("g"))
    out = grid.join(spread.select("g", "density"), "g", "left")
    return out.select((F.col("_low") + F.col("g") * F.col("_step")).alias("x"), F.coalesce("density", F.lit(0.0)).alias("density"))


def density_2d(values: DataFrame, x: str, y: str, points: int = 320, adjust: float = 1.0, cut: float = 3.0) -> DataFrame:
    """(x, y, density) on a grid of points x points: as ``density``, with the covariance of
    both columns and n^(-1/6).

    Rows are counted by grid point, in shares of the four around them; the grid, at most
    ``points`` squared rows, is folded with the kernel in one task.  Rows that miss a value
    count for nothing; values on a line have no density.
    """
    a, b = F.col("_x"), F.col("_y")
    rows = values.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).filter(a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b))
    one = rows.agg(F.count("*").alias("n"), F.var_samp(a).alias("xx"), F.var_samp(b).alias("yy"), F.covar_samp(a, b).alias("xy"), F.min(a), F.max(a), F.min(b), F.max(b)).first()
    schema = "x double, y double, density double"
    if one.n < 3 or not one.xx * one.yy - one.xy**2 > 1e-12 * one.xx * one.yy:
        return values.sparkSession.createDataFrame([], schema)
    scale = one.n ** (-1 / 6) * adjust
    cov = np.array([[one.xx, one.xy], [one.xy, one.yy]]) * scale**2
    low = np.array([one[4] - cut * cov[0, 0] ** 0.5, one[6] - cut * cov[1, 1] ** 0.5])
    step = (np.array([one[5] + cut * cov[0, 0] ** 0.5, one[7] + cut * cov[1, 1] ** 0.5]) - low) / (points - 1)
    place = rows.select(*(((c - float(low[k])) / float(step[k])).alias(f"p{k}") for k, c in enumerate((a, b))))
    place = place.withColumns({f"i{k}": F.least(F.floor(f"p{k}"), F.lit(points - 2)) for k in range(2)})
    share = lambda k, up: (F.col(f"p{k}") - F.col(f"i{k}")) if up else (1 - F.col(f"p{k}") + F.col(f"i{k}"))
    corners = F.explode(F.array(*(F.struct((F.col("i0") + u).alias("i"), (F.col("i1") + v).alias("j"), (share(0, u) * share(1, v)).alias("w")) for u in (0, 1) for v in (0, 1))))
    bins = place.select(corners.alias("c")).groupBy(F.col("c.i").alias("i"), F.col("c.j").alias("j")).agg(F.sum("c.w").alias("w"))
    n = one.n

    def fold(batches):
        grid = np.zeros((points, points))
        for batch in batches:
            grid[batch["i"].to_numpy(), batch["j"].to_numpy()] += batch["w"].to_numpy()
        off = np.arange(-points + 1, points)
        dx, dy = np.meshgrid(off * step[0], off * step[1], indexing="ij")
        inverse = np.linalg.inv(cov)
        kernel = np.exp(-0.5 * (inverse[0, 0] * dx * dx + 2 * inverse[0, 1] * dx * dy + inverse[1, 1] * dy * dy)) / (2 * np.pi * np.linalg.det(cov) ** 0.5 * n)
        size = (3 * points,) * 2
        whole = np.fft.irfft2(np.fft.rfft2(grid, size) * np.fft.rfft2(kernel, size), size)[points - 1 : 2 * points - 1, points - 1 : 2 * points - 1]
        i, j = np.indices(whole.shape)
        yield pd.DataFrame({"x": (low[0] + i * step[0]).ravel(), "y": (low[1] + j * step[1]).ravel(), "density": np.maximum(whole, 0).ravel()})

    return bins.coalesce(1).mapInPandas(fold, schema)


def front_distances(points: DataFrame, front: DataFrame, x: str, y: str, score: str, key: str = "point") -> DataFrame:
    """(key, distance, marker_size, score_rank): how far each point is from the nearest of
    ``front`` (keys), with x and y scaled to 0..1; 1 if there is no front.

    ``score_rank`` is the mean rank of the score from 0 to 1, null for a single point.  The
    nearest is searched exactly (``neighbours.nearest``), not among all pairs.
    """
    ends = points.agg(*(f(c).alias(f"_{n}_{k}") for k, c in enumerate((x, y)) for n, f in (("low", F.min), ("high", F.max))), F.count("*").alias("_n"))
    unit = [(F.col(c) - F.col(f"_low_{k}")) / (F.col(f"_high_{k}") - F.col(f"_low_{k}") + 1e-9) for k, c in enumerate((x, y))]
    placed = settled(points.crossJoin(F.broadcast(ends)).select(key, score, "_n", F.array(*unit).alias("v")).withColumn("cell_id", F.monotonically_increasing_id()))  # one row
    near = nearest(placed, placed.join(front.select(key).distinct(), key, "left_semi"), 1).select("cell_id", "distance")
    out = average_ranks(placed, score, name="_r").join(near, "cell_id", "left").withColumn("distance", F.coalesce("distance", F.lit(1.0)))
    rank = F.try_divide(F.col("_r") - 1, F.col("_n") - 1)
    return out.select(key, "distance", (20 + 160 * F.exp(-4 * F.col("distance"))).alias("marker_size"), rank.alias("score_rank"))


def step_drops(waterfall: DataFrame, count: str = "n_cells") -> DataFrame:
    """A waterfall (step, name, count) with what each step drops, and its share."""
    before = F.lag(count).over(W.orderBy("step"))
    out = waterfall.withColumn("dropped", F.coalesce(before - F.col(count), F.lit(0)))
    return out.withColumn("pct_dropped", F.coalesce(F.try_divide(100.0 * F.col("dropped"), before), F.lit(0.0)))


def ecdf(values: DataFrame, column: str) -> DataFrame:
    """(value, share) at each distinct value: the share of rows at or below it."""
    return cumulative(values.select(F.col(column).alias("value")), "value").select("value", (F.col("_upto") / F.col("_total")).alias("share"))


def log_histogram(values: DataFrame, column: str, low: float, high: float, bins: int = 50) -> DataFrame:
    """(bin, n) over equal steps of the logarithm; the last bin holds its end."""
    width = (high - low) / bins
    at = F.least(F.floor((F.log10(column) - low) / width), F.lit(bins - 1)).cast("bigint")
    return values.filter((F.col(column) > 0) & (F.log10(column) >= low) & (F.log10(column) <= high)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def bin_of(column: str, low: float, high: float, bins: int) -> Column:
    return F.least(F.floor((F.col(column) - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("bigint")


def histogram_2d(values: DataFrame, x: str, y: str, x_range: tuple[float, float], y_range: tuple[float, float], bins: int = 100) -> DataFrame:
    """(x_bin, y_bin, n) of the rows inside both ranges."""
    inside = values.filter(F.col(x).between(*x_range) & F.col(y).between(*y_range))
    return inside.groupBy(bin_of(x, *x_range, bins).alias("x_bin"), bin_of(y, *y_range, bins).alias("y_bin")).agg(F.count("*").alias("n"))


def attrition(stages: DataFrame) -> DataFrame:
    """(step, name, n_cells, n_genes) with shares of the start and of the most genes."""
    w = W.partitionBy()
    start = F.min_by("n_cells", "step").over(w)
    return stages.withColumn("pct_of_start", F.try_divide(100.0 * F.col("n_cells"), start)).withColumn("pct_of_max_genes", F.try_divide(100.0 * F.col("n_genes"), F.max("n_genes").over(w)))


def stage_counts(stages: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(step, name, n_cells, n_genes) of named (obs, var) pairs, in their order."""
    out = None
    for i, (name, (obs, var)) in enumerate(stages.items()):
        row = obs.agg(F.count("*").alias("n_cells")).crossJoin(var.agg(F.count("*").alias("n_genes"))).select(F.lit(i).alias("step"), F.lit(name).alias("name"), "n_cells", "n_genes")
        out = row if out is None else out.unionByName(row)
    return out


def batch_summary(obs: DataFrame, column: str = "batch") -> DataFrame:
    """(n_batches, smallest, largest, mean) of the batches' sizes."""
    sizes = obs.groupBy(column).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("n_batches"), F.min("n").alias("smallest"), F.max("n").alias("largest"), F.avg("n").alias("mean"))


def score_summary(scores: DataFrame, score: str, flag: str) -> DataFrame:
    """Doublet and ambient reports: counts, mean, and the least score that is flagged."""
    return scores.agg(F.count("*").alias("n"), F.count_if(flag).alias("n_flagged"), F.avg(score).alias("mean"), F.min(F.when(F.col(flag), F.col(score))).alias("threshold"))


def efficiency_summary(stats: DataFrame) -> DataFrame:
    """Escaper report: perturbations, median efficiency, how many are low, cells escaped."""
    return stats.agg(F.count("*").alias("n_perturbations"), F.median("efficiency").alias("median_efficiency"), F.count_if("low_efficiency").alias("n_low"), F.sum("n_escaped").alias("n_escaped"))


def driver_shift(deltas: DataFrame, components: DataFrame, k: int = 5) -> DataFrame:
    """(pc, i, mean_pre, mean_post, shift) of the top loadings (pc, i, loading)."""
    rank = F.row_number().over(W.partitionBy("pc").orderBy(F.desc(F.abs("loading")), "i"))
    top = components.withColumn("rank", rank).filter(F.col("rank") <= k)
    values = deltas.select(F.posexplode(F.arrays_zip("pre", "delta")).alias("i", "x")).groupBy("i").agg(F.avg("x.pre").alias("mean_pre"), F.avg("x.delta").alias("mean_post"))
    return F.broadcast(top).join(values, "i").select("pc", "i", "mean_pre", "mean_post", (F.col("mean_post") - F.col("mean_pre")).alias("shift"))


def disruption_verdict(disruption: str) -> Column:
    """Bands of rank disruption."""
    return F.when(F.col(disruption) > 0.15, "STRONG").when(F.col(disruption) > 0.08, "MODERATE").otherwise("WEAK")


def run_verdict(n_warnings: int) -> str:
    return "CLEAN RUN" if n_warnings == 0 else "MINOR WARNINGS" if n_warnings <= 3 else "REVIEW NEEDED"
