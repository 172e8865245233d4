"""Statistics over sparse columns and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from screenspark.sources.storage import settled


def sparse_percentile(x: DataFrame, genes: DataFrame, n_cells: DataFrame, q: float) -> DataFrame:
    """(gene_name, threshold): linear percentile of each gene over all cells.

    The entries not stored are zeros.  Equal values are counted first, then ranges of
    values are accumulated for themselves, so that no gene's entries are gathered in one
    place, however many values it has.
    """
    stored = settled(x.filter("value <> 0").groupBy("gene_name", F.col("value").cast("double").alias("value")).agg(F.count("*").alias("_count")))
    nnz = stored.groupBy("gene_name").agg(F.sum("_count").alias("nnz"))
    names = genes.select("gene_name").distinct()
    zeros = (
        names.join(nnz, "gene_name", "left").crossJoin(F.broadcast(n_cells))
        .select("gene_name", F.lit(0.0).alias("value"), (F.col("n_cells") - F.coalesce("nnz", F.lit(0))).alias("_count"))
    )
    counts = zeros.unionByName(stored.join(names, "gene_name", "left_semi"))
    return _at_quantile(_accumulated(counts, "value", ("gene_name",)), "value", q, "threshold", ("gene_name",))


def average_ranks(rows: DataFrame, value: str, *by: str, name: str = "rank") -> DataFrame:
    """``rows`` with the rank of a value within its group, the mean of the ranks of ties.

    A null value has no rank.  Ranges of values are ranked for themselves, so that no group,
    nor the whole table, is sorted in one place.
    """
    at = cumulative(rows, value, *by).select(*by, value, ((2 * F.col("_upto") - F.col("_count") + 1) / 2).alias(name))
    return rows.join(at, [*by, value], "left")


def _offset(rows: DataFrame, weight: Column, by: tuple[str, ...]) -> DataFrame:
    """(by..., _bucket, _before, _all): what the buckets before hold, and all of them; a
    group has so few buckets that a window over them is small."""
    sizes = rows.groupBy(*by, "_bucket").agg(F.sum(weight).alias("_n"))
    w = W.partitionBy(*by)
    return sizes.select(*by, "_bucket", (F.sum("_n").over(w.orderBy("_bucket")) - F.col("_n")).alias("_before"), F.sum("_n").over(w).alias("_all"))


def _ranged(rows: DataFrame, column: str, by: tuple[str, ...], ranges: int = 128) -> DataFrame:
    """``rows`` with ``_bucket``: in which of some ranges of about equal size a value lies."""
    cuts = rows.groupBy(*by).agg(F.percentile_approx(column, [i / ranges for i in range(1, ranges)], 2000).alias("_cuts"))
    marked = rows.join(cuts, list(by)) if by else rows.crossJoin(F.broadcast(cuts))
    return marked.withColumn("_bucket", F.expr(f"size(filter(_cuts, c -> c < {column}))")).drop("_cuts")


def _accumulated(counts: DataFrame, column: str, by: tuple[str, ...]) -> DataFrame:
    """(by..., column, _count, _upto, _total) of rows that have a value and its ``_count``."""
    counts = _ranged(counts, column, by)
    before = _offset(counts, F.col("_count"), by)
    inside = F.sum("_count").over(W.partitionBy(*by, "_bucket").orderBy(column))
    return counts.withColumn("_in", inside).join(before, [*by, "_bucket"]).select(*by, column, "_count", (F.col("_in") + F.col("_before")).alias("_upto"), F.col("_all").alias("_total"))


def cumulative(values: DataFrame, column: str, *by: str) -> DataFrame:
    """(by..., column, _count, _upto, _total) of the distinct values that aren't null: how
    many rows hold a value, it or a smaller one, and any.

    Equal values are counted first, once, and ranges of values accumulated for themselves,
    so that no group is sorted in one place.
    """
    return _accumulated(settled(values.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_count"))), column, by)


def _at_quantile(accumulated: DataFrame, column: str, q: float, name: str, by: tuple[str, ...]) -> DataFrame:
    at = accumulated.withColumn("_h", (F.col("_total") - 1) * F.lit(float(q)))
    low = F.min(F.when(F.col("_upto") > F.floor("_h"), F.col(column)))
    high = F.min(F.when(F.col("_upto") > F.ceil("_h"), F.col(column)))
    h = F.first("_h")
    return at.groupBy(*by).agg((low + (high - low) * (h - F.floor(h))).cast("double").alias(name))


def quantile(values: DataFrame, column: str, q: float, name: str, *by: str) -> DataFrame:
    """(by..., name): the linear quantile of a column, exact, null without values."""
    return _at_quantile(cumulative(values, column, *by), column, q, name, by)


def rank_by(rows: DataFrame, key: Column, tie: str, *by: str, name: str = "rank") -> DataFrame:
    """``rows`` with their 1-based rank in the order of a hexadecimal hash, then of ``tie``.

    Rows are ranked within buckets of the hash, then moved up by what the buckets before
    hold, so that a large group isn't sorted in one place.
    """
    marked = rows.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, 2))
    inside = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy("_key", tie))
    ranked = marked.withColumn("_in", inside).join(_offset(marked, F.lit(1), by), [*by, "_bucket"])
    return ranked.select(*rows.columns, (F.col("_in") + F.col("_before")).alias(name))


def rank_in_ranges(rows: DataFrame, column: str, *by: str, name: str = "rank") -> DataFrame:
    """``rows`` with their 1-based rank in the order of a numeric column of distinct values."""
    marked = _ranged(rows, column, by)
    inside = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy(column))
    ranked = marked.withColumn("_in", inside).join(_offset(marked, F.lit(1), by), [*by, "_bucket"])
    return ranked.select(*rows.columns, (F.col("_in") + F.col("_before")).alias(name))


def percentile_of_score(values: DataFrame, column: str) -> DataFrame:
    """Each value's percentile among all, by mean rank of the ties."""
    at = cumulative(values, column)
    pct = at.select(column, ((2 * F.col("_upto") - F.col("_count") + 1) * 50.0 / F.col("_total")).alias(f"{column}_pct"))
    return values.join(pct, column)


def min_max(values: DataFrame, column: str, name: str) -> DataFrame:
    """``values`` with a column scaled to 0..1 over all rows; a constant gives 1."""
    ends = values.agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    unit = F.when(F.col("_high") > F.col("_low"), (F.col(column) - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(F.lit(1.0))
    return values.crossJoin(F.broadcast(ends)).withColumn(name, unit).drop("_low", "_high")


def md5_order(seed: int, column: str) -> Column:
    """A random order that is the same on every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")))
