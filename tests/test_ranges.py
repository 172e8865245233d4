"""Matrices whose files hold ranges of genes."""

import pytest
from pyspark.sql import functions as F

from screenspark.model import CountMatrix
from screenspark.sources import matrix

FILES = 120


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """1,000 genes; one of them holds a third of all entries."""
    x = spark.range(60_000).select(
        (F.col("id") % 4001).alias("cell_id"), F.when(F.col("id") % 3 == 0, "g0500").otherwise(F.format_string("g%04d", F.pmod(F.xxhash64("id"), F.lit(1000)))).alias("gene_name"), F.lit(1.0).alias("value")
    )
    m = CountMatrix(x.select("cell_id").distinct(), x.select("gene_name").distinct(), x)
    path = f"file://{tmp_path_factory.mktemp('ranges')}/m"
    matrix.write_matrix(m, path, gene_ranges=True, files=FILES)
    return m, path


def genes(spark, names):
    return spark.createDataFrame([(n,) for n in names], "gene_name string")


def test_few_genes_open_few_files(spark, written):
    m, path = written
    few = [f"g{i:04d}" for i in range(200, 210)]
    got = matrix.read_genes(spark, path, genes(spark, few))
    whole = matrix.read_matrix(spark, path).x
    assert len(whole.inputFiles()) > 100 and len(got.x.inputFiles()) < 0.05 * len(whole.inputFiles())
    want = m.x.filter(F.col("gene_name").isin(few))
    assert got.x.select(want.columns).exceptAll(want).count() == 0
    assert got.x.count() == want.count() and got.var.count() == 10


def test_scattered_and_hot_genes_are_whole(spark, written):
    m, path = written
    some = ["g0003", "g0500", "g0999", "unknown", "g0003"]
    got = matrix.read_genes(spark, path, genes(spark, some)).x
    want = m.x.filter(F.col("gene_name").isin(some))
    assert got.count() == want.count() and got.select(want.columns).exceptAll(want).count() == 0
    sizes = matrix.read_matrix(spark, path).x.groupBy(F.col("_metadata.file_name")).count()
    assert sizes.agg(F.max("count")).first()[0] < 3 * 60_000 / FILES  # the hot gene goes on over many files


def test_no_genes_and_empty_matrices(spark, written, tmp_path):
    m, path = written
    assert matrix.read_genes(spark, path, genes(spark, ["zz"])).x.count() == 0
    assert matrix.read_genes(spark, path, genes(spark, [])).var.count() == 0
    matrix.write_matrix(CountMatrix(m.obs.limit(0), m.var.limit(0), m.x.limit(0)), f"file://{tmp_path}/e", gene_ranges=True)
    assert matrix.read_genes(spark, f"file://{tmp_path}/e", genes(spark, ["g0001"])).x.count() == 0
