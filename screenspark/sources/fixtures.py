"""The driver's tables, read as screens.  The SQL forms are for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenspark.model import CountMatrix
from screenspark.spec import ScreenSpec

CONTROL = "non-targeting"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _matrix(spark: SparkSession, sf_dir: str, gene: F.Column) -> CountMatrix:
    part = table(spark, sf_dir, "part").select("p_partkey", gene.alias("gene_name"))
    x = (
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("o_custkey").alias("cell_id"), "gene_name").agg(F.sum("l_quantity").alias("value"))
    )
    label = F.when(F.col("c_nationkey") == 0, F.lit(CONTROL)).otherwise(F.concat(F.lit("Brand#"), (F.col("c_nationkey") + 1).cast("string")))
    obs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cell_id"), label.alias("pert"), F.col("c_mktsegment").alias("cell_line"), (F.col("c_custkey") % 4).alias("batch"))
    return CountMatrix(obs, part.select("gene_name").distinct(), x)


def coarse(spark: SparkSession, sf_dir: str) -> CountMatrix:
    """customers as cells, brands as genes, quantities as counts."""
    return _matrix(spark, sf_dir, F.col("p_brand"))


def fine(spark: SparkSession, sf_dir: str) -> CountMatrix:
    """as F1 with brand and type as genes, so sparser."""
    return _matrix(spark, sf_dir, F.concat_ws("/", "p_brand", "p_type"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as expression profiles; label 0 is the control group."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("cell_id"), F.col("label").cast("string").alias("pert"), (F.col("label") == 0).alias("is_control"), (F.col("vec_id") % 4).alias("batch"),
        F.when(F.col("vec_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B")).alias("cell_line"), F.col("embedding").cast("array<double>").alias("v"),
    )


#: Parameters that suit the fixtures.
SPEC = ScreenSpec(
    control_label=CONTROL, mt_prefix="Brand#1", ribosomal_prefixes=("BRAND#24", "BRAND#25"), mt_threshold=0.5,
    min_genes=10, max_genes=24, min_counts=500, max_counts=2000, min_cells_per_perturbation=50, min_cells_per_line=100,
)

OBS = """obs AS (SELECT c_custkey AS cell_id, CASE WHEN c_nationkey = 0 THEN 'non-targeting' ELSE 'Brand#' || CAST(c_nationkey + 1 AS VARCHAR) END AS pert,
  c_mktsegment AS cell_line, c_custkey % 4 AS batch FROM customer)"""
ITEMS = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
COARSE_X = f"x AS (SELECT o_custkey AS cell_id, p_brand AS gene_name, SUM(l_quantity) AS value {ITEMS} GROUP BY 1, 2)"
COARSE_VAR = "var AS (SELECT DISTINCT p_brand AS gene_name FROM part)"
FINE_X = f"x AS (SELECT o_custkey AS cell_id, p_brand || '/' || p_type AS gene_name, SUM(l_quantity) AS value {ITEMS} GROUP BY 1, 2)"
FINE_VAR = "var AS (SELECT DISTINCT p_brand || '/' || p_type AS gene_name FROM part)"
COARSE = f"WITH {OBS}, {COARSE_X}, {COARSE_VAR}"
FINE = f"WITH {OBS}, {FINE_X}, {FINE_VAR}"
VECTORS = """WITH emb AS (SELECT vec_id AS cell_id, CAST(label AS VARCHAR) AS pert, label = 0 AS is_control, vec_id % 4 AS batch,
  CASE WHEN vec_id % 2 = 0 THEN 'A' ELSE 'B' END AS cell_line, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""
