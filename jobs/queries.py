"""The jobs as queries: each runs twice into one new folder, which stays, and is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import cell_intake, term_screen
from jobs.common import load_config
from screenspark.plans.catalog import GOOD, QC
from screenspark.sources.fixtures import COARSE
from screenspark.sources.storage import new_path


def job1_cell_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"entries": "lineitem", "barcodes": "orders", "features": "part", "cells": "customer"}
    inputs, out, config = {k: f"{sf_dir}/{t}.parquet" for k, t in tables.items()}, new_path(spark, "job1-cell-intake"), load_config(cell_intake.CONFIG)
    for _ in range(2):
        cells = cell_intake.run(spark, inputs, out, config)
    return cells.withColumn("pct_counts_mt", F.round("pct_counts_mt", 6))


def job2_term_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, config = new_path(spark, "job2-term-screen"), load_config(term_screen.CONFIG)
    for _ in range(2):
        found = term_screen.run(spark, {"documents": f"{sf_dir}/documents.parquet"}, out, config)
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "control_mean", "shift")})


JOB1_SQL = f"""{COARSE}{QC} SELECT cell_id, pert, cell_line, n_genes_by_counts, total_counts, total_counts_mt, ROUND(pct, 6) AS pct_counts_mt, COALESCE({GOOD}, FALSE) AS passed,
CASE WHEN COALESCE(pct <= 50, FALSE) = FALSE THEN 'mt' WHEN n_genes_by_counts < 10 THEN 'min_genes' WHEN n_genes_by_counts > 24 THEN 'max_genes' WHEN total_counts < 500 THEN 'min_counts' WHEN total_counts > 2000 THEN 'max_counts' END AS failed,
batch AS plate FROM qc WHERE batch IN (SELECT batch FROM obs JOIN x USING (cell_id))"""

JOB2_SQL = """WITH w AS (SELECT doc_id, UNNEST(list_filter(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda t: t <> '')) AS term FROM documents),
x AS (SELECT doc_id, term, CAST(COUNT(*) AS DOUBLE) AS v FROM w GROUP BY 1, 2),
good AS (SELECT doc_id FROM x GROUP BY 1 HAVING COUNT(*) BETWEEN 10 AND 100000 AND SUM(v) BETWEEN 20 AND 1000000),
obs AS (SELECT doc_id, COALESCE(source, 'unknown') AS pert, COALESCE(lang, 'und') AS line FROM documents JOIN good USING (doc_id)), n AS (SELECT COUNT(*) AS n FROM obs),
terms AS (SELECT term FROM x JOIN good USING (doc_id) CROSS JOIN n GROUP BY term HAVING COUNT(*) >= 5 AND (COUNT(*) >= FLOOR(ANY_VALUE(n) * 0.02) OR SUM(v) / ANY_VALUE(n) >= 0.05)),
k AS (SELECT x.*, line, pert FROM x JOIN obs USING (doc_id) JOIN terms USING (term)), size AS (SELECT doc_id, line, SUM(v) AS total FROM k GROUP BY 1, 2),
med AS (SELECT line, quantile_cont(total, 0.5) AS med FROM size GROUP BY 1), g AS (SELECT line, pert, COUNT(*) AS n_cells FROM obs GROUP BY 1, 2),
m AS (SELECT k.line, k.pert, term, n_cells, COUNT(*) AS n_cells_expr, SUM(LN(1 + v * med / total)) / n_cells AS mean FROM k JOIN size USING (doc_id) JOIN med ON med.line = k.line JOIN g ON g.line = k.line AND g.pert = k.pert GROUP BY 1, 2, 3, 4)
SELECT m.line AS cell_line, m.pert, m.term AS gene_name, m.n_cells, m.n_cells_expr, ROUND(m.mean, 6) AS mean, ROUND(COALESCE(c.mean, CASE WHEN g.line IS NOT NULL THEN 0.0 END), 6) AS control_mean, ROUND(m.mean - COALESCE(c.mean, CASE WHEN g.line IS NOT NULL THEN 0.0 END), 6) AS shift
FROM m LEFT JOIN m c ON c.line = m.line AND c.term = m.term AND c.pert = 'src0' LEFT JOIN g ON g.line = m.line AND g.pert = 'src0'"""

QUERIES = {"job1_cell_intake": job1_cell_intake, "job2_term_screen": job2_term_screen}
ORACLE = {"job1_cell_intake": JOB1_SQL, "job2_term_screen": JOB2_SQL}
