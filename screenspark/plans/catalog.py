"""Queries over the test tables, each with SQL that computes the same independently.

The engine works on sparse entries; the SQL is written over dense grids, subqueries and
joins of its own wherever the two can differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenspark.functions import statistics, vectors
from screenspark.operators import ambient, calibrate, counterfactual, detect, diagnostics, escapers, genes, hvg, lines, metacells, neighbours, normalize, qc, splits
from screenspark.sources import fixtures as fx
from screenspark.sources.fixtures import COARSE, CONTROL, FINE, SPEC, VECTORS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def r6(name: str, alias: str | None = None) -> Column:
    return F.round(F.col(name).cast("double"), 6).alias(alias or name)


# ---------------------------------------------------------------- cells

QC = """, per AS (SELECT cell_id, COUNT_IF(value <> 0) AS n, SUM(value) AS t, SUM(CASE WHEN gene_name LIKE 'Brand#1%' THEN value ELSE 0 END) AS mt FROM x GROUP BY 1),
qc AS (SELECT o.cell_id, o.pert, o.cell_line, o.batch, COALESCE(n, 0) AS n_genes_by_counts, COALESCE(t, 0) AS total_counts, COALESCE(mt, 0) AS total_counts_mt,
  100 * COALESCE(mt, 0) / NULLIF(COALESCE(t, 0), 0) AS pct FROM obs o LEFT JOIN per USING (cell_id))"""
GOOD = "pct <= 50 AND n_genes_by_counts >= 10 AND n_genes_by_counts <= 24 AND total_counts >= 500 AND total_counts <= 2000"


#: Cells after each filter, one row a step.
STEPS = f"""c AS (SELECT COUNT(*) c0, COUNT_IF(pct <= 50) c1, COUNT_IF(pct <= 50 AND n_genes_by_counts >= 10) c2,
  COUNT_IF(pct <= 50 AND n_genes_by_counts BETWEEN 10 AND 24) c3, COUNT_IF(pct <= 50 AND n_genes_by_counts BETWEEN 10 AND 24 AND total_counts >= 500) c4, COUNT_IF({GOOD}) c5 FROM qc),
w AS (SELECT 0 AS step, 'start' AS name, c0 AS n_cells FROM c UNION ALL SELECT 1, 'mt', c1 FROM c UNION ALL SELECT 2, 'min_genes', c2 FROM c
UNION ALL SELECT 3, 'max_genes', c3 FROM c UNION ALL SELECT 4, 'min_counts', c4 FROM c UNION ALL SELECT 5, 'max_counts', c5 FROM c)"""


def metrics(spark, d):
    return qc.qc_metrics(fx.coarse(spark, d), SPEC)


@query("p08_cell_waterfall", f"{COARSE}{QC}, {STEPS} SELECT step, name, n_cells FROM w")
def p08(spark, d):
    return qc.cell_waterfall(metrics(spark, d), SPEC)


@query("p04_qc_metrics", f"{COARSE}{QC} SELECT cell_id, n_genes_by_counts, total_counts, total_counts_mt, ROUND(pct, 6) AS pct_counts_mt FROM qc")
def p04(spark, d):
    return metrics(spark, d).select("cell_id", "n_genes_by_counts", "total_counts", "total_counts_mt", r6("pct_counts_mt"))


@query("p05_good_cells", f"{COARSE}{QC} SELECT cell_id, pert FROM qc WHERE {GOOD}")
def p05(spark, d):
    return qc.good_cells(metrics(spark, d), SPEC).select("cell_id", "pert")


@query("p03_subset_matrix", f"""{COARSE}{QC} SELECT x.cell_id, x.gene_name, x.value FROM x JOIN qc USING (cell_id)
WHERE {GOOD} AND NOT (x.gene_name LIKE 'Brand#24%' OR x.gene_name LIKE 'Brand#25%')""")
def p03(spark, d):
    return qc.triage_cells(fx.coarse(spark, d), SPEC).x.select("cell_id", "gene_name", "value")


@query("p09_ribo_removal", f"{COARSE} SELECT gene_name FROM var WHERE NOT (UPPER(gene_name) LIKE 'BRAND#24%' OR UPPER(gene_name) LIKE 'BRAND#25%')")
def p09(spark, d):
    return qc.drop_ribosomal(fx.coarse(spark, d).var, SPEC)


@query("w18_step_drops", f"""{COARSE}{QC}, {STEPS}, l AS (SELECT step, n_cells, LAG(n_cells) OVER (ORDER BY step) AS b FROM w)
SELECT step, n_cells, COALESCE(b - n_cells, 0) AS dropped, ROUND(COALESCE(100.0 * (b - n_cells) / b, 0), 6) AS pct_dropped FROM l""")
def w18(spark, d):
    return diagnostics.step_drops(qc.cell_waterfall(metrics(spark, d), SPEC)).select("step", "n_cells", "dropped", r6("pct_dropped"))


@query("a01_sparsity", f"""{COARSE} SELECT c AS n_cells, g AS n_genes, nnz, ROUND(1 - nnz / (c * g), 6) AS sparsity, 4 * c * g AS dense_bytes, 8 * nnz + 4 * (c + 1) AS sparse_bytes
FROM (SELECT COUNT(*) c FROM obs), (SELECT COUNT(*) g FROM var), (SELECT COUNT(*) nnz FROM x WHERE value <> 0)""")
def a01(spark, d):
    return qc.sparsity(fx.coarse(spark, d)).select("n_cells", "n_genes", "nnz", r6("sparsity"), "dense_bytes", "sparse_bytes")


DENSE = ", grid AS (SELECT obs.cell_id, obs.pert, obs.cell_line, var.gene_name, COALESCE(x.value, 0) AS value FROM obs CROSS JOIN var LEFT JOIN x ON x.cell_id = obs.cell_id AND x.gene_name = var.gene_name)"

#: Sums of each gene over its entries, and the number of cells: all that moments need.
SUMS = ", sums AS (SELECT gene_name, COALESCE(SUM(value), 0) AS s, COALESCE(SUM(value * value), 0) AS s2, (SELECT COUNT(*) FROM obs) AS n FROM var LEFT JOIN x USING (gene_name) GROUP BY 1)"


@query("a02_gene_cell_counts", f"""{COARSE}{DENSE} SELECT gene_name, COUNT_IF(value <> 0) AS n_cells_expr, SUM(value) AS total FROM grid GROUP BY 1""")
def a02(spark, d):
    return qc.counts_per_gene(fx.coarse(spark, d)).select("gene_name", "n_cells_expr", "total")


@query("a11_gene_stats", f"""{FINE}{DENSE} SELECT gene_name, COUNT_IF(value <> 0) AS n_cells_expr, ROUND(AVG(value), 6) AS mean, ROUND(100.0 * COUNT_IF(value <> 0) / COUNT(*), 6) AS penetrance FROM grid GROUP BY 1""")
def a11(spark, d):
    return qc.counts_per_gene(fx.fine(spark, d)).select("gene_name", "n_cells_expr", r6("mean"), r6("penetrance"))


# ---------------------------------------------------------------- ambient

@query("a03_mean_profile", f"{FINE}{DENSE} SELECT gene_name, ROUND(AVG(value), 6) AS ambient FROM grid GROUP BY 1 HAVING SUM(value) > 0")
def a03(spark, d):
    return ambient.global_profile(fx.fine(spark, d)).select("gene_name", r6("ambient"))


AMBIENT = DENSE + """, prof AS (SELECT gene_name, AVG(value) AS a FROM grid GROUP BY 1),
score AS (SELECT cell_id, COALESCE(SUM(value * a) / (GREATEST(SQRT(SUM(value * value)), 1e-10) * SQRT(SUM(a * a))), 0) AS s FROM grid JOIN prof USING (gene_name) GROUP BY 1)"""


@query("a05_ambient_score", f"{COARSE}{AMBIENT} SELECT cell_id, ROUND(s, 6) AS ambient_score FROM score")
def a05(spark, d):
    m = fx.coarse(spark, d)
    return ambient.ambient_scores(m, ambient.global_profile(m)).select("cell_id", r6("ambient_score"))


@query("p24_ambient_flag", f"""{COARSE}{QC}{AMBIENT} SELECT cell_id, (s > 0.8 AND total_counts <= (SELECT QUANTILE_CONT(total_counts, 0.1) FROM qc)) AS ambient_flagged FROM qc JOIN score USING (cell_id)""")
def p24(spark, d):
    m = fx.coarse(spark, d)
    return ambient.flag_ambient(qc.qc_metrics(m, SPEC), ambient.ambient_scores(m, ambient.global_profile(m)), SPEC).select("cell_id", "ambient_flagged")


@query("a04_empty_droplets", f"""{COARSE}, empty AS (SELECT cell_id FROM obs WHERE cell_id % 3 <> 0 ORDER BY md5('42:' || cell_id), cell_id LIMIT 10000)
SELECT gene_name, ROUND(SUM(value) / (SELECT COUNT(*) FROM empty), 6) AS ambient FROM x SEMI JOIN empty USING (cell_id) GROUP BY 1""")
def a04(spark, d):
    m = fx.coarse(spark, d)
    return ambient.empty_droplet_profile(m, m.obs.filter("cell_id % 3 = 0"), 42).select("gene_name", r6("ambient"))


# ---------------------------------------------------------------- detection

@query("j01_gene_harmonise", """WITH ids AS (SELECT DISTINCT p_type || ':' || p_brand AS id, CASE WHEN p_brand < 'Brand#20' THEN p_type END AS symbol FROM part),
named AS (SELECT id, COALESCE(symbol, id) AS nm FROM ids), k AS (SELECT id, nm, ROW_NUMBER() OVER (PARTITION BY nm ORDER BY id) - 1 AS k FROM named)
SELECT id AS original_gene_id, CASE WHEN k > 0 THEN nm || '_' || k ELSE nm END AS gene_name FROM k""")
def j01(spark, d):
    ids = fx.table(spark, d, "part").select(F.concat_ws(":", "p_type", "p_brand").alias("gene_name"), "p_type", "p_brand").distinct()
    known = ids.filter("p_brand < 'Brand#20'").select(F.col("gene_name").alias("gene_id"), F.col("p_type").alias("symbol"))
    return detect.harmonise(ids.select("gene_name"), known).select("original_gene_id", "gene_name")


@query("p12_gene_id_format", """WITH n AS (SELECT 'ENSG' || LPAD(CAST(p_partkey AS VARCHAR), 11, '0') AS g FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT p_brand FROM part WHERE p_partkey % 3 = 0),
f AS (SELECT g FROM n ORDER BY g LIMIT 200) SELECT CASE WHEN AVG(CAST(regexp_matches(g, '^ENSG[0-9]+$') AS INT)) > 0.5 THEN 'ensembl' ELSE 'symbol' END AS format FROM f""")
def p12(spark, d):
    part = fx.table(spark, d, "part")
    names = part.filter("p_partkey % 3 <> 0").select(F.concat(F.lit("ENSG"), F.lpad(F.col("p_partkey").cast("string"), 11, "0")).alias("gene_name"))
    return detect.gene_id_format(names.unionByName(part.filter("p_partkey % 3 = 0").select(F.col("p_brand").alias("gene_name")))).select("format")


@query("p10_modality", "SELECT CASE WHEN COUNT_IF(p_type = 'ECONOMY') > 0 THEN 'cite_seq' ELSE 'scrna_seq' END AS modality FROM part")
def p10(spark, d):
    part = fx.table(spark, d, "part")
    kind = F.when(F.col("p_type") == "ECONOMY", "Antibody Capture").otherwise("Gene Expression")
    return detect.modality(part.select(F.concat(F.lit("MT-"), "p_brand").alias("gene_name"), kind.alias("feature_type")), "cells")


LABELS = "WITH obs AS (SELECT c_custkey AS cell_id, CASE WHEN c_nationkey = 0 THEN 'non-targeting' WHEN c_nationkey % 5 = 1 THEN c_mktsegment || ' + ' || c_nationkey ELSE c_mktsegment END AS pert FROM customer)"


def labels(spark, d):
    label = F.when(F.col("c_nationkey") == 0, CONTROL).when(F.col("c_nationkey") % 5 == 1, F.concat_ws(" + ", "c_mktsegment", F.col("c_nationkey").cast("string"))).otherwise(F.col("c_mktsegment"))
    return fx.table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), label.alias("pert"))


@query("p14_combinatorial", f"{LABELS} SELECT AVG(CAST(contains(pert, '+') AS INT)) >= 0.05 AS is_combinatorial, CASE WHEN AVG(CAST(contains(pert, '+') AS INT)) >= 0.05 THEN '+' END AS separator FROM obs WHERE pert <> 'non-targeting'")
def p14(spark, d):
    return detect.combinatorial(labels(spark, d), SPEC)


@query("p14_constituents", f"{LABELS} SELECT DISTINCT TRIM(p) AS gene FROM (SELECT UNNEST(string_split(pert, '+')) AS p FROM obs WHERE pert <> 'non-targeting') WHERE TRIM(p) <> ''")
def p14b(spark, d):
    return detect.constituents(labels(spark, d), "+", SPEC)


@query("p15_combinatorial_labels", f"{LABELS} SELECT AVG(CAST(contains(pert, '+') AS INT)) >= 0.05 AS is_combinatorial, CASE WHEN AVG(CAST(contains(pert, '+') AS INT)) >= 0.05 THEN '+' END AS separator FROM (SELECT DISTINCT pert FROM obs WHERE pert <> 'non-targeting')")
def p15(spark, d):
    return detect.combinatorial(labels(spark, d), SPEC, per_label=True)


@query("p21_perturbation_type", "SELECT CASE WHEN COUNT_IF(contains(LOWER(c_mktsegment), 'crispra') OR contains(LOWER(c_mktsegment), 'activation')) > 0 THEN 'CRISPRa' ELSE 'CRISPRi' END AS perturbation_type FROM customer")
def p21(spark, d):
    return detect.perturbation_type(fx.table(spark, d, "customer").select(F.col("c_mktsegment").alias("value")))


@query("p27_alias_map", "SELECT a AS alias, MAX(g) AS gene_name FROM (SELECT p_brand || '/' || p_type AS a, p_brand || '/' || p_type AS g FROM part UNION ALL SELECT p_type, p_brand || '/' || p_type FROM part) GROUP BY 1")
def p27(spark, d):
    var = fx.table(spark, d, "part").select(F.concat_ws("/", "p_brand", "p_type").alias("gene_name"), F.col("p_type").alias("symbol")).distinct()
    return escapers.alias_map(var, ("symbol",))


@query("p20_control_label", "SELECT 'Non Targeting' AS control_label")
def p20(spark, d):
    named = fx.table(spark, d, "customer").select(F.when(F.col("c_nationkey") == 0, "Non Targeting").when(F.col("c_nationkey") == 1, "GFP").otherwise(F.col("c_mktsegment")).alias("pert"))
    return detect.control_label(spark, named)


@query("p22_feature_routing", "SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'adt' WHEN p_size = 1 THEN 'atac' ELSE 'rna' END AS route FROM part")
def p22(spark, d):
    part = fx.table(spark, d, "part")
    name = F.when(F.col("p_size") == 1, F.concat(F.lit("chr1:"), F.col("p_partkey").cast("string"), F.lit("-9"))).otherwise(F.col("p_brand"))
    kind = F.when(F.col("p_type") == "ECONOMY", "Antibody Capture").otherwise("Gene Expression")
    return detect.route_features(part.select("p_partkey", name.alias("gene_name"), kind.alias("feature_type"))).select("p_partkey", "route")


# ---------------------------------------------------------------- escapers

CTRL_Q = DENSE + """, thr AS (SELECT gene_name, QUANTILE_CONT(value, {q}) AS t FROM grid WHERE pert = 'non-targeting' GROUP BY 1)"""


@query("w01_control_percentiles", f"{COARSE}{CTRL_Q.format(q=0.1)} SELECT gene_name, ROUND(t, 6) AS threshold FROM thr")
def w01(spark, d):
    m = fx.coarse(spark, d)
    return escapers.control_percentiles(m, m.var, SPEC).select("gene_name", r6("threshold"))


@query("w01_fine_percentiles", f"{FINE}{CTRL_Q.format(q=0.9)} SELECT gene_name, ROUND(t, 6) AS threshold FROM thr")
def w01b(spark, d):
    m = fx.fine(spark, d)
    control = m.obs.filter(F.col("pert") == CONTROL)
    return statistics.sparse_percentile(m.x.join(control.select("cell_id"), "cell_id", "left_semi"), m.var, control.agg(F.count("*").alias("n_cells")), 0.9).select("gene_name", r6("threshold"))


JUDGED = CTRL_Q.format(q=0.1) + """, judged AS (SELECT g.cell_id, g.pert, CASE WHEN g.pert = 'non-targeting' THEN TRUE ELSE g.value <= t.t END AS kept, CASE WHEN g.pert = 'non-targeting' THEN 0 ELSE 1 END AS n
  FROM grid g JOIN thr t USING (gene_name) WHERE g.gene_name = CASE WHEN g.pert = 'non-targeting' THEN 'Brand#1' ELSE g.pert END)"""
FIRST_GENE = "(SELECT MIN(gene_name) FROM var)"
JUDGED = JUDGED.replace("'Brand#1'", FIRST_GENE)


@query("p28_escaper_filter", f"{COARSE}{JUDGED} SELECT cell_id, pert, kept FROM judged")
def p28(spark, d):
    return escapers.judged_cells(fx.coarse(spark, d), SPEC).select("cell_id", "pert", "kept")


@query("p28_escaper_activation", f"{COARSE}{CTRL_Q.format(q=0.9)} SELECT g.cell_id, g.value >= CASE WHEN t.t = 0 THEN 1e-5 ELSE t.t END AS kept FROM grid g JOIN thr t USING (gene_name) WHERE g.gene_name = g.pert")
def p28b(spark, d):
    from dataclasses import replace

    spec = replace(SPEC, perturbation_type="CRISPRa")
    return escapers.judged_cells(fx.coarse(spark, d), spec).filter(F.col("pert") != CONTROL).select("cell_id", "kept")


MEANS = DENSE + ", means AS (SELECT pert, gene_name, AVG(value) AS m FROM grid GROUP BY 1, 2), ctrl AS (SELECT gene_name, m AS c FROM means WHERE pert = 'non-targeting')"


@query("a07_knockdown_depth", f"{COARSE}{MEANS} SELECT m.pert, ROUND(m.m / CASE WHEN c > 1e-10 THEN c END, 6) AS depth FROM means m JOIN ctrl USING (gene_name) WHERE m.pert = m.gene_name")
def a07(spark, d):
    return escapers.knockdown_depth(fx.coarse(spark, d), SPEC).select("pert", r6("depth"))


@query("a09_escaper_stats", f"""{COARSE}{JUDGED} SELECT pert, COUNT(*) AS n_total, COUNT_IF(NOT kept) AS n_escaped, COUNT_IF(kept) AS n_kept, CAST(1 AS BIGINT) AS n_genes_checked,
ROUND(COUNT_IF(kept) / COUNT(*), 6) AS efficiency, COUNT_IF(kept) / COUNT(*) < 0.5 AS low_efficiency, 'filtered' AS status FROM judged WHERE pert <> 'non-targeting' GROUP BY 1""")
def a09(spark, d):
    return escapers.escaper_stats(fx.coarse(spark, d), SPEC).select("pert", "n_total", "n_escaped", "n_kept", "n_genes_checked", r6("efficiency"), "low_efficiency", "status")


@query("j02_efficiency_per_cell", f"""{COARSE}{JUDGED}, e AS (SELECT pert, COUNT_IF(kept) / COUNT(*) AS e FROM judged GROUP BY 1) SELECT cell_id, ROUND(CASE WHEN pert = 'non-targeting' THEN 1.0 ELSE e END, 6) AS efficiency FROM obs JOIN e USING (pert)""")
def j02(spark, d):
    m = fx.coarse(spark, d)
    return escapers.efficiency_per_cell(m.obs, escapers.escaper_stats(m, SPEC), SPEC).select("cell_id", r6("efficiency"))


@query("p30_undersized", f"{COARSE} SELECT cell_id, pert FROM obs WHERE pert = 'non-targeting' OR pert IN (SELECT pert FROM obs GROUP BY 1 HAVING COUNT(*) >= 50)")
def p30(spark, d):
    return escapers.drop_undersized(fx.coarse(spark, d).obs, SPEC).select("cell_id", "pert")


@query("a10_group_sizes", f"{COARSE} SELECT pert, COUNT(*) AS n_cells FROM obs GROUP BY 1")
def a10(spark, d):
    return escapers.group_sizes(fx.coarse(spark, d).obs)


# ---------------------------------------------------------------- genes

def gene_spec():
    from dataclasses import replace

    return replace(SPEC, min_cells_expressing=25, cell_share=0.3, mean_umi=9.0)


GENES = DENSE + """, g AS (SELECT gene_name, COUNT_IF(value <> 0) AS n, AVG(value) AS m, (SELECT COUNT(*) FROM obs) AS cells FROM grid GROUP BY 1),
tri AS (SELECT gene_name, n < 25 AS rare, n < GREATEST(25, FLOOR(cells * 0.3)) AND m < 9.0 AS low, gene_name IN (SELECT split_part(pert, '#', 1) || '#' || split_part(pert, '#', 2) || '/PROMO' FROM obs) AS is_target FROM g)"""


def fine_targets(spark, d):
    return fx.fine(spark, d).obs.filter(F.col("pert") != CONTROL).select(F.concat("pert", F.lit("/PROMO")).alias("gene_name")).distinct()


@query("p31_gene_triage", f"{FINE}{GENES} SELECT gene_name, rare AS removed_rare, low AS removed_low, is_target, (NOT (rare OR low)) OR is_target AS kept FROM tri")
def p31(spark, d):
    return genes.triage(fx.fine(spark, d), gene_spec(), fine_targets(spark, d)).select("gene_name", "removed_rare", "removed_low", "is_target", "kept")


@query("p35_gene_waterfall", f"""{FINE}{GENES} SELECT 0 AS step, 'start' AS name, COUNT(*) AS n_genes FROM tri UNION ALL SELECT 1, 'after_floor', COUNT_IF(NOT rare) FROM tri
UNION ALL SELECT 2, 'pre_rescue', COUNT_IF(NOT (rare OR low)) FROM tri UNION ALL SELECT 3, 'post_rescue', COUNT_IF((NOT (rare OR low)) OR is_target) FROM tri""")
def p35(spark, d):
    return genes.gene_waterfall(genes.triage(fx.fine(spark, d), gene_spec(), fine_targets(spark, d)))


@query("a27_sparsity_boost", f"""{FINE}{GENES}, p AS (SELECT 100.0 * n / cells AS p, (NOT (rare OR low)) OR is_target AS kept FROM g JOIN tri USING (gene_name))
SELECT ROUND(1 - AVG(p) / 100, 6) AS sparsity_before, ROUND(1 - AVG(CASE WHEN kept THEN p END) / 100, 6) AS sparsity_after FROM p""")
def a27(spark, d):
    return genes.penetrance_boost(genes.triage(fx.fine(spark, d), gene_spec(), fine_targets(spark, d))).select(r6("sparsity_before"), r6("sparsity_after"))


# ---------------------------------------------------------------- splits

SHIFT = MEANS + """, shifts AS (SELECT m.pert, SUM(ABS(m.m - c)) AS shift FROM means m JOIN ctrl USING (gene_name) WHERE m.pert <> 'non-targeting' GROUP BY 1)"""
BINS = SHIFT + """, e AS (SELECT QUANTILE_CONT(shift, 0.25) AS a, QUANTILE_CONT(shift, 0.5) AS b, QUANTILE_CONT(shift, 0.75) AS c FROM shifts),
binned AS (SELECT pert, shift, CAST(shift > a AS INT) + CAST(shift > b AS INT) + CAST(shift > c AS INT) AS bin FROM shifts, e)"""
SPLIT = BINS + """, k AS (SELECT pert, bin, ROW_NUMBER() OVER (PARTITION BY bin ORDER BY md5('42:' || pert), pert) AS rn, COUNT(*) OVER (PARTITION BY bin) AS n FROM binned),
t AS (SELECT *, CASE WHEN n > 3 THEN GREATEST(1, CAST(FLOOR(n * 0.25) AS BIGINT)) ELSE 1 END AS nt FROM k),
v AS (SELECT *, CASE WHEN n - nt > 2 THEN GREATEST(1, CAST(FLOOR((n - nt) * 0.10) AS BIGINT)) ELSE 1 END AS nv FROM t),
lab AS (SELECT pert, bin, CASE WHEN rn <= nt THEN 'test' WHEN rn <= nt + nv THEN 'val' ELSE 'train' END AS split FROM v)"""
ZERO = SPLIT + """, sh AS (SELECT COUNT(*) AS n, COUNT_IF(split = 'test') AS t, COUNT_IF(split = 'val') AS v FROM lab),
cc AS (SELECT cell_id, ROW_NUMBER() OVER (ORDER BY md5('42:' || cell_id), cell_id) AS rn, COUNT(*) OVER () AS n FROM obs WHERE pert = 'non-targeting'),
cs AS (SELECT cell_id, CASE WHEN rn <= FLOOR(cc.n * t / sh.n) THEN 'test' WHEN rn <= FLOOR(cc.n * t / sh.n) + FLOOR(cc.n * v / sh.n) THEN 'val' ELSE 'train' END AS split FROM cc, sh),
zs AS (SELECT cell_id, pert, split FROM obs JOIN lab USING (pert) UNION ALL SELECT cell_id, 'non-targeting', split FROM cs)"""


@query("a12_mean_shift", f"{FINE}{SHIFT} SELECT pert, ROUND(shift, 6) AS shift FROM shifts")
def a12(spark, d):
    return splits.mean_shift(fx.fine(spark, d), SPEC).select("pert", r6("shift"))


@query("w03_qcut_bins", f"{COARSE}{BINS} SELECT pert, bin FROM binned")
def w03(spark, d):
    return splits.effect_bins(splits.mean_shift(fx.coarse(spark, d), SPEC), SPEC).select("pert", "bin")


@query("w05_label_split", f"{COARSE}{SPLIT} SELECT pert, bin, split FROM lab")
def w05(spark, d):
    return splits.split_labels(splits.effect_bins(splits.mean_shift(fx.coarse(spark, d), SPEC), SPEC), SPEC).select("pert", "bin", "split")


@query("w06_control_split", f"{COARSE}{ZERO} SELECT cell_id, split FROM cs")
def w06(spark, d):
    return splits.zero_shot(fx.coarse(spark, d), SPEC).filter(F.col("pert") == CONTROL).select("cell_id", "split")


@query("j03_zero_shot", f"{COARSE}{ZERO} SELECT cell_id, pert, split FROM zs")
def j03(spark, d):
    return splits.zero_shot(fx.coarse(spark, d), SPEC).select("cell_id", "pert", "split")


@query("a21_split_summary", f"""{COARSE}{ZERO} SELECT split, COUNT(*) AS n_cells, COUNT(DISTINCT CASE WHEN pert <> 'non-targeting' THEN pert END) AS n_targets, ROUND(100.0 * COUNT(*) / (SELECT COUNT(*) FROM zs), 6) AS pct_cells FROM zs GROUP BY 1""")
def a21(spark, d):
    return splits.split_summary(splits.zero_shot(fx.coarse(spark, d), SPEC), SPEC).select("split", "n_cells", "n_targets", r6("pct_cells"))


@query("u05_leakage", f"""{COARSE}{ZERO}, s AS (SELECT DISTINCT split FROM zs) SELECT a.split AS split_a, b.split AS split_b,
(SELECT COUNT(*) FROM (SELECT DISTINCT pert FROM zs WHERE split = a.split AND pert <> 'non-targeting' INTERSECT SELECT DISTINCT pert FROM zs WHERE split = b.split)) AS n_shared FROM s a JOIN s b ON a.split < b.split""")
def u05(spark, d):
    return splits.leakage(splits.zero_shot(fx.coarse(spark, d), SPEC), SPEC)


@query("w07_stratified_sample", f"""{COARSE}, z AS (SELECT pert, COUNT(*) AS n FROM obs GROUP BY 1), k AS (SELECT pert, GREATEST(1, LEAST(CAST(round_even(n * LEAST(1.0, 700 / (SELECT COUNT(*) FROM obs)), 0) AS BIGINT), n)) AS take FROM z)
SELECT cell_id, pert FROM (SELECT cell_id, pert, ROW_NUMBER() OVER (PARTITION BY pert ORDER BY md5('42:' || cell_id), cell_id) AS rn FROM obs) JOIN k USING (pert) WHERE rn <= take""")
def w07(spark, d):
    return hvg.stratified_sample(fx.coarse(spark, d).obs, 700, 42).select("cell_id", "pert")


@query("w08_uniform_sample", f"{COARSE} SELECT cell_id FROM obs ORDER BY md5('42:' || cell_id), cell_id LIMIT 100")
def w08(spark, d):
    return hvg.uniform_sample(fx.coarse(spark, d).obs, 100, 42).select("cell_id")


# ---------------------------------------------------------------- variable genes, normalisation

@query("a13_hvg_moments", f"{FINE}{DENSE} SELECT gene_name, ROUND(AVG(value), 6) AS mean, ROUND(VAR_SAMP(value), 6) AS variance FROM grid GROUP BY 1")
def a13(spark, d):
    return hvg.moments(fx.fine(spark, d)).select("gene_name", r6("mean"), r6("variance"))


RANKED = SUMS + """, mo AS (SELECT gene_name, ROUND((s2 - s * s / n) / (n - 1), 6) AS score FROM sums), top AS (SELECT gene_name FROM mo ORDER BY score DESC, gene_name LIMIT 40),
mk AS (SELECT gene_name, score, gene_name IN (SELECT gene_name FROM top) AS hv, gene_name LIKE '%/PROMO' AND gene_name < 'Brand#15' AS tg, gene_name LIKE 'Brand#2%/STANDARD' AS cy FROM mo),
lo AS (SELECT *, CASE WHEN hv AND NOT tg AND NOT cy THEN ROW_NUMBER() OVER (PARTITION BY hv AND NOT tg AND NOT cy ORDER BY score, gene_name DESC) END AS low FROM mk),
st AS (SELECT *, COALESCE((SELECT COUNT_IF(tg AND NOT hv) <= COUNT_IF(hv AND NOT tg AND NOT cy) FROM mk) AND low <= (SELECT COUNT_IF(tg AND NOT hv) FROM mk), FALSE) AS gone FROM lo)"""


def ranked(spark, d):
    scores = hvg.moments(fx.fine(spark, d)).select("gene_name", r6("variance", "score"))
    aims = scores.filter("gene_name LIKE '%/PROMO' AND gene_name < 'Brand#15'")
    return hvg.swap_targets(hvg.top_genes(scores, 40), aims, scores.filter("gene_name LIKE 'Brand#2%/STANDARD'"))


@query("w10_target_swap", f"""{FINE}{RANKED} SELECT gene_name, CASE WHEN tg AND NOT hv THEN 'rescued_target' WHEN gone THEN 'swapped_out' WHEN hv THEN 'variable' WHEN cy THEN 'ghost' ELSE 'dropped' END AS status,
(hv AND NOT gone) OR tg AS is_core, (hv AND NOT gone) OR tg OR cy AS selected FROM st""")
def w10(spark, d):
    return ranked(spark, d).select("gene_name", "status", "is_core", "selected")


@query("a22_status_summary", f"""{FINE}{RANKED} SELECT CASE WHEN tg AND NOT hv THEN 'rescued_target' WHEN gone THEN 'swapped_out' WHEN hv THEN 'variable' WHEN cy THEN 'ghost' ELSE 'dropped' END AS status,
COUNT(*) AS n, ROUND(AVG(score), 5) AS mean, MIN(score) AS low, MAX(score) AS high FROM st GROUP BY 1""")
def a22(spark, d):
    return hvg.status_summary(ranked(spark, d)).select("status", "n", F.round("mean", 5).alias("mean"), "low", "high")


@query("s10_stream_subset", f"{FINE}{RANKED} SELECT cell_id, gene_name, value FROM x WHERE gene_name IN (SELECT gene_name FROM st WHERE (hv AND NOT gone) OR tg OR cy)")
def s10(spark, d):
    """The subset is read from the files that hold its genes, written, and read again."""
    from screenspark.sources import matrix
    from screenspark.sources.storage import new_path

    whole, subset = new_path(spark, "matrix"), new_path(spark, "subset")
    matrix.write_matrix(fx.fine(spark, d), whole, gene_ranges=True)
    matrix.write_matrix(matrix.read_genes(spark, whole, ranked(spark, d).filter("selected")), subset)
    matrix.clean_up(spark, [whole], dry_run=False)
    return matrix.read_matrix(spark, subset).x.select("cell_id", "gene_name", "value")


@query("p36_ghost_excision", f"{FINE}{RANKED} SELECT gene_name, COUNT(*) AS n FROM x WHERE gene_name IN (SELECT gene_name FROM st WHERE (hv AND NOT gone) OR tg) GROUP BY 1")
def p36(spark, d):
    m = fx.fine(spark, d)
    return hvg.excise_ghosts(m, ranked(spark, d)).x.groupBy("gene_name").agg(F.count("*").alias("n"))


TOTALS = ", tot AS (SELECT cell_id, cell_line, SUM(value) AS t FROM x JOIN obs USING (cell_id) GROUP BY 1, 2), med AS (SELECT cell_line, MEDIAN(t) AS md FROM tot WHERE t > 0 GROUP BY 1)"
NORM = TOTALS + ", nm AS (SELECT x.cell_id, x.gene_name, LN(1 + value * md / t) AS v FROM x JOIN tot USING (cell_id) JOIN med USING (cell_line))"


@query("a14_median_size", f"{COARSE}{TOTALS} SELECT cell_line, md AS median_size FROM med")
def a14(spark, d):
    return normalize.median_size(fx.coarse(spark, d), "cell_line")


@query("n01_normalise", f"{COARSE}{TOTALS} SELECT x.cell_id, x.gene_name, ROUND(value * 10000 / t, 6) AS value FROM x JOIN tot USING (cell_id)")
def n01(spark, d):
    from dataclasses import replace

    return normalize.normalise(fx.coarse(spark, d), replace(SPEC, target_sum=10_000.0, log=False), "cell_line").x.select("cell_id", "gene_name", r6("value"))


@query("n02_log1p", f"{COARSE}{NORM} SELECT cell_id, gene_name, ROUND(v, 6) AS value FROM nm")
def n02(spark, d):
    return normalize.normalise(fx.coarse(spark, d), SPEC, "cell_line").x.select("cell_id", "gene_name", r6("value"))


@query("a15_gene_std", f"{FINE}{DENSE} SELECT gene_name, ROUND(CASE WHEN STDDEV_POP(value) < 1e-10 THEN 1.0 ELSE STDDEV_POP(value) END, 6) AS std FROM grid GROUP BY 1")
def a15(spark, d):
    return normalize.gene_std(fx.fine(spark, d)).select("gene_name", r6("std"))


@query("n03_scale_clip", f"{FINE}{SUMS}, sd AS (SELECT gene_name, SQRT(GREATEST(0, s2 / n - s / n * s / n)) AS s FROM sums) SELECT cell_id, gene_name, ROUND(LEAST(GREATEST(value / CASE WHEN s < 1e-10 THEN 1.0 ELSE s END, 0), 10), 6) AS value FROM x JOIN sd USING (gene_name)")
def n03(spark, d):
    return normalize.scale(fx.fine(spark, d), SPEC).x.select("cell_id", "gene_name", r6("value"))


@query("a25_value_summary", f"{COARSE}{NORM} SELECT cell_line, ROUND(AVG(v), 6) AS mean_nonzero, ROUND(MAX(v), 6) AS max_nonzero FROM nm JOIN obs USING (cell_id) WHERE v <> 0 GROUP BY 1")
def a25(spark, d):
    return normalize.value_summary(normalize.normalise(fx.coarse(spark, d), SPEC, "cell_line"), "cell_line").select("cell_line", r6("mean_nonzero"), r6("max_nonzero"))


# ---------------------------------------------------------------- lines

VLONG = VECTORS + ", lv AS (SELECT cell_id, pert, is_control, batch, cell_line, UNNEST(generate_series(1, 64)) AS i, UNNEST(v) AS x FROM emb)"
DIRS = VLONG + """, mm AS (SELECT cell_line, i, AVG(CASE WHEN NOT is_control THEN x END) - AVG(CASE WHEN is_control THEN x END) AS dd FROM lv GROUP BY 1, 2),
dirs AS (SELECT cell_line, i, dd / SQRT(SUM(dd * dd) OVER (PARTITION BY cell_line)) AS x FROM mm)"""


@query("a19_v_vector", f"{DIRS} SELECT cell_line, CAST(i AS INT) AS i, ROUND(x, 6) AS x FROM dirs")
def a19(spark, d):
    return lines.directions(fx.vectors(spark, d), SPEC).select("cell_line", F.posexplode("direction").alias("p", "x")).select("cell_line", (F.col("p") + 1).alias("i"), r6("x"))


@query("a20_pairwise_cos", f"{DIRS} SELECT a.cell_line AS line_a, b.cell_line AS line_b, ROUND(SUM(a.x * b.x), 6) AS cosine, SUM(a.x * b.x) > 0.5 AS parallel FROM dirs a JOIN dirs b ON a.i = b.i AND a.cell_line < b.cell_line GROUP BY 1, 2")
def a20(spark, d):
    return lines.direction_cosines(lines.directions(fx.vectors(spark, d), SPEC), SPEC).select("line_a", "line_b", r6("cosine"), "parallel")


@query("p37_small_lines", f"{COARSE} SELECT cell_id, cell_line FROM obs WHERE cell_line IN (SELECT cell_line FROM obs GROUP BY 1 HAVING COUNT(*) >= 100)")
def p37(spark, d):
    return lines.drop_small_lines(fx.coarse(spark, d).obs, SPEC).select("cell_id", "cell_line")


@query("a29_line_means", f"{COARSE}{DENSE} SELECT gene_name, cell_line, ROUND(AVG(value), 6) AS mean FROM grid GROUP BY 1, 2")
def a29(spark, d):
    return lines.line_means(fx.coarse(spark, d)).select("gene_name", "cell_line", r6("mean"))


LOADS = VLONG + ", ld AS (SELECT CAST(cell_id AS INT) AS pc, 'g' || i AS gene_name, x AS loading FROM lv)"


def loadings(spark, d):
    rows = fx.vectors(spark, d).select(F.col("cell_id").cast("int").alias("pc"), F.posexplode("v").alias("i", "loading"))
    return rows.select("pc", F.concat(F.lit("g"), F.col("i") + 1).alias("gene_name"), "loading")


@query("w11_top_loadings", f"{LOADS} SELECT pc, gene_name, ROUND(loading, 6) AS loading, CAST(rn AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pc ORDER BY ABS(loading) DESC, gene_name) AS rn FROM ld) WHERE rn <= 5")
def w11(spark, d):
    return lines.top_loadings(loadings(spark, d), 5).select("pc", "gene_name", r6("loading"), "rank")


@query("j12_driver_table", f"""{COARSE}{DENSE}, ld AS (SELECT gene_name, LENGTH(gene_name) * 10 + CAST(split_part(gene_name, '#', 2) AS INT) AS loading FROM var),
top AS (SELECT 0 AS pc, gene_name, CAST(loading AS DOUBLE) AS loading, CAST(ROW_NUMBER() OVER (ORDER BY loading DESC, gene_name) AS INT) AS rank FROM ld ORDER BY loading DESC, gene_name LIMIT 5),
mn AS (SELECT gene_name, AVG(CASE WHEN batch = 0 THEN value END) AS b0, AVG(CASE WHEN batch = 1 THEN value END) AS b1 FROM grid JOIN obs USING (cell_id) GROUP BY 1)
SELECT pc, gene_name, loading, rank, ROUND(b0, 6) AS line_0, ROUND(b1, 6) AS line_1 FROM top JOIN mn USING (gene_name)""")
def j12(spark, d):
    m = fx.coarse(spark, d)
    loads = m.var.select(F.lit(0).alias("pc"), "gene_name", (F.length("gene_name") * 10 + F.split_part("gene_name", F.lit("#"), F.lit(2)).cast("int")).cast("double").alias("loading"))
    return lines.driver_table(loads, m, 5, "batch").select("pc", "gene_name", "loading", "rank", r6("0", "line_0"), r6("1", "line_1"))


@query("a28_driver_shift", f"{LOADS}, pp AS (SELECT i, AVG(x) AS a, AVG(x * 2) AS b FROM lv GROUP BY 1) SELECT pc, CAST(i - 1 AS INT) AS i, ROUND(a, 6) AS mean_pre, ROUND(b, 6) AS mean_post, ROUND(b - a, 6) AS shift FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pc ORDER BY ABS(loading) DESC, CAST(SUBSTR(gene_name, 2) AS INT)) AS rn FROM ld) JOIN pp ON gene_name = 'g' || i WHERE rn <= 5")
def a28(spark, d):
    rows = fx.vectors(spark, d)
    loads = rows.select(F.col("cell_id").cast("int").alias("pc"), F.posexplode("v").alias("i", "loading"))
    both = rows.select(F.col("v").alias("pre"), F.expr("transform(v, x -> x * 2)").alias("delta"))
    return diagnostics.driver_shift(both, loads, 5).select("pc", "i", r6("mean_pre"), r6("mean_post"), r6("shift"))


# ---------------------------------------------------------------- metacells

@query("n12_graining", f"""{COARSE} SELECT pert, n AS n_cells, CAST(GREATEST(1, FLOOR(n / CASE WHEN n < 30 THEN n WHEN n < 100 THEN 5 WHEN n < 500 THEN 10 ELSE 15 END)) AS BIGINT) AS n_metacells FROM (SELECT pert, COUNT(*) AS n FROM obs GROUP BY 1)""")
def n12(spark, d):
    return metacells.grainings(fx.coarse(spark, d).obs, "pert")


META = VLONG + """, z AS (SELECT cell_line, pert, COUNT(*) AS n FROM emb GROUP BY 1, 2), zz AS (SELECT cell_line, pert, CAST(GREATEST(1, FLOOR(n / CASE WHEN n < 30 THEN n WHEN n < 100 THEN 5 WHEN n < 500 THEN 10 ELSE 15 END)) AS BIGINT) AS k FROM z),
lab AS (SELECT e.cell_id, (ROW_NUMBER() OVER (PARTITION BY e.cell_line, e.pert ORDER BY e.cell_id) - 1) % k AS metacell FROM emb e JOIN zz USING (cell_line, pert)),
mc AS (SELECT cell_line, pert, metacell, i, AVG(x) AS x, COUNT(*) AS n FROM lv JOIN lab USING (cell_id) GROUP BY 1, 2, 3, 4)"""


def meta(spark, d):
    return metacells.profiles(metacells.dealt_metacells(fx.vectors(spark, d), "cell_line", "pert"), "cell_line", "pert")


@query("a16_metacell_mean", f"{META} SELECT cell_line, pert, metacell, n AS n_cells_in_metacell, CAST(i AS INT) AS i, ROUND(x, 6) AS x FROM mc")
def a16(spark, d):
    rows = meta(spark, d).select("cell_line", "pert", "metacell", "n_cells_in_metacell", F.posexplode("v").alias("p", "x"))
    return rows.select("cell_line", "pert", "metacell", "n_cells_in_metacell", (F.col("p") + 1).alias("i"), r6("x"))


@query("a17_inner_variance", f"""{META}, pv AS (SELECT cell_line, pert, i, VAR_POP(x * x) AS v, AVG(x * x) AS m, COUNT(*) AS n FROM mc GROUP BY 1, 2, 3)
SELECT cell_line, pert, MAX(n) AS n_metacells, ROUND(CASE WHEN MAX(n) < 2 THEN 0.0 ELSE AVG(v) / CASE WHEN AVG(m) <= 1e-10 THEN 1.0 ELSE AVG(m) END END, 6) AS inner_variance FROM pv GROUP BY 1, 2""")
def a17(spark, d):
    squared = meta(spark, d).withColumn("v", F.expr("transform(v, x -> x * x)"))
    return metacells.inner_variance(squared, "cell_line", "pert").select("cell_line", "pert", "n_metacells", r6("inner_variance"))


@query("a18_centroids", f"""{META}, pm AS (SELECT pert, i, AVG(x) AS m FROM mc WHERE pert <> '0' GROUP BY 1, 2)
SELECT CAST(i - 1 AS BIGINT) AS i, ROUND((SELECT AVG(x) FROM mc c WHERE c.pert = '0' AND c.i = pm.i), 6) AS c_ctrl, ROUND(AVG(m), 6) AS o_pert_macro, ROUND((SELECT AVG(x) FROM mc c WHERE c.pert <> '0' AND c.i = pm.i), 6) AS o_pert_micro FROM pm GROUP BY i""")
def a18(spark, d):
    return metacells.centroids(meta(spark, d), "0").select("i", r6("c_ctrl"), r6("o_pert_macro"), r6("o_pert_micro"))


@query("a24_metacell_rollup", f"""{META}, u AS (SELECT cell_line, pert AS split, metacell, MAX(n) AS n FROM mc GROUP BY 1, 2, 3)
SELECT CASE WHEN GROUPING(cell_line) = 1 THEN 'TOTAL' ELSE cell_line END AS cell_line, CASE WHEN GROUPING(split) = 1 THEN 'TOTAL' ELSE split END AS split, COUNT(*) AS n_metacells, CAST(SUM(n) AS BIGINT) AS n_cells
FROM u GROUP BY GROUPING SETS ((cell_line, split), (cell_line), ())""")
def a24(spark, d):
    return metacells.rollup(meta(spark, d).withColumnRenamed("pert", "split"))


@query("p38_large_enough", f"{VECTORS} SELECT cell_id FROM emb WHERE (cell_line, pert) IN (SELECT (cell_line, pert) FROM emb GROUP BY cell_line, pert HAVING COUNT(*) >= 25)")
def p38(spark, d):
    from dataclasses import replace

    return metacells.large_enough(fx.vectors(spark, d), replace(SPEC, min_cells_per_split=25), "cell_line", "pert").select("cell_id")


# ---------------------------------------------------------------- counterfactual

KNN = VECTORS + """, prs AS (SELECT q.cell_id, c.cell_id AS neighbour, list_distance(q.v, c.v) AS dist FROM emb q JOIN emb c ON {on}),
nn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cell_id ORDER BY dist, neighbour) AS rn FROM prs), near AS (SELECT * FROM nn WHERE rn <= {k})"""
PERT_ON, CTRL_ON = "NOT q.is_control AND c.is_control", "q.is_control AND c.is_control AND q.cell_id <> c.cell_id"


def sides(spark, d):
    v = fx.vectors(spark, d)
    return v.filter("NOT is_control"), v.filter("is_control")


@query("j09_knn", f"{KNN.format(on=PERT_ON, k=5)} SELECT cell_id, neighbour, ROUND(dist, 6) AS distance, CAST(rn AS INT) AS rank FROM near")
def j09(spark, d):
    perturbed, controls = sides(spark, d)
    return neighbours.nearest(perturbed, controls, 5).select("cell_id", "neighbour", r6("distance"), "rank")


@query("j10_control_knn", f"{KNN.format(on=CTRL_ON, k=3)} SELECT cell_id, neighbour, ROUND(dist, 6) AS distance, CAST(rn AS INT) AS rank FROM near")
def j10(spark, d):
    controls = sides(spark, d)[1]
    return neighbours.nearest(controls, controls, 3, exclude_self=True).select("cell_id", "neighbour", r6("distance"), "rank")


@query("j11_knn_regression", f"{KNN.format(on=PERT_ON, k=5)} SELECT cell_id, ROUND(AVG(neighbour % 7), 6) AS score FROM near GROUP BY 1")
def j11(spark, d):
    perturbed, controls = sides(spark, d)
    values = controls.select("cell_id", (F.col("cell_id") % 7).cast("double").alias("score"))
    return neighbours.regress(neighbours.nearest(perturbed, controls, 5), values, "score").select("cell_id", r6("score"))


DELTA = KNN.format(on=PERT_ON, k=20) + """, cl AS (SELECT cell_id, UNNEST(generate_series(1, 64)) AS i, UNNEST(v) AS x FROM emb),
ba AS (SELECT n.cell_id, i, AVG(x) AS b FROM near n JOIN cl ON cl.cell_id = n.neighbour GROUP BY 1, 2), dl AS (SELECT ba.cell_id, i, x, x - b AS delta FROM ba JOIN cl USING (cell_id, i))"""


def deltas(spark, d):
    perturbed, controls = sides(spark, d)
    basal = neighbours.mean_profile(neighbours.nearest(perturbed, controls, 20), controls, about=20 * perturbed.count())
    return perturbed.join(basal, "cell_id").withColumn("delta", vectors.minus("v", "basal"))


@query("n19_knn_delta", f"{DELTA} SELECT cell_id, CAST(i AS INT) AS i, ROUND(delta, 6) AS delta FROM dl")
def n19(spark, d):
    return deltas(spark, d).select("cell_id", F.posexplode("delta").alias("p", "delta")).select("cell_id", (F.col("p") + 1).alias("i"), r6("delta"))


@query("n18_project_out", f"""{DIRS}, dot AS (SELECT lv.cell_id, SUM(lv.x * dirs.x) AS s FROM lv JOIN dirs ON dirs.i = lv.i AND dirs.cell_line = 'A' GROUP BY 1)
SELECT lv.cell_id, CAST(lv.i AS INT) AS i, ROUND(lv.x - dot.s * dirs.x, 6) AS x FROM lv JOIN dot USING (cell_id) JOIN dirs ON dirs.i = lv.i AND dirs.cell_line = 'A'""")
def n18(spark, d):
    v = fx.vectors(spark, d)
    one = lines.directions(v, SPEC).filter("cell_line = 'A'").select("direction")
    rows = v.crossJoin(F.broadcast(one)).select("cell_id", vectors.project_out("v", "direction").alias("w"))
    return rows.select("cell_id", F.posexplode("w").alias("p", "x")).select("cell_id", (F.col("p") + 1).alias("i"), r6("x"))


@query("n26_stability", f"{DELTA}, ln AS (SELECT cell_id, SQRT(SUM(delta * delta)) AS l FROM dl GROUP BY 1) SELECT ROUND(1 / (STDDEV_POP(l) + 1e-6), 6) AS stability FROM ln")
def n26(spark, d):
    return calibrate.stability(deltas(spark, d)).select(r6("stability"))


@query("n25_rank_disruption", f"""{DELTA}, r AS (SELECT i, RANK() OVER (PARTITION BY i ORDER BY x) + (COUNT(*) OVER (PARTITION BY i, x) - 1) / 2 AS a, RANK() OVER (PARTITION BY i ORDER BY delta) + (COUNT(*) OVER (PARTITION BY i, delta) - 1) / 2 AS b FROM dl)
SELECT ROUND(1 - AVG(rho), 6) AS rank_disruption FROM (SELECT i, CORR(a, b) AS rho FROM r GROUP BY 1)""")
def n25(spark, d):
    pairs = deltas(spark, d).select("cell_id", F.posexplode(F.arrays_zip("v", "delta")).alias("i", "z")).select("cell_id", "i", F.col("z.v").alias("pre"), F.col("z.delta").alias("post"))
    return calibrate.rank_disruption(pairs).select(r6("rank_disruption"))


@query("n27_discrimination", f"""{DELTA}, pr AS (SELECT a.cell_id AS a, b.cell_id AS b FROM (SELECT DISTINCT cell_id FROM dl) a JOIN (SELECT DISTINCT cell_id FROM dl) b ON b.cell_id = a.cell_id + 10),
cs AS (SELECT pr.a, 1 - SUM(p.x * q.x) / (SQRT(SUM(p.x * p.x)) * SQRT(SUM(q.x * q.x))) AS pre, 1 - SUM(p.delta * q.delta) / (SQRT(SUM(p.delta * p.delta)) * SQRT(SUM(q.delta * q.delta))) AS post
FROM pr JOIN dl p ON p.cell_id = pr.a JOIN dl q ON q.cell_id = pr.b AND q.i = p.i GROUP BY 1, pr.b)
SELECT ROUND(AVG(post) / (AVG(pre) + 1e-10), 6) AS ratio, ROUND(1 / (1 + ABS(AVG(post) / (AVG(pre) + 1e-10) - 1)), 6) AS discrimination FROM cs""")
def n27(spark, d):
    df = deltas(spark, d)
    ids = df.select(F.col("cell_id").alias("a"))
    pairs = ids.join(df.select(F.col("cell_id").alias("b")), F.col("b") == F.col("a") + 10)
    before = calibrate.cosine_distances(pairs, df, column="v")
    return calibrate.discrimination(before, calibrate.cosine_distances(pairs, df, column="delta")).select(r6("ratio"), r6("discrimination"))


# ---------------------------------------------------------------- calibration

POINTS = """WITH pt AS (SELECT CAST(p_partkey AS VARCHAR) AS point, p_size / 50 AS rank_preservation, (p_partkey * 37 % 101) / 101 AS discrimination, (p_partkey * 53 % 97) / 97 AS stability FROM part),
front AS (SELECT * FROM pt a WHERE NOT EXISTS (SELECT 1 FROM pt b WHERE b.rank_preservation >= a.rank_preservation AND b.discrimination >= a.discrimination AND b.stability >= a.stability
  AND (b.rank_preservation > a.rank_preservation OR b.discrimination > a.discrimination OR b.stability > a.stability)))"""


def points(spark, d):
    k = F.col("p_partkey")
    return fx.table(spark, d, "part").select(k.cast("string").alias("point"), (F.col("p_size") / 50).alias("rank_preservation"), (k * 37 % 101 / 101).alias("discrimination"), (k * 53 % 97 / 97).alias("stability"))


@query("n28_pareto", f"{POINTS} SELECT point FROM front")
def n28(spark, d):
    return calibrate.pareto_front(points(spark, d)).select("point")


@query("n28_front_distance", f"""{POINTS}, u AS (SELECT point, stability, (rank_preservation - MIN(rank_preservation) OVER ()) / (MAX(rank_preservation) OVER () - MIN(rank_preservation) OVER () + 1e-9) AS x,
(discrimination - MIN(discrimination) OVER ()) / (MAX(discrimination) OVER () - MIN(discrimination) OVER () + 1e-9) AS y FROM pt), f AS (SELECT DISTINCT x, y FROM u JOIN front USING (point)),
d AS (SELECT u.point, MIN(SQRT(POWER(u.x - f.x, 2) + POWER(u.y - f.y, 2))) AS d FROM u, f GROUP BY 1),
r AS (SELECT point, (RANK() OVER (ORDER BY stability) + (COUNT(*) OVER (PARTITION BY stability) - 1) / 2 - 1) / (COUNT(*) OVER () - 1) AS r FROM u)
SELECT point, ROUND(d, 6) AS distance, ROUND(20 + 160 * EXP(-4 * d), 6) AS marker_size, ROUND(r, 6) AS score_rank FROM d JOIN r USING (point)""")
def n28_front_distance(spark, d):
    p = points(spark, d)
    found = diagnostics.front_distances(p, calibrate.pareto_front(p), "rank_preservation", "discrimination", "stability")
    return found.select("point", r6("distance"), r6("marker_size"), r6("score_rank"))


@query("w20_density", f"""{COARSE}{QC}, v AS (SELECT total_counts AS v FROM qc), e AS (SELECT COUNT(*) AS n, STDDEV_SAMP(v) * POWER(COUNT(*), -0.2) AS bw, MIN(v) AS lo, MAX(v) AS hi FROM v),
s AS (SELECT n, bw, lo - 3 * bw AS low, (hi - lo + 6 * bw) / 511 AS step FROM e), p AS (SELECT (v - low) / step AS p, LEAST(FLOOR((v - low) / step), 510) AS i FROM v, s),
b AS (SELECT i, SUM(w) AS w FROM (SELECT i, 1 - (p - i) AS w FROM p UNION ALL SELECT i + 1, p - i FROM p) GROUP BY 1), g AS (SELECT UNNEST(range(512)) AS g)
SELECT ROUND(ANY_VALUE(low + g * step), 4) AS x, ROUND(1000 * SUM(w * EXP(-0.5 * POWER((g - i) * step / bw, 2)) / (n * bw * SQRT(2 * PI()))), 6) AS density FROM g, b, s GROUP BY g""")
def w20_density(spark, d):
    """Density of the cells' total counts, in thousandths."""
    return diagnostics.density(metrics(spark, d), "total_counts").select(F.round("x", 4).alias("x"), F.round(1000 * F.col("density"), 6).alias("density"))


PCT = lambda o: f"(SELECT (COUNT_IF(b.{o} < a.{o}) + COUNT_IF(b.{o} <= a.{o}) + 1) * 50.0 / COUNT(*) FROM pt b)"
UNIT = lambda o: f"COALESCE((a.{o} - (SELECT MIN({o}) FROM pt)) / NULLIF((SELECT MAX({o}) - MIN({o}) FROM pt), 0), 1.0)"


@query("n29_utopian", f"""{POINTS}, sc AS (SELECT point, SQRT(1.5 * POWER(1 - {UNIT('rank_preservation')}, 2) + POWER(1 - {UNIT('discrimination')}, 2) + POWER(1 - {UNIT('stability')}, 2)) AS dist,
{PCT('rank_preservation')} >= 30 AND {PCT('discrimination')} >= 30 AND {PCT('stability')} >= 30 AS high FROM front a)
SELECT point, ROUND(dist, 6) AS distance FROM sc WHERE high OR NOT (SELECT BOOL_OR(high) FROM sc) ORDER BY dist, point LIMIT 1""")
def n29(spark, d):
    return calibrate.choose(points(spark, d), SPEC).select("point", r6("distance"))


@query("w12_avg_rank", "SELECT p_partkey, RANK() OVER (PARTITION BY p_type ORDER BY p_size) + (COUNT(*) OVER (PARTITION BY p_type, p_size) - 1) / 2 AS rank FROM part")
def w12(spark, d):
    return statistics.average_ranks(fx.table(spark, d, "part").select("p_partkey", "p_type", "p_size"), "p_size", "p_type").select("p_partkey", "rank")


@query("w13_percentileofscore", "SELECT p_partkey, ROUND((SELECT (COUNT_IF(b.p_size < a.p_size) + COUNT_IF(b.p_size <= a.p_size) + 1) * 50.0 / COUNT(*) FROM part b), 6) AS p_size_pct FROM part a")
def w13(spark, d):
    return statistics.percentile_of_score(fx.table(spark, d, "part").select("p_partkey", "p_size"), "p_size").select("p_partkey", r6("p_size_pct"))


@query("w14_min_max", "SELECT p_partkey, ROUND((p_size - MIN(p_size) OVER ()) / (MAX(p_size) OVER () - MIN(p_size) OVER ()), 6) AS unit FROM part")
def w14(spark, d):
    return statistics.min_max(fx.table(spark, d, "part").select("p_partkey", "p_size"), "p_size", "unit").select("p_partkey", r6("unit"))


# ---------------------------------------------------------------- diagnostics

@query("w15_ecdf", f"{COARSE}{QC} SELECT DISTINCT total_counts AS value, ROUND(CUME_DIST() OVER (ORDER BY total_counts), 6) AS share FROM qc")
def w15(spark, d):
    return diagnostics.ecdf(metrics(spark, d), "total_counts").select("value", r6("share"))


@query("w16_log_histogram", f"{COARSE}{QC} SELECT LEAST(CAST(FLOOR((LOG10(total_counts) - 1) / (3.0 / 50)) AS BIGINT), 49) AS bin, COUNT(*) AS n FROM qc WHERE total_counts > 0 AND LOG10(total_counts) BETWEEN 1 AND 4 GROUP BY 1")
def w16(spark, d):
    return diagnostics.log_histogram(metrics(spark, d), "total_counts", 1.0, 4.0)


@query("w17_hist2d", f"""{COARSE}{QC} SELECT LEAST(CAST(FLOOR(total_counts / (3000 / 30.0)) AS BIGINT), 29) AS x_bin, LEAST(CAST(FLOOR(n_genes_by_counts / (30 / 30.0)) AS BIGINT), 29) AS y_bin, COUNT(*) AS n
FROM qc WHERE total_counts BETWEEN 0 AND 3000 AND n_genes_by_counts BETWEEN 0 AND 30 GROUP BY 1, 2""")
def w17(spark, d):
    return diagnostics.histogram_2d(metrics(spark, d), "total_counts", "n_genes_by_counts", (0.0, 3000.0), (0.0, 30.0), 30)


@query("a23_batch_summary", f"{COARSE} SELECT COUNT(*) AS n_batches, MIN(n) AS smallest, MAX(n) AS largest, AVG(n) AS mean FROM (SELECT batch, COUNT(*) AS n FROM obs GROUP BY 1)")
def a23(spark, d):
    return diagnostics.batch_summary(fx.coarse(spark, d).obs)


@query("a26_attrition", f"""{COARSE}{QC}, st AS (SELECT 0 AS step, 'raw' AS name, (SELECT COUNT(*) FROM obs) AS c, (SELECT COUNT(*) FROM var) AS g UNION ALL
SELECT 1, 'cells', (SELECT COUNT_IF({GOOD}) FROM qc), (SELECT COUNT(*) FROM var WHERE NOT (gene_name LIKE 'Brand#24%' OR gene_name LIKE 'Brand#25%')))
SELECT step, name, c AS n_cells, g AS n_genes, ROUND(100.0 * c / (SELECT c FROM st WHERE step = 0), 6) AS pct_of_start, ROUND(100.0 * g / (SELECT MAX(g) FROM st), 6) AS pct_of_max_genes FROM st""")
def a26(spark, d):
    m = fx.coarse(spark, d)
    t = qc.triage_cells(m, SPEC)
    stages = diagnostics.stage_counts({"raw": (m.obs, m.var), "cells": (t.obs, t.var)})
    return diagnostics.attrition(stages).select("step", "name", "n_cells", "n_genes", r6("pct_of_start"), r6("pct_of_max_genes"))


@query("r05_efficiency_summary", f"""{COARSE}{JUDGED}, e AS (SELECT pert, COUNT_IF(kept) / COUNT(*) AS e, COUNT_IF(NOT kept) AS n FROM judged WHERE pert <> 'non-targeting' GROUP BY 1)
SELECT COUNT(*) AS n_perturbations, ROUND(MEDIAN(e), 6) AS median_efficiency, COUNT_IF(e < 0.5) AS n_low, CAST(SUM(n) AS BIGINT) AS n_escaped FROM e""")
def r05(spark, d):
    return diagnostics.efficiency_summary(escapers.escaper_stats(fx.coarse(spark, d), SPEC)).select("n_perturbations", r6("median_efficiency"), "n_low", "n_escaped")


# ---------------------------------------------------------------- fitted operators, rows checked by tests

@query("n04_hvg")
def n04(spark, d):
    return hvg.top_genes(hvg.normalised_variance(fx.fine(spark, d)), 40).select("gene_name", r6("score"), "is_hvg")


@query("n05_svd")
def n05(spark, d):
    from screenspark.operators import embed

    m = normalize.scale(fx.coarse(spark, d), SPEC)
    return embed.project_sparse(m, embed.truncated_svd(m, 8))


@query("n06_harmony")
def n06(spark, d):
    from screenspark.operators import batch

    return batch.harmony(fx.vectors(spark, d), rounds=5).select("cell_id", "batch", "corrected")


@query("n07_doublets")
def n07(spark, d):
    from screenspark.operators import doublets

    return doublets.doublet_scores(fx.coarse(spark, d), SPEC, components=8)


@query("n09_lines")
def n09(spark, d):
    v = fx.vectors(spark, d)
    return lines.assign_lines(v.select("cell_id", "pert"), v, k=3)


@query("n10_estimate_k")
def n10(spark, d):
    return spark.createDataFrame([(lines.estimate_lines(fx.vectors(spark, d)),)], "k int")


@query("n13_metacells")
def n13(spark, d):
    return metacells.cluster_metacells(fx.vectors(spark, d), "cell_line", "pert").select("cell_id", "cell_line", "pert", "metacell")


@query("n15_pca")
def n15(spark, d):
    from screenspark.operators import embed

    v = fx.vectors(spark, d)
    return embed.project_dense(v, embed.pca(v.filter("batch <> 3"), 10)).select("cell_id", "pcs")


@query("n21_hybrid")
def n21(spark, d):
    from dataclasses import replace

    v = fx.vectors(spark, d)
    model = counterfactual.fit(v.filter("batch <> 3"), replace(SPEC, mode="hybrid", n_pcs=10, neighbours=5))
    return model.transform(v).select("cell_id", "is_control", "delta")


@query("n24_sweep")
def n24(spark, d):
    from dataclasses import replace

    return calibrate.sweep(fx.vectors(spark, d), replace(SPEC, mode="explore"))


@query("pipeline_full")
def pipeline_full(spark, d):
    from dataclasses import replace

    from screenspark.plans import pipeline

    spec = replace(SPEC, min_cells_per_perturbation=1, min_cells_per_line=1, min_cells_per_split=1, n_top_genes=15, n_components=8, n_pcs=5, neighbours=3, min_cells_expressing=1, harmony_rounds=3)
    return pipeline.run(fx.coarse(spark, d), spec).tables["deltas"].select("cell_line", "split", "pert", "metacell", "delta")


# The queries of sources and sinks, and of models with given parameters, register themselves.
from screenspark.plans import catalog_io, catalog_models  # noqa: E402, F401
