"""Queries of sources, sinks and detection: what is written is read again and compared."""

from __future__ import annotations

import contextlib
from dataclasses import replace

from pyspark.sql import functions as F

from screenspark.model import stacked
from screenspark.operators import detect, doublets, genes, hvg, lines, qc, splits
from screenspark.plans import report
from screenspark.plans.catalog import DELTA, DENSE, META, QC, RANKED, SPLIT, STEPS, ZERO, deltas, meta, query, ranked
from screenspark.sources import fixtures as fx
from screenspark.sources import matrix
from screenspark.sources.fixtures import COARSE, CONTROL, FINE, SPEC, VECTORS
from screenspark.sources.storage import new_path
from screenspark.spec import parse_spec

ENTRIES = f"{COARSE} SELECT cell_id, gene_name, value FROM x"


def brands(m):
    return [r.gene_name for r in m.var.orderBy("gene_name").collect()]


def wide(m, names):
    """One row per cell with its counts in the order of ``names``."""
    found = m.x.groupBy("cell_id").agg(F.map_from_entries(F.collect_list(F.struct("gene_name", "value"))).alias("of"))
    counts = F.array(*[F.coalesce(F.try_element_at("of", F.lit(n)), F.lit(0.0)) for n in names])
    return found.select("cell_id", counts.alias("counts"))


# ---------------------------------------------------------------- matrices

@query("s01_sparse_cache", ENTRIES)
def s01(spark, d):
    m, raw, cache = fx.coarse(spark, d), new_path(spark, "raw"), new_path(spark, "cache")
    names = brands(m)
    wide(m, names).write.parquet(raw)
    matrix.load(spark, raw, cache, names)
    matrix.clean_up(spark, [raw], dry_run=False)  # so the second time it must come from the sparse copy
    return matrix.load(spark, raw, cache, names).x.select("cell_id", "gene_name", "value")


@query("s02_dense_to_sparse", ENTRIES)
def s02(spark, d):
    m = fx.coarse(spark, d)
    names = brands(m)
    return matrix.from_wide(wide(m, names), names).x.select("cell_id", "gene_name", "value")


@query("s03_ensure_sparse", ENTRIES)
def s03(spark, d):
    m = fx.coarse(spark, d)
    grid = m.obs.select("cell_id").crossJoin(m.var.select("gene_name")).join(m.x, ["cell_id", "gene_name"], "left")
    return replace(m, x=grid.withColumn("value", F.coalesce("value", F.lit(0.0)))).ensure_sparse().x.select("cell_id", "gene_name", "value")


@query("s04_lazy_read", f"{COARSE} SELECT cell_id, gene_name, value FROM x WHERE gene_name = 'Brand#11' AND value >= 2")
def s04(spark, d):
    path = new_path(spark, "matrix")
    m = fx.coarse(spark, d)
    matrix.write_matrix(m, path, gene_ranges=True)
    return matrix.read_genes(spark, path, m.var.filter("gene_name = 'Brand#11'")).x.filter("value >= 2").select("cell_id", "gene_name", "value")


@query("s05_droplets", f"{COARSE} SELECT COUNT(DISTINCT cell_id) AS n_droplets, COUNT(DISTINCT gene_name) AS n_genes, COUNT(*) AS n_entries, SUM(value) AS total FROM x")
def s05(spark, d):
    path = new_path(spark, "droplets")
    fx.coarse(spark, d).x.write.parquet(path)
    m = matrix.read_droplets(spark, path)
    sizes = m.obs.agg(F.count("*").alias("n_droplets")).crossJoin(m.var.agg(F.count("*").alias("n_genes")))
    return sizes.crossJoin(m.x.agg(F.count("*").alias("n_entries"), F.sum("value").alias("total")))


GENE_MAP = """WITH ids AS (SELECT DISTINCT p_type || ':' || p_brand AS id, CASE WHEN p_brand < 'Brand#20' THEN p_type END AS symbol FROM part),
named AS (SELECT id, COALESCE(symbol, id) AS nm FROM ids), k AS (SELECT id, nm, ROW_NUMBER() OVER (PARTITION BY nm ORDER BY id) - 1 AS k FROM named)
SELECT id AS original_gene_id, CASE WHEN k > 0 THEN nm || '_' || k ELSE nm END AS gene_name FROM k"""


def ids_and_map(spark, d):
    ids = fx.table(spark, d, "part").select(F.concat_ws(":", "p_type", "p_brand").alias("gene_name"), "p_type", "p_brand").distinct()
    return ids.select("gene_name"), ids.filter("p_brand < 'Brand#20'").select(F.col("gene_name").alias("gene_id"), F.col("p_type").alias("symbol"))


@query("s06_gene_map", GENE_MAP)
def s06(spark, d):
    path = new_path(spark, "gene-map")
    ids, known = ids_and_map(spark, d)
    known.write.csv(path, header=True)
    return detect.harmonise(ids, matrix.read_gene_map(spark, path)).select("original_gene_id", "gene_name")


@query("s07_gene_lookup", GENE_MAP)
def s07(spark, d):
    ids, known = ids_and_map(spark, d)  # any DataFrame can be the lookup
    return detect.harmonise(ids, known).select("original_gene_id", "gene_name")


@query("u04_stacked", f"{COARSE} SELECT gene_name, COUNT(*) AS n, SUM(value) AS total, (SELECT COUNT(*) FROM obs) AS n_cells FROM x GROUP BY 1")
def u04(spark, d):
    m = fx.coarse(spark, d)
    m = stacked([m.keep_cells(m.obs.filter(f"cell_id % 3 = {i}")) for i in range(3)])
    return m.x.groupBy("gene_name").agg(F.count("*").alias("n"), F.sum("value").alias("total")).crossJoin(F.broadcast(m.n_cells()))


# ---------------------------------------------------------------- sinks

@query("s08_split_files", f"{COARSE}{ZERO} SELECT split, cell_id, pert FROM zs")
def s08(spark, d):
    m, path = fx.coarse(spark, d), new_path(spark, "splits")
    matrix.write_matrix(replace(m, obs=splits.zero_shot(m, SPEC)), path, ("split",))
    return matrix.read_matrix(spark, path).obs.select("split", "cell_id", "pert")


@query("s09_split_manifest", f"{COARSE}{SPLIT} SELECT split, pert, CAST(42 AS BIGINT) AS seed FROM lab")
def s09(spark, d):
    m, path = fx.coarse(spark, d), f"{new_path(spark, 'manifest')}.json"
    labels = splits.split_labels(splits.effect_bins(splits.mean_shift(m, SPEC), SPEC), SPEC)
    matrix.write_manifest(spark, matrix.split_manifest(labels, SPEC.seed), path)
    found = spark.read.schema("train_labels array<string>, val_labels array<string>, test_labels array<string>, seed bigint").json(path)
    rows = [found.select(F.lit(s).alias("split"), F.explode(f"{s}_labels").alias("pert"), "seed") for s in ("train", "val", "test")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("s11_hvg_manifest", f"{FINE}{RANKED} SELECT gene_name, (hv AND NOT gone) OR tg AS is_core FROM st WHERE (hv AND NOT gone) OR tg OR cy")
def s11(spark, d):
    path = f"{new_path(spark, 'manifest')}.json"
    matrix.write_manifest(spark, hvg.gene_manifest(ranked(spark, d)), path)
    found = spark.read.schema("hvg_names array<string>, core_features array<string>").json(path)
    return found.select(F.explode("hvg_names").alias("gene_name"), "core_features").select("gene_name", F.expr("array_contains(core_features, gene_name)").alias("is_core"))


NARROW = "ROUND(CAST(CAST({x} AS FLOAT) AS DOUBLE), 4)"


@query("s12_vectors_sink", f"{VECTORS}, lv AS (SELECT cell_id, cell_line, UNNEST(generate_series(1, 64)) AS i, UNNEST(v) AS x FROM emb) SELECT cell_id, cell_line, CAST(i AS INT) AS i, {NARROW.format(x='x')} AS x FROM lv")
def s12(spark, d):
    path = new_path(spark, "vectors")
    matrix.write_vectors(fx.vectors(spark, d), path, ("cell_line",))
    rows = spark.read.parquet(path).select("cell_id", "cell_line", F.posexplode("v").alias("p", "x"))
    return rows.select("cell_id", "cell_line", (F.col("p") + 1).alias("i"), F.round(F.col("x").cast("double"), 4).alias("x"))


@query("s13_obs_sink", f"{COARSE} SELECT cell_id, pert, cell_line, batch FROM obs")
def s13(spark, d):
    path = new_path(spark, "obs")
    matrix.write_vectors(fx.coarse(spark, d).obs, path)
    return spark.read.parquet(path).select("cell_id", "pert", "cell_line", "batch")


@query("s14_recovery", f"{COARSE} SELECT pert, COUNT(*) AS n_cells FROM obs GROUP BY 1")
def s14(spark, d):
    path = new_path(spark, "stage")
    made = []

    def make():
        made.append(1)
        return fx.coarse(spark, d).obs.groupBy("pert").agg(F.count("*").alias("n_cells"))

    for _ in range(2):
        found = matrix.checkpointed(spark, path, make)
    return found.filter(F.lit(len(made) == 1))


@query("s14_shards", f"{COARSE} SELECT pert, COUNT(*) AS n_cells, TRUE AS recovered FROM obs GROUP BY 1")
def s14_shards(spark, d):
    """A run that stops in the third of five shards, and one that makes only what is missing."""
    path, made = new_path(spark, "shards"), []
    obs = fx.coarse(spark, d).obs.withColumn("bucket", F.pmod(F.crc32(F.col("pert").cast("binary")), F.lit(5)))

    def make(shard):
        made.append(shard)
        if made == ["0", "1", "2"]:
            raise InterruptedError
        return obs.filter(F.col("bucket") == int(shard)).groupBy("pert").agg(F.count("*").alias("n_cells"))

    with contextlib.suppress(InterruptedError):
        matrix.recovered(spark, path, list("01234"), make)
    found = matrix.recovered(spark, path, list("01234"), make)
    return found.select("pert", "n_cells", F.lit(made == list("012234")).alias("recovered"))


@query("s15_metacell_sink", f"{META} SELECT cell_line, pert, metacell, MAX(n) AS n_cells_in_metacell, ROUND(SUM(CAST(CAST(x AS FLOAT) AS DOUBLE)), 4) AS total FROM mc GROUP BY 1, 2, 3")
def s15(spark, d):
    path = new_path(spark, "metacells")
    matrix.write_vectors(meta(spark, d), path, ("cell_line", "pert"))
    total = F.expr("aggregate(v, 0D, (s, x) -> s + cast(x as double))")
    return spark.read.parquet(path).select("cell_line", F.col("pert").cast("string").alias("pert"), "metacell", "n_cells_in_metacell", F.round(total, 4).alias("total"))


@query("s16_delta_sink", f"{DELTA} SELECT cell_id, ROUND(SUM(CAST(CAST(delta AS FLOAT) AS DOUBLE)), 4) AS total FROM dl GROUP BY 1")
def s16(spark, d):
    path = new_path(spark, "deltas")
    matrix.write_vectors(deltas(spark, d).select("cell_id", "pert", "delta"), path, ("pert",))
    return spark.read.parquet(path).select("cell_id", F.round(F.expr("aggregate(delta, 0D, (s, x) -> s + cast(x as double))"), 4).alias("total"))


@query("s19_clean_up", f"""{COARSE}, gone AS (SELECT MIN(cell_line) AS cell_line FROM obs)
SELECT cell_id, pert, cell_line, (SELECT COUNT(*) FROM obs) AS counted, 1 AS deleted, 0 AS deleted_again FROM obs WHERE cell_line <> (SELECT cell_line FROM gone)""")
def s19(spark, d):
    """Cells written by line; a dry run leaves all of them, then one line's folder goes, then nothing is left to delete."""
    path = new_path(spark, "intermediate")
    obs = fx.coarse(spark, d).obs.select("cell_id", "pert", "cell_line")
    obs.write.partitionBy("cell_line").parquet(path)
    gone = [f"{path}/cell_line={obs.agg(F.min('cell_line')).first()[0]}"]
    matrix.clean_up(spark, gone)
    counted = spark.read.parquet(path).count()
    deleted, again = (len(matrix.clean_up(spark, gone, dry_run=False)["deleted"]) for _ in range(2))
    return spark.read.parquet(path).select("cell_id", F.col("pert").cast("string").alias("pert"), F.col("cell_line").cast("string").alias("cell_line"), F.lit(counted).cast("bigint").alias("counted"), F.lit(deleted).alias("deleted"), F.lit(again).alias("deleted_again"))


CONFIG = "dataset: quantities\ntriage:\n  min_genes: 12\n  max_genes: 24\n  unknown: 1\n  mt_threshold:\n"


@query("s20_config", f"{COARSE}{QC} SELECT 'quantities' AS dataset, cell_id, n_genes_by_counts FROM qc WHERE pct <= 20 AND n_genes_by_counts BETWEEN 12 AND 24 AND total_counts BETWEEN 500 AND 80000")
def s20(spark, d):
    """Cells triaged by a configuration: its bounds, and the default where it names none or gives no value."""
    spec = parse_spec(CONFIG)
    return qc.good_cells(qc.qc_metrics(fx.coarse(spark, d), SPEC), spec).select(F.lit(spec.dataset).alias("dataset"), "cell_id", "n_genes_by_counts")


@query("s21_report_waterfall", f"""{COARSE}{QC}, {STEPS}
SELECT 0 AS line, '| step | name | n_cells |' AS text UNION ALL SELECT 1, '| --- | --- | --- |' UNION ALL SELECT step + 2, '| ' || step || ' | ' || name || ' | ' || n_cells || ' |' FROM w""")
def s21(spark, d):
    table = qc.cell_waterfall(qc.qc_metrics(fx.coarse(spark, d), SPEC), SPEC).orderBy("step")
    text = report.report("screen", {"Cell waterfall": table}, [])
    body = text.split("## Cell waterfall\n\n")[1].split("\n\n## ")[0]
    return spark.createDataFrame(list(enumerate(body.split("\n"))), "line int, text string")


# ---------------------------------------------------------------- detection by its rules

MODALITY = r"""WITH f AS (SELECT 'antibody' AS name, COUNT_IF(p_type = 'ECONOMY') > 0 AS ab, FALSE AS pk, FALSE AS mt, FALSE AS side, 'cells' AS assay FROM part
UNION ALL SELECT 'peaks', FALSE, (SELECT AVG(CAST(regexp_matches(g, '^chr\w+:\d+-\d+$') AS INT)) > 0.3 FROM (SELECT g FROM (SELECT CASE WHEN p_size <= 25 THEN 'chr1:' || p_partkey || '-9' ELSE 'x' || p_brand END AS g FROM part) ORDER BY g LIMIT 50)), FALSE, FALSE, 'cells'
UNION ALL SELECT 'few_peaks', FALSE, (SELECT AVG(CAST(regexp_matches(g, '^chr\w+:\d+-\d+$') AS INT)) > 0.3 FROM (SELECT g FROM (SELECT CASE WHEN p_size <= 25 THEN 'chr1:' || p_partkey || '-9' ELSE 'a' || p_brand END AS g FROM part) ORDER BY g LIMIT 50)), FALSE, FALSE, 'cells'
UNION ALL SELECT 'side_matrix', FALSE, FALSE, FALSE, TRUE, 'cells'
UNION ALL SELECT 'mitochondria', FALSE, FALSE, COUNT_IF(starts_with('MT-' || p_brand, 'MT-')) > 0, FALSE, 'snRNA' FROM part
UNION ALL SELECT 'nuclei', FALSE, FALSE, FALSE, FALSE, 'single Nucleus' UNION ALL SELECT 'plain', FALSE, FALSE, FALSE, FALSE, 'cells' UNION ALL SELECT 'names_alone', FALSE, FALSE, FALSE, FALSE, NULL)
SELECT name, CASE WHEN ab THEN 'cite_seq' WHEN pk OR side THEN 'multiome' WHEN NOT mt THEN CASE WHEN assay IS NULL THEN 'scrna_seq_or_snrna_seq' WHEN LOWER(assay) LIKE '%nucleus%' OR LOWER(assay) LIKE '%snrna%' OR LOWER(assay) LIKE '%snuc%' THEN 'snrna_seq' ELSE 'scrna_seq' END ELSE 'scrna_seq' END AS modality FROM f"""


@query("p11_modality_rules", MODALITY)
def p11(spark, d):
    part = fx.table(spark, d, "part")
    plain = part.select(F.col("p_brand").alias("gene_name"))
    kind = F.when(F.col("p_type") == "ECONOMY", "Antibody Capture").otherwise("Gene Expression")
    peaks = lambda rest: part.select(F.when(F.col("p_size") <= 25, F.concat(F.lit("chr1:"), F.col("p_partkey").cast("string"), F.lit("-9"))).otherwise(F.concat(F.lit(rest), "p_brand")).alias("gene_name"))
    cases = {
        "antibody": (part.select(F.col("p_brand").alias("gene_name"), kind.alias("feature_type")), "cells", ()), "peaks": (peaks("x"), "cells", ()), "few_peaks": (peaks("a"), "cells", ()),
        "side_matrix": (plain, "cells", ("X_ATAC",)), "mitochondria": (part.select(F.concat(F.lit("MT-"), "p_brand").alias("gene_name")), "snRNA", ()),
        "nuclei": (plain, "single Nucleus", ()), "plain": (plain, "cells", ()), "names_alone": (plain, None, ()),
    }
    rows = [detect.modality(var, assay, layers).select(F.lit(name).alias("name"), "modality") for name, (var, assay, layers) in cases.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


# The vocabularies once more, so that the SQL sees a wrong word in detection.
CONTROL_WORDS = ("non-targeting", "non_targeting", "nontargeting", "control", "ctrl", "scramble", "scrambled", "negative", "NT", "ntc", "gfp", "lacz", "safe_harbor", "safe-harbor", "AAVS1", "INTERGENIC", "non targeting", "nontarget", "neg_ctrl", "neg_control", "CTRL", "NEGATIVE", "GFP")
PERTURBATION_WORDS = ("gene", "perturbation", "target", "guide", "knockout", "crispr", "sgrna", "guide_rna", "perturb", "perturbagen", "gene_target", "target_gene", "gene_name", "symbol", "pert", "pert_name", "gene_id", "guide_id", "perturbation_target", "CRISPR", "guide_assignment", "gene_symbol")
BATCH_WORDS = ("gem_group", "batch", "run", "lane", "library", "experiment", "sample", "replicate", "10x_run", "batch_id", "run_id", "sample_id", "library_id", "sequencing_run", "prep_batch", "gem")
LINE_WORDS = ("cell_line", "cell_type", "cellline", "cell_line_id", "line", "sample_type", "condition_cell", "clone", "subline", "tissue", "cell_line_name", "cell_origin", "sample_origin")
LINE_WORDS_OF_NAMES = ("cell_line", "cell_type", "cellline", "cell_line_id", "line", "sample_type", "cell_line_name", "condition", "clone", "subline", "tissue", "cell_origin")
LINE_NAMES = ("k562", "rpe1", "hesc", "h1", "jurkat", "ipsc", "hela", "a549", "293t", "hek293", "thp1", "mcf7", "u2os", "hct116", "pc9", "h358", "h1299", "h1792", "h2009", "lncap", "du145", "pc3", "hl60", "molt4", "ramos", "raji", "daudi", "hcc1954", "bt474", "skbr3", "t47d", "mbda231")

WORDS = lambda words: ", ".join(f"('{w}')" for w in dict.fromkeys(words))
COLUMNS = rf"""WITH o AS (SELECT 'G' || c_nationkey AS target_gene, c_custkey % 4 AS gem_group, CASE c_custkey % 3 WHEN 0 THEN 'K-562' WHEN 1 THEN 'HeLa' ELSE 'RPE 1' END AS origin, c_mktsegment AS tissue, c_name AS note, CASE WHEN c_nationkey < 12 THEN 'NT' || c_nationkey ELSE 'MYC' || c_nationkey END AS line_of FROM customer),
long AS (SELECT 'target_gene' AS name, 1 AS pos, target_gene AS v, TRUE AS txt FROM o UNION ALL SELECT 'gem_group', 2, CAST(gem_group AS VARCHAR), FALSE FROM o UNION ALL SELECT 'origin', 3, origin, TRUE FROM o UNION ALL SELECT 'tissue', 4, tissue, TRUE FROM o UNION ALL SELECT 'note', 5, note, TRUE FROM o UNION ALL SELECT 'line_of', 6, line_of, TRUE FROM o),
st AS (SELECT name, pos, txt, COUNT(DISTINCT v) AS n, MAX(LENGTH(v)) AS len FROM long GROUP BY 1, 2, 3),
few AS (SELECT name, v, ROW_NUMBER() OVER (PARTITION BY name ORDER BY v) AS rn FROM (SELECT DISTINCT name, v FROM long)),
gl AS (SELECT name, AVG(CAST(regexp_matches(v, '^[A-Z][A-Z0-9\-]{{1,15}}$') AS INT)) AS g, COUNT_IF(regexp_replace(LOWER(v), '[-_ ]', '', 'g') IN (SELECT w FROM (VALUES {WORDS(LINE_NAMES)}) t(w))) AS known FROM few WHERE rn <= 20 GROUP BY 1),
h AS (SELECT st.*, g, known, (SELECT COUNT(*) FROM (VALUES {WORDS(w.lower() for w in PERTURBATION_WORDS)}) t(w) WHERE contains(name, w)) AS hp,
 (SELECT COUNT(*) FROM (VALUES {WORDS(BATCH_WORDS)}) t(w) WHERE contains(name, w)) AS hb, (SELECT COUNT(*) FROM (VALUES {WORDS(LINE_WORDS)}) t(w) WHERE contains(name, w)) AS hl,
 (SELECT COUNT(*) FROM (VALUES {WORDS(LINE_WORDS_OF_NAMES)}) t(w) WHERE contains(name, w)) AS hn FROM st JOIN gl USING (name)),
p AS (SELECT name FROM h WHERE txt AND hp > 0 AND n BETWEEN 2 AND 50000 ORDER BY hp DESC, pos LIMIT 1), b AS (SELECT name FROM h WHERE hb > 0 AND n BETWEEN 2 AND 10000 AND name NOT IN (SELECT name FROM p) ORDER BY pos LIMIT 1),
l AS (SELECT * FROM h WHERE txt AND n BETWEEN 2 AND 20 AND len <= 40 AND name NOT IN (SELECT name FROM p UNION ALL SELECT name FROM b))
SELECT (SELECT name FROM p) AS perturbation, (SELECT name FROM b) AS batch, (SELECT name FROM l WHERE NOT (n > 5 AND g > 0.6) ORDER BY 2 * hl + known DESC, pos LIMIT 1) AS line, (SELECT name FROM l WHERE hn > 0 ORDER BY hn DESC, pos LIMIT 1) AS line_by_name"""


@query("p16_columns", COLUMNS)
def p16(spark, d):
    """P16 to P19 on columns that each of the rules can tell apart."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    obs = fx.table(spark, d, "customer").select(
        k.alias("cell_id"), F.concat(F.lit("G"), n.cast("string")).alias("target_gene"), (k % 4).alias("gem_group"), F.when(k % 3 == 0, "K-562").when(k % 3 == 1, "HeLa").otherwise("RPE 1").alias("origin"),
        F.col("c_mktsegment").alias("tissue"), F.col("c_name").alias("note"), F.when(n < 12, F.concat(F.lit("NT"), n.cast("string"))).otherwise(F.concat(F.lit("MYC"), n.cast("string"))).alias("line_of"),
    )
    by_values, by_names = detect.detect_columns(obs), detect.detect_columns(obs, False)
    return spark.createDataFrame([(by_values.perturbation, by_values.batch, by_values.cell_line, by_names.cell_line)], "perturbation string, batch string, line string, line_by_name string")


CONTROL_CASES = "WITH l AS (SELECT 'vocabulary' AS name, CASE WHEN c_nationkey = 0 THEN 'Non Targeting' WHEN c_nationkey = 1 THEN 'GFP' ELSE c_mktsegment END AS pert FROM customer UNION ALL SELECT 'later_word', CASE WHEN c_nationkey = 0 THEN 'neg-ctrl' WHEN c_nationkey = 1 THEN 'g f p' ELSE c_mktsegment END FROM customer UNION ALL SELECT 'none', c_mktsegment FROM customer)"


@query("p20_control_rules", f"""{CONTROL_CASES}, w AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{w}')" for i, w in enumerate(CONTROL_WORDS))}) t(position, word)),
hit AS (SELECT DISTINCT l.name, pert, MIN(position) AS position FROM l JOIN w ON translate(LOWER(pert), ' _-', '') = translate(LOWER(word), ' _-', '') GROUP BY 1, 2)
SELECT name, FIRST(pert ORDER BY position, pert) AS control_label FROM hit GROUP BY 1""")
def p20(spark, d):
    c, n = fx.table(spark, d, "customer"), F.col("c_nationkey")
    cases = {
        "vocabulary": F.when(n == 0, "Non Targeting").when(n == 1, "GFP").otherwise(F.col("c_mktsegment")), "later_word": F.when(n == 0, "neg-ctrl").when(n == 1, "g f p").otherwise(F.col("c_mktsegment")),
        "none": F.col("c_mktsegment"),
    }
    rows = [detect.control_label(spark, c.select(label.alias("pert"))).select(F.lit(name).alias("name"), "control_label") for name, label in cases.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


KINDS = "WITH v AS (SELECT c_mktsegment || ' CRISPRa screen' AS value, 'a' AS name FROM customer UNION ALL SELECT c_mktsegment || ' Activation', 'b' FROM customer UNION ALL SELECT 'interference', 'c' FROM customer UNION ALL SELECT 'crispri', 'c' FROM customer UNION ALL SELECT c_name || ' CRISPR-KO', 'd' FROM customer UNION ALL SELECT 'knockout and interference', 'e' FROM customer UNION ALL SELECT c_mktsegment, 'f' FROM customer)"


@query("p21_type_rules", f"""{KINDS}, x AS (SELECT name, BOOL_OR(contains(LOWER(value), 'crispra') OR contains(LOWER(value), 'activation')) AS a, BOOL_OR(contains(LOWER(value), 'crispri') OR contains(LOWER(value), 'interference')) AS i,
BOOL_OR(contains(LOWER(value), 'knockout') OR contains(LOWER(value), 'crispr-ko') OR contains(LOWER(value), 'crisprko')) AS k FROM v GROUP BY 1) SELECT name, CASE WHEN a THEN 'CRISPRa' WHEN i THEN 'CRISPRi' WHEN k THEN 'CRISPRko' ELSE 'CRISPRi' END AS perturbation_type FROM x""")
def p21(spark, d):
    c = fx.table(spark, d, "customer")
    cases = {"a": [F.concat("c_mktsegment", F.lit(" CRISPRa screen"))], "b": [F.concat("c_mktsegment", F.lit(" Activation"))], "c": [F.lit("interference"), F.lit("crispri")], "d": [F.concat("c_name", F.lit(" CRISPR-KO"))], "e": [F.lit("knockout and interference")], "f": [F.col("c_mktsegment")]}
    out = None
    for name, values in cases.items():
        rows = c.select(F.explode(F.array(*values)).alias("value"))
        row = detect.perturbation_type(rows).select(F.lit(name).alias("name"), "perturbation_type")
        out = row if out is None else out.unionByName(row)
    return out


CYCLE = "CASE gene_name WHEN 'Brand#11' THEN 'MCM5' WHEN 'Brand#12' THEN 'mki67' WHEN 'Brand#13' THEN 'Top2a' ELSE gene_name END"


@query("p33_cycle_rescue", f"""{COARSE}{DENSE}, g AS (SELECT {CYCLE} AS gene_name, COUNT_IF(value <> 0) AS n, AVG(value) AS m, (SELECT COUNT(*) FROM obs) AS cells FROM grid GROUP BY 1)
SELECT gene_name, n < GREATEST(10, FLOOR(cells * 0.99)) AND m < 1000 AS removed_low, UPPER(gene_name) IN ('MCM5', 'MKI67', 'TOP2A') AS is_cycle, NOT (n < 10 OR (n < GREATEST(10, FLOOR(cells * 0.99)) AND m < 1000)) OR UPPER(gene_name) IN ('MCM5', 'MKI67', 'TOP2A') AS kept FROM g""")
def p33(spark, d):
    m, named = fx.coarse(spark, d), F.expr(CYCLE)
    m = replace(m, var=m.var.withColumn("gene_name", named), x=m.x.withColumn("gene_name", named))
    spec = replace(SPEC, min_cells_expressing=10, cell_share=0.99, mean_umi=1000.0)
    return genes.triage(m, spec).select("gene_name", "removed_low", "is_cycle", "kept")


@query("p25_doublet_removal", f"{COARSE} SELECT cell_id, CASE WHEN cell_id % 5 <> 0 THEN (cell_id % 11) / 11 END AS doublet_score FROM obs WHERE cell_id % 5 = 0 OR (cell_id % 11) / 11 <= 0.6")
def p25(spark, d):
    obs, share = fx.coarse(spark, d).obs, F.col("cell_id") % 11 / 11
    scores = obs.filter("cell_id % 5 <> 0").select("cell_id", share.alias("doublet_score"), (share > 0.6).alias("predicted_doublet"))
    return doublets.drop_doublets(obs, scores, replace(SPEC, remove_doublets=True)).select("cell_id", "doublet_score")


@query("p39_line_labels", f"{COARSE} SELECT cell_id, cell_line AS line, 'cell_line_1' AS single FROM obs")
def p39(spark, d):
    """A column's labels, and one line where nothing tells lines apart."""
    obs = fx.coarse(spark, d).obs
    return lines.assign_lines(obs, None, "cell_line").join(lines.assign_lines(obs.select("cell_id"), None).withColumnRenamed("line", "single"), "cell_id").select("cell_id", "line", "single")
