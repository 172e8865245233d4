"""Literal cases, invariants and planted truths."""

from dataclasses import replace

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from screenspark.functions.statistics import sparse_percentile
from screenspark.model import CountMatrix
from screenspark.operators import batch, calibrate, counterfactual, detect, doublets, embed, escapers, hvg, lines, metacells, normalize, qc, splits
from screenspark.plans.report import report
from screenspark.sources import matrix
from screenspark.spec import ScreenSpec, load_spec

SPEC = ScreenSpec()


def matrix_of(spark, dense, perts=None):
    n, g = dense.shape
    perts = perts or ["non-targeting"] * n
    obs = spark.createDataFrame([(i, perts[i], "A", i % 2) for i in range(n)], "cell_id bigint, pert string, cell_line string, batch bigint")
    var = spark.createDataFrame([(f"g{j}",) for j in range(g)], "gene_name string")
    x = spark.createDataFrame([(i, f"g{j}", float(dense[i, j])) for i in range(n) for j in range(g) if dense[i, j]], "cell_id bigint, gene_name string, value double")
    return CountMatrix(obs, var, x)


def vectors_of(spark, x, control, line="A", batches=None):
    rows = [(i, bool(control[i]), line, int(batches[i]) if batches is not None else 0, [float(v) for v in x[i]]) for i in range(len(x))]
    return spark.createDataFrame(rows, "cell_id bigint, is_control boolean, cell_line string, batch bigint, v array<double>")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(0, 4), min_size=3, max_size=3), min_size=1, max_size=9), st.sampled_from([0.0, 0.1, 0.37, 0.5, 0.9, 1.0]))
def test_sparse_percentile_is_dense_percentile(spark, rows, q):
    dense = np.array(rows)
    m = matrix_of(spark, dense)
    got = {r.gene_name: r.threshold for r in sparse_percentile(m.x, m.var, m.n_cells(), q).collect()}
    for j in range(3):
        assert got[f"g{j}"] == pytest.approx(np.percentile(dense[:, j], 100 * q))


def test_empty_matrix(spark):
    m = matrix_of(spark, np.zeros((0, 2)))
    assert [r.n_cells for r in qc.cell_waterfall(qc.qc_metrics(m, SPEC), SPEC).collect()] == [0] * 6
    assert normalize.normalise(m.__class__(m.obs.withColumn("split", F.lit("a")), m.var, m.x), SPEC).x.count() == 0


def test_gene_id_formats(spark):
    fmt = lambda names: detect.gene_id_format(spark.createDataFrame([(n,) for n in names], "gene_name string")).first().format
    assert fmt([f"ENSG{i:011d}" for i in range(20)]) == "ensembl"
    assert fmt([str(i) for i in range(20)]) == "entrez"
    assert fmt(["TP53", "MYC"]) == "symbol"


def test_modalities(spark):
    var = lambda rows: spark.createDataFrame(rows, "gene_name string, feature_type string")
    assert detect.modality(var([(f"chr1:{i}-{i + 9}", "Peaks") for i in range(20)] + [("A", "x")]), "rna").first()[0] == "multiome"
    assert detect.modality(var([("A", "Antibody Capture")]), "rna").first()[0] == "cite_seq"
    assert detect.modality(var([("A", "x")]), "snRNA").first()[0] == "snrna_seq"
    assert detect.modality(var([("A", "x")])).first()[0] == "scrna_seq_or_snrna_seq"
    assert detect.modality(var([("MT-A", "x")]), "snRNA").first()[0] == "scrna_seq"


def test_combinatorial_threshold(spark):
    labels = lambda k: spark.createDataFrame([("A+B" if i < k else "A",) for i in range(100)], "pert string")
    assert tuple(detect.combinatorial(labels(5), SPEC).first()) == (True, "+")
    assert tuple(detect.combinatorial(labels(4), SPEC).first()) == (False, None)


def test_duplicate_symbols(spark):
    var = spark.createDataFrame([("i1",), ("i2",), ("i3",), ("i4",)], "gene_name string")
    names = spark.createDataFrame([("i1", "A"), ("i2", "B"), ("i3", "A"), ("i4", "A")], "gene_id string, symbol string")
    assert [r.gene_name for r in detect.harmonise(var, names).orderBy("original_gene_id").collect()] == ["A", "B", "A_1", "A_2"]


def test_columns_are_detected(spark):
    obs = spark.createDataFrame([(i, f"P{i % 3}", i % 4, ("K562", "HeLa")[i % 2]) for i in range(24)], "cell_id bigint, target_gene string, gem_group bigint, cell_line string")
    assert detect.detect_columns(obs) == detect.Columns("target_gene", "gem_group", "cell_line")


def test_grainings(spark):
    rows = [(str(n), i) for n in (29, 30, 99, 100, 499, 500) for i in range(n)]
    got = {r.pert: r.n_metacells for r in metacells.grainings(spark.createDataFrame(rows, "pert string, cell_id bigint"), "pert").collect()}
    assert got == {"29": 1, "30": 6, "99": 19, "100": 10, "499": 49, "500": 33}


@pytest.mark.parametrize("n, want", [(1, (1, 0, 0)), (2, (1, 1, 0)), (3, (1, 1, 1)), (4, (1, 1, 2)), (8, (2, 1, 5)), (25, (6, 1, 18))])
def test_split_sizes(spark, n, want):
    binned = spark.createDataFrame([(f"p{i}", 0) for i in range(n)], "pert string, bin int")
    got = {r.split: r["count"] for r in splits.split_labels(binned, SPEC).groupBy("split").count().collect()}
    assert tuple(got.get(s, 0) for s in ("test", "val", "train")) == want


def test_equal_scores_share_a_bin(spark):
    shifts = spark.createDataFrame([(f"p{i}", 1.0) for i in range(5)], "pert string, shift double")
    assert {r.bin for r in splits.effect_bins(shifts, SPEC).collect()} == {0}


def test_escapers_bypass_unknown_targets(spark):
    m = matrix_of(spark, np.array([[1, 0], [5, 1], [9, 0], [2, 2]]), ["non-targeting", "g0", "elsewhere", "g0+g1"])
    kept = {r.cell_id: r.kept for r in escapers.judged_cells(m, SPEC, "+").collect()}
    assert kept == {0: True, 1: False, 2: True, 3: False}


def test_normalised_totals(spark):
    dense = np.random.default_rng(0).integers(0, 5, (8, 6)) + np.eye(8, 6)
    m = matrix_of(spark, dense)
    out = normalize.normalise(m, replace(SPEC, target_sum=100.0, log=True))
    assert [pytest.approx(100)] * 8 == [r.s for r in out.x.groupBy("cell_id").agg(F.sum(F.expm1("value")).alias("s")).collect()]
    scaled = normalize.scale(m, SPEC).x.agg(F.min("value"), F.max("value")).first()
    assert 0 <= scaled[0] and scaled[1] <= SPEC.clip


def test_svd_and_pca_agree_with_numpy(spark):
    dense = np.random.default_rng(1).poisson(2.0, (30, 7)).astype(float)
    m = matrix_of(spark, dense)
    basis = embed.truncated_svd(m, 3)
    want = embed.signed(np.linalg.svd(dense, full_matrices=False)[2][:3])
    assert np.allclose(basis.components, want)
    scores = np.array([r.v for r in embed.project_sparse(m, basis).orderBy("cell_id").collect()])
    assert np.allclose(scores, dense @ want.T)
    v = vectors_of(spark, dense, np.zeros(30))
    p = embed.pca(v, 2)
    centred = dense - dense.mean(axis=0)
    assert np.allclose(np.array([r.pcs for r in embed.project_dense(v, p).orderBy("cell_id").collect()]), centred @ embed.signed(np.linalg.svd(centred, full_matrices=False)[2][:2]).T)


def test_harmony_shrinks_a_batch_shift(spark):
    rng = np.random.default_rng(2)
    x, b = rng.normal(size=(120, 4)) + 4 * np.eye(4)[rng.integers(0, 2, 120)], np.arange(120) % 2
    x[b == 1] += np.array([1.5, 0, 0, 1.5])
    rows = batch.harmony(vectors_of(spark, x, np.zeros(120), batches=b), clusters=2).orderBy("cell_id").collect()
    fixed = np.array([r.corrected for r in rows])
    gap = lambda y: np.linalg.norm(y[b == 0].mean(axis=0) - y[b == 1].mean(axis=0))
    assert gap(fixed) < 0.5 * gap(x)


def test_two_blobs_are_two_lines(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(150, 10)), rng.normal(size=(150, 10)) + 8])
    assert lines.density_clusters(x, 50) == 2
    v = vectors_of(spark, x, np.zeros(300))
    found = lines.assign_lines(v.select("cell_id"), v).orderBy("cell_id").collect()
    assert len({r.line for r in found[:150]}) == 1 and found[0].line != found[-1].line


def test_doublets_score_higher(spark):
    rng = np.random.default_rng(4)
    a, b = rng.poisson([6] * 5 + [0.2] * 5, (40, 10)), rng.poisson([0.2] * 5 + [6] * 5, (40, 10))
    dense = np.concatenate([a, b, a[:6] + b[:6]])
    rows = doublets.doublet_scores(matrix_of(spark, dense), SPEC, components=5).orderBy("cell_id").collect()
    scores = np.array([r.doublet_score for r in rows])
    assert len(scores) == 86 and scores[80:].mean() > scores[:80].mean()


def test_deltas_recover_the_effect(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6)) * 0.05
    control = np.arange(60) < 30
    x[~control] += np.array([1.0, 0, 0, 0, 0, 0])
    v = vectors_of(spark, x, control)
    model = counterfactual.fit(v, replace(SPEC, n_pcs=3, neighbours=5))
    rows = model.transform(v).filter("NOT is_control").collect()
    assert np.allclose(np.mean([r.delta for r in rows], axis=0), [1, 0, 0, 0, 0, 0], atol=0.1)
    assert np.allclose(counterfactual.remove_directions(x, np.eye(6)[:1])[:, 0], 0)


def test_pareto_front_is_what_nothing_dominates(spark):
    rng = np.random.default_rng(6)
    p = rng.integers(0, 5, (40, 3)).astype(float)
    rows = spark.createDataFrame([(str(i), *map(float, r)) for i, r in enumerate(p)], "point string, rank_preservation double, discrimination double, stability double")
    front = {int(r.point) for r in calibrate.pareto_front(rows).collect()}
    want = {i for i in range(40) if not any((p[j] >= p[i]).all() and (p[j] > p[i]).any() for j in range(40))}
    assert front == want


def test_variable_gene_stands_out(spark):
    rng = np.random.default_rng(7)
    dense = rng.poisson(np.linspace(1, 9, 30), (60, 30))
    dense[:, 4] = np.where(rng.random(60) < 0.5, 0, 12)
    best = hvg.normalised_variance(matrix_of(spark, dense)).orderBy(F.desc("score")).first()
    assert best.gene_name == "g4"


def test_metacells_keep_all_cells(spark):
    x = np.random.default_rng(8).normal(size=(130, 4))
    v = vectors_of(spark, x, np.zeros(130)).withColumn("pert", F.when(F.col("cell_id") < 20, "a").otherwise("b"))
    meta = metacells.profiles(metacells.cluster_metacells(v, "pert"), "pert")
    assert meta.agg(F.sum("n_cells_in_metacell")).first()[0] == 130
    assert meta.filter("pert = 'a'").count() == 1


def test_matrix_round_trip_and_clean_up(spark, tmp_path):
    m = matrix_of(spark, np.array([[1, 0], [0, 2]]))
    path = str(tmp_path / "m")
    matrix.write_matrix(m, path, ("pert",))
    assert matrix.read_matrix(spark, path).x.count() == 2
    wide = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], "cell_id bigint, counts array<double>")
    assert matrix.from_wide(wide, ["a", "b"]).x.count() == 2
    matrix.write_manifest(spark, {"seed": 1}, f"{path}/manifest.json")
    assert matrix.clean_up(spark, [path, f"{path}-none"])["missing"] == [f"{path}-none"] and matrix.exists(spark, path)
    matrix.clean_up(spark, [path], dry_run=False)
    assert not matrix.exists(spark, path)


def test_stream_sums(spark, tmp_path):
    from screenspark.streaming.gene_sums import take_available

    x, args = str(tmp_path / "x"), (str(tmp_path / "x"), str(tmp_path / "out"), str(tmp_path / "cp"))
    for _ in range(2):
        spark.createDataFrame([(1, "a", 2.0), (2, "a", 0.0)], "cell_id bigint, gene_name string, value double").write.mode("append").parquet(x)
        got = take_available(spark, *args).first()
    assert (got.gene_name, got.total, got.nnz) == ("a", 4.0, 2)


def test_spec_and_report(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("dataset: d\nphase2:\n  min_genes: 7\n  unknown: 1\npaths:\n  out: %s\n" % (tmp_path / "made"))
    spec = load_spec(str(tmp_path / "c.yaml"))
    assert spec.min_genes == 7 and (tmp_path / "made").is_dir()
    text = report("d", {"Table": spark.createDataFrame([(1, 2.5)], "a int, b double"), "Note": "x"}, ["w"])
    assert "| 1 | 2.5 |" in text and "MINOR WARNINGS" in text


def test_preflight(spark):
    from screenspark.plans.preflight import detection, suggested_yaml

    obs = spark.createDataFrame([(i, ("NT", "TP53", "MYC")[i % 3], i % 4, ("K562", "HeLa")[i % 2], "CRISPRa screen") for i in range(24)], "cell_id bigint, target_gene string, gem_group bigint, cell_line string, assay_type string")
    found = detection(obs, spark.createDataFrame([("MT-ND1",), ("TP53",)], "gene_name string"))
    assert (found.perturbation_column, found.control_label, found.batch_column, found.cell_line_column) == ("target_gene", "NT", "gem_group", "cell_line")
    assert (found.perturbation_type, found.modality, found.is_combinatorial) == ("CRISPRa", "scrna_seq", False)
    assert "control_label: NT" in suggested_yaml(found)


@pytest.mark.parametrize(("n", "g", "k"), [(300, 60, 4), (200, 25, 25), (50, 12, 30), (400, 90, 6)])
def test_svd_without_a_gramian_is_numpys(spark, n, g, k):
    """Angles to numpy's directions, and the absolute scores of each component."""
    rng = np.random.default_rng(n)
    dense = rng.poisson(rng.gamma(0.5, 2.0, size=(1, g)) * rng.gamma(1.0, 1.0, size=(n, 1)) * 0.7).astype(float)
    m = matrix_of(spark, dense)
    basis = embed.truncated_svd(m, k)
    order = [int(name[1:]) for name in basis.names]
    _, s, vt = np.linalg.svd(dense[:, order], full_matrices=False)
    k = min(k, g)
    rank = int((s[:k] > 1e-9 * s[0]).sum())
    cosines = np.linalg.svd(vt[:rank] @ basis.components[:rank].T)[1]
    assert np.sqrt(np.maximum(0, 1 - cosines**2)).max() < 1e-6
    assert np.allclose(basis.variance_ratio, np.resize(s, k) ** 2 / (s**2).sum() if len(s) >= k else basis.variance_ratio, atol=1e-9)
    scores = np.array([r.v for r in embed.project_sparse(m, basis).orderBy("cell_id").collect()])
    assert np.allclose(np.abs(scores[:, : min(5, rank)]), np.abs(dense[:, order] @ vt[: min(5, rank)].T), atol=1e-6)


def test_svd_of_nothing(spark):
    basis = embed.truncated_svd(matrix_of(spark, np.zeros((3, 4))), 2)
    assert basis.components.shape == (2, 4) and not basis.variance_ratio.any()
