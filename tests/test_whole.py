"""Queries over whole tables, stages of the pipeline, fits and sweeps."""

import inspect
from dataclasses import replace

import numpy as np
import pytest

from pyspark.sql import functions as F

from screenspark.functions import statistics
from screenspark.operators import batch, calibrate, counterfactual, detect, doublets, lines, metacells, neighbours
from screenspark.plans import pipeline, report
from screenspark.plans.catalog import QUERIES
from screenspark.sources import fixtures
from screenspark.spec import ScreenSpec
from tests.compare import SF


def test_neighbours_equal_brute_force(spark):
    rows = fixtures.vectors(spark, SF).orderBy("cell_id").collect()
    ids, control, x = np.array([r.cell_id for r in rows]), np.array([r.is_control for r in rows]), np.array([r.v for r in rows])
    want = {}
    for i in np.flatnonzero(~control):
        d = np.sqrt(((x[control] - x[i]) ** 2).sum(axis=1))
        want[int(ids[i])] = [int(n) for n in ids[control][np.lexsort((ids[control], d))[:5]]]
    got = {}
    for r in QUERIES["j09_knn"](spark, SF).orderBy("cell_id", "rank").collect():
        got.setdefault(r.cell_id, []).append(r.neighbour)
    assert got == want


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_neighbours_with_ties_and_without_self(spark, metric):
    rng = np.random.default_rng(9)
    x = rng.integers(-1, 2, (300, 4)).astype(float) + 1e-3
    v = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "cell_id bigint, v array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in neighbours.nearest(v, v, 6, metric, exclude_self=True).orderBy("cell_id", "rank").collect():
        got.setdefault(r.cell_id, []).append((r.neighbour, r.distance))
    for i in range(300):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1)) if metric == "euclidean" else 1 - (unit * unit[i]).sum(axis=1)
        d[i] = np.inf
        assert got[i] == [(int(j), pytest.approx(d[j])) for j in np.lexsort((np.arange(300), d))[:6]]


def test_front_of_many_points_in_many_tasks(spark):
    x = np.random.default_rng(10).integers(0, 40, (30_000, 3)).astype(float)
    rows = [(str(i), *map(float, r)) for i, r in enumerate(x)] + [("none", 1.0, None, 1.0)]
    points = spark.createDataFrame(rows, "point string, rank_preservation double, discrimination double, stability double").repartition(7)
    front = {r.point for r in calibrate.pareto_front(points).collect()}
    best = np.unique(x, axis=0)
    best = {tuple(b) for b in best if not ((best >= b).all(axis=1) & (best > b).any(axis=1)).any()}
    assert front == {str(i) for i in range(len(x)) if tuple(x[i]) in best} | {"none"}


def screen(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(90, 6)) * np.array([3, 1, 1, 1, 0.5, 0.5])
    x[40:] += np.array([2.0, 0.5, 0, 0, 0, 0])
    return spark.createDataFrame([(i, i < 40, [float(c) for c in r]) for i, r in enumerate(x)], "cell_id bigint, is_control boolean, v array<double>"), x


def test_explore_sweeps_every_mode(spark):
    v, x = screen(spark)
    spec = replace(ScreenSpec(), mode="explore", neighbour_grid=(1, 5), systematic_cosine=0.3)
    rows = {r.point: r for r in calibrate.sweep(v, spec, n_pcs=(3, 4), metrics=("euclidean",)).collect()}
    assert set(rows) == {f"{m}:{k}:{n}:euclidean" for m in ("knn", "hybrid") for k in (1, 5) for n in (3, 4)} | {f"pc_decomposition:0:{n}:N/A" for n in (3, 4)}
    for mode in counterfactual.MODES:
        k, metric = (0, "N/A") if mode == "pc_decomposition" else (5, "euclidean")
        model = counterfactual.fit(v, replace(spec, mode=mode, n_pcs=3, neighbours=5))
        lengths = [np.linalg.norm(r.delta) for r in model.transform(v).filter("NOT is_control").collect()]
        assert rows[f"{mode}:{k}:3:{metric}"].stability == pytest.approx(1 / (np.std(lengths) + 1e-6))


def test_explore_is_fitted(spark):
    v, _ = screen(spark)
    model = counterfactual.fit(v, replace(ScreenSpec(), mode="explore", neighbour_grid=(1, 5)))
    assert model.spec.mode in counterfactual.MODES
    assert model.transform(v).count() == 90


def test_pipeline_runs_every_stage(spark):
    spec = replace(fixtures.SPEC, min_cells_per_perturbation=1, min_cells_per_line=1, min_cells_per_split=1, n_top_genes=15, n_components=8, min_cells_expressing=1, harmony_rounds=2, neighbour_grid=(1, 3))
    m = fixtures.coarse(spark, "/root/testdata/sf0.01")
    run = pipeline.run(replace(m, obs=m.obs.drop("cell_line")), spec)
    scores = run.tables["doublets"]
    assert scores.count() == run.stages["cells"].obs.count()
    assert run.stages["singlets"].obs.count() == scores.filter("NOT predicted_doublet").count() < scores.count()
    assert {r.metric for r in run.tables["sweep"].collect()} == {"euclidean", "cosine"}
    assert all(r.cell_line.startswith("cell_line_") for r in run.tables["deltas"].select("cell_line").distinct().collect())
    text = report.run_report(run, "screen", outputs=("x/train",), downstream="networks")
    assert [line.split()[1] for line in text.splitlines() if line.startswith("## ")] == list("123456789")
    summary = report.delta_summary(run.model, run.tables["sweep"])
    row = run.tables["sweep"].filter(f"mode = '{summary['mode']}' AND n_pcs = {summary['n_pcs']} AND (k = {summary['k']} OR k = 0) AND metric IN ('{summary['metric']}', 'N/A')").first()
    assert summary["signal_stability"] == row.stability and summary["rank_disruption"] == pytest.approx(1 - row.rank_preservation)
    assert "x/train" in text and "CLEAN RUN" in text and f"- mode: {summary['mode']}" in text


def test_manifold_is_each_lines_own(spark):
    rng = np.random.default_rng(14)
    x = rng.normal(size=(60, 5)) * np.array([5, 1, 1, 1, 4])
    v = spark.createDataFrame([(i, "AB"[i % 2], [float(c) for c in r]) for i, r in enumerate(x)], "cell_id bigint, cell_line string, v array<double>")
    meta = v.filter("cell_id < 4").withColumn("metacell", F.col("cell_id"))
    rows = metacells.manifold(v, meta).collect()
    assert sorted({(r.cell_line, r.kind) for r in rows}) == [("A", "cell"), ("A", "metacell"), ("B", "cell"), ("B", "metacell")] and len(rows) == 64
    for i, line in enumerate("AB"):
        mine = x[i::2]
        want = mine @ np.linalg.svd(mine, full_matrices=False)[2][:2].T
        got = np.array([(r.x, r.y) for r in sorted((r for r in rows if r.cell_line == line and r.kind == "cell"), key=lambda r: r.id)])
        assert np.allclose(np.abs(got), np.abs(want))


def test_quantiles_and_ranks_equal_plain_ones(spark):
    rng = np.random.default_rng(15)
    x, g = rng.integers(0, 40, 500) / 4, rng.integers(0, 3, 500)
    rows = spark.createDataFrame([(i, int(g[i]), float(x[i]), 7) for i in range(500)] + [(500, 1, None, 7)], "cell_id bigint, g int, total double, n int")
    for q in (0.0, 0.1, 0.37, 0.5, 1.0):
        assert statistics.quantile(rows, "total", q, "out").first().out == pytest.approx(np.quantile(x, q))
        got = {r.g: r.out for r in statistics.quantile(rows, "total", q, "out", "g").collect()}
        assert got == {i: pytest.approx(np.quantile(x[g == i], q)) for i in range(3)}
    assert statistics.quantile(rows.filter("false"), "total", 0.5, "out").first().out is None
    for ranked in (statistics.rank_in_ranges(rows, "cell_id", "g"), statistics.rank_by(rows, F.lpad(F.hex("cell_id"), 8, "0"), "cell_id", "g")):
        want = {int(i): int((g[:i] == g[i]).sum()) + 1 for i in range(500)}
        assert {r.cell_id: r["rank"] for r in ranked.filter("cell_id < 500").collect()} == want


def test_line_columns_by_structure_alone(spark):
    obs = spark.createDataFrame([(i, ("left", "right")[i % 2], ("h-1", "T47D")[i % 2], f"note {i}") for i in range(30)], "cell_id bigint, side string, origin string, remark string")
    assert detect.detect_columns(obs).cell_line == "origin" and detect.detect_columns(obs.drop("origin")).cell_line == "side"
    assert detect.detect_columns(obs, False).cell_line is None


def test_doublets_without_a_bound_on_cells(spark):
    v, _ = screen(spark)
    m = fixtures.coarse(spark, SF)
    few = m.keep_cells(m.obs.filter("cell_id % 4 = 0"))
    whole, part = (doublets.doublet_scores(few, fixtures.SPEC, most=most, components=5) for most in (None, 15))
    assert whole.count() == part.count() == few.obs.count()


def test_harmony_starts_in_types_that_come_late(spark):
    x = 5 * np.eye(4)[np.repeat([0, 1, 2], 200)] + 0.1 * np.random.default_rng(12).normal(size=(600, 4))
    v = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "cell_id bigint, v array<double>")
    assert {int(c.argmax()) for c in batch.first_centres(v, 3)} == {0, 1, 2}


def test_lines_are_estimated_from_the_survey_sample(spark):
    rng = np.random.default_rng(13)
    x = np.concatenate([rng.normal(size=(100, 3)), rng.normal(size=(100, 3)) + 9])
    v = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "cell_id bigint, v array<double>")
    assert lines.estimate_lines(v) == 2
    assert inspect.signature(lines.estimate_lines).parameters["most"].default == 50_000
    assert QUERIES["n10_estimate_k"](spark, SF).first().k >= 1
