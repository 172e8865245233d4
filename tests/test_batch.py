"""Batch correction: blocks, objective, and cells that the model hasn't seen."""

import numpy as np
import pytest

from screenspark.operators import batch
from screenspark.plans.catalog import ORACLE, QUERIES
from tests.compare import SF, differences

TYPES = 3


@pytest.fixture(scope="module")
def shifted(spark):
    """Three types, the batches of unequal size, batch c with one type alone; a's null is a batch."""
    rng = np.random.default_rng(4)
    kind = rng.integers(0, TYPES, 600)
    name = np.array(["a", "b", "c"])[rng.choice(3, 600, p=[0.5, 0.4, 0.1])]
    kind[name == "c"] = 2
    x = 6 * np.eye(6)[kind] + rng.normal(size=(600, 6)) * 0.4
    x[name == "b"] += [0, 0, 0, 2, 1, 0]
    x[name == "c"] += [0, 0, 0, 0, 2, 2]
    rows = [(i, None if name[i] == "a" else str(name[i]), int(kind[i]), [float(c) for c in x[i]], "kept") for i in range(600)]
    return spark.createDataFrame(rows, "cell_id bigint, batch string, code int, v array<double>, block string"), x, name, kind


def test_objective_falls_in_every_pass(shifted):
    model = batch.fit(shifted[0], clusters=6, rounds=4, tolerance=0.0, pass_tolerance=0.0)
    assert model.batches == ("", "b", "c") and 1 <= len(model.rounds) <= 4
    for values in model.objective:
        assert all(b <= a + 1e-6 * abs(a) for a, b in zip(values, values[1:]))
    ends = [values[-1] for values in model.objective]
    assert len(ends) == 1 or ends[1] < ends[0]


def test_types_stay_and_batches_meet(shifted):
    v, x, name, kind = shifted
    rows = batch.harmony(v, clusters=6).orderBy("cell_id").collect()
    fixed = np.array([r.corrected for r in rows])
    assert [(r.code, r.block) for r in rows] == [(int(k), "kept") for k in kind]  # users' columns keep their values

    def gap(y, n, t):
        return np.linalg.norm(y[(name == "a") & (kind == t)].mean(axis=0) - y[(name == n) & (kind == t)].mean(axis=0))

    for n, t in (("b", 0), ("b", 1), ("b", 2), ("c", 2)):
        assert gap(fixed, n, t) < 0.35 * gap(x, n, t)
    means = np.array([fixed[kind == t].mean(axis=0) for t in range(TYPES)])
    assert min(np.linalg.norm(means[i] - means[j]) for i in range(TYPES) for j in range(i)) > 6


def test_one_pass_equals_numpy(spark, shifted):
    """A block update by Spark against the same written out over all cells at once."""
    v, x, name, _ = shifted
    model = batch.fit(v, clusters=4, rounds=1, passes=1, blocks=3, tolerance=0.0)
    code = np.searchsorted(["", "b", "c"], np.where(name == "a", "", name))
    block = np.array([r[0] for r in v.orderBy("cell_id").select(batch._place("batch", model)[1]).collect()])
    (done,) = model.rounds
    r = np.concatenate([batch.memberships(x[i : i + 1], done.centres, done.weights[block[i], code[i]], 0.1) for i in range(600)])
    counts = np.array([r[code == b].sum(axis=0) for b in range(3)])
    shift = np.zeros((3, 4, 6))
    for k in range(4):  # the ridge regression by its normal equations
        phi = np.hstack([np.ones((600, 1)), np.eye(3)[code]])
        left = (phi * r[:, k : k + 1]).T @ phi + np.diag([0, 1, 1, 1])
        shift[:, k] = np.linalg.solve(left, (phi * r[:, k : k + 1]).T @ x)[1:]
    assert np.allclose(done.shift, shift)
    before = [counts - np.array([r[(code == b) & (block == 2)].sum(axis=0) for b in range(3)])]
    share = np.bincount(code) / 600
    assert np.allclose(done.weights[2], batch.weights_of(before[0], share, 2.0))  # the last block saw the others' last counts
    fixed = np.array([q.corrected for q in batch.apply(v, model).orderBy("cell_id").collect()])
    assert np.allclose(fixed, x - np.einsum("nk,nkd->nd", r, shift[code]))


def test_unknown_batches_stay_and_nothing_is_left(spark, shifted, tmp_path, monkeypatch):
    v, x, *_ = shifted
    monkeypatch.setattr(batch, "new_path", lambda spark, label: f"file://{tmp_path}/{label}")
    model = batch.fit(v.filter("batch is null or batch = 'b'"), clusters=3, rounds=2)
    assert not list(tmp_path.iterdir())
    rows = {r.cell_id: r for r in batch.apply(v, model).filter("batch = 'c'").collect()}
    assert all(np.allclose(r.corrected, x[i]) for i, r in rows.items())
    assert batch.apply(v.limit(0), model).count() == 0
    assert batch.fit(v.limit(0)).rounds == () == batch.fit(v.filter("batch = 'b'")).rounds


@pytest.mark.parametrize("name", ["n06_weights", "n06_correction"])
def test_one_step_equals_sql(spark, name):
    assert not differences(QUERIES[name](spark, SF), ORACLE[name], SF)


def test_tasks_without_rows_have_no_sums(spark):
    """A large file is read in more ranges than it has row groups, so some tasks see no row."""
    rows = spark.createDataFrame([(0, i % 2, [1.0 + i, 2.0], [1.0 + i, 2.0]) for i in range(3)], "block int, code int, v array<double>, fixed array<double>").repartition(8, "code")
    found = batch.tally(rows, np.eye(2), np.ones((1, 2, 2)), 0.5)
    assert np.allclose(found.counts.sum(axis=(0, 2)), [2, 1])
