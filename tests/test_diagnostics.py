"""Densities against direct sums, distances to a front, recovery by shard."""

import numpy as np
import pytest

from screenspark.operators import diagnostics
from screenspark.sources import matrix


def pairs(spark, a, b=None):
    return spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, a if b is None else b)] + [(None, 1.0), (float("nan"), 2.0)], "a double, b double")


@pytest.mark.parametrize(("adjust", "cut"), [(1.0, 3.0), (0.5, 0.0)])
def test_density_is_the_direct_sum(spark, adjust, cut):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, 300), rng.normal(8, 0.5, 100)])
    bw = x.std(ddof=1) * len(x) ** -0.2 * adjust
    rows = diagnostics.density(pairs(spark, x), "a", adjust=adjust, cut=cut).orderBy("x").collect()
    at = np.array([r.x for r in rows])
    want = np.exp(-0.5 * ((at[:, None] - x) / bw) ** 2).sum(axis=1) / (len(x) * bw * np.sqrt(2 * np.pi))
    assert len(rows) == 512 and np.isclose(at[0], x.min() - cut * bw) and np.abs(np.array([r.density for r in rows]) - want).max() < 1e-3 * want.max()
    assert diagnostics.density(pairs(spark, [3, 3, 3]), "a").count() == 0 and diagnostics.density(pairs(spark, []), "a").count() == 0


def test_density_2d_is_the_direct_sum(spark):
    rng = np.random.default_rng(1)
    p = rng.normal(size=(400, 2)) @ np.array([[1.0, 0.8], [0.0, 0.5]])
    cov = np.cov(p.T) * len(p) ** (-1 / 3)
    got = diagnostics.density_2d(pairs(spark, p[:, 0], p[:, 1]), "a", "b").toPandas()
    assert len(got) == 320**2
    got = got.iloc[::13]
    d = got[["x", "y"]].to_numpy()[:, None] - p
    want = np.exp(-0.5 * np.einsum("ijk,kl,ijl->ij", d, np.linalg.inv(cov), d)).sum(axis=1) / (len(p) * 2 * np.pi * np.sqrt(np.linalg.det(cov)))
    assert np.abs(got["density"].to_numpy() - want).max() < 1e-3 * want.max()
    assert diagnostics.density_2d(pairs(spark, [1, 2, 3, 4]), "a", "b").count() == 0


def test_distance_without_a_front(spark):
    points = spark.createDataFrame([("p", 0.0, 1.0, 3.0), ("q", 1.0, 0.0, 3.0)], "point string, x double, y double, s double")
    rows = diagnostics.front_distances(points, points.filter("false"), "x", "y", "s").collect()
    assert {(r.distance, r.score_rank) for r in rows} == {(1.0, 0.5)}


def test_only_missing_shards_are_made_again(spark, tmp_path):
    made = []

    def make(shard):
        made.append(shard)
        if len(made) == 3:
            spark.createDataFrame([(9,)], "v int").write.parquet(f"{tmp_path}/shard=c")  # unfinished work of the run that stops
            (tmp_path / "shard=c" / "_SUCCESS").unlink()
            raise RuntimeError("stopped")
        return spark.createDataFrame([(ord(shard),)], "v int")

    with pytest.raises(RuntimeError):
        matrix.recovered(spark, str(tmp_path), list("abcde"), make)
    assert matrix.shards_done(spark, str(tmp_path), list("abcde")) == ["a", "b"]
    found = matrix.recovered(spark, str(tmp_path), list("abcde"), make)
    assert made == list("abccde") and sorted((r.shard, r.v) for r in found.collect()) == [(s, ord(s)) for s in "abcde"]
