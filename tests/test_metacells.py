"""Metacells of groups that a task doesn't hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenspark.operators import metacells


def frame(spark, x, groups):
    import pyarrow as pa

    v = pa.FixedSizeListArray.from_arrays(pa.array(x.astype(float).ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
    table = pa.table({"cell_id": np.arange(len(x)), "pert": pa.array(groups, pa.string()), "v": v})
    return spark.createDataFrame(table).repartition(8)


def inertia(found, x):
    rows = found.select("cell_id", "pert", "metacell").toPandas()
    assert sorted(rows["cell_id"]) == list(range(len(x)))
    return sum(((x[c] - x[c].mean(axis=0)) ** 2).sum() for c in (part["cell_id"].to_numpy() for _, part in rows.groupby(["pert", "metacell"], dropna=False)))


def test_large_group_keeps_planted_blobs_whole(spark):
    """50,000 cells in 40 blobs: no metacell mixes two of them."""
    rng = np.random.default_rng(0)
    blob = rng.integers(40, size=50_000)
    x = (rng.normal(size=(40, 12)) * 30)[blob] + rng.normal(size=(50_000, 12)) * 0.5
    found = metacells.cluster_metacells(frame(spark, x, ["a"] * 50_000), "pert").select("cell_id", "metacell").toPandas()
    assert len(found) == 50_000 and found["metacell"].nunique() == pytest.approx(50_000 / 15, rel=0.01)
    assert (found.assign(blob=blob[found["cell_id"]]).groupby("metacell")["blob"].nunique() == 1).all()


def test_divided_groups_are_as_tight_as_one_task(spark):
    """Several groups at once, one null, that fit a task: divided or not, the inertia is the same within 5 %."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6_000, 8)) @ rng.normal(size=(8, 8)) + rng.normal(size=(30, 8))[rng.integers(30, size=6_000)] * 4
    groups = ["a"] * 3_500 + [None] * 2_000 + ["c"] * 500
    cells = frame(spark, x, groups)
    one = inertia(metacells.cluster_metacells(cells, "pert"), x)
    parted = inertia(metacells.cluster_metacells(cells, "pert", most=400, batch=512, ways=4), x)
    assert parted <= 1.05 * one, parted / one


def test_equal_cells_can_be_divided(spark):
    x = np.vstack([np.zeros((900, 3)), np.ones((2, 3)) * 5])
    found = metacells.cluster_metacells(frame(spark, x, ["a"] * 902), "pert", most=100, batch=64)
    sizes = found.groupBy("metacell").agg(F.count("*").alias("n"), F.count_distinct("v").alias("kinds")).collect()
    assert sum(r.n for r in sizes) == 902 and sum(r.kinds > 1 for r in sizes) <= 1


def test_no_cells(spark):
    assert metacells.cluster_metacells(frame(spark, np.zeros((1, 2)), ["a"]).filter("false"), "pert").count() == 0
