"""Operator 1's division of large nodes over the cluster."""

from dataclasses import replace

import numpy as np

from screenspark.llm import near_vectors
from screenspark.llm.common import Scratch


def classes_of(spark, x, labels):
    rows = [(i, int(g), [float(c) for c in v], 1, i) for i, (v, g) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, "cls bigint, label int, embedding array<float>, times bigint, least bigint")


def test_large_nodes_are_divided_by_tasks(spark, monkeypatch):
    """Every class has a leaf in each tree, vectors near a label's centre share one, and no expression
    goes through a vector's numbers for each of its numbers."""
    rng = np.random.default_rng(14)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    x[:200] = x[0] + rng.normal(size=(200, 8)) * 1e-3  # a third of its label, a core
    labels = np.where(np.arange(900) < 600, 1, 2)
    params = replace(near_vectors.ForestParams(), local=150, leaf=40)
    plans, stored = [], Scratch.stored
    monkeypatch.setattr(Scratch, "stored", lambda self, df, label: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), stored(self, df, label))[1])
    with Scratch(spark) as tmp:
        found = near_vectors.divide(classes_of(spark, x, labels), tmp, params).collect()
    codes = {}
    for r in found:
        codes.setdefault(r.cls, set()).add(r.code)
    trees = params.trees + int(np.ceil(np.log2(300 / 40))) // 3
    assert codes.keys() == set(range(900)) and all(len(codes[i]) >= trees for i in range(600, 900))
    assert set.intersection(*(codes[i] for i in range(200)))
    assert len(plans) > 4 and not any("aggregate(" in p for p in plans)


def test_means_of_nodes(spark):
    rng = np.random.default_rng(15)
    x, y = rng.normal(size=(50, 3)), rng.normal(size=(20, 5))
    rows = [(0, "a", v.tolist()) for v in x] + [(1, "b", v.tolist()) for v in y]
    means = {r.node: r["mean"] for r in near_vectors._node_means(spark.createDataFrame(rows, "tree int, node string, embedding array<double>").repartition(3)).collect()}
    for node, v in (("a", x), ("b", y)):
        np.testing.assert_allclose(means[node], (v / np.linalg.norm(v, axis=1, keepdims=True)).mean(axis=0), atol=1e-12)
