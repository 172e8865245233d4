"""Counterfactual deltas: what a perturbation changed against like controls.

A model is fitted on training cells alone: components of their vectors, which of them
are systematic, and the controls that later cells are compared with.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.operators import embed, neighbours
from screenspark.spec import ScreenSpec

MODES = ("knn", "pc_decomposition", "hybrid")


def systematic(components: np.ndarray, direction: np.ndarray, threshold: float) -> list[int]:
    """Components near the direction of all effects; else the nearest, if it's near at all."""
    length = np.linalg.norm(direction)
    if length < 1e-10:
        return []
    cos = np.abs(components @ (direction / length)) / np.maximum(np.linalg.norm(components, axis=1), 1e-12)
    found = [int(i) for i in np.flatnonzero(cos > threshold)]
    return found or ([int(cos.argmax())] if cos.max() > 0.2 else [])


def remove_directions(x: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Each row minus its parts along the unit directions, one after the other."""
    for d in directions:
        x = x - np.outer(x @ d, d)
    return x


def without(vectors: DataFrame, directions: np.ndarray, column: str = "v") -> DataFrame:
    if not len(directions):
        return vectors

    @F.pandas_udf("array<double>")
    def clean(v: pd.Series) -> pd.Series:
        return pd.Series(list(remove_directions(np.stack(v.to_numpy()), directions))) if len(v) else pd.Series([], dtype=object)

    return vectors.withColumn(column, clean(column))


@dataclass(frozen=True)
class DeltaModel:
    spec: ScreenSpec
    basis: embed.Basis
    directions: np.ndarray
    controls: DataFrame  # cell_id, v, pcs of the training controls
    systematic: tuple[int, ...] = ()  # which components the directions are

    def transform(self, vectors: DataFrame) -> DataFrame:
        """Vectors (cell_id, is_control, v) with ``pre``, ``basal`` and ``delta``.

        knn: minus the mean of the nearest training controls; of a control itself, these
        without it.  pc_decomposition: minus the systematic components; controls get zeros.
        hybrid: the components first, on both sides, then the neighbours.
        """
        if self.spec.mode not in MODES:
            raise ValueError(f"unknown mode {self.spec.mode}")
        own = embed.project_dense(vectors, self.basis).withColumn("pre", F.col("v"))
        if self.spec.mode == "pc_decomposition":
            out = without(own, self.directions)
            zeros = F.expr("transform(v, x -> 0D)")
            return out.withColumn("basal", F.when(F.col("is_control"), F.col("pre"))).withColumn("delta", F.when(F.col("is_control"), zeros).otherwise(F.col("v"))).drop("v", "pcs")
        controls = self.controls
        if self.spec.mode == "hybrid":
            own, controls = without(own, self.directions), without(controls, self.directions)
        near = neighbours.nearest(own, controls, self.spec.neighbours, self.spec.metric, exclude_self=True, column="pcs")
        basal = neighbours.mean_profile(near, controls, about=self.spec.neighbours * vectors.count())
        out = own.join(basal, "cell_id", "left")
        delta = F.when(F.col("basal").isNotNull(), F.expr("zip_with(v, basal, (x, y) -> x - y)")).otherwise(F.col("v"))
        return out.withColumn("delta", delta).drop("v", "pcs")


def effect(train: DataFrame) -> np.ndarray:
    """Mean of the perturbed cells less that of the controls; zeros without perturbed cells."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    means = {r.is_control: np.array(r.m) for r in train.groupBy("is_control").agg(vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("m")).collect()}
    if True not in means:
        raise ValueError("no control cells to compare with")
    return means.get(False, means[True]) - means[True]


def fit(train: DataFrame, spec: ScreenSpec) -> DeltaModel:
    """Fit on (cell_id, is_control, v) of the training split; mode explore takes the mode,
    neighbours, components and metric that a sweep chooses."""
    shift = effect(train)
    if spec.mode == "explore":
        from screenspark.operators import calibrate

        spec = calibrate.calibrated(calibrate.sweep(train, spec), spec)
    basis = embed.pca(train, spec.n_pcs)
    found = [] if spec.mode == "knn" else systematic(basis.components, shift, spec.systematic_cosine)
    controls = embed.project_dense(train.filter("is_control"), basis).select("cell_id", "v", "pcs")
    return DeltaModel(spec, basis, basis.components[found], controls, tuple(found))


def fit_and_transform(train: DataFrame, others: dict[str, DataFrame], spec: ScreenSpec) -> dict[str, DataFrame]:
    """Deltas of the training split and of the others, by the same model."""
    model = fit(train, spec)
    return {name: model.transform(df) for name, df in {"train": train, **others}.items()}
