"""Metacells: clusters of cells of a perturbation, and their profiles."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from screenspark.functions.statistics import rank_in_ranges
from screenspark.sources.storage import settled
from screenspark.spec import ScreenSpec


def metacell_count(n: str, base: int = 10) -> Column:
    """By size of the group: one below 30, then groups of 5, of ``base``, of a few more."""
    c = F.col(n)
    target = F.when(c < 30, c).when(c < 100, F.lit(5)).when(c < 500, F.lit(base)).otherwise(F.lit(min(base + 5, 20)))
    return F.greatest(F.lit(1), F.floor(c / target)).cast("bigint")


def grainings(obs: DataFrame, *by: str, base: int = 10) -> DataFrame:
    """(group, n_cells, n_metacells)."""
    return obs.groupBy(*by).agg(F.count("*").alias("n_cells")).withColumn("n_metacells", metacell_count("n_cells", base))


def dealt_metacells(obs: DataFrame, *by: str, base: int = 10) -> DataFrame:
    """Cells dealt out over the metacells of their group in the order of their ids."""
    ids = settled(obs.select("cell_id", *by))
    ranked = rank_in_ranges(ids, "cell_id", *by, name="_r").join(grainings(ids, *by, base=base), list(by))
    return obs.join(ranked.select("cell_id", ((F.col("_r") - 1) % F.col("n_metacells")).cast("bigint").alias("metacell")), "cell_id")


def lloyd(x: np.ndarray, k: int, rounds: int = 50) -> np.ndarray:
    """k-means from a farthest-first start at the first row; labels in use are 0..."""
    centres = [0]
    d = ((x - x[0]) ** 2).sum(axis=1)
    while len(centres) < min(k, len(x)):
        centres.append(int(d.argmax()))
        d = np.minimum(d, ((x - x[centres[-1]]) ** 2).sum(axis=1))
    c, label = x[centres], None
    for _ in range(rounds):
        new = ((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        if label is not None and (new == label).all():
            break
        label = new
        c = np.stack([x[label == j].mean(axis=0) if (label == j).any() else c[j] for j in range(len(c))])
    return np.unique(label, return_inverse=True)[1]


def bounded(small: DataFrame, most: int = 100_000) -> DataFrame:
    """A stored table, to be broadcast if it has at most so many rows."""
    return F.broadcast(small) if small.count() <= most else small


def _spread(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres by k-means++ and some rounds of Lloyd; fewer where points coincide."""
    centres = x[rng.integers(len(x))][None]
    d = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and d.max() > 0:
        centres = np.vstack([centres, x[rng.choice(len(x), p=d / d.sum())]])
        d = np.minimum(d, ((x - centres[-1]) ** 2).sum(axis=1))
    for _ in range(20):
        label = ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        moved = np.stack([x[label == j].mean(axis=0) if (label == j).any() else c for j, c in enumerate(centres)])
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def _group_axes(cells: DataFrame, components: int) -> DataFrame:
    """(_g, axes): the first right singular vectors of each group's own cells, from sums of
    products that tasks add up, one small matrix a group and task."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    def add(batches):
        sums = {}
        for batch in batches:
            for g, rows in batch.groupby("_g")["v"]:
                x = np.stack(rows.to_numpy())
                sums[g] = sums.get(g, 0) + x.T @ x
        yield pd.DataFrame({"_g": list(sums), "sums": [s.ravel() for s in sums.values()]})

    def axes(batches):
        for batch in batches:
            found = []
            for s in batch["sums"]:
                size = int(round(len(s) ** 0.5))
                found.append(np.linalg.eigh(np.reshape(s, (size, size)))[1][:, ::-1][:, :components].T.tolist())
            yield pd.DataFrame({"_g": batch["_g"], "axes": found})

    total = cells.select("_g", "v").mapInPandas(add, "_g bigint, sums array<double>").groupBy("_g").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    return total.mapInPandas(axes, "_g bigint, axes array<array<double>>")


def _divided(cells: DataFrame, most: int, batch: int, ways: int) -> DataFrame:
    """(cell_id, _g, _n, x, leaf): cells (cell_id, _g, _n, x) in leaves of at most ``most``.
    A leaf's number has seven bits for each level, so ``ways`` is at most 127.

    All nodes that are too large are divided at once, level by level: k-means of a batch of
    cells, drawn from all of a node's by a hash, gives it up to ``ways`` centres, a row of a
    table; each cell goes to the nearest.  Where a batch holds only equal vectors, a
    hash divides the node.
    """
    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x, size, level = np.stack(frame.sort_values("cell_id")["x"].to_numpy()), *(int(frame[c].iloc[0]) for c in ("_size", "_level"))
        k = min(ways, -(-2 * size // most))
        return pd.DataFrame({"_g": [key[0]], "leaf": [key[1]], "centres": [_spread(x, k, np.random.default_rng(level)).tolist()], "_ways": [k]})

    nodes, done, level = settled(cells.withColumn("leaf", F.lit(0).cast("bigint"))), [], 0
    while True:
        sizes = settled(nodes.groupBy("_g", "leaf").agg(F.count("*").alias("_size")).filter(F.col("_size") > most))
        if sizes.isEmpty():
            break
        done.append(nodes.join(bounded(sizes), ["_g", "leaf"], "left_anti"))
        nodes = nodes.join(bounded(sizes), ["_g", "leaf"])
        first = F.row_number().over(W.partitionBy("_g", "leaf").orderBy(F.xxhash64("cell_id", F.lit(level)), "cell_id"))
        centres = nodes.withColumn("_first", first).filter(F.col("_first") <= batch).withColumn("_level", F.lit(level)).groupBy("_g", "leaf").applyInPandas(fit, "_g bigint, leaf bigint, centres array<array<double>>, _ways int")
        far = F.transform("centres", lambda c: F.aggregate(F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, t: s + t))
        met = nodes.join(bounded(settled(centres), 1_000), ["_g", "leaf"]).withColumn("_far", far)
        child = F.when(F.size("centres") > 1, F.array_position("_far", F.array_min("_far"))).otherwise(1 + F.pmod(F.xxhash64("cell_id", F.lit(-1 - level)), "_ways"))
        nodes, level = settled(met.select("cell_id", "_g", "_n", "x", (F.col("leaf") * 128 + child).alias("leaf"))), level + 1
    return reduce(DataFrame.unionByName, done, nodes)


def _refined(cells: DataFrame, found: DataFrame, rounds: int, near: int = 3) -> DataFrame:
    """(cell_id, _g, leaf, label) after some rounds of Lloyd across the borders of leaves.

    ``cells`` has (cell_id, _g, x, leaf), ``found`` the start.  The metacells' means are a
    table, by the leaf that a metacell began in; each cell is held against those of the
    leaves whose means are nearest to it, and goes to the nearest of all.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    mean = vector_to_array(Summarizer.mean(array_to_vector("x"))).alias("m")
    leaves = cells.groupBy("_g", "leaf").agg(mean).groupBy("_g").agg(F.collect_list(F.struct("m", "leaf")).alias("leaves"))
    far = F.transform("leaves", lambda c: F.struct(F.aggregate(F.zip_with("x", c["m"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, t: s + t).alias("d"), c["leaf"].alias("leaf")))
    met = cells.drop("leaf").join(bounded(settled(leaves), 1_000), "_g").withColumn("_near", F.slice(F.array_sort(far), 1, near))
    asked = settled(met.select("cell_id", "_g", "x", F.explode("_near.leaf").alias("leaf")))

    def assign(key: tuple, own: pd.DataFrame, means: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(means):
            return pd.DataFrame({"cell_id": [], "leaf": [], "label": [], "d": []})
        c, labels, best, least = np.stack(means["m"].to_numpy()), means["label"].to_numpy(), [], []
        for start in range(0, len(own), 2_048):
            x = np.stack(own["x"].iloc[start : start + 2_048].to_numpy())
            d = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T
            best.append(labels[d.argmin(axis=1)])
            least.append(d.min(axis=1))
        return pd.DataFrame({"cell_id": own["cell_id"], "leaf": key[1], "label": np.concatenate(best), "d": np.concatenate(least)})

    places = cells.select("cell_id", "_g", "x")
    for _ in range(rounds):
        means = places.join(found.select("cell_id", "leaf", "label"), "cell_id").groupBy(F.col("_g").alias("_of"), F.col("leaf").alias("_home"), "label").agg(mean)
        each = asked.groupBy("_g", "leaf").cogroup(means.groupBy("_of", "_home")).applyInPandas(assign, "cell_id bigint, leaf bigint, label bigint, d double")
        found = settled(each.groupBy("cell_id").agg(F.min(F.struct("d", "leaf", "label")).alias("_to")).select("cell_id", "_to.leaf", "_to.label"))
    return places.select("cell_id", "_g").join(found, "cell_id")


def cluster_metacells(vectors: DataFrame, *by: str, base: int = 10, components: int = 10, most: int = 8_000, batch: int = 8_192, ways: int = 64, rounds: int = 4) -> DataFrame:
    """``vectors`` with ``metacell``, by k-means on a group's own few components.

    A task clusters at most ``most`` cells.  A larger group is projected on its own
    components, whatever its size, and divided by a tree of k-means centres (``_divided``)
    into leaves of neighbouring cells, which are clustered like small groups, each with its
    share of the group's metacells; rounds over the whole group follow, in which cells
    cross the borders (``_refined``).  Groups may be null; a cell_id stands for one cell.
    """
    keyed = vectors.select("cell_id", F.to_json(F.struct(*by), {"ignoreNullFields": "false"}).alias("_key"), "v")
    sizes = settled(keyed.groupBy("_key").agg(F.count("*").alias("_n")).withColumn("_g", F.monotonically_increasing_id()))
    cells = keyed.join(bounded(sizes), "_key").drop("_key")

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cell_id").reset_index(drop=True)
        x, n, size = np.stack(frame["x"].to_numpy()), int(frame["_n"].iloc[0]), len(frame)
        target = n if n < 30 else 5 if n < 100 else base if n < 500 else min(base + 5, 20)
        k = max(1, n // target if size == n else round(size / target))
        if n >= 50 and size == n:
            x = x @ np.linalg.svd(x, full_matrices=False)[2][:components].T
        label = lloyd(x, k) if k > 1 else np.zeros(size, dtype=int)
        return pd.DataFrame({"cell_id": frame["cell_id"], "_g": key[0], "leaf": key[1], "label": label.astype(np.int64)})

    def clustered(leaves: DataFrame) -> DataFrame:
        return leaves.groupBy("_g", "leaf").applyInPandas(run, "cell_id bigint, _g bigint, leaf bigint, label bigint")

    found = clustered(cells.filter(F.col("_n") <= most).select("cell_id", "_g", "_n", F.col("v").alias("x"), F.lit(0).cast("bigint").alias("leaf")))
    if not sizes.filter(F.col("_n") > most).isEmpty():
        rest = cells.filter(F.col("_n") > most)
        turned = F.transform("axes", lambda w: F.aggregate(F.zip_with("v", w, lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t))
        scores = rest.join(bounded(settled(_group_axes(rest, components)), 1_000), "_g").select("cell_id", "_g", "_n", turned.alias("x"))
        leaves = _divided(scores, most, batch, ways)
        found = found.unionByName(_refined(leaves.select("cell_id", "_g", "x", "leaf"), settled(clustered(leaves)), rounds).select("cell_id", "_g", "leaf", "label"))
    found = settled(found)
    tops = found.groupBy("_g", "leaf").agg(F.max("label").alias("_top"))
    before = F.sum(F.col("_top") + 1).over(W.partitionBy("_g").orderBy("leaf")) - F.col("_top") - 1  # a group's leaves are few
    offsets = settled(tops.select("_g", "leaf", before.alias("_before")))
    named = found.join(bounded(offsets), ["_g", "leaf"]).select("cell_id", (F.col("label") + F.col("_before")).alias("metacell"))
    return vectors.join(named, "cell_id")


def profiles(cells: DataFrame, *by: str) -> DataFrame:
    """(by..., metacell, n_cells_in_metacell, v): mean vectors of the clusters."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return cells.groupBy(*by, "metacell").agg(F.count("*").alias("n_cells_in_metacell"), vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("v"))


def inner_variance(meta: DataFrame, *by: str, spec: ScreenSpec = ScreenSpec()) -> DataFrame:
    """(by..., n_metacells, inner_variance, warn): mean over features of the variance
    across metacells over the mean; 0 for a single one."""
    values = meta.select(*by, F.posexplode("v").alias("i", "x"))
    per = values.groupBy(*by, "i").agg(F.var_pop("x").alias("var"), F.avg("x").alias("mean"), F.count("*").alias("n"))
    level = F.when(F.avg("mean") <= 1e-10, 1.0).otherwise(F.avg("mean"))
    out = per.groupBy(*by).agg(F.max("n").alias("n_metacells"), F.when(F.max("n") < 2, 0.0).otherwise(F.avg("var") / level).alias("inner_variance"))
    return out.withColumn("warn", F.col("inner_variance") > spec.variance_warning)


def centroids(meta: DataFrame, control: str) -> DataFrame:
    """(i, c_ctrl, o_pert_macro, o_pert_micro) by feature: the controls' mean, and that
    of the perturbed metacells, unweighted over perturbations and over all rows."""
    values = meta.select("pert", F.posexplode("v").alias("i", "x"))
    ctrl = values.filter(F.col("pert") == control).groupBy("i").agg(F.avg("x").alias("c_ctrl"))
    rest = values.filter(F.col("pert") != control)
    macro = rest.groupBy("pert", "i").agg(F.avg("x").alias("m")).groupBy("i").agg(F.avg("m").alias("o_pert_macro"))
    micro = rest.groupBy("i").agg(F.avg("x").alias("o_pert_micro"))
    return macro.join(micro, "i").join(ctrl, "i", "left").withColumn("i", F.col("i").cast("bigint")).select("i", "c_ctrl", "o_pert_macro", "o_pert_micro")


def large_enough(obs: DataFrame, spec: ScreenSpec, *by: str) -> DataFrame:
    """Rows of the groups that have enough cells."""
    small = obs.groupBy(*by).count().filter(F.col("count") < spec.min_cells_per_split)
    return obs.join(F.broadcast(small), list(by), "left_anti")


def rollup(meta: DataFrame) -> DataFrame:
    """(cell_line, split, n_metacells, n_cells) with totals of lines and of all."""
    out = meta.rollup("cell_line", "split").agg(F.count("*").alias("n_metacells"), F.sum("n_cells_in_metacell").alias("n_cells"), F.grouping("cell_line").alias("_a"), F.grouping("split").alias("_b"))
    return out.select(F.when(F.col("_a") == 1, "TOTAL").otherwise(F.col("cell_line")).alias("cell_line"), F.when(F.col("_b") == 1, "TOTAL").otherwise(F.col("split")).alias("split"), "n_metacells", "n_cells")



def manifold(cells: DataFrame, meta: DataFrame, line: str = "cell_line") -> DataFrame:
    """(line, kind, id, x, y): cells and metacells on the first two components, not centred,
    of the cells of their line; ``id`` is a cell's, or null.  Lines are few."""
    from screenspark.operators.embed import signed, summed

    size = len(cells.select("v").first().v)
    names = [r[0] for r in cells.select(line).distinct().orderBy(line).collect()]
    at = {name: i for i, name in enumerate(names)}

    def add(batches):
        total = np.zeros((len(names), size, size))
        for batch in batches:
            for name, rows in batch.groupby(line)["v"]:
                x = np.stack(rows.to_numpy())
                total[at[name]] += x.T @ x
        yield pd.DataFrame({"row": np.arange(len(names)), "sums": list(total.reshape(len(names), -1))})

    axes = {names[r.row]: signed(np.linalg.eigh(np.reshape(r.sums, (size, size)))[1][:, ::-1][:, :2].T) for r in summed(cells.select(line, "v").mapInPandas(add, "row int, sums array<double>"))}

    @F.pandas_udf("array<double>")
    def place(name: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series([axes[n] @ x for n, x in zip(name, v)], dtype=object)

    both = cells.select(line, F.lit("cell").alias("kind"), F.col("cell_id").alias("id"), "v").unionByName(meta.filter(F.col(line).isin(names)).select(line, F.lit("metacell").alias("kind"), F.lit(None).cast("bigint").alias("id"), "v"))
    return both.withColumn("_p", place(line, "v")).select(line, "kind", "id", F.col("_p")[0].alias("x"), F.col("_p")[1].alias("y"))
