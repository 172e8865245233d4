"""Operator 1: embedding near-duplicates by a random-projection tree forest.

Equal vectors of a label form a class.  Many trees, the more the larger the label, divide
the classes of each label: a node is cut where a random projection has a sparse place not far from its middle,
and vectors close to the cut spill over to both sides.  Large nodes are divided level
by level over the cluster, smaller ones to the end inside a task.  All pairs inside a
leaf are verified by cosine in double precision.

A pair can meet in several leaves.  Each vector carries the codes of all its leaves,
and a pair counts only in the smallest code that both carry, so that links are counted
without gathering pairs.  Of a leaf's links those of a spanning forest go on to the
union into components.

Where a large share of a node lies near its mean, random cuts would part what links: that
core and all that can link with it become a dense leaf of any size, and the others are
divided on.  Leaves are compared in blocks of bounded size.
"""

from __future__ import annotations

import functools
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.llm.common import Scratch, dealt, stored
from screenspark.llm.components import components


@dataclass(frozen=True)
class ForestParams:
    """``leaf``: most vectors of a leaf that isn't dense, and of a block; ``local``: most
    of a node that one task divides; ``trees``: those of a label, and one more for each
    three halvings that it needs (one alone where it is a leaf); ``spill``: most of a node
    that goes to both sides from either, with which a pair may still be parted where vectors
    lie close, but not in all trees; ``dense``: cosine to a node's mean of its core, ``share``: least share of
    the node for a core to become a dense leaf; ``depth``: levels after which a node is
    taken as a leaf anyhow."""

    cosine: float = 0.98
    trees: int = 5
    leaf: int = 512
    local: int = 20_000
    spill: float = 0.10
    dense: float = 0.97
    share: float = 0.25
    depth: int = 60
    seed: int = 1


GRID = np.linspace(0.02, 0.98, 49)


def direction(tree: int, depth: int, size: int, seed: int) -> np.ndarray:
    """The unit vector that all nodes of one depth of a tree are projected on."""
    v = np.random.default_rng([seed, tree, depth]).normal(size=size)
    return v / np.linalg.norm(v)


def cut_of(quantiles: np.ndarray) -> float:
    """Between two neighbouring quantiles on the grid: where they lie far apart, but
    rather in the middle."""
    gap = np.diff(quantiles)
    middle = (GRID[1:] + GRID[:-1]) / 2
    k = int(np.argmax(gap * np.minimum(middle, 1 - middle)))
    return float((quantiles[k] + quantiles[k + 1]) / 2)


def margin(size: int, cosine: float) -> float:
    """How far from a cut a vector spills: about what linked vectors' projections differ."""
    return 0.6 * np.sqrt(2 * (1 - cosine) / size)


def reach(dense: float, cosine: float) -> float:
    """Cosine to the mean that a vector has at least, if it links with one of the core."""
    return dense * cosine - np.sqrt((1 - dense * dense) * (1 - cosine * cosine)) - 1e-9


def units(vectors: list) -> np.ndarray:
    x = np.asarray(np.stack(vectors), dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def leaves(x: np.ndarray, tree: int, depth: int, params: ForestParams) -> list[tuple[str, np.ndarray]]:
    """(path, rows) of the leaves below a node with the unit vectors ``x``."""
    out, todo = [], [("", np.arange(len(x)), depth)]
    while todo:
        path, rows, level = todo.pop()
        if len(rows) <= params.leaf or level >= params.depth:
            out.append((path, rows))
            continue
        mean = x[rows].mean(axis=0)
        near = x[rows] @ mean / max(np.linalg.norm(mean), 1e-300)
        core = near >= params.dense
        if core.mean() >= params.share:
            # Whatever links with the core is in the dense leaf; what isn't core goes on.
            out.append((path + "d", rows[near >= reach(params.dense, params.cosine)]))
            if not core.all():
                todo.append((path + "r", rows[~core], level + 1))
            continue
        p = x[rows] @ direction(tree, level, x.shape[1], params.seed)
        cut = cut_of(np.quantile(p, GRID))
        low, high = spill_bounds(p, cut, margin(x.shape[1], params.cosine), params.spill)
        left, right = rows[p <= high], rows[p >= low]
        if min(len(left), len(right)) == 0 or max(len(left), len(right)) == len(rows):
            left, right = rows[p <= cut], rows[p > cut]
            if not len(left) or not len(right):
                todo.append((path, rows, level + 1))
                continue
        todo += [(path + "0", left, level + 1), (path + "1", right, level + 1)]
    return out


def spill_bounds(p: np.ndarray, cut: float, width: float, share: float) -> tuple[float, float]:
    """Between these projections vectors go to both sides."""
    most = int(len(p) * share)
    below, above = np.sort(p[p <= cut]), np.sort(p[p > cut])
    low = max(cut - width, below[-most - 1] if len(below) > most else -np.inf)
    high = min(cut + width, above[most] if len(above) > most else np.inf)
    return low, high


def vector_classes(vectors: DataFrame, tmp: Scratch) -> DataFrame:
    """(cls, label, embedding, times, least) of the distinct vectors that can link; ``cls``
    is a number of its own for each, fixed as the table is written."""
    size = F.expr("aggregate(embedding, 0D, (s, v) -> s + cast(v as double) * cast(v as double))")
    good = F.expr("forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity'))")
    usable = vectors.filter("label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL").filter(good & (size > 0) & (size < float("inf")))
    grouped = usable.groupBy("label", "embedding").agg(F.count("*").alias("times"), F.min("vec_id").alias("least"))
    return tmp.stored(grouped.withColumn("cls", F.monotonically_increasing_id()), "vectors")


def planted(classes: DataFrame, tmp: Scratch, params: ForestParams) -> DataFrame:
    """(cls, embedding, tree, node): each class at the root of the trees of its label.

    Vectors of different lengths never link; a node holds those of one length.
    """
    rooted = classes.select("cls", "embedding", F.concat_ws("/", F.lit(""), "label", F.size("embedding")).alias("node"))
    levels = F.ceil(F.log2(F.col("count") / params.leaf))
    trees = F.when(F.col("count") <= params.leaf, F.lit(1)).otherwise(params.trees + F.floor(levels / 3)).cast("int")
    sizes = tmp.stored(rooted.groupBy("node").count().select("node", trees.alias("trees")), "trees")
    return rooted.join(sizes, "node").select("cls", "embedding", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"), "node")


def divide(classes: DataFrame, tmp: Scratch, params: ForestParams) -> DataFrame:
    """(cls, code): the leaves of each class in all trees.

    What is told of a node, as its size, mean and cut, is a small table of its own, so that
    joins with it needn't shuffle vectors; nodes that a task can divide wait aside.
    """
    nodes = planted(classes, tmp, params)
    depth, dense, waiting = 0, None, []
    while True:
        sizes = tmp.stored(nodes.groupBy("tree", "node").count(), "sizes")
        large = sizes.filter(F.col("count") > params.local)
        if depth >= params.depth or large.isEmpty():
            break
        waiting.append(nodes.join(large, ["tree", "node"], "left_anti"))
        found, nodes = _take_cores(nodes.join(large, ["tree", "node"], "left_semi"), tmp, params)
        if found is not None:
            dense = found if dense is None else dense.unionByName(found)
            sizes = tmp.stored(nodes.groupBy("tree", "node").count(), "sizes")
        nodes = tmp.stored(_divide_once(nodes, sizes, depth, tmp, params), "forest")
        depth += 1
    left = nodes.join(large, ["tree", "node"], "left_semi").select("cls", F.xxhash64("tree", "node").alias("code"))
    small = functools.reduce(DataFrame.unionByName, waiting, nodes.join(large, ["tree", "node"], "left_anti"))
    level = depth

    def finish(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        tree, node = key
        cls, code = frame["cls"].to_numpy(), []
        at = []
        for path, rows in leaves(units(frame["embedding"].tolist()), int(tree), level, params):
            at.append(cls[rows])
            code.append(np.full(len(rows), leaf_code(int(tree), node, path)))
        return pd.DataFrame({"cls": np.concatenate(at), "code": np.concatenate(code)})

    done = small.groupBy("tree", "node").applyInPandas(finish, "cls bigint, code bigint")
    if depth >= params.depth:
        done = done.unionByName(left)
    return done if dense is None else done.unionByName(dense)


def leaf_code(tree: int, node: str, path: str) -> int:
    text = f"{tree}:{node}:{path}".encode()
    return (zlib.crc32(text) << 31) ^ zlib.crc32(b"leaf" + text)


def _by_length(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) of those of one length."""
    lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
    return [(at, units(vectors[at])) for n in np.unique(lengths) for at in [np.flatnonzero(lengths == n)]]


def _node_means(nodes: DataFrame) -> DataFrame:
    """(tree, node, mean) of the unit vectors; a task sends a row of sums for a node."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    def add(batches):
        sums: dict[tuple, np.ndarray] = {}
        for frame in batches:
            vectors = frame["embedding"].to_numpy()
            for key, at in frame.groupby(["tree", "node"]).indices.items():
                sums[key] = sums.get(key, 0) + np.append(units(vectors[at]).sum(axis=0), len(at))
        if sums:
            yield pd.DataFrame({"tree": [k[0] for k in sums], "node": [k[1] for k in sums], "sums": list(sums.values())})

    sums = nodes.select("tree", "node", "embedding").mapInPandas(add, "tree int, node string, sums array<double>")
    total = sums.groupBy("tree", "node").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("s"))
    return total.select("tree", "node", F.expr("transform(slice(s, 1, size(s) - 1), x -> x / element_at(s, -1))").alias("mean"))


def _take_cores(nodes: DataFrame, tmp: Scratch, params: ForestParams) -> tuple[DataFrame | None, DataFrame]:
    """(leaves, nodes): dense leaves of the nodes that have a core, or None, and the nodes
    without those cores; as inside a task, but with means and shares over the cluster."""

    @F.pandas_udf("double")
    def near(embedding: pd.Series, mean: pd.Series) -> pd.Series:
        out, means = np.zeros(len(embedding)), mean.to_numpy()
        for at, x in _by_length(embedding.to_numpy()):
            m = np.stack(means[at])
            out[at] = (x * m).sum(axis=1) / np.maximum(np.linalg.norm(m, axis=1), 1e-300)
        return pd.Series(out)

    means = tmp.stored(_node_means(nodes), "means")
    rows = nodes.join(means, ["tree", "node"]).select("cls", "tree", "node", "embedding", near("embedding", "mean").alias("near"))
    share = rows.groupBy("tree", "node").agg(F.avg((F.col("near") >= params.dense).cast("double")).alias("share"))
    cores = tmp.stored(share.filter(F.col("share") >= params.share).select("tree", "node"), "shares")
    if cores.isEmpty():
        return None, nodes
    cored = tmp.stored(rows.join(cores, ["tree", "node"], "left_semi"), "cores")
    leaves = cored.filter(F.col("near") >= float(reach(params.dense, params.cosine))).select("cls", F.xxhash64("tree", "node", F.lit("dense")).alias("code"))
    rest = cored.filter(F.col("near") < params.dense).select("cls", "embedding", "tree", F.concat("node", F.lit("r")).alias("node"))
    return leaves, nodes.join(cores, ["tree", "node"], "left_anti").select("cls", "embedding", "tree", "node").unionByName(rest)


def _divide_once(nodes: DataFrame, sizes: DataFrame, depth: int, tmp: Scratch, params: ForestParams) -> DataFrame:
    """One more level below the nodes that are too large for a task."""

    @F.pandas_udf("double")
    def project(embedding: pd.Series, tree: pd.Series) -> pd.Series:
        out, trees = np.zeros(len(tree)), tree.to_numpy()
        for at, x in _by_length(embedding.to_numpy()):
            for t in np.unique(trees[at]):
                some = trees[at] == t
                out[at[some]] = x[some] @ direction(int(t), depth, x.shape[1], params.seed)
        return pd.Series(out)

    @F.pandas_udf("double")
    def cut(quantiles: pd.Series) -> pd.Series:
        return quantiles.map(lambda q: cut_of(np.asarray(q)))

    keys = sizes.filter(F.col("count") > params.local).select("tree", "node")
    large = nodes.join(keys, ["tree", "node"], "left_semi").withColumn("p", project("embedding", "tree"))
    quantiles = large.groupBy("tree", "node").agg(F.percentile_approx("p", GRID.tolist(), 2000).alias("q"), F.min("p").alias("p0"), F.max("p").alias("p1"))
    # The spill's bounds come from the quantiles around the cut.
    bounds = quantiles.withColumn("cut", cut("q"))
    step = max(1, round(params.spill / (GRID[1] - GRID[0])))
    bounds = bounds.withColumn("k", F.expr("size(filter(q, v -> v <= cut))"))
    bounds = bounds.withColumn("low", F.expr(f"if(k > {step}, q[k - 1 - {step}], p0)")).withColumn("high", F.expr(f"if(k + {step} < size(q), q[k + {step}], p1)"))
    bounds = tmp.stored(bounds.select("tree", "node", "cut", "low", "high", "p0", "p1"), "cuts")
    width = 0.6 * float(np.sqrt(2 * (1 - params.cosine)))
    reach = F.lit(width) / F.sqrt(F.size("embedding"))
    split = large.join(bounds, ["tree", "node"])
    left = (F.col("p") <= F.least("high", F.col("cut") + reach)) & (F.col("p0") < F.col("p1"))
    right = (F.col("p") > F.greatest("low", F.col("cut") - reach)) & (F.col("p0") < F.col("p1"))
    sides = F.array_compact(F.array(F.when(left | (F.col("p0") == F.col("p1")), F.lit("0")), F.when(right, F.lit("1"))))
    children = split.select("cls", "embedding", "tree", "node", F.explode(sides).alias("side"))
    children = children.select("cls", "embedding", "tree", F.concat("node", F.lit("."), "side").alias("node"))
    return nodes.join(keys, ["tree", "node"], "left_anti").select("cls", "embedding", "tree", "node").unionByName(children)


def leaf_links(classes: DataFrame, codes: DataFrame, tmp: Scratch, params: ForestParams) -> DataFrame:
    """(cls, links, near): by leaf and class the vectors that it links with and that no
    smaller leaf has counted, and one class that a chain of links leads to, or null."""
    from pyspark.sql.types import LongType, StructField, StructType

    codes = tmp.stored(codes.distinct(), "leaves")
    blocks = codes.groupBy("code").count().withColumn("blocks", F.ceil(F.col("count") / params.leaf)).select("code", "blocks")
    every = codes.groupBy("cls").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    rows = classes.select("cls", "embedding", "times").join(every, "cls")
    rows = rows.withColumn("code", F.explode("codes")).join(blocks, "code")
    # Block i meets the blocks from i on; the seed keeps cls's own hash from deciding.
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cls", F.lit(params.seed)), F.col("blocks")))
    meets = F.expr("transform(sequence(0L, blocks - 1), k -> struct(least(block, k) as a, greatest(block, k) as b))")
    rows = rows.withColumn("pair", F.explode(meets)).select("code", "pair", "block", "cls", "times", "embedding", "codes")
    schema = StructType([StructField(n, LongType()) for n in ("cls", "links", "near")])

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        code = key[0]
        a, b = (int(key[1][k]) for k in (0, 1)) if not isinstance(key[1], dict) else (key[1]["a"], key[1]["b"])
        x = units(frame["embedding"].tolist())
        cls, times, block = (frame[k].to_numpy() for k in ("cls", "times", "block"))
        n = len(x)
        similar = x @ x.T >= params.cosine
        similar &= ~np.eye(n, dtype=bool)
        if a != b:
            similar &= block[:, None] != block[None, :]
        i, j = np.nonzero(np.triu(similar))
        smaller = [frozenset(c for c in own if c < code) for own in frame["codes"]]
        counted = np.fromiter((not smaller[p].isdisjoint(smaller[q]) for p, q in zip(i.tolist(), j.tolist())), bool, len(i))
        links = np.zeros(n, dtype=np.int64)
        np.add.at(links, i[~counted], times[j[~counted]])
        np.add.at(links, j[~counted], times[i[~counted]])
        root = np.arange(n)
        while True:  # the smallest row that a chain of links leads to
            least = np.minimum(root, np.minimum.reduce(np.where(similar, root[None, :], n), axis=1, initial=n))
            least = least[least]
            if (least == root).all():
                break
            root = least
        near = pd.array(cls[root], dtype="Int64")
        near[root == np.arange(n)] = pd.NA
        out = pd.DataFrame({"cls": cls, "links": links, "near": near})
        return out[(links > 0) | out["near"].notna()]

    return rows.groupBy("code", "pair").applyInPandas(compare, schema)


def near_duplicates(vectors: DataFrame, params: ForestParams = ForestParams()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label).

    Vectors link when their labels are equal and their cosine is at least ``cosine``.  A
    row whose label, embedding or vec_id is null, or whose vector is zero, empty or holds
    null or non-finite components links with nothing; its component is its own vec_id.
    Rows that repeat a vector link with each other.  ``kept``: vec_id = component_id.
    Other columns are ignored.
    """
    vectors = vectors.select("vec_id", "embedding", "label")
    with Scratch(vectors.sparkSession) as tmp:
        classes = vector_classes(vectors, tmp)
        found = tmp.stored(leaf_links(classes, divide(classes, tmp, params), tmp, params), "vector-links")
        links = found.groupBy("cls").agg(F.sum("links").alias("links"))
        rooted = components(found.filter("near IS NOT NULL"), "cls", "near", tmp).select(F.col("id").alias("cls"), F.col("component").alias("root"))
        known = classes.join(links, "cls", "left").join(rooted, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
        known = known.join(dealt(smallest), "root").select("label", "embedding", "component_id", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n"))
        # Hashes go first, so that vectors are compared where these are equal; a row that can't link finds nothing.
        keys = ["hash", "label", "embedding"]
        own, known = (df.withColumn("hash", F.xxhash64("label", "embedding")) for df in (vectors, known))
        out = own.join(known, keys, "left").select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("n")).alias("n"), F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"))
        out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        return stored(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), "near-vectors")
