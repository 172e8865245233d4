"""Connected components of a graph of links, by alternating large and small stars.

Each round is two aggregations and joins over the edges.  A hub has many edges: its
minimum is combined before the shuffle, and the minima are dealt out anew before they
are joined to the edges, so that both sides of the join are plain shuffles, whose large
partitions Spark splits (adaptive skew join).  The rounds grow with the logarithm of the
longest chain.  Each round is written to the shared folder, so that a lost executor costs
one round.

A graph of at most ``FEW_EDGES`` edges, 16 MB of ids, is united by one task in place of the
rounds, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.llm.common import Scratch, dealt, write_table

FEW_EDGES = 1 << 20


def _round(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with u > v, drawn nearer to the smallest vertex of each component."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = dealt(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    nearest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(dealt(nearest), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(nearest.select("u", F.col("m").alias("v"))).distinct()


def smallest_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vertices of the edges, and the smallest vertex that each of them reaches."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))  # in the order of the ids, so that the smallest index is the smallest id
    while True:
        before, low = root.copy(), np.minimum(root[a], root[b])
        for side in (root[a], root[b]):
            np.minimum.at(root, side, low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            return ids, ids[root]


def _united(edges: DataFrame) -> DataFrame:
    """(u, v): each vertex but the smallest of its component, with that; by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if sides:
            ids, root = smallest_reached(*(np.concatenate(s) for s in zip(*sides, strict=True)))
            rest = ids != root
            yield pa.RecordBatch.from_arrays([pa.array(ids[rest]), pa.array(root[rest])], ["u", "v"])

    return edges.select("u", "v").coalesce(1).mapInArrow(run, "u bigint, v bigint")


def components(links: DataFrame, a: str, b: str, tmp: Scratch, few_edges: int = FEW_EDGES) -> DataFrame:
    """(id, component) for each vertex that isn't the smallest of its component.

    ``links`` has an undirected link in the columns ``a`` and ``b``; loops, repeats and
    links with a null end count for nothing.  The table belongs to ``tmp``.
    """
    spark = links.sparkSession
    edges = links.filter(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    before, path, rounds = None, None, 0
    while True:
        new = tmp.path("components")
        write_table(edges if before is None else _round(edges), new)
        edges = spark.read.schema("u bigint, v bigint").parquet(new)
        if path:
            tmp.drop(path)
        path, rounds = new, rounds + 1
        if rounds == 1 and edges.count() <= few_edges:
            return tmp.stored(_united(edges), "components").toDF("id", "component")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == before or not row[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        if rounds > 64:
            raise RuntimeError("components don't settle")
        before = tuple(row)
