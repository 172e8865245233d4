"""Tries over the turns of conversations, kept as level-order (LOUDS) bitvectors.

A node is a distinct sequence of first turns; its members are the conversations that
start with it.  Turns are digests of 16 bytes from the first step on, so texts are read
once and never shuffled.  A running XOR of hashes of (depth, digest) names each prefix
with 128 bits.

Equal conversations become one sequence with a count before anything is built.  Prefixes
that many sequences share (``heavy``) are the upper levels: there are at most
``MOST_HEAVY`` of them, since each needs that share of all rows.  Below them every
sequence belongs to the shard of its first prefix that isn't heavy; tasks read whole
shards, and numpy builds for each batch of them the LOUDS bitvector (a one for each child
of a node, then a zero, in level order) with the array of labels, takes parents from it
by rank and select, and sums upwards level by level with ``add.at``.  What the shards'
roots hold is added up for the heavy prefixes, whose own trie is built from at most
``MOST_HEAVY`` rows in one task.

Shards hold few sequences, so that a popular prefix is divided.  A conversation itself is
one sorted stream in bounded memory until its trie, which takes some 200 bytes a turn.
The digest of all members of a node that end there is taken over runs of ids, which are
put together before the shuffle, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from screenspark.llm.common import Scratch, stored

#: Most heavy prefixes, and sequences below which a prefix is never heavy.
MOST_HEAVY, CROWD = 100_000, 32
#: Ids of members that are put together before the shuffle, and rows of a batch of shards.
RUN, AT_ONCE = 256, 50_000
NO_ENDS = hashlib.sha256().hexdigest()
KEY = ["depth", "a", "b"]


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, label, bytes) of each turn; pos counts from 0 within a conversation.

    Turns are in the order of ``turn``, null first, and of their labels where they tie; a
    null role or text is empty, and a turn that is repeated counts twice.  Rows without
    conv_id belong to no conversation.  ``label`` is the MD5 of the role's length in
    characters, a colon, role and text; ``bytes`` the length of the text in UTF-8.
    """
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    label = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.select("conv_id", "turn", label.alias("label"), F.octet_length(text).cast("bigint").alias("bytes")).filter("conv_id IS NOT NULL")
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "label")
    return turns.select("conv_id", (F.row_number().over(order) - 1).cast("bigint").alias("pos"), "label", "bytes")


def hash_of(side: int) -> Column:
    return F.xxhash64(F.lit(side), "depth", "label")


def paths(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation: (conv_id, depth, a, b, label, bytes, last).

    ``turns`` has (conv_id, place, label, bytes), ``place`` ordering the turns of a
    conversation; a row with a null place stands for the conversation itself, and
    conversations that have none get one here.
    """
    whole = turns.select("conv_id").distinct().select("conv_id", F.lit(None).cast(turns.schema["place"].dataType).alias("place"), F.lit(b"").alias("label"), F.lit(0).cast("bigint").alias("bytes"))
    order = W.partitionBy("conv_id").orderBy(F.col("place").asc_nulls_first())
    numbered = whole.unionByName(turns.filter("place IS NOT NULL")).withColumn("depth", (F.row_number().over(order) - 1).cast("bigint"))
    order = W.partitionBy("conv_id").orderBy("depth")
    a, b = (F.bit_xor(hash_of(side)).over(order) for side in (1, 2))
    return numbered.select("conv_id", "depth", a.alias("a"), b.alias("b"), "label", "bytes", F.lead("depth").over(order).isNull().alias("last"))


def ended(found: DataFrame) -> DataFrame:
    """Per distinct whole conversation: its key, n, first (smallest conv_id), ends_sha256."""
    runs = found.filter("last").groupBy(*KEY, F.expr(f"conv_id div {RUN}").alias("run")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    text = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    runs = runs.select(*KEY, "run", F.size("ids").cast("bigint").alias("n"), F.element_at("ids", 1).alias("first"), text.alias("ids"))
    schema = "depth bigint, a bigint, b bigint, n bigint, first bigint, ends_sha256 string"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, first, digest = None, 0, 0, hashlib.sha256()
        for batch in batches:
            done = []
            for *now, _, count, least, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != key:
                    if key:
                        done.append((*key, n, first, digest.hexdigest()))
                    key, n, first, digest = now, 0, least, hashlib.sha256()
                digest.update((("," if n else "") + ids).encode())
                n += count
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names)
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, n, first, digest.hexdigest())], names)

    return runs.repartition(*KEY).sortWithinPartitions(*KEY, "run").mapInArrow(run, schema)


def louds(parent: np.ndarray, nodes: int) -> np.ndarray:
    """The bitvector of a forest below one root of their own; node k's parent is
    ``parent[k]``, both numbered in level order from 0, and -1 is that root."""
    degrees = np.bincount(parent + 1, minlength=nodes + 1)
    bits = np.ones(2 * nodes + 1, np.uint8)
    bits[np.cumsum(degrees) + np.arange(nodes + 1)] = 0
    return bits


def parents(bits: np.ndarray) -> np.ndarray:
    """Parents from the bitvector: zeros before the one of each node, less the root."""
    ones = np.flatnonzero(bits)
    return ones - np.arange(len(ones)) - 1


def rolled_up(bits: np.ndarray, starts: list[int], n: np.ndarray, first: np.ndarray, sizes: np.ndarray, leaves: np.ndarray, saved: np.ndarray) -> dict[str, np.ndarray]:
    """Sums of each node's subtree, from the last level to the first.

    ``starts`` has the first node of each level.  n, first, leaves and saved are what a
    node has besides its children; ``sizes`` are the bytes of its last turn.
    """
    up = parents(bits)
    for lo, hi in reversed(list(zip(starts, [*starts[1:], len(up)], strict=True))):
        saved[lo:hi] += (n[lo:hi] - 1) * sizes[lo:hi]
        if lo:
            np.add.at(n, up[lo:hi], n[lo:hi])
            np.minimum.at(first, up[lo:hi], first[lo:hi])
            np.add.at(leaves, up[lo:hi], leaves[lo:hi])
            np.add.at(saved, up[lo:hi], saved[lo:hi])
    return {"conv_id": first, "n_convs": n, "n_leaves": leaves, "saved_tokens": saved}


def forest(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The tries of whole shards, one row in ``rows`` per sequence and depth, in order.

    Returns level-ordered arrays: ``at`` (a row that has the node), ``bits``, ``parent``
    and the sums.
    """
    shard = np.cumsum(np.r_[True, np.any([np.diff(rows[k]) != 0 for k in ("top_depth", "top_a", "top_b")], axis=0)])
    start = np.flatnonzero(np.r_[True, (np.diff(shard) != 0) | (np.diff(rows["conv_id"]) != 0)])
    length = np.diff(np.r_[start, len(shard)])
    by_length = np.argsort(-length, kind="stable")
    start, length = start[by_length], length[by_length]
    node, ups, ats, starts, count = -shard[start] - 1, [], [], [], 0  # roots are told apart by shard
    end = np.zeros(len(start), np.int64)
    for level in range(length[0] if len(length) else 0):
        alive = int(np.searchsorted(-length, -level, side="left"))  # sequences longer than level
        at, up = start[:alive] + level, node[:alive]
        a, b = rows["a"][at], rows["b"][at]
        order = np.lexsort((b, a, up))
        new = np.r_[True, (np.diff(up[order]) != 0) | (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)]
        named = np.empty(alive, np.int64)
        named[order] = count + np.cumsum(new) - 1
        starts.append(count)
        ups.append(np.maximum(up[order][new], -1))
        ats.append(at[order][new])
        count += int(new.sum())
        end[:alive] = node[:alive] = named
    up, at = np.concatenate(ups), np.concatenate(ats)
    bits = louds(up, count)
    n, first, own = np.zeros(count, np.int64), np.full(count, np.iinfo(np.int64).max), np.full(count, -1)
    final = start + length - 1
    n[end], first[end], own[end] = rows["n"][final], rows["conv_id"][final], final
    degrees = np.bincount(up + 1, minlength=count + 1)[1:]
    sums = rolled_up(bits, starts, n, first, rows["bytes"][at], (degrees == 0).astype(np.int64), np.zeros(count, np.int64))
    return {"at": at, "own": own, "bits": bits, "parent": up, "n_children": degrees, **sums}


WHOLE = ("conv_id", "depth", "a", "b", "bytes", "n", "top_depth", "top_a", "top_b")
NODES = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, a bigint, b bigint, label binary, top boolean"
TRIES = "shards bigint, nodes bigint, louds binary, labels binary"


def node_table(table: pa.Table) -> pa.RecordBatch:
    rows = {c: table[c].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False) for c in WHOLE}
    got = forest(rows)
    top = got["parent"] < 0
    parent_id = pa.array(got["conv_id"][np.maximum(got["parent"], 0)], mask=top)
    ends = table["ends_sha256"].combine_chunks().take(pa.array(np.maximum(got["own"], 0))).to_pylist()
    ends = [e if k >= 0 else NO_ENDS for e, k in zip(ends, got["own"], strict=True)]
    label = table["label"].combine_chunks().take(pa.array(got["at"]))
    columns = [got["conv_id"], rows["depth"][got["at"]], parent_id, got["n_convs"], got["n_children"], got["n_leaves"], got["saved_tokens"], ends, rows["a"][got["at"]], rows["b"][got["at"]], label, top]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], [f.split()[0] for f in NODES.split(", ")])


def trie_table(table: pa.Table) -> pa.RecordBatch:
    got = forest({c: table[c].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False) for c in WHOLE})
    labels = b"".join(table["label"].combine_chunks().take(pa.array(got["at"])).to_pylist())
    row = (int((got["parent"] < 0).sum()), len(got["at"]), np.packbits(got["bits"]).tobytes(), labels)
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], [f.split()[0] for f in TRIES.split(", ")])


def by_shards(steps: DataFrame, make: Callable[[pa.Table], pa.RecordBatch], schema: str, at_once: int = AT_ONCE) -> DataFrame:
    """``make`` of each batch of whole shards, of ``at_once`` rows or one shard."""
    tops = ["top_depth", "top_a", "top_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size < at_once:
                continue
            table = pa.Table.from_batches(waiting)
            last = np.any([table[c].to_numpy() != table[c][-1].as_py() for c in tops], axis=0)
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0  # the last shard may go on
            if cut:
                yield make(table.slice(0, cut))
            waiting, size = table.slice(cut).to_batches(), size - cut
        if size:
            yield make(pa.Table.from_batches(waiting))

    return steps.repartition(*tops).sortWithinPartitions(*tops, "conv_id", "depth").mapInArrow(run, schema)


UPPER = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, a bigint, b bigint"


def upper_levels(heavy: DataFrame) -> DataFrame:
    """The trie of the heavy prefixes, of which there are at most ``MOST_HEAVY``, in one task.

    Each row has what ended there and what the shards below it hold.
    """
    names = [f.split()[0] for f in UPPER.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        if not rows:
            return
        levels: dict[int, list[dict]] = {}
        for r in rows:
            levels.setdefault(r["depth"], []).append(r)
        place, ordered, starts, up = {}, [], [], []
        for depth in sorted(levels):
            starts.append(len(ordered))
            at = [(place.get((depth - 1, r["up_a"], r["up_b"]), -1), r["a"], r["b"], r) for r in levels[depth]]
            for p, a, b, r in sorted(at, key=lambda x: x[:3]):
                place[depth, a, b] = len(ordered)
                ordered.append(r)
                up.append(p)
        column = lambda name: np.array([r[name] for r in ordered], np.int64)
        up, below = np.array(up), np.bincount(np.array(up) + 1, minlength=len(ordered) + 1)[1:]
        children = column("n_children") + below
        got = rolled_up(louds(up, len(up)), starts, column("n"), column("first"), column("bytes"), column("n_leaves") + (children == 0), column("saved_tokens"))
        parent_id = pa.array(got["conv_id"][np.maximum(up, 0)], mask=up < 0)
        columns = [got["conv_id"], column("depth"), parent_id, got["n_convs"], children, got["n_leaves"], got["saved_tokens"], [r["ends_sha256"] for r in ordered], column("a"), column("b")]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return heavy.coalesce(1).mapInArrow(run, UPPER)


def steps_of(turns: DataFrame, tmp: Scratch, most_heavy: int, crowd: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ends per sequence; heavy prefixes; and one row per other prefix of each sequence."""
    found = tmp.stored(paths(turns), "paths")
    ends = tmp.stored(ended(found), "ends")
    steps = tmp.stored(found.join(ends.select(F.col("first").alias("conv_id"), "n", "ends_sha256"), "conv_id"), "steps")
    crowd = max(crowd, -(-steps.count() // most_heavy))
    counts = steps.groupBy(*KEY).agg(F.count("*").alias("sequences"), F.min("label").alias("label"), F.min("bytes").alias("bytes"))
    heavy = tmp.stored(counts.filter(F.col("sequences") > crowd), "heavy")
    known = steps.join(F.broadcast(heavy.select(*KEY, F.lit(True).alias("heavy"))), KEY, "left")  # at most most_heavy rows
    top = F.min(F.when(F.col("heavy").isNull(), F.struct(*KEY))).over(W.partitionBy("conv_id"))
    light = known.withColumn("top", top).filter("heavy IS NULL").withColumns({f"top_{c}": F.col("top")[c] for c in KEY})
    end = F.when(F.col("last"), F.col("ends_sha256")).alias("ends_sha256")
    return ends, heavy, light.select("conv_id", *KEY, "label", "bytes", F.when(F.col("last"), F.col("n")).alias("n"), end, "top_depth", "top_a", "top_b")


def prefix_nodes(turns: DataFrame, most_heavy: int = MOST_HEAVY, crowd: int = CROWD) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``turns`` has (conv_id, place, label, bytes) as ``paths`` takes them, with a null place
    for a conversation without turns.  Without conversations there is no node, nor a root.
    The result is a table in the shared folder, which stays.
    """
    with Scratch(turns.sparkSession) as tmp:
        ends, heavy, light = steps_of(turns, tmp, most_heavy, crowd)
        nodes = tmp.stored(by_shards(light, node_table, NODES), "shard-nodes")
        up = [F.col(c).bitwiseXOR(hash_of(side)).alias(f"up_{c}") for side, c in ((1, "a"), (2, "b"))]
        roots = nodes.filter("top").select((F.col("depth") - 1).alias("depth"), *up, "conv_id", "n_convs", "n_leaves", "saved_tokens")
        below = roots.groupBy("depth", F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"), F.sum("n_convs").alias("below_n"), F.min("conv_id").alias("below_first"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        whole = heavy.select(*KEY, "bytes", *up).join(below, KEY, "left").join(ends, KEY, "left").select(
            *KEY, "bytes", "up_a", "up_b", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")),
            (F.coalesce("n", F.lit(0)) + F.coalesce("below_n", F.lit(0))).alias("n"), F.coalesce(F.least("first", "below_first"), F.lit((1 << 63) - 1)).alias("first"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
        upper = tmp.stored(upper_levels(whole), "upper-levels")
        columns = [c.split()[0] for c in NODES.split(", ")][:8]
        over = F.broadcast(upper.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("over")))  # at most most_heavy rows
        tops = nodes.filter("top").select(*columns, *up).join(over, ["depth", "up_a", "up_b"], "left").withColumn("parent_conv_id", F.col("over"))
        return stored(nodes.filter("NOT top").select(columns).unionByName(tops.select(columns)).unionByName(upper.select(columns)), "prefix-nodes")


def succinct_tries(turns: DataFrame, most_heavy: int = MOST_HEAVY, crowd: int = CROWD) -> DataFrame:
    """The tries below the heavy prefixes themselves: per batch of shards the number of
    shards and nodes, the LOUDS bitvector (packed, high bits first) and 16 bytes of label
    for each node in level order, none for a root of depth 0.  The table stays."""
    with Scratch(turns.sparkSession) as tmp:
        return stored(by_shards(steps_of(turns, tmp, most_heavy, crowd)[2], trie_table, TRIES), "tries")
