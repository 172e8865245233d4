"""Operator 9: n-gram Jaccard join with size-banded tiles and bitmap signatures.

A document's set holds its distinct word shingles.  Documents with equal sets form a
class, whose smallest doc_id stands for it; the join is over classes.  Two sets that are
similar enough share shingles among the first of each in the order of the hashes (prefix
filtering), and their sizes are near.  So the classes that share a prefix shingle make a
tile, kept in order of size, and only classes in near size bands of a tile are compared:

1. bitmap signatures: each shingle sets one hashed bit; the bits in which two bitmaps
   differ bound the symmetric difference from below, so the overlap from above;
2. what passes is verified by intersecting the sorted shingle arrays.

The order puts the most frequent shingles last, as a sample shows them, so passages that
many documents share make tiles only for documents that hold little else.  The order has
no influence on the result.

How many prefix shingles a link needs: a set of n has at least a = ceil(percent * n / 100)
in common with any that it links with.  The prefix of n - a + l shingles leaves out a - l,
so at least l of the common ones are in it; in the prefixes of both sets are the first of
the common ones, as many as the smaller l.  With l a share of n, a class that has fewer
prefix shingles with others, and a pair that has fewer in both prefixes, can't link.  No
linked pair is lost by this.

Components need not all links: first each class is verified against the leader of its
tiles that it shares most with, and only tiles that then still hold several components
are compared pair by pair.

Tiles of hot shingles, those that more than some thousand texts share, are never gathered
in one task: their rows are dealt out by class, what a tile knows of all its classes is
aggregated before it is shuffled, and joins are between plain shuffles, whose large
partitions Spark splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from screenspark.llm.common import Scratch, kept, map_batches, parts_of, stored
from screenspark.llm.components import components


@dataclass(frozen=True)
class JaccardParams:
    """Links have 100 * intersection >= ``percent`` * union, of ``words``-word shingles.

    ``shared``: of a set's size the percentage of prefix shingles that a link needs, one at
    least.  One document in ``sample`` gives the frequent shingles, at most ``frequent`` of
    them, so another shingle has at most one in ``frequent`` of the sample's; ``hot``: how often
    the sample has a shingle whose tile is too large for one task; ``tuples``: the aim for the
    prefix shingles that one task sorts.  ``leaders``: those that a class is
    verified against first.  ``small``: most classes of a tile whose pairs become rows, which
    are then at most (small - 1) / 2 for each row of a tile.  ``tile``: about the classes of a
    side of a larger tile's block; ``rows``: about the rows of blocks that a task compares at
    once.  ``filter_bits``: most bits of the filter that keeps texts of classes without
    candidates from being read again.
    None of these has an influence on the result.
    """

    words: int = 5
    percent: int = 75
    shared: int = 5
    sample: int = 32
    frequent: int = 1 << 19
    hot: int = 128
    tuples: int = 400_000
    leaders: int = 3
    small: int = 8
    tile: int = 1024
    rows: int = 10_000
    filter_bits: int = 1 << 27

    def common(self, n: int) -> int:
        """The fewest shingles that a set of n has in common with one that it links with."""
        return -(-self.percent * n // 100)

    def least(self, n: int) -> int:
        """How many of them the prefix holds."""
        return max(1, n * self.shared // 100)

    def least_sql(self, n: str) -> str:
        return f"greatest(1L, {n} * {self.shared} div 100)"

    def common_sql(self, n: str) -> str:
        return f"({n} * {self.percent} + 99) div 100"

    def near_sql(self, a: str, b: str) -> str:
        return f"100 * least({a}, {b}) >= {self.percent} * greatest({a}, {b})"


#: A prefix shingle of a class: the shingle, the class's name in two halves, its size.
TUPLE = np.dtype([("t", "<u8"), ("hi", "<i8"), ("lo", "<i8"), ("n", "<i4")])
#: A document: its id (if ``named``), the size and (if any) the name of its set.
DOC = np.dtype([("d", "<i8"), ("named", "u1"), ("n", "<i4"), ("hi", "<i8"), ("lo", "<i8")])
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Words(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a whole text's shingles.

    Words end at ASCII white space, A-Z count as a-z.  A text with fewer words than a
    shingle has its whole sequence as one shingle, a text without words none.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(kept("shingles", _Words).__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    out = np.full(len(parts) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = (out ^ h[k : len(parts) - width + 1 + k]) * MIX[0]
        out ^= out >> np.uint64(29)
    out *= MIX[1]
    out ^= out >> np.uint64(32)
    return np.unique(out)


def class_of(shingles: np.ndarray) -> tuple[int, int]:
    """A 128-bit name for a set."""
    name = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(name[:8], "little", signed=True), int.from_bytes(name[8:], "little", signed=True)


def prefix(shingles: np.ndarray, common: np.ndarray, params: JaccardParams) -> tuple[np.ndarray, np.ndarray]:
    """The prefix shingles of a set, and which of them are frequent; ``common`` has the
    frequent shingles in order."""
    n = len(shingles)
    hot = np.zeros(n, dtype=bool)
    if len(common):
        hot = common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] == shingles
    order = np.concatenate([np.flatnonzero(~hot), np.flatnonzero(hot)])[: n - params.common(n) + params.least(n)]
    return shingles[order], hot[order]


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Bits by hash; as many bits, a power of two, as suit the size."""
    width = min(16_384, max(64, 8 << int(len(shingles) - 1).bit_length())) if len(shingles) else 64
    bits = np.zeros(width, dtype=np.uint8)
    bits[(shingles % np.uint64(width)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The same bitmap with fewer bits."""
    while len(bits) > words:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def may_link(differing: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the overlap that the differing bits allow is enough for a link."""
    overlap = (size_a + size_b - differing) // 2
    return 100 * overlap >= percent * (size_a + size_b - overlap)


def _packed(rows: np.ndarray, bucket: np.ndarray) -> tuple[list[int], list[bytes]]:
    """The buckets in which rows are, and the rows of each as bytes."""
    order = np.argsort(bucket, kind="stable")
    names, starts = np.unique(bucket[order], return_index=True)
    return names.tolist(), [x.tobytes() for x in np.split(rows[order], starts[1:])] if len(rows) else []


def _unpacked(table: pa.Table, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table["rows"].to_pylist()), dtype=kind)


def frequent_shingles(docs: DataFrame, tmp: Scratch, params: JaccardParams) -> tuple[np.ndarray, np.ndarray, int]:
    """The most frequent shingles, by a sample of the distinct texts, those of them that are
    hot, and about how many shingles all texts have: hints on how to order and spread the work."""
    slots = max(4, docs.count() // (params.sample * 800))

    def make():
        def step(cols):
            found = np.concatenate([np.zeros(0, np.uint64), *(shingle_set(t, params.words) for t in cols["text"])])
            names, rows = _packed(found, (found >> np.uint64(20)) % np.uint64(slots))
            return {"slot": names, "rows": rows}

        return step

    def count(table: pa.Table) -> pa.Table:
        every = _unpacked(table, "<u8")
        found, times = np.unique(every, return_counts=True)
        often = times >= 3
        t = pa.array([None, *found[often].view(np.int64).tolist()], pa.int64())
        return pa.table({"t": t, "n": pa.array([len(every), *times[often].tolist()], pa.int64())})

    texts = docs.select("text").filter(F.xxhash64("text") % params.sample == 0).distinct()
    counts = tmp.stored(map_batches(texts, make, "slot bigint, rows binary").groupBy("slot").applyInArrow(count, "t bigint, n bigint"), "jaccard-sample")
    rows = counts.filter("t IS NOT NULL").orderBy(F.desc("n"), "t").limit(params.frequent).collect()
    total = counts.filter("t IS NULL").agg(F.sum("n")).first()[0] or 0
    found, hot = np.array([r.t for r in rows], dtype=np.int64).view(np.uint64), np.array([r.n >= params.hot for r in rows], dtype=bool)
    return np.sort(found), np.sort(found[hot]), params.sample * total


def described(docs: DataFrame, frequent: np.ndarray, hottest: np.ndarray, buckets: int, params: JaccardParams) -> DataFrame:
    """What one pass over all texts gives: in rows without ``t`` the documents (d, n, hi,
    lo), in the others prefix shingles ``t`` of classes (hi, lo) of n shingles, where other
    classes of near size have the shingle in their prefix too (``hot`` ones: all).
    """
    sent = docs.sparkSession.sparkContext.broadcast((frequent, hottest))

    def make():
        common, largest = sent.value
        seen: set[tuple[int, int]] = set()

        def step(cols):
            known = np.zeros(len(cols["text"]), dtype=DOC)
            tuples, places = [], []
            for i, (doc_id, text) in enumerate(zip(cols["doc_id"], cols["text"])):
                s = shingle_set(text, params.words)
                cls = class_of(s) if len(s) else (0, 0)
                known[i] = (doc_id or 0, doc_id is not None, len(s), *cls)
                # A class that many documents share is sent on once by each task.
                if not len(s) or doc_id is None or cls in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(cls)
                t, often = prefix(s, common, params)
                hot = often & np.isin(t, largest)
                rows = np.empty(len(t), dtype=TUPLE)
                rows["t"], rows["hi"], rows["lo"], rows["n"] = t, *cls, len(s)
                tuples.append(rows)
                # Shingles meet in the bucket of their hash; of hot ones any bucket will do.
                spread = (np.uint64(cls[1] % (1 << 64)) + t) % np.uint64(buckets) + np.uint64(buckets)
                places.append(np.where(hot, spread, t % np.uint64(buckets)).astype(np.int64))
            names, packed = _packed(np.concatenate(tuples), np.concatenate(places)) if tuples else ([], [])
            own = int(known["lo"].astype(np.uint64).sum(dtype=np.uint64) % np.uint64(buckets))
            return {"bucket": [-1 - own, *names], "rows": [known.tobytes(), *packed]}

        return step

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket < 0:
            rows = _unpacked(table, DOC)
            empty, nobody = rows["n"] == 0, rows["named"] == 0
            columns = {"t": pa.nulls(len(rows), pa.int64()), "d": pa.array(rows["d"], mask=nobody), "hi": pa.array(rows["hi"], mask=empty), "lo": pa.array(rows["lo"], mask=empty)}
        else:
            rows = _unpacked(table, TUPLE)
            rows = rows[np.lexsort((rows["lo"], rows["n"], rows["t"]))]
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows["t"][1:] != rows["t"][:-1]) | (rows["lo"][1:] != rows["lo"][:-1]) | (rows["hi"][1:] != rows["hi"][:-1])
            rows = rows[new]
            if bucket < buckets:
                # In order of size, a class has a partner if its neighbour is near.
                near = (rows["t"][1:] == rows["t"][:-1]) & (100 * rows["n"][:-1].astype(np.int64) >= params.percent * rows["n"][1:].astype(np.int64))
                rows = rows[np.append(near, False) | np.insert(near, 0, False)]
            columns = {"t": pa.array(rows["t"].view(np.int64)), "d": pa.nulls(len(rows), pa.int64()), "hi": pa.array(rows["hi"]), "lo": pa.array(rows["lo"])}
        return pa.table(columns | {"n": pa.array(rows["n"].astype(np.int64)), "hot": pa.array(np.full(len(rows), bucket >= buckets))})

    packed = map_batches(docs, make, "bucket bigint, rows binary")
    return packed.groupBy("bucket").applyInArrow(gather, "t bigint, d bigint, hi bigint, lo bigint, n bigint, hot boolean")


def over_tiles(rows: DataFrame, tmp: Scratch, keys: tuple[str, ...] = ("t",), **of: Column) -> DataFrame:
    """``rows`` (t, hot, ...) with aggregates over their tiles.

    Tiles of other shingles have some thousand rows at most, so a window over them does; rows
    of hot ones are aggregated first and joined with what comes of it, one row for a tile.
    """
    window = W.partitionBy(*keys)
    few = rows.filter("NOT hot").select("*", *[f.over(window).alias(k) for k, f in of.items()])
    hot = rows.filter("hot")
    found = tmp.stored(hot.groupBy(*keys).agg(*[f.alias(k) for k, f in of.items()]), "jaccard-hot")
    return few.unionByName(hot.join(found, list(keys)).select(few.columns))


def enough_shared(tiles: DataFrame, tmp: Scratch, params: JaccardParams, key: str = "c") -> DataFrame:
    """Rows of tiles (t, hot, c, n, ...) of classes that share enough with other classes, or
    with classes of another root (``key``)."""
    shared = over_tiles(tiles, tmp, _low=F.min(key), _high=F.max(key)).filter("_low <> _high").drop("_low", "_high")
    counted = shared.withColumn("_k", F.count("*").over(W.partitionBy("c")))
    return counted.filter(f"_k >= {params.least_sql(params.common_sql('n'))}").drop("_k")


def doc_filter(wanted: DataFrame, most: int) -> np.ndarray:
    """A filter that all documents (c) of ``wanted`` pass, and few others; of ``most`` bits."""
    bits = 1 << 16
    n = wanted.count()
    while bits < 16 * n and bits < most:
        bits *= 2
    slot = F.pmod(F.xxhash64("c"), F.lit(bits))
    words = wanted.select((slot / 64).cast("int").alias("w"), F.pmod(slot, F.lit(64)).cast("int").alias("b")).distinct()
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("v")).toPandas()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words["w"].to_numpy()] = words["v"].to_numpy()
    return out.view(np.uint64)


def class_arrays(docs: DataFrame, wanted: np.ndarray, params: JaccardParams) -> DataFrame:
    """(c, n, bits, sketch, shingles) of the documents c that pass the filter, each set once;
    the sketch is the bitmap folded once, of half its bits."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)
    slots = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(64 * len(wanted))).alias("slot"))
    names = ("c", "n", "bits", "sketch", "shingles")
    schema = pa.schema([("c", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("sketch", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        for batch in batches:
            slot = batch.column(2).to_numpy().astype(np.uint64)
            passing = batch.filter(pa.array((words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)))
            for part in parts_of(passing):
                out = {k: [] for k in names}
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    s = shingle_set(text, params.words)
                    if len(s):
                        bits = bitmap(s)
                        for name, value in zip(names, (doc_id, len(s), bits.tobytes(), folded(bits, max(1, len(bits) // 2)).tobytes(), s.tobytes())):
                            out[name].append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in schema], schema=schema)

    rows = slots.mapInArrow(run, "c bigint, n bigint, bits binary, sketch binary, shingles binary")
    return rows.groupBy("c", "n", F.md5("shingles").alias("name")).agg(F.first("bits").alias("bits"), F.first("sketch").alias("sketch"), F.first("shingles").alias("shingles")).drop("name")


def not_ruled_out(pairs: DataFrame, arrays: DataFrame, params: JaccardParams) -> DataFrame:
    """Of the pairs (a, b) of classes those that their bitmaps allow to link."""
    side = {x: arrays.select(F.col("c").alias(x), *[F.col(k).alias(f"{k}_{x}") for k in ("n", "bits")]) for x in "ab"}
    rows = pairs.select("a", "b").join(side["a"], "a").join(side["b"], "b")

    def make():
        def allowed(n_a, n_b, bits_a, bits_b) -> bool:
            x, y = np.frombuffer(bits_a, np.uint64), np.frombuffer(bits_b, np.uint64)
            words = min(len(x), len(y))
            differing = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
            return may_link(differing, n_a, n_b, params.percent)

        def step(cols):
            keep = [allowed(*x) for x in zip(*(cols[k] for k in ("n_a", "n_b", "bits_a", "bits_b")))]
            return {x: [v for v, k in zip(cols[x], keep) if k] for x in "ab"}

        return step

    return map_batches(rows, make, "a bigint, b bigint")


def verified(pairs: DataFrame, arrays: DataFrame, params: JaccardParams) -> DataFrame:
    """Of the pairs (a, b) of classes those that link: by bitmaps first, then exactly."""
    side = {x: arrays.select(F.col("c").alias(x), F.col("shingles").alias(f"shingles_{x}")) for x in "ab"}
    rows = not_ruled_out(pairs, arrays, params).join(side["a"], "a").join(side["b"], "b")

    def make():
        def linked(raw_a, raw_b) -> bool:
            a, b = np.frombuffer(raw_a, np.uint64), np.frombuffer(raw_b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            return 100 * both >= params.percent * (len(a) + len(b) - both)

        def step(cols):
            keep = [linked(*x) for x in zip(cols["shingles_a"], cols["shingles_b"])]
            return {x: [v for v, k in zip(cols[x], keep) if k] for x in "ab"}

        return step

    return map_batches(rows, make, "a bigint, b bigint")


def banded(tiles: DataFrame, params: JaccardParams) -> DataFrame:
    """Each row in the size band ``own`` and in the next one, so that any two near sizes
    have a band in common."""
    own = F.floor(F.log("n") / float(np.log(100 / params.percent)) + 1e-9)
    return tiles.withColumn("own", own).withColumn("band", F.explode(F.array(F.col("own"), F.col("own") + 1)))


def leader_pairs(tiles: DataFrame, tmp: Scratch, params: JaccardParams) -> DataFrame:
    """(a, b): each class with the leaders that it shares most prefix shingles with.

    A tile's leader in a size band is the class that shares most with all others.
    """
    sized = over_tiles(tiles, tmp, m=F.count("*"))
    weighed = sized.withColumn("weight", F.sum("m").over(W.partitionBy("c")) / F.col("n"))
    rows = banded(weighed.select("t", "hot", "c", "n", "weight"), params)
    led = over_tiles(rows, tmp, ("t", "band"), l=F.max_by(F.struct("c", "n"), F.struct("weight", "c")))
    led = led.filter("c <> l.c AND " + params.near_sql("n", "l.n"))
    led = led.groupBy("c", F.col("l.c").alias("l")).count()
    best = F.row_number().over(W.partitionBy("c").orderBy(F.desc("count"), "l"))
    led = led.withColumn("best", best).filter(F.col("best") <= params.leaders)
    return led.select(F.least("c", "l").alias("a"), F.greatest("c", "l").alias("b")).distinct()


def small_tile_pairs(members: DataFrame, params: JaccardParams) -> DataFrame:
    """(a, b): pairs of classes of different roots that share enough prefix shingles."""
    a = members.select("t", F.col("c").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"))
    b = members.select("t", F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"))
    met = a.join(b, "t").filter("a < b AND root_a <> root_b AND " + params.near_sql("n_a", "n_b"))
    met = met.groupBy("a", "b").agg(F.count("*").alias("both"), F.least(F.min("n_a"), F.min("n_b")).alias("n"))
    return met.filter(f"both >= {params.least_sql('n')}").select("a", "b")


def large_tile_pairs(members: DataFrame, arrays: DataFrame, tmp: Scratch, params: JaccardParams) -> DataFrame:
    """(a, b): pairs of tiles (t, hot, c, n, root) that a sketch doesn't rule out.

    For tiles of so many classes that their pairs should not become rows.  A band of a tile
    is dealt into blocks of bounded size by a hash of the class; a task compares two blocks,
    and only classes of near sizes and different roots.  Sketches are shuffled once, to the
    blocks, and not for bands in which no two can meet.
    """
    known = {"m": F.count("*"), "_top": F.max("own"), "_low": F.min("root"), "_high": F.max("root")}
    rows = over_tiles(banded(members, params), tmp, ("t", "band"), **known).filter("_top = band AND _low <> _high")
    rows = rows.withColumn("blocks", F.ceil(F.col("m") / params.tile)).withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")))
    many = (rows.agg(F.sum("blocks")).first()[0] or 0) // params.rows + 1
    meets = F.expr("transform(sequence(0L, blocks - 1), k -> struct(least(block, k) as a, greatest(block, k) as b))")
    keys = ("t", "band", "a", "b")
    rows = rows.withColumn("pair", F.explode(meets)).select("t", "band", "pair.a", "pair.b", "block", "own", "c", "n", "root")
    percent = params.percent

    def met(key: tuple, frame: dict[str, np.ndarray]) -> Iterator[np.ndarray]:
        _, band, block_a, block_b = key
        words = min(map(len, frame["bits"])) // 8
        bits = np.array([folded(np.frombuffer(b, np.uint64), words) for b in frame["bits"]])
        c, n, root, own, block = (frame[k] for k in ("c", "n", "root", "own", "block"))
        a, b = np.flatnonzero(block == block_a), np.flatnonzero(block == block_b)
        for i in a.tolist():
            # Two of the lower band meet there already; in one block, each two meet once.
            j = b[b > i] if block_a == block_b else b
            j = j[(root[j] != root[i]) & (np.maximum(own[j], own[i]) == band) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
            if len(j):
                differing = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1).astype(np.int64)
                j = j[may_link(differing, n[i], n[j], percent)]
                yield np.stack([np.minimum(c[i], c[j]), np.maximum(c[i], c[j])], axis=1)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        columns = {k: frame[k].to_numpy() for k in frame}
        order = np.lexsort([columns[k] for k in keys])
        names = np.stack([columns[k][order] for k in keys], axis=1)
        starts = np.flatnonzero(np.append(True, (names[1:] != names[:-1]).any(axis=1)))
        found = []
        for start, at in zip(starts, np.split(order, starts[1:])):
            found += met(tuple(names[start].tolist()), {k: v[at] for k, v in columns.items()})
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=np.int64)
        return pd.DataFrame(pairs, columns=["a", "b"])

    sketched = rows.join(arrays.select("c", "n", F.col("sketch").alias("bits")), ["c", "n"])
    dealt_rows = sketched.withColumn("some", F.pmod(F.xxhash64(*keys), F.lit(many)))
    return dealt_rows.groupBy("some").applyInPandas(compare, "a bigint, b bigint").distinct()


def repeated_ids(known: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): what stands for the sets of rows that repeat a doc_id with other sets."""
    sets = known.filter("doc_id IS NOT NULL").select("doc_id", "hi", "lo").distinct()
    several = sets.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    stands = sets.join(several, "doc_id").join(classes, ["hi", "lo"], "left").select("doc_id", F.coalesce("c", "doc_id").alias("b"))
    return stands.select(F.col("doc_id").alias("a"), "b")


def near_duplicates(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    ``component_id`` is the smallest doc_id that links lead to, the document's own
    included.  A null or empty text has no shingles and links with nothing, nor does a
    row without doc_id (its component is null).  Rows with equal texts link, rows that
    repeat a doc_id are one document.  Other columns than doc_id and text are ignored.
    """
    docs = docs.select("doc_id", "text")
    with Scratch(docs.sparkSession) as tmp:
        frequent, hottest, total = frequent_shingles(docs, tmp, params)
        buckets = max(8, int(total * (100 - params.percent + params.shared) / 100 / params.tuples) + 1)
        every = tmp.stored(described(docs, frequent, hottest, buckets, params), "jaccard-sets")
        known = every.filter("t IS NULL").select(F.col("d").alias("doc_id"), "n", "hi", "lo")
        named = known.filter("hi IS NOT NULL AND doc_id IS NOT NULL")
        classes = tmp.stored(named.groupBy("hi", "lo").agg(F.min("doc_id").alias("c")), "jaccard-classes")
        tiles = every.filter("t IS NOT NULL").join(classes, ["hi", "lo"]).select("t", "hot", "c", "n")
        tiles = tmp.stored(enough_shared(enough_shared(tiles, tmp, params), tmp, params), "jaccard-tiles")
        arrays = tmp.stored(class_arrays(docs.filter("doc_id IS NOT NULL"), doc_filter(tiles.select("c").distinct(), params.filter_bits), params), "jaccard-arrays")

        first_links = tmp.stored(verified(leader_pairs(tiles, tmp, params), arrays, params), "jaccard-links")

        # What tiles hold besides: pairs of classes that no link found so far connects.
        found = components(first_links, "a", "b", tmp)
        rooted = tiles.join(found.select(F.col("id").alias("c"), "component"), "c", "left").withColumn("root", F.coalesce("component", "c")).drop("component")
        mixed = enough_shared(tmp.stored(enough_shared(rooted, tmp, params, "root"), "jaccard-mixed"), tmp, params, "root")
        mixed = tmp.stored(over_tiles(mixed, tmp, m=F.count("*")), "jaccard-mixed")
        # A pair whose shared shingles lie in large tiles as well as small ones is found in the
        # large ones; so pairs are counted in small tiles only where no large one can hold them.
        narrow, wide = mixed.filter(F.col("m") <= params.small).drop("m"), mixed.filter(F.col("m") > params.small).drop("m")
        pairs = small_tile_pairs(narrow, params).unionByName(large_tile_pairs(wide, arrays, tmp, params)).distinct()
        links = first_links.unionByName(verified(pairs, arrays, params)).unionByName(repeated_ids(known, classes))
        final = components(links, "a", "b", tmp)

        component = F.coalesce("component", "c").alias("component_id")
        by_class = classes.join(final, F.col("id") == F.col("c"), "left").select("hi", "lo", component)
        one = named.join(by_class, ["hi", "lo"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        bare = known.filter("hi IS NULL OR doc_id IS NULL").join(final, F.col("id") == F.col("doc_id"), "left")
        bare = bare.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
        return stored(one.unionByName(bare), "jaccard")
