"""Prefix tries and exact duplicates against plain Python, and on awkward rows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenspark.llm import copies, prefix_trie
from screenspark.llm.common import Scratch
from tests.llm.data import AWKWARD, documents, no_documents

TURNS = "conv_id bigint, turn bigint, role string, text string, label string, depth bigint"


def conversations(spark, rows):
    """With extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, "mine", 7) for r in rows], TURNS)


def plain_nodes(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by_conv[conv].append((turn is not None, turn or 0, tie, role, text))
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(by_conv):
        path = tuple((t[3], t[4]) for t in sorted(by_conv[conv]))
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
        ends[path].append(conv)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, who in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1].encode()) if path else 0
            leaves[path[:d]] += not children[path]
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted((who[0], len(p), members[p[:-1]][0] if p else -1, len(who), children[p], leaves[p], saved[p], digest(ends[p])) for p, who in members.items())


def nodes_of(found):
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in found.collect())


def made_up(seed, n, words=3):
    rng = random.Random(seed)
    hot = [(t, "user", f"hot {t}") for t in range(5)]
    rows = []
    for conv in range(n):
        start = hot[: rng.randint(0, 5)] if rng.random() < 0.5 else []
        turns = hot if rng.random() < 0.3 else start + [(t + 5, rng.choice("ab"), "Größe " + str(rng.randint(1, words))) for t in range(rng.randint(not start, 6))]
        rows += [(conv, *t) for t in turns]
    return rows


@pytest.mark.parametrize(("most_heavy", "crowd"), [(100_000, 32), (100_000, 1), (100_000, 0), (3, 1), (40, 4)])
def test_nodes_by_brute_force(spark, most_heavy, crowd):
    """With no heavy prefix, some, and all that two sequences share."""
    rows = made_up(1, 300)
    turns = prefix_trie.ranked_turns(conversations(spark, rows)).withColumnRenamed("pos", "place")
    assert nodes_of(prefix_trie.prefix_nodes(turns, most_heavy, crowd)) == plain_nodes(rows)


def test_nodes_of_awkward_turns(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "a", "é" * 40_000), (2, 5, "", ""), (2, 9, "user", "x"), (None, 1, "user", "lost"),
            (-3, 1, "user", "x"), (3, 1, None, "x"), (4, 1, "", "x"), (2**60, 1, "a:", "b"), (2**60 + 1, 1, "a", ":b")]
    rows += [(10, t, "user", "same") for t in range(300)]
    turns = prefix_trie.ranked_turns(conversations(spark, rows)).withColumnRenamed("pos", "place")
    assert nodes_of(prefix_trie.prefix_nodes(turns)) == plain_nodes(rows)
    assert prefix_trie.prefix_nodes(turns.filter("false")).count() == 0


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    label = hashlib.md5(b"1:ab").digest()
    turns = spark.createDataFrame([(1, None, bytearray(), 0), (2, 0, bytearray(label), 1)], "conv_id bigint, place bigint, label binary, bytes bigint")
    digest = lambda s: hashlib.sha256(s).hexdigest()
    assert nodes_of(prefix_trie.prefix_nodes(turns)) == [(1, 0, -1, 2, 1, 1, 0, digest(b"1")), (2, 1, 1, 1, 0, 1, 0, digest(b"2"))]


def test_louds_bits_give_parents_back(spark):
    parent = np.array([-1, -1, 0, 0, 1, 3, 3, 4])
    bits = prefix_trie.louds(parent, len(parent))
    assert "".join(map(str, bits)) == "110110100110100" + "00" and (prefix_trie.parents(bits) == parent).all()
    turns = prefix_trie.ranked_turns(conversations(spark, made_up(2, 200))).withColumnRenamed("pos", "place")
    got = prefix_trie.succinct_tries(turns, crowd=2).collect()
    assert sum(r.shards for r in got) > 1
    for r in got:
        bits = np.unpackbits(np.frombuffer(r.louds, np.uint8))[: 2 * r.nodes + 1]
        up = prefix_trie.parents(bits)
        assert len(up) == r.nodes and (up < np.arange(r.nodes)).all() and (np.diff(up) >= 0).all() and (up < 0).sum() == r.shards and len(r.labels) == 16 * r.nodes


def test_shards_go_over_batches(spark):
    """Batches of one row up to all rows give the same nodes."""
    rows = made_up(3, 150)
    turns = prefix_trie.ranked_turns(conversations(spark, rows)).withColumnRenamed("pos", "place")
    with Scratch(spark) as tmp:
        light = tmp.stored(prefix_trie.steps_of(turns, tmp, 100_000, 3)[2], "light")
        counts = []
        for size in (1, 7, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
            try:
                found = prefix_trie.by_shards(light, prefix_trie.node_table, prefix_trie.NODES, size).drop("a", "b", "label")
                counts.append(sorted(found.collect(), key=str))
            finally:
                spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert counts[0] == counts[1] == counts[2] and len(counts[0]) > 100


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        out += [(str(i), str(ids[0]), len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out)


COPIES = [*AWKWARD, (20, "ÄB"), (21, "Äb"), (22, "äb"), (None, "ab"), (None, "AB"), (30, "only null ids differ"), (40, "K"), (41, "K"), (42, "k"), (43, "x" * 70_000)]


def test_copies_by_brute_force(spark):
    docs = documents(spark, COPIES + [(1000 + k, "Hot Text") for k in range(500)])
    found = copies.find_copies(docs)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((str(r[0]), str(r[1]), *r[2:]) for r in found.collect()) == plain_copies([(r.doc_id, r.text) for r in docs.collect()])
    assert copies.find_copies(no_documents(spark)).count() == 0


@pytest.mark.parametrize(("words", "most_words"), [(1, 1), (4, 0), (1 << 12, 1 << 21), (1 << 30, 1 << 21)])
def test_copies_at_any_size_of_the_filter(spark, monkeypatch, words, most_words):
    """A filter that is full, one that is met by a shuffle, and ones with room give the same."""
    monkeypatch.setattr(copies, "words_for", lambda rows: words)
    rows = [(k, f"text {k % 400}") for k in range(600)]
    docs = documents(spark, rows)
    with Scratch(spark) as tmp:
        made = tmp.stored(copies.hashed(docs, "doc_id", "text", ["doc_id"]), "hashes")
        found = copies.marked(made, made.select("h"), tmp, most_words)
        got = sorted((str(r[0][0]), str(r[1]), r[2], r[3], bytes(r[4]).hex()) for r in found.collect())
    assert got == plain_copies(rows)


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    twice = rows.limit(500)
    hashes = rows.unionByName(twice).cache()
    words = copies.words_for(20_500)
    maybe = copies.tested(hashes, copies.repeat_filter(hashes, words), words, True).filter("maybe")
    found = {r.h for r in maybe.select("h").collect()}
    repeated = {r.h for r in hashes.groupBy("h").count().filter("count > 1").collect()}
    assert len(repeated) == 500 and repeated <= found and len(found) - len(repeated) < 0.03 * 20_000


def test_whole_rows_stay_with_their_columns(spark):
    rows = COPIES
    docs = documents(spark, rows).withColumn("keep_id", F.lit("mine")).withColumn("row", F.lit(3)).withColumn("sha", F.array("doc_id"))
    with Scratch(spark) as tmp:
        kept = copies.drop_copies(docs, tmp)
        assert kept.schema.simpleString() == docs.schema.simpleString()
        got = kept.collect()
    want = [(i, True) for i, _, _, k, _ in plain_copies([(r.doc_id, r.text) for r in docs.collect()]) if k]
    assert sorted(str(r.doc_id) for r in got) == sorted(i for i, _ in want)
    assert {(r.score, r.hits, r.keep_id, r.row) for r in got} == {("x", "y", "mine", 3)}
