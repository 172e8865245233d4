"""Operators over whole tables: archives, decontamination, joins, vectors, pipeline."""

import gzip
import hashlib
import random
from collections import defaultdict
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenspark.llm import bpe, decontaminate, jaccard, near_vectors, pii, warc
from screenspark.llm.common import Scratch, map_batches, shared_dir, stored
from screenspark.llm.components import components
from tests.llm.data import AWKWARD, documents, no_documents


def united(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("few_edges", [0, 1 << 20])
def test_components_equal_union_find(spark, few_edges):
    rng = random.Random(0)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)] + [(90, 90)]
    with Scratch(spark) as tmp:
        got = {r.id: r.component for r in components(spark.createDataFrame(pairs + [(5, None)], "a bigint, b bigint"), "a", "b", tmp, few_edges).collect()}
        want = united(140, pairs)
        assert all(got.get(i, i) == want[i] for i in range(140))
        assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b", tmp, few_edges).count() == 0


def test_shared_folder_is_the_clusters_own(spark):
    class Elsewhere:
        conf = type("Conf", (), {"get": lambda self, key, default=None: default})()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getConf": lambda self: type("Conf", (), {"get": lambda self, key: None})()})()

    with pytest.raises(ValueError):
        shared_dir(Elsewhere(), "x")
    assert shared_dir(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_tables_of_a_run_go(spark):
    folder = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(folder.iterdir())
    jaccard.near_duplicates(documents(spark))
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["jaccard"]


def test_session_keeps_its_settings(spark):
    before = {r.key: r.value for r in spark.sql("SET").collect()}
    map_batches(documents(spark).select("doc_id"), lambda: lambda cols: cols, "doc_id bigint").count()
    jaccard.near_duplicates(no_documents(spark))
    assert {r.key: r.value for r in spark.sql("SET").collect()} == before


# ---------------------------------------------------------------- archives

def pages(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, refers_to int")


def with_ranges(spark, size, read):
    """What ``read`` gives while Spark cuts files into ranges of ``size`` bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for name, value in zip(names, (str(size), "0", "1")):
            spark.conf.set(name, value)
        return read()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


ARCHIVED = "<p>ü</p>" * 40
PAGES = [(7, "u7", ARCHIVED), (3, "a\r\nb", ARCHIVED), (9, None, ARCHIVED + "x"), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "n", ARCHIVED), (8, "b", "y" * 300_000), (7, "u7", ARCHIVED), (10, "", "\x1f\x8b\x08 WARC/1.1\r\n" * 30), (11, "é", "")]


@pytest.mark.parametrize("size", [197, 1000, 1 << 22])
def test_archives_round_trip_at_any_split(spark, tmp_path, size):
    path = f"file://{tmp_path}/w"
    warc.write_archives(pages(spark, PAGES), path)
    got = with_ranges(spark, size, lambda: warc.read_archives(spark, path, payloads=True).collect())
    assert sorted((r.page_id or -1) for r in got) == sorted((r[0] or -1) for r in PAGES)
    by = {r.page_id: r for r in got}
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        row = next(r for r in got if r.page_id == page_id)
        assert (row.payload_bytes, row.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert row.payload is None or row.payload == raw
    assert (by[7].record_type, by[7].refers_to, by[3].record_type) == ("revisit", 3, "response")
    assert {by[i].record_type for i in (4, 5, 6, 8, 9, 11, None)} == {"response"} and by[3].url == "a%0D%0Ab"
    file = next(f for f in (tmp_path / "w").iterdir() if f.name.startswith("part") and f.stat().st_size)
    assert gzip.open(file).read().startswith(b"WARC/1.1")


def stored_member(data):
    """A gzip member that holds its content as it is."""
    return gzip.compress(data, 0)


@pytest.mark.parametrize("size", [90, 400, 1 << 20])
def test_archives_of_other_makers(spark, tmp_path, size):
    """Magic bytes inside of members, junk, other records and members that end too early."""
    full = "\x1f\x8b\x08 and more \x1f\x8b\x08\x00" * 8
    records = [warc.record(i, f"u{i}", (f"{i} " + full).encode("latin-1"), 0, "x", None) for i in range(5)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    broken = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 900\r\n\r\nabcd"
    raw = b"junk" + stored_member(info) + b"".join(stored_member(r) for r in records[:4]) + stored_member(b"no record" * 9) + stored_member(broken) + stored_member(records[4])[:200]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc").write_bytes(raw)
    got = with_ranges(spark, size, lambda: warc.read_archives(spark, f"file://{tmp_path}/a", payloads=True).collect())
    assert sorted(r.record_type for r in got) == ["malformed"] + ["response"] * 4 + ["warcinfo"]
    assert {r.page_id: r.payload for r in got if r.page_id is not None} == {i: (f"{i} " + full).encode("latin-1") for i in range(4)}


def test_no_pages_no_records(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    warc.write_archives(pages(spark, [(1, "u", "x")]).filter("false"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_names_that_spark_would_decompress_are_refused(spark, tmp_path):
    (tmp_path / "x.warc.bz2").write_bytes(stored_member(b"x"))
    with pytest.raises(ValueError):
        warc.read_archives(spark, f"file://{tmp_path}")


@pytest.mark.parametrize("name", ["x.warc.gz", "CC-MAIN-0001-17.warc.gz", "-.gz", "0.gz", "~.warc.gz"])
def test_gzip_names_are_read_in_ranges(spark, tmp_path, name):
    """Archives as crawls name them, with members that gzip itself wrote, cut anywhere."""
    made = [warc.record(i, f"u{i}", bytes([97 + i]) * (900 * i), 0, "x", None) for i in range(8)]
    (tmp_path / name).write_bytes(b"".join(gzip.compress(r) for r in made) + stored_member(made[3]))
    read = lambda: warc.read_archives(spark, f"file://{tmp_path}", payloads=True)
    got = with_ranges(spark, 97, lambda: read().collect())
    want = [(i, bytes([97 + i]) * (900 * i)) for i in [*range(8), 3]]
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == sorted(want)
    parts = with_ranges(spark, 97, lambda: spark.read.options(**warc.AS_THEY_ARE).text(f"file://{tmp_path}").rdd.getNumPartitions())
    assert parts > 10


# ---------------------------------------------------------------- decontamination

def edits(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, d in enumerate(t):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(800):
        p, t = ("".join(rng.choice("ab c") for _ in range(rng.randint(1, n))) for n in (12, 25))
        want = edits(p, t)
        assert (decontaminate.myers(p, t, 100) or (None,))[0] == want
        assert (decontaminate.myers(p, t, want - 1) is None) or want == 0


def test_matches_equal_brute_force(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(14))) for i in range(12)] + [(50, "tiny item"), (51, ""), (52, None)]
    docs = list(AWKWARD)
    for k in range(40):
        text = list(items[k % 12][1])
        for _ in range(k % 8):
            text[rng.randrange(len(text))] = rng.choice("abcxyz ")
        docs.append((100 + k, " ".join(word() for _ in range(20)) + " " + "".join(text).upper() + ". " + word()))
    docs += [(300, "a tiny item here"), (301, "a tiny items here")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rule = decontaminate.EditMatch()
    wants = set()
    for doc_id, text in docs:
        t = decontaminate.normalised(text)
        for item_id, item in items:
            p = decontaminate.normalised(item)
            if p and t and len(t) < 5000 and edits(p, t) <= decontaminate.budget_of(p, rule):
                wants.add((doc_id, item_id))
    assert (300, 50) in wants and (301, 50) not in wants
    for blocks in (rule, replace(rule, block_chars=300)):
        rows = decontaminate.find_leaks(documents(spark, docs), bench, blocks).collect()
        assert len(rows) == len(docs) and {(r.doc_id, h.item_id) for r in rows for h in r.hits} == wants
    assert decontaminate.find_leaks(documents(spark), bench.filter("false")).agg(F.sum(F.size("hits"))).first()[0] == 0
    assert decontaminate.find_leaks(no_documents(spark), bench).count() == 0
    twice = spark.createDataFrame([(50, "tiny item"), (50, "tiny items")], "item_id bigint, text string")
    found = decontaminate.find_leaks(documents(spark, [(300, "a tiny item here")]), twice, replace(rule, block_chars=5)).first()
    assert [(h.item_id, h.edits) for h in found.hits] == [(50, 0)]


def test_several_blocks_keep_copies_nulls_and_users_columns(spark):
    """Hits come back by the text's digest: to every copy, and to no other row."""
    bench = spark.createDataFrame([(1, "one item of words"), (2, "another item of words"), (None, "nobody"), (3, None)], "item_id bigint, text string")
    rows = [(1, "so one item of words and another item of words", "k", "a"), (1, "so one item of words and another item of words", "k", "b"), (2, None, None, "c"), (3, "", "x", "d"), (4, "nothing", "y", "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digest string, _digest0 string").withColumn("hits", F.lit("mine"))
    want = {"a": [1, 2], "b": [1, 2], "c": [], "d": [], "e": []}
    for chars in (5, 10_000):
        found = decontaminate.find_leaks(docs, bench, replace(decontaminate.EditMatch(), block_chars=chars))
        assert found.columns == ["doc_id", "text", "digest", "_digest0", "hits"]
        assert {r["_digest0"]: [h.item_id for h in r.hits] for r in found.collect()} == want
        assert sorted(map(repr, found.select("doc_id", "text", "digest", "_digest0").collect())) == sorted(map(repr, docs.drop("hits").collect()))


# ---------------------------------------------------------------- Jaccard join

def brute_sets(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return sets


def brute_jaccard(rows):
    sets = brute_sets(rows)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] is not None and rows[j][0] is not None and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    links += [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] is not None and rows[i][0] == rows[j][0]]
    root, least = united(len(rows), links), defaultdict(lambda: 1 << 60)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root[i]] = min(least[root[i]], doc_id)
    return {(doc_id, len(sets[i]), None if doc_id is None else least[root[i]]) for i, (doc_id, _) in enumerate(rows)}


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(30)]
    rows, last = [], [word() for _ in range(60)]
    for i in range(n):
        kind = rng.random()
        if kind < 0.4:
            text = list(last)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = word()
        elif kind < 0.6:
            text = passage + [word() for _ in range(rng.randrange(1, 60))]
        else:
            text = last = [word() for _ in range(rng.randrange(1, 120))]
        rows.append((1000 + i, " ".join(text)))
    return rows


#: Rows that repeat a doc_id with other texts, or with none.
REPEATED = [(2001, "one two three four five six"), (2001, "seven eight nine ten eleven twelve"), (2002, "seven eight nine ten eleven twelve"), (2003, "one two three four five six"), (2001, None), (1990, "seven eight nine ten eleven twelve")]


@pytest.mark.parametrize("params", [jaccard.JaccardParams(), jaccard.JaccardParams(small=3, tile=4, leaders=1, sample=1), jaccard.JaccardParams(shared=20, small=0, tile=7, sample=2, frequent=5, tuples=50)], ids=["usual", "tiny tiles", "large tiles alone"])
def test_join_equals_brute_force(spark, params):
    rows = AWKWARD + corpus(3, 150) + REPEATED
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(documents(spark, rows), params).collect()}
    assert got == brute_jaccard(rows)


@pytest.mark.parametrize("percent", [75, 60])
def test_join_of_large_groups(spark, percent):
    """A third of all rows equal, a third alike, a passage in many others; links at the very bound."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(900)}"
    base, passage = [word() for _ in range(50)], [word() for _ in range(40)]
    rows = [(i, " ".join(base)) for i in range(120)]
    for i in range(120, 240):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(50)] = word()
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(passage + [word() for _ in range(rng.randrange(4, 40))])) for i in range(240, 330)]
    for i in range(330, 360, 2):
        n = rng.randrange(20, 90)
        text = [word() for _ in range(n)]
        gone = n - 4 - -(-percent * (n - 4) // 100) + rng.randrange(2)
        rows += [(i, " ".join(text)), (i + 1, " ".join(text[gone:]))]
    params = jaccard.JaccardParams(percent=percent, sample=2, small=20, tile=16)
    rng.shuffle(rows)
    sets = brute_sets(rows)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    root, least = united(len(rows), links), defaultdict(lambda: 1 << 60)
    for i, (doc_id, _) in enumerate(rows):
        least[root[i]] = min(least[root[i]], doc_id)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(documents(spark, rows), params).collect()}
    assert got == {doc_id: least[root[i]] for i, (doc_id, _) in enumerate(rows)}


def test_pairs_of_small_tiles_grow_no_faster_than_their_rows(spark, monkeypatch):
    """A passage that 60 texts share, none of which link: pairs by rows would be 1,770 a shingle."""
    passage, seen = [f"p{i}" for i in range(80)], []
    rows = [(i, " ".join(passage + [f"own{i}_{j}" for j in range(20)])) for i in range(60)]
    before = jaccard.small_tile_pairs

    def spy(members, params):
        seen.append([r["count"] for r in members.groupBy("t").count().collect()])
        return before(members, params)

    monkeypatch.setattr(jaccard, "small_tile_pairs", spy)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(documents(spark, rows)).collect()}
    assert got == brute_jaccard(rows)
    assert len(seen) == 1 and sum(m * (m - 1) // 2 for m in seen[0]) <= 4 * sum(seen[0])


def test_only_rows_of_tiles_too_large_for_a_task_are_joined(spark, monkeypatch):
    """A passage that 60 texts share makes tiles that windows hold: none of their rows goes through a join."""
    passage, seen = [f"p{i}" for i in range(80)], []
    rows = [(i, " ".join(passage + [f"own{i}_{j}" for j in range(20)])) for i in range(60)]
    before = jaccard.over_tiles

    def spy(tiles, *more, **of):
        seen.append(tiles.filter("hot").count())
        return before(tiles, *more, **of)

    monkeypatch.setattr(jaccard, "over_tiles", spy)
    for params, joined in ((jaccard.JaccardParams(sample=1), False), (jaccard.JaccardParams(sample=1, hot=50), True)):
        seen.clear()
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(documents(spark, rows), params).collect()}
        assert got == brute_jaccard(rows)
        assert seen and any(seen) == joined


def test_prefixes_share_what_they_must():
    """Of any linked pair both prefixes hold as many common shingles as candidates need."""
    rng, params = np.random.default_rng(3), jaccard.JaccardParams(shared=10)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        both = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        a = np.unique(np.concatenate([both, rng.integers(0, 1 << 63, rng.integers(0, n // 3 + 1), dtype=np.uint64)]))
        common = np.sort(rng.choice(a, len(a) // 4))
        if 100 * len(both) >= params.percent * len(a):
            shared = len(np.intersect1d(jaccard.prefix(a, common, params)[0], jaccard.prefix(both, common, params)[0]))
            assert shared >= min(params.least(len(a)), params.least(len(both))) >= params.least(params.common(len(a)))


def test_join_of_nothing(spark):
    assert jaccard.near_duplicates(no_documents(spark)).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(0)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 100))) for _ in range(2))
        x, y = jaccard.bitmap(a), jaccard.bitmap(b)
        words = min(len(x), len(y))
        differing = int(np.bitwise_count(jaccard.folded(x, words) ^ jaccard.folded(y, words)).sum())
        assert (len(a) + len(b) - differing) // 2 >= len(np.intersect1d(a, b))


# ---------------------------------------------------------------- vectors

def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(260, 16)).astype(np.float32)
    for i in range(100, 180):
        x[i] = x[i - 100] + rng.normal(size=16) * 0.04 * (i % 3)
    x[180:240] = x[0] + rng.normal(size=(60, 16)) * 0.05
    rows = [(i, [float(v) for v in x[i]], i % 2) for i in range(260)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, [float("inf")] + [1.0] * 15, 0), (304, rows[3][1], None), (305, [None] + [1.0] * 15, 1), (306, [], 0), (307, rows[3][1], 1), (308, rows[3][1][:8], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("links", F.lit(1)).withColumn("cls", F.lit("x"))
    good = [r for r in rows if r[2] is not None and r[0] not in (300, 301, 302, 303, 305, 306)]
    pairs = []
    for i, a in enumerate(good):
        for j in range(i):
            b = good[j]
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                p, q = np.float64(a[1]), np.float64(b[1])
                if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.98:
                    pairs.append((i, j))
    root, count = united(len(good), pairs), defaultdict(int)
    for i, j in pairs:
        count[i] += 1
        count[j] += 1
    want = {good[i][0]: (count[i], good[root[i]][0]) for i in range(len(good))}
    for params in (near_vectors.ForestParams(), near_vectors.ForestParams(leaf=24, trees=10)):
        got = near_vectors.near_duplicates(df, params).collect()
        assert len(got) == len(rows)
        wrong = [r.vec_id for r in got if (r.n_links, r.component_id) != want.get(r.vec_id, (0, r.vec_id))]
        assert len(wrong) <= (0 if params.leaf > 100 else 5), wrong
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
        assert all(r.n_links <= want.get(r.vec_id, (0, 0))[0] for r in got)
    assert near_vectors.near_duplicates(df.filter("false")).count() == 0


def test_large_nodes_are_divided_over_the_cluster(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 16))
    x[200:] = x[:200] + rng.normal(size=(200, 16)) * 0.02
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], 0) for i in range(400)], "vec_id bigint, embedding array<double>, label int")
    got = near_vectors.near_duplicates(df, near_vectors.ForestParams(local=150, leaf=40)).orderBy("vec_id").collect()
    assert sum(r.component_id == r.vec_id % 200 for r in got) >= 0.98 * 400


def test_recall_where_nodes_are_split(spark):
    """Production parameters on labels so large that their nodes are cut: an even one, a
    loose cluster and a tighter one, each with planted pairs just above the threshold."""
    rng = np.random.default_rng(9)
    n, d, k, rows, want = 6000, 64, 150, [], set()
    for label, near in enumerate((0.0, 0.92, 0.96)):
        mean = rng.normal(size=d)
        mean /= np.linalg.norm(mean)
        rest = rng.normal(size=(n, d))
        rest -= np.outer(rest @ mean, mean) * (near > 0)
        rest /= np.linalg.norm(rest, axis=1, keepdims=True)
        x = near * mean + np.sqrt(1 - near * near) * rest
        off = rng.normal(size=(k, d))
        off -= (off * x[:k]).sum(axis=1, keepdims=True) * x[:k]
        off /= np.linalg.norm(off, axis=1, keepdims=True)
        cos = rng.uniform(0.9801, 0.984, size=(k, 1))
        x[k : 2 * k] = cos * x[:k] + np.sqrt(1 - cos * cos) * off
        rows += [(label * n + i, [float(v) for v in x[i]], label) for i in range(n)]
        similar = x @ x.T >= 0.98
        want |= {(label * n + i) for i in np.flatnonzero(similar.sum(axis=1) > 1)}
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = {r.vec_id for r in near_vectors.near_duplicates(df).filter("n_links > 0").collect()}
    assert found <= want and len(found) >= 0.99 * len(want), (len(found), len(want))


# ---------------------------------------------------------------- pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    sf = SF_DIR
    docs = cp.table(spark, sf, "documents")
    columns = docs.columns
    for name, stage in cp.STAGES[:3]:
        before = docs
        docs = stored(stage(spark, before, sf), f"test-{name}")
        assert docs.columns == columns
        assert docs.join(before, columns, "left_anti").count() == 0
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
            assert {r.doc_id for r in docs.collect()} == {c for _, _, c in brute_jaccard(rows)}
        if name == "decontamination":
            items = [decontaminate.normalised(r.text) for r in cp.table(spark, sf, "benchmark").collect()]
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()}
            leaks = lambda r: any(edits(i, decontaminate.normalised(r.text)) <= decontaminate.budget_of(i, decontaminate.EditMatch()) for i in items if i[40:60] in decontaminate.normalised(r.text) or i in decontaminate.normalised(r.text))
            assert not [r.doc_id for r in docs.collect() if any(i in decontaminate.normalised(r.text) for i in items)]
            assert all(leaks(r) for r in before.filter(F.col("doc_id").isin(list(gone))).collect() if any(i[40:60] in decontaminate.normalised(r.text) for i in items))
    redacted = cp.redact_personal(spark, docs, sf)
    assert redacted.columns == columns and redacted.count() == docs.count()
    for row, old in zip(redacted.orderBy("doc_id").collect(), docs.orderBy("doc_id").collect()):
        assert not pii.base_spans(row.text) or len(row.text) < len(old.text)
        for _, start, end in pii.base_spans(old.text):
            assert row.text != old.text and old.text[start:end] not in row.text
        assert row.n_chars == len(row.text)
    encoded = {r.doc_id: r for r in cp.encode(spark, redacted, sf).collect()}
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(bpe.default_path())
    for row in redacted.collect():
        ids = reference.encode(row.text, add_special_tokens=False).ids
        assert encoded[row.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()


def test_pipeline_stages_on_awkward_rows(spark):
    """Nulls, empty and very long texts, repeats and extra columns; and no rows at all."""
    import corpus_pipeline as cp

    rows = AWKWARD + [(20, "mail a.b@c.org now"), (20, None), (21, "mail a.b@c.org now"), (22, "x")]
    docs = documents(spark, rows)
    for name, stage in cp.STAGES:
        assert stage(spark, docs.filter("false"), SF_DIR).count() == 0, name
    kept = dict(cp.STAGES)
    distinct = kept["near_duplicates"](spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id or -1) for r in distinct) == [-1, 1, 2, 3, 4, 5, 8, 9, 10, 11, 12, 20, 22]
    assert next(r.text for r in distinct if r.doc_id == 20) is None  # the first in the order of the columns
    assert kept["decontamination"](spark, docs, SF_DIR).count() == len(rows)
    clean = kept["personal_data"](spark, docs, SF_DIR)
    assert clean.columns == docs.columns
    by = {r.doc_id: r for r in clean.collect()}
    assert by[21].text == "mail [EMAIL] now" and by[21].n_chars == 16 and by[2].text is None and by[2].n_chars is None and by[3].text == ""
    assert kept["encoding"](spark, docs, SF_DIR).count() == len(rows)
    good = kept["quality"](spark, docs, SF_DIR)
    assert good.columns == docs.columns and good.count() <= len(rows)


def test_pipeline_stages_keep_the_values_of_users_columns(spark):
    """Types and values of columns that operators name themselves, after each stage but the last."""
    import corpus_pipeline as cp

    docs = documents(spark).withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in ("score", "predicted", "hits", "spans", "own0")})
    docs = docs.withColumns({"_rank": F.lit(77), "rank": F.array(F.lit("a")), "label": F.create_map(F.lit("k"), "doc_id"), "quality": F.lit(5), "n a.me": F.lit(True)}).select("score", "text", "doc_id", *[c for c in ("predicted", "hits", "spans", "own0", "_rank", "rank", "label", "quality", "source", "n")], F.col("`n a.me`"))
    own = [i for i, c in enumerate(docs.columns) if c != "text"]
    given = {repr([r[i] for i in own]) for r in docs.collect()}
    for name, stage in cp.STAGES[:-1]:
        found = stage(spark, docs, SF_DIR)
        assert found.schema.simpleString() == docs.schema.simpleString(), name
        rows = found.collect()
        assert {repr([r[i] for i in own]) for r in rows} <= given and (rows or name == "quality"), name


def test_pipeline_leaves_nothing_when_a_stage_fails(spark, monkeypatch, tmp_path):
    import corpus_pipeline as cp

    monkeypatch.setattr(cp, "shared_dir", lambda _, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(cp, "STAGES", [("first", lambda s, docs, d: docs), ("second", lambda s, docs, d: docs.limit(5)), ("third", lambda s, docs, d: 1 / 0)])
    with pytest.raises(ZeroDivisionError):
        cp.run(spark, SF_DIR)
    assert not list(tmp_path.iterdir())


def test_pipeline_runs(spark):
    import corpus_pipeline as cp

    out = cp.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() == out.select("doc_id").distinct().count()
