"""The jobs: against SQL, over growing input, after failures, by their command line."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs import cell_intake, queries, term_screen
from jobs.common import load_config
from tests.compare import SF, differences

ROOT = Path(__file__).resolve().parent.parent
TABLES = {"entries": "lineitem", "barcodes": "orders", "features": "part", "cells": "customer"}


def rows(df):
    return sorted(df.collect(), key=repr)


@pytest.mark.parametrize("name", queries.ORACLE)
def test_job_equals_sql(spark, name):
    assert not differences(queries.QUERIES[name](spark, SF), queries.ORACLE[name], SF)


@pytest.fixture
def inputs(spark, tmp_path):
    """Paths of the tables, with a folder for entries of which two thirds arrive later."""
    parts = [spark.read.parquet(f"{SF}/lineitem.parquet").filter(F.col("l_orderkey") % 3 == k) for k in range(3)]

    def arrive(k):
        parts[k].coalesce(1).write.mode("append").parquet(str(tmp_path / "entries"))

    return {n: f"{SF}/{t}.parquet" for n, t in TABLES.items()} | {"entries": str(tmp_path / "entries")}, arrive, str(tmp_path / "out")


@pytest.fixture
def whole(spark, tmp_path):
    out = cell_intake.run(spark, {n: f"{SF}/{t}.parquet" for n, t in TABLES.items()}, str(tmp_path / "whole"), load_config(cell_intake.CONFIG))
    return rows(out), rows(spark.read.parquet(str(tmp_path / "whole/genes")))


def test_intake_takes_only_what_is_new(spark, inputs, whole):
    paths, arrive, out = inputs
    config = load_config(cell_intake.CONFIG)
    arrive(0)
    first = rows(cell_intake.run(spark, paths, out, config))
    assert 0 < len(first) <= len(whole[0]) and first != whole[0]
    arrive(1)
    arrive(2)
    assert rows(cell_intake.run(spark, paths, out, config)) == whole[0]
    assert rows(spark.read.parquet(f"{out}/genes")) == whole[1]
    entries = spark.read.parquet(f"{out}/entries")
    assert entries.agg(F.sum("n_rows")).first()[0] == spark.read.parquet(paths["entries"]).count() and {r.intake for r in entries.select("intake").distinct().collect()} == {0, 1}
    before = {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}
    assert rows(cell_intake.run(spark, paths, out, config)) == whole[0]
    assert before == {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}  # nothing new, nothing written


def test_intake_leaves_other_plates_alone(spark, inputs):
    paths, _, out = inputs
    config = load_config(cell_intake.CONFIG)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").join(spark.read.parquet(f"{SF}/orders.parquet").selectExpr("o_orderkey AS l_orderkey", "o_custkey % 4 AS plate"), "l_orderkey")
    for plate in (0, 1):
        lines.filter(F.col("plate") == plate).drop("plate").coalesce(1).write.mode("append").parquet(paths["entries"])
        before = {p: p.stat().st_mtime_ns for p in Path(out).glob("cells/plate=0/*.parquet")}
        cells = cell_intake.run(spark, paths, out, config)
        assert {r.plate for r in cells.select("plate").distinct().collect()} == set(range(plate + 1))
        assert not plate or before == {p: p.stat().st_mtime_ns for p in Path(out).glob("cells/plate=0/*.parquet")}


def test_intake_redoes_a_step_that_failed(spark, inputs, whole, monkeypatch):
    paths, arrive, out = inputs
    config = load_config(cell_intake.CONFIG)
    arrive(0)
    cell_intake.run(spark, paths, out, config)
    arrive(1)
    arrive(2)
    with monkeypatch.context() as m:
        m.setattr(cell_intake, "triaged", lambda *_: 1 / 0)  # after the entries are written
        with pytest.raises(Exception, match="ZeroDivisionError|division by zero"):
            cell_intake.run(spark, paths, out, config)
    assert rows(cell_intake.run(spark, paths, out, config)) == whole[0]


def test_sample_sheet_may_come_after_the_counts(spark, inputs, whole, tmp_path):
    paths, arrive, out = inputs
    config = load_config(cell_intake.CONFIG)
    sheet = spark.read.parquet(paths["barcodes"])
    half, late = str(tmp_path / "half"), str(tmp_path / "late")
    sheet.filter("o_orderkey % 2 = 0").write.parquet(half)
    sheet.unionByName(sheet).unionByName(sheet.limit(1).withColumn("o_orderkey", F.lit(None).cast("bigint"))).write.parquet(late)  # repeats and a missing key
    arrive(0)
    arrive(1)
    cell_intake.run(spark, paths | {"barcodes": half}, out, config)
    assert spark.read.parquet(f"{out}/unassigned").filter("intake = 0").count() > 0
    arrive(2)
    assert rows(cell_intake.run(spark, paths | {"barcodes": late}, out, config)) == whole[0]
    assert spark.read.parquet(f"{out}/unassigned").filter("intake = 1").count() == 0


def test_term_screen_of_awkward_documents(spark, tmp_path):
    shared = "one two three four five six seven eight nine ten eleven twelve " * 2
    docs = [(k, shared + f"own{k}", "src0" if k % 2 else "srcA", "en") for k in range(8)]
    docs += [(100, None, "srcA", "en"), (101, "", None, None), (None, shared, "srcA", "en"), (0, "ONE Extra", "srcB", "zz"), (103, shared * 5_000, "srcC", "de")]
    spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, source string, lang string, gene_name string").write.parquet(str(tmp_path / "docs"))
    found = term_screen.run(spark, {"documents": str(tmp_path / "docs")}, str(tmp_path / "out"), load_config(term_screen.CONFIG)).collect()
    at = {(r.cell_line, r.pert, r.gene_name): r for r in found}
    assert {k[:2] for k in at} == {("en", "src0"), ("en", "srcA"), ("de", "srcC")} and not any("own" in k[2] for k in at)
    assert at["en", "src0", "two"].shift == 0 and at["en", "srcA", "two"].n_cells == 4 and at["de", "srcC", "two"].shift is None
    assert at["en", "srcA", "one"].mean > at["en", "src0", "one"].mean  # the repeated id is one document
    spark.createDataFrame([], "doc_id bigint, text string, source string, lang string").write.parquet(str(tmp_path / "none"))
    assert term_screen.run(spark, {"documents": str(tmp_path / "none")}, str(tmp_path / "out"), load_config(term_screen.CONFIG)).count() == 0


@pytest.mark.parametrize("job", [cell_intake, term_screen])
def test_command_line(spark, tmp_path, job):
    paths = {n: f"{SF}/{t}.parquet" for n, t in {**TABLES, "documents": "documents"}.items() if n in job.INPUTS}
    words = [w for n, p in paths.items() for w in (f"--{n}", p)] + ["--out", str(tmp_path / "out")]
    done = subprocess.run([sys.executable, "-m", job.__name__, *words], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read" in done.stderr and "wrote" in done.stderr
    assert spark.read.parquet(str(tmp_path / "out" / ("cells" if job is cell_intake else "profiles"))).count() > 0


def exchanges(df):
    return [line for line in df._jdf.queryExecution().sparkPlan().toString().splitlines() + df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_words_are_counted_where_their_document_is(spark):
    docs = spark.range(9).selectExpr("id % 5 AS cell_id", "'a' AS pert", "'b' AS cell_line", "'A b a' AS text")
    x = term_screen.term_matrix(docs).x
    assert not any("gene_name" in line for line in exchanges(x))
    assert {(r.cell_id, r.gene_name, r.value) for r in x.collect()} == {(k, g, n * (1 if k == 4 else 2)) for k in range(5) for g, n in (("a", 2.0), ("b", 1.0))}


def test_bucketed_matrix_is_not_shuffled_by_cell(spark, tmp_path):
    from screenspark.sources.matrix import bucketed_matrix

    m = term_screen.term_matrix(spark.range(40).selectExpr("id AS cell_id", "'a' AS pert", "'b' AS cell_line", "concat('x y', id) AS text"), 4)
    for _ in range(2):  # a rerun replaces all
        with bucketed_matrix(m, str(tmp_path / "m"), 4) as found:
            sums = found.x.groupBy("cell_id").agg(F.sum("value").alias("total"))
            assert not exchanges(sums) and {(r.cell_id, r.total) for r in sums.collect()} == {(k, 2.0) for k in range(40)}
            assert found.var.count() == 41 and found.obs.count() == 40
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("matrix_")]


def test_entries_are_not_dealt_by_plate(spark, inputs, monkeypatch):
    paths, arrive, out = inputs
    arrive(0)
    plans, triaged = [], cell_intake.triaged

    def seen(cells, entries, config):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in (cells, entries))
        return triaged(cells, entries, config)

    monkeypatch.setattr(cell_intake, "triaged", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert cell_intake.run(spark, paths, out, load_config(cell_intake.CONFIG)).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plans and not any("SortMergeJoin [plate" in plan for plan in plans)
