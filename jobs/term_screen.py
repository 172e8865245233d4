"""Documents as a screen: which terms set a source apart from the control source.

A term-by-document count matrix has the shape of a perturbation screen: documents are the
cells, terms the genes, the source is the perturbation and the language the line.  The job
builds the sparse matrix from whole texts and runs the screen's own operators on it:
triage of documents by distinct terms and words, triage of terms by penetrance, scaling to
the median size within a language, log(1 + v), and per language and source the mean
profile with its shift from the control source's.

Below ``out``: ``matrix`` (obs, var, x), and ``profiles/cell_line=`` with pert, gene_name,
n_cells (documents of the group), n_cells_expr, mean, control_mean and shift.  All of it
is replaced by each run, so a rerun gives the same.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import replace
from itertools import repeat
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import Config, columns_of, count_of, log, main
from screenspark.model import CountMatrix
from screenspark.operators import genes, normalize, qc
from screenspark.sources.matrix import bucketed_matrix
from screenspark.sources.storage import settled
from screenspark.spec import ScreenSpec

CONFIG = Path(__file__).with_name("term_screen.yaml")
INPUTS = ["documents"]
PROFILES = "pert string, gene_name string, n_cells bigint, n_cells_expr bigint, mean double, control_mean double, shift double, cell_line string"


#: Most terms that are broadcast; common ones are few, but the thresholds may keep all.
FEW_TERMS = 200_000
#: Entries after which a task hands on what it counted.
ENTRIES = 50_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell_id, gene_name, value) of rows (cell_id, text) in the order of their ids."""
    last, words, ids, terms, counts, kind = None, Counter(), [], [], [], None

    def made() -> pa.RecordBatch:
        rows = [pa.array(ids, kind), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.float64())]
        for column in (ids, terms, counts):
            column.clear()
        return pa.RecordBatch.from_arrays(rows, ["cell_id", "gene_name", "value"])

    def end() -> None:
        ids.extend(repeat(last, len(words)))
        terms.extend(words.keys())
        counts.extend(words.values())
        words.clear()

    for batch in batches:
        kind = batch.schema.field(0).type
        texts = batch.column(1)
        for cell, text in zip(batch.column(0).to_pylist(), texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())):
            if cell != last:
                end()
                last = cell
                if len(ids) >= ENTRIES:
                    yield made()
            if text.is_valid:
                words.update(text.as_py().lower().split())  # of bytes: A-Z, and the six characters of ASCII white space
    end()
    if ids:
        yield made()


def term_matrix(docs: DataFrame, parts: int | None = None) -> CountMatrix:
    """Counts of the words (between white space, A-Z in lower case) of each document.

    The texts are dealt to ``parts`` partitions by document and counted there, so that no
    row a word is shuffled, nor made.  Rows that repeat a document's id are one document: their words add up, the smallest
    labels count.  Rows without id are left out; a null text has no words.
    """
    docs = docs.filter("cell_id IS NOT NULL")
    dealt = docs.select("cell_id", "text").repartition(*([parts] if parts else []), "cell_id").sortWithinPartitions("cell_id")
    x = dealt.mapInArrow(_counted, f"cell_id {docs.schema['cell_id'].dataType.simpleString()}, gene_name string, value double")
    obs = docs.groupBy("cell_id").agg(F.min("pert").alias("pert"), F.min("cell_line").alias("cell_line"))
    return CountMatrix(obs, x.select("gene_name").distinct(), x)


def group_profiles(m: CountMatrix, spec: ScreenSpec) -> DataFrame:
    """Means over all documents of a language and source of the terms that occur there, and
    their shift from the control source in that language; null where it has none."""
    sizes = m.obs.groupBy("cell_line", "pert").agg(F.count("*").alias("n_cells"))
    sums = m.x.join(m.obs.select("cell_id", "cell_line", "pert"), "cell_id").groupBy("cell_line", "pert", "gene_name").agg(F.count("*").alias("n_cells_expr"), F.sum("value").alias("total"))
    means = sums.join(sizes, ["cell_line", "pert"]).withColumn("mean", F.col("total") / F.col("n_cells"))
    is_control = F.col("pert") == spec.control_label
    control = means.filter(is_control).select("cell_line", "gene_name", F.col("mean").alias("own"))
    lines = sizes.filter(is_control).select("cell_line", F.lit(0.0).alias("none"))
    out = means.join(lines, "cell_line", "left").join(control, ["cell_line", "gene_name"], "left").withColumn("control_mean", F.coalesce("own", "none"))
    return out.withColumn("shift", F.col("mean") - F.col("control_mean"))


def write_profiles(m: CountMatrix, out: str, spec: ScreenSpec) -> None:
    columns = [c.split() for c in PROFILES.split(", ")]
    rows = group_profiles(m, spec).select(*(F.col(name).cast(kind) for name, kind in columns))
    rows.write.mode("overwrite").partitionBy("cell_line").parquet(f"{out}/profiles")


def run(spark: SparkSession, inputs: dict[str, str], out: str, config: Config) -> DataFrame:
    """Build the matrix of the documents and write the profiles; returns the profiles."""
    spec = config.spec
    docs = columns_of(spark.read.parquet(inputs["documents"]), config.columns["documents"])
    buckets = config.options.get("buckets", 64)
    with bucketed_matrix(term_matrix(docs, buckets), f"{out}/matrix", buckets) as m:
        log.info("read %d rows; wrote a matrix of %d documents, %d terms, %d entries", count_of(docs), count_of(m.obs), count_of(m.var), count_of(m.x))
        good = settled(qc.good_cells(qc.qc_metrics(m, spec), spec).select("cell_id"))
        kept = m.keep_cells(good)
        terms = settled(genes.triage(kept, spec, cycle=()).filter("kept").select("gene_name"))
        kept = kept.keep_genes(F.broadcast(terms) if terms.count() <= FEW_TERMS else terms)
        scaled = normalize.normalise(kept, replace(spec, target_sum=None, log=True), by="cell_line")
        write_profiles(scaled, out, spec)
    found = spark.read.schema(PROFILES).parquet(f"{out}/profiles")
    log.info("wrote %d rows of profiles below %s", count_of(found), out)
    return found


if __name__ == "__main__":
    main(run, INPUTS, CONFIG)
