"""Incremental intake of a screen: new count files in, triaged cells by plate out.

Sequencing delivers count files (barcode, feature, value) over weeks.  Each run takes only
the files that no run before has taken, by a file stream with a checkpoint and
``availableNow``; it resolves barcodes to cells and features to genes, adds the counts to
the stored sparse matrix, and triages anew the cells of those plates that got counts.

Below ``out``:

* ``entries/plate=/intake=``: counts per cell and gene, one folder per plate and step;
* ``unassigned/intake=``: rows whose barcode or feature isn't known (yet).  They are tried
  again with the next step, so a sample sheet may come after the counts;
* ``cells/plate=``: all cells of the plate with their quality metrics, ``passed``, and
  ``failed``, the first filter that a cell fails, null for none;
* ``genes/plate=``: per gene the passed cells that express it, and their counts;
* ``checkpoint``: which files have been taken.

A step is redone as a whole where a run died: it gets the same number and the same files
again, and replaces the folders that it had written (dynamic partition overwrite).
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import Config, columns_of, count_of, log, main
from screenspark.model import CountMatrix
from screenspark.operators import qc

CONFIG = Path(__file__).with_name("cell_intake.yaml")
INPUTS = ["entries", "barcodes", "features", "cells"]
ENTRIES = "cell_id bigint, gene_name string, value double, n_rows bigint, plate bigint, intake bigint"
UNASSIGNED = "barcode bigint, feature bigint, value double, intake bigint"
CELLS = "cell_id bigint, pert string, cell_line string, n_genes_by_counts bigint, total_counts double, total_counts_mt double, pct_counts_mt double, passed boolean, failed string, plate bigint"
GENES = "gene_name string, n_cells_expr bigint, total double, plate bigint"


def write_parts(rows: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``rows`` has, and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def typed(rows: DataFrame, schema: str) -> DataFrame:
    return rows.select(*(F.col(name).cast(kind) for name, kind in (c.split() for c in schema.split(", "))))


def triaged(cells: DataFrame, entries: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """All of ``cells`` with metrics and verdict, and sums of the passed cells by gene."""
    x = entries.groupBy("plate", "cell_id", "gene_name").agg(F.sum("value").alias("value"))
    metrics = qc.qc_metrics(CountMatrix(cells, x.select("gene_name").distinct(), x), config.spec)
    failed = F.coalesce(*(F.when(~passes, F.lit(name)) for name, passes in qc.cell_filters(config.spec)))
    judged = metrics.withColumn("failed", failed).withColumn("passed", F.col("failed").isNull())
    good = x.join(judged.filter("passed").select("cell_id"), "cell_id", "left_semi")
    return judged, good.groupBy("plate", "gene_name").agg(F.count_if(F.col("value") != 0).alias("n_cells_expr"), F.sum("value").alias("total"))


def take(spark: SparkSession, batch: DataFrame, step: int, inputs: dict[str, str], out: str, config: Config) -> None:
    """One step: add the counts of ``batch``, then triage the plates that they belong to."""
    read = {name: columns_of(spark.read.parquet(inputs[name]), config.columns[name]) for name in INPUTS[1:]}
    cells = read["cells"].filter("cell_id IS NOT NULL AND plate IS NOT NULL").dropDuplicates(["cell_id"])
    barcodes, features = (read[n].dropna().dropDuplicates([k]) for n, k in (("barcodes", "barcode"), ("features", "feature")))
    new = columns_of(batch, config.columns["entries"])
    if step:
        waiting = spark.read.schema(UNASSIGNED).parquet(f"{out}/unassigned").filter(F.col("intake") == step - 1)
        new = waiting.select(*new.columns).unionByName(new)
    # From the tables' side, so that the session with all its settings plans the joins.
    known = barcodes.join(cells.select("cell_id", "plate"), "cell_id").join(new, "barcode", "right").join(features, "feature", "left")
    resolved = F.col("plate").isNotNull() & F.col("gene_name").isNotNull()
    counts = known.filter(resolved).groupBy("plate", "cell_id", "gene_name").agg(F.sum(F.col("value").cast("double")).alias("value"), F.count("*").alias("n_rows"))
    write_parts(typed(counts.withColumn("intake", F.lit(step)), ENTRIES), f"{out}/entries", "plate", "intake")
    write_parts(typed(known.filter(~resolved).withColumn("intake", F.lit(step)), UNASSIGNED), f"{out}/unassigned", "intake")

    entries = spark.read.schema(ENTRIES).parquet(f"{out}/entries")
    added = entries.filter(F.col("intake") == step)
    plates = F.broadcast(added.select("plate").distinct())  # as few as folders; dealt by plate, a task would get a whole one
    so_far = entries.filter(F.col("intake") <= step).join(plates, "plate", "left_semi")
    judged, genes = triaged(cells.join(plates, "plate", "left_semi"), so_far, config)
    write_parts(typed(judged, CELLS), f"{out}/cells", "plate")
    write_parts(typed(genes, GENES), f"{out}/genes", "plate")
    sums = added.agg(F.sum("n_rows").alias("rows"), F.count("*").alias("entries"), F.count_distinct("plate").alias("plates")).first()
    left = count_of(spark.read.schema(UNASSIGNED).parquet(f"{out}/unassigned").filter(F.col("intake") == step))
    log.info("step %d: read %d rows of new files; wrote %d entries of %d rows, %d rows unassigned; triaged %d plates", step, count_of(batch), sums.entries, sums.rows or 0, left, sums.plates)


def as_pattern(path: str) -> str:
    """A pattern that only ``path`` fits: a file stream takes one file only by a pattern."""
    path = path.rstrip("/")
    return path if set(path) & set("*?[{") else f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, inputs: dict[str, str], out: str, config: Config) -> DataFrame:
    """Take the count files that are new and triage the plates they touch; returns the cells.

    ``inputs`` has the paths of entries (a folder of files, or one file), barcodes, features
    and cells.  Rows of the sample
    sheets that repeat a key count once; those without key or plate count for nothing.  A
    null value counts as none.  Plates without any counts yet aren't in the result.
    """
    schema = spark.read.parquet(inputs["entries"]).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", config.options.get("files_at_once", 1000)).parquet(as_pattern(inputs["entries"]))
    steps = stream.writeStream.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
    query = steps.foreachBatch(lambda batch, step: take(spark, batch, step, inputs, out, config)).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    cells = spark.read.schema(CELLS).parquet(f"{out}/cells")
    log.info("%d cells of %d plates are triaged below %s", *cells.agg(F.count("*"), F.count_distinct("plate")).first(), out)
    return cells


if __name__ == "__main__":
    main(run, INPUTS, CONFIG)
