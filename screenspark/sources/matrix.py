"""Reading and writing screens as Parquet tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenspark.model import CountMatrix


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _path(spark, path)
    return system.exists(target)


def write_matrix(m: CountMatrix, path: str, by: tuple[str, ...] = (), gene_ranges: bool = False, files: int | None = None) -> None:
    """Obs, var and x below a folder; ``by`` (split, line) become partitions.

    With ``gene_ranges`` each file of x holds a range of genes, and a table ``ranges`` (file,
    low, high) tells which, so that ``read_genes`` opens few files.  A gene of very many
    entries goes on over several files.  Finding the ranges runs the plan of x once more:
    give it stored.  ``files`` fixes their number; else adaptive execution sizes them.
    """
    m.obs.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/obs") if by else m.obs.write.mode("overwrite").parquet(f"{path}/obs")
    m.var.write.mode("overwrite").parquet(f"{path}/var")
    x = m.ensure_sparse().x
    if gene_ranges:
        x = x.repartitionByRange(*([files] if files else []), "gene_name", "cell_id")
    x.sortWithinPartitions("gene_name").write.mode("overwrite").parquet(f"{path}/x")
    if gene_ranges:
        spark = x.sparkSession
        found = spark.read.schema(x.schema).parquet(f"{path}/x").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("gene_name").alias("low"), F.max("gene_name").alias("high"))
        found.write.mode("overwrite").parquet(f"{path}/ranges")


def read_matrix(spark: SparkSession, path: str) -> CountMatrix:
    """Lazy; columns and row groups that a query doesn't need aren't read."""
    return CountMatrix(*(spark.read.parquet(f"{path}/{t}") for t in ("obs", "var", "x"))).ensure_sparse()


@contextmanager
def bucketed_matrix(m: CountMatrix, path: str, buckets: int) -> Iterator[CountMatrix]:
    """Write a matrix as ``write_matrix`` does, x in buckets of cells, and read it back.

    Within the block Spark knows the buckets, so that grouping x by cell, or joining it with
    tables of cells, doesn't shuffle it; x of cells in as many partitions isn't shuffled to
    be written either.  The genes are those that have entries.
    """
    spark, name = m.x.sparkSession, f"matrix_{uuid.uuid4().hex}"
    m.obs.write.mode("overwrite").parquet(f"{path}/obs")
    try:
        m.ensure_sparse().x.write.mode("overwrite").format("parquet").bucketBy(buckets, "cell_id").sortBy("gene_name").option("path", f"{path}/x").saveAsTable(name)
        spark.table(name).select("gene_name").distinct().write.mode("overwrite").parquet(f"{path}/var")
        yield CountMatrix(spark.read.parquet(f"{path}/obs"), spark.read.parquet(f"{path}/var"), spark.table(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay


def read_genes(spark: SparkSession, path: str, genes: DataFrame) -> CountMatrix:
    """The columns of the genes in ``genes``, from the files that can hold them.

    For a matrix written with ``gene_ranges``; without genes, or with unknown ones alone, x
    is empty.  There is one range for each file, no more than Spark lists to read them all,
    so the ranges may be broadcast and the names of the files come to the driver.
    """
    keep = genes.select("gene_name")
    ranges = spark.read.schema("file string, low string, high string").parquet(f"{path}/ranges")
    hits = keep.join(F.broadcast(ranges), F.col("gene_name").between(F.col("low"), F.col("high"))).select("file").distinct().collect()
    m = read_matrix(spark, path)
    x = spark.read.schema(m.x.schema).parquet(*(f"{path}/x/{r.file}" for r in hits)) if hits else m.x.limit(0)
    return CountMatrix(m.obs, m.var, x).keep_genes(genes)


def from_wide(wide: DataFrame, gene_names: list[str], counts: str = "counts") -> CountMatrix:
    """One row per cell with a dense array of counts, to the long form."""
    names = F.array(*[F.lit(g) for g in gene_names])
    x = wide.select("cell_id", F.posexplode(counts).alias("i", "value")).filter("value <> 0").select("cell_id", names[F.col("i")].alias("gene_name"), "value")
    var = wide.sparkSession.createDataFrame([(g,) for g in gene_names], "gene_name string")
    return CountMatrix(wide.drop(counts), var, x)


def load(spark: SparkSession, raw_path: str, cache_path: str, gene_names: list[str]) -> CountMatrix:
    """The sparse copy if there is one, else the dense file, which leaves a copy."""
    if not exists(spark, f"{cache_path}/x"):
        write_matrix(from_wide(spark.read.parquet(raw_path), gene_names), cache_path)
    return read_matrix(spark, cache_path)


def read_droplets(spark: SparkSession, path: str) -> CountMatrix:
    """Unfiltered droplets, as a long table (cell_id, gene_name, value)."""
    x = spark.read.parquet(path).select("cell_id", "gene_name", "value")
    return CountMatrix(x.select("cell_id").distinct(), x.select("gene_name").distinct(), x)


def read_gene_map(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of gene_id, symbol.  S07: any such DataFrame can take its place."""
    return spark.read.csv(path, header=True, schema="gene_id string, symbol string")


def write_vectors(vectors: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Rows with array columns, values as floats."""
    narrow = vectors.select(*[F.col(f.name).cast("array<float>").alias(f.name) if f.dataType.simpleString() == "array<double>" else F.col(f.name) for f in vectors.schema.fields])
    writer = narrow.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_manifest(spark: SparkSession, content: dict, path: str) -> None:
    """One small JSON file, by whatever file system the path is on."""
    target, system = _path(spark, path)
    out = system.create(target, True)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()


def split_manifest(labels: DataFrame, seed: int) -> dict:
    """Label lists by split; labels are as few as perturbations."""
    rows = labels.groupBy("split").agg(F.sort_array(F.collect_set("pert")).alias("perts")).collect()
    return {f"{r.split}_labels": r.perts for r in rows} | {"seed": seed}


def checkpointed(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at ``path`` if a complete one is there, else made and written."""
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def shards_done(spark: SparkSession, path: str, shards: list[str]) -> list[str]:
    """Those of ``shards`` whose folder Spark's committer has marked as complete."""
    return [s for s in shards if exists(spark, f"{path}/shard={s}/_SUCCESS")]


def recovered(spark: SparkSession, path: str, shards: list[str], make: Callable[[str], DataFrame]) -> DataFrame:
    """The table at ``path``, made shard by shard; what a run before has finished stays.

    ``make(shard)`` gives a shard's rows, from which its folder ``shard=...`` is written; a
    folder that a failed run left unfinished is replaced.  Shard names are few, and plain
    words, such as the numbers of a bucket that a key is hashed to.
    """
    done = set(shards_done(spark, path, shards))
    for shard in shards:
        if shard not in done:
            make(shard).write.mode("overwrite").parquet(f"{path}/shard={shard}")
    return spark.read.option("basePath", path).parquet(*(f"{path}/shard={s}" for s in shards))


def clean_up(spark: SparkSession, paths: list[str], dry_run: bool = True) -> dict:
    """Deletes intermediates; {deleted, missing, bytes}.  A dry run only counts."""
    found = {"deleted": [], "missing": [], "bytes": 0}
    for path in paths:
        target, system = _path(spark, path)
        if not system.exists(target):
            found["missing"].append(path)
            continue
        found["bytes"] += system.getContentSummary(target).getLength()
        found["deleted"].append(path)
        if not dry_run:
            system.delete(target, True)
    return found
