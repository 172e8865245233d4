"""Helpers that several operators share: Arrow maps, shared storage, sampling."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of texts that a map function is given at once.
ROWS_AT_ONCE, BYTES_AT_ONCE = 256, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """An Arrow batch, cut so that its texts as Python strings still fit a worker."""
    step = max(1, min(ROWS_AT_ONCE, BYTES_AT_ONCE * batch.num_rows // max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str | StructType) -> DataFrame:
    """Run ``make()`` once per task; the function it returns maps columns to columns.

    Columns go in and come out as plain Python lists, one list per column.
    """
    names = df.columns
    out = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        step = make()
        for batch in batches:
            for part in parts_of(batch):
                got = step({n: part.column(i).to_pylist() for i, n in enumerate(names)})
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new path below the folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset a local folder
    is taken, but only if all runs on this machine, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/screenspark-checkpoints"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Whether Spark removes the shuffle files of a query as soon as it is done.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str) -> None:
    """Write Parquet, and let go of the shuffle files behind it when all is written."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEAN_UP) if before is None else conf.set(CLEAN_UP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage with a Parquet table in the shared folder, which stays there."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one run in the shared folder; they go when the run ends, well or not."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            drop_dir(self.spark, path)

    def path(self, label: str) -> str:
        self.paths.append(shared_dir(self.spark, label))
        return self.paths[-1]

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = self.path(label)
        write_table(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, path: str) -> None:
        """Let go of a table before the run ends."""
        self.paths.remove(path)
        drop_dir(self.spark, path)


def dealt(rows: DataFrame) -> DataFrame:
    """The same rows in no order: a join with them has a plain shuffle on this side too, so
    that Spark can split large partitions of the other side (adaptive skew join)."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def bucket_of(column: str, modulus: int) -> F.Column:
    """crc32 of a column's text form, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def sample_per_class(df: DataFrame, key: str, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each label, in an order fixed by a hash of ``key``.

    The rank limit reaches the map side, so that one large class costs no more.
    """
    from pyspark.sql import Window as W

    order = W.partitionBy(label).orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key))
    return df.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= per_class).drop("_rank")


_KEPT: dict[str, object] = {}


def kept(owner: str, make: Callable[[], object]):
    """What a worker process remembers from task to task for one operator and model.

    Workers are used again by other operators; the memory of the one before is let go.
    """
    if owner not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[owner] = make()
    return _KEPT[owner]


def give_back() -> None:
    """Return freed memory to the system, which the allocator would keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not on every C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)
