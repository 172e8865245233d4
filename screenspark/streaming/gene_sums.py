"""Running sums per gene over files of counts as they arrive, an extension.

``availableNow`` takes what is there and stops; the checkpoint remembers what was taken,
so that a later call goes on with new files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def gene_sums(spark: SparkSession, folder: str) -> DataFrame:
    """A streaming DataFrame (gene_name, total, nnz) over a folder of Parquet files."""
    x = spark.readStream.schema("cell_id bigint, gene_name string, value double").parquet(folder)
    return x.groupBy("gene_name").agg(F.sum("value").alias("total"), F.count_if(F.col("value") != 0).alias("nnz"))


def take_available(spark: SparkSession, folder: str, out: str, checkpoint: str) -> DataFrame:
    """Process all new files; the table at ``out`` holds the sums of everything so far."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    query = gene_sums(spark, folder).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(replace).start()
    query.awaitTermination()
    return spark.read.parquet(out)
