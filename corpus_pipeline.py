"""From raw documents to token counts: filter, join, decontaminate, redact, encode.

Each stage takes (spark, docs, sf_dir), ``docs`` being all that the stage before it
kept, and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from screenspark.llm import bpe, decontaminate, jaccard, pii, quality
from screenspark.llm.common import drop_dir, shared_dir, table, write_table


def apart(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but doc_id and text under names that no operator uses."""
    return docs.toDF(*(c if c in ("doc_id", "text") else f"own{i}" for i, c in enumerate(docs.columns)))


def again(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, under their names, of what became of ``apart(docs)``."""
    return found.select(*apart(docs).columns).toDF(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; a null text is scored as an empty one.

    Only the documents that come in, and that have labels, are learned from.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return again(quality.score(apart(docs), model).filter("predicted = 1"), docs)


def first_rows(docs: DataFrame) -> DataFrame:
    """Of rows that repeat a doc_id the first in the order of the other columns, nulls first."""
    plain = [f.name for f in docs.schema.fields if f.name != "doc_id" and not isinstance(f.dataType, (MapType, VariantType))]
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy(*plain) if plain else W.partitionBy("doc_id").orderBy("doc_id"))
    return docs.withColumn("_rank", rank).filter("_rank = 1").select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id.

    Of rows that repeat a doc_id the first in the order of the other columns stays; rows
    without doc_id all stay, as do null and empty texts, which are nobody's duplicates.
    """
    rows = apart(docs)
    keep = jaccard.near_duplicates(rows).filter("doc_id = component_id").select("doc_id").distinct()
    kept = first_rows(rows.join(keep, "doc_id", "left_semi").select(*rows.columns))
    return again(kept.unionByName(rows.filter("doc_id IS NULL")), docs)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of the benchmark occurs; null and empty texts stay."""
    found = decontaminate.find_leaks(apart(docs), table(spark, sf_dir, "benchmark"))
    return again(found.filter(F.size("hits") == 0), docs)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the personal data in their texts replaced and n_chars counted
    anew; a null text stays null, and has no n_chars."""
    found = again(pii.redact(apart(docs), pii.train()), docs)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast("bigint"))
    return found


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of all documents; a null text is an empty one."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_unleaked),
    ("personal_data", redact_personal),
    ("encoding", encode),
]

#: SQL can't express the trained stages; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages; the tables between them go as soon as they are read, or
    when a stage fails.  The last one stays in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    with contextlib.ExitStack() as failing:
        before = None
        for name, stage in STAGES:
            path = shared_dir(spark, f"pipeline-{name}")
            failing.callback(drop_dir, spark, path)
            made = stage(spark, docs, sf_dir)
            write_table(made, path)
            docs = spark.read.schema(made.schema).parquet(path)
            if before:
                drop_dir(spark, before)
            before = path
        failing.pop_all()
    return docs
