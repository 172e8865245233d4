"""Queries on tables larger than the bounds of what they sample."""

import duckdb

from screenspark.plans.catalog import ORACLE, QUERIES
from tests.compare import SF, differences


def test_grid_judges_every_perturbed_cell(spark, tmp_path):
    """2,500 vectors, some 2,200 of them perturbed; a sweep's own sample has 2,000."""
    copies = f"SELECT vec_id + 500 * c AS vec_id, list_concat(embedding[c + 1:], embedding[:c]) AS embedding, label FROM '{SF}/embeddings.parquet', (SELECT UNNEST(range(5)) AS c)"
    duckdb.sql(f"COPY ({copies}) TO '{tmp_path}/embeddings.parquet' (FORMAT parquet)")
    assert not differences(QUERIES["n24_knn_grid"](spark, str(tmp_path)), ORACLE["n24_knn_grid"], str(tmp_path))
