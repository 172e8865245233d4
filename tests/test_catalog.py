"""Every query with SQL gives the rows that DuckDB gives for that SQL."""

import pytest

from screenspark.plans.catalog import ORACLE, QUERIES
from tests.compare import SF, differences


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    assert not differences(QUERIES[name](spark, SF), ORACLE[name], SF)


def test_golden_waterfall(spark):
    rows = QUERIES["p08_cell_waterfall"](spark, "/root/testdata/sf0.01").orderBy("step").collect()
    assert [r.n_cells for r in rows] == [1500, 1093, 1081, 1061, 999, 989]


@pytest.mark.parametrize("name", ["n04_hvg", "n05_svd", "n06_harmony", "n09_lines", "n13_metacells", "n15_pca", "n21_hybrid"])
def test_fitted_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_imports():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
