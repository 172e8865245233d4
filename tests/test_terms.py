"""Words of documents, as tasks count them."""

from jobs import term_screen


def test_words_are_counted_without_a_row_for_each(spark, monkeypatch):
    """By ASCII white space alone, A-Z in lower case; rows of one id add up, also over batches."""
    monkeypatch.setattr(term_screen, "ENTRIES", 3)
    rows = [(1, "A b\ta c\x0bÀ à"), (2, None), (1, "b  B\x1cx\r\n"), (3, " \x0c "), (None, "lost"), (4, "ÄA äa Z")] + [(9, f"w{i} shared") for i in range(40)]
    docs = spark.createDataFrame([(i, "s", "l", t) for i, t in rows], "cell_id bigint, pert string, cell_line string, text string").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        m = term_screen.term_matrix(docs, 3)
        got = [(r.cell_id, r.gene_name, r.value) for r in m.x.collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {(1, "a"): 1.0, (1, "b"): 2.0, (1, "a c"): 1.0, (1, "À"): 1.0, (1, "à"): 1.0, (1, "b\x1cx"): 1.0, (4, "Äa"): 1.0, (4, "äa"): 1.0, (4, "z"): 1.0, (9, "shared"): 40.0}
    want |= {(9, f"w{i}"): 1.0 for i in range(40)}
    assert len(got) == len(want) and {(c, g): v for c, g, v in got} == want
    assert sorted(r.cell_id for r in m.obs.collect()) == [1, 2, 3, 4, 9]
    assert "Generate" not in m.x._jdf.queryExecution().optimizedPlan().toString()
