"""Queries of models whose parameters are given, or whose results SQL can tell some other way."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from screenspark.model import CountMatrix
from screenspark.operators import batch, calibrate, counterfactual, doublets, embed, hvg, lines, metacells, neighbours
from screenspark.plans.catalog import CTRL_ON, DENSE, KNN, VLONG, query, r6
from screenspark.sources import fixtures as fx
from screenspark.sources.fixtures import COARSE, FINE, SPEC, VECTORS

SIZE = 64
HALF = 1 / np.sqrt(2)


def axes(*rows: dict[int, float]) -> np.ndarray:
    """Unit vectors, each by its few components that aren't 0."""
    out = np.zeros((len(rows), SIZE))
    for i, row in enumerate(rows):
        for j, x in row.items():
            out[i, j] = x
    return out


#: Components and directions that SQL can state.
GIVEN = axes({0: 1.0}, {1: HALF, 2: HALF}, {3: HALF, 4: -HALF})
DIRECTIONS = GIVEN[:2]


def basis_of(components: np.ndarray, mean: np.ndarray | None = None) -> embed.Basis:
    return embed.Basis([str(i) for i in range(SIZE)], components, np.zeros(SIZE) if mean is None else mean, np.ones(len(components)) / len(components))


def given_model(spark, d, mode: str, k: int) -> tuple:
    """A model with the vectors themselves as components; and the vectors."""
    v, basis = fx.vectors(spark, d), basis_of(np.eye(SIZE))
    controls = embed.project_dense(v.filter("is_control"), basis).select("cell_id", "v", "pcs")
    return counterfactual.DeltaModel(replace(SPEC, mode=mode, neighbours=k, metric="euclidean"), basis, DIRECTIONS, controls), v


def long(rows, column: str, *keep: str):
    out = rows.select(*keep, F.posexplode(column).alias("p", "x"))
    return out.select(*keep, (F.col("p") + 1).alias("i"), r6("x", column))


# ---------------------------------------------------------------- variable genes, embeddings

@query("n04_clipped_variance", f"""{FINE}{DENSE}, mo AS (SELECT gene_name, COUNT(*) AS n, AVG(value) AS m, 1.2 * SQRT(AVG(value)) AS sd FROM grid GROUP BY 1)
SELECT gene_name, ROUND(CASE WHEN MAX(sd) > 0 THEN SUM(POWER(LEAST(value, m + sd * SQRT(n)) - m, 2)) / ((MAX(n) - 1) * MAX(sd) * MAX(sd)) ELSE 0 END, 6) AS score FROM grid JOIN mo USING (gene_name) GROUP BY 1""")
def n04_clipped(spark, d):
    m = fx.fine(spark, d)
    return hvg.clipped_variance(m, hvg.moments(m).withColumn("sd", 1.2 * F.sqrt("mean"))).select("gene_name", r6("score"))


@query("n05_norms", f"{COARSE} SELECT cell_id, ROUND(COALESCE(SUM(value * value), 0), 3) AS squares FROM obs LEFT JOIN x USING (cell_id) GROUP BY 1")
def n05_norms(spark, d):
    """With all components the scores are the counts, turned."""
    m = fx.coarse(spark, d)
    scores = embed.project_sparse(m, embed.truncated_svd(m, 1000))
    return scores.select("cell_id", F.round(F.expr("aggregate(v, 0D, (s, x) -> s + x * x)"), 3).alias("squares"))


STRENGTH = "EXP(CASE WHEN pert = 'non-targeting' THEN 1 ELSE CAST(SUBSTR(pert, 7) AS INT) END / 10.0)"


@query("n05_scores", f"""{COARSE}, e AS (SELECT cell_id, pert, {STRENGTH} AS value FROM obs), s AS (SELECT pert, ROW_NUMBER() OVER (ORDER BY SUM(value * value) DESC) AS component FROM e GROUP BY 1)
SELECT cell_id, CAST(i AS INT) AS i, ROUND(CASE WHEN component = i THEN value ELSE 0 END, 6) AS score FROM e JOIN s USING (pert), (SELECT UNNEST(generate_series(1, 5)) AS i)""")
def n05_scores(spark, d):
    """Cells that store one gene each: the components are the genes, by their squares, and a rotation of them is seen."""
    obs = fx.coarse(spark, d).obs
    x = obs.select("cell_id", F.col("pert").alias("gene_name"), F.expr(STRENGTH).cast("double").alias("value"))
    m = CountMatrix(obs, x.select("gene_name").distinct(), x)
    scores = embed.project_sparse(m, embed.truncated_svd(m, 5)).withColumn("score", F.expr("transform(v, x -> abs(x))"))
    return long(scores, "score", "cell_id")


@query("n05_variance", "SELECT CAST(i AS INT) AS component, TRUE AS explained, TRUE AS in_order FROM (SELECT UNNEST(generate_series(0, 24)) AS i)")
def n05_variance(spark, d):
    """A component explains the share of all squares that its scores have, no less than the next."""
    m = fx.coarse(spark, d)
    basis = embed.truncated_svd(m, 25)
    scores = embed.project_sparse(m, basis).select(F.posexplode("v").alias("component", "x")).groupBy("component").agg(F.sum(F.col("x") * F.col("x")).alias("s"))
    shares = spark.createDataFrame([(i, float(s), bool(i == 0 or basis.variance_ratio[i - 1] >= s)) for i, s in enumerate(basis.variance_ratio)], "component int, share double, in_order boolean")
    total = m.x.agg(F.sum(F.col("value") * F.col("value")).alias("total"))
    rows = scores.join(shares, "component").crossJoin(F.broadcast(total))
    return rows.select("component", (F.abs(F.col("s") / F.col("total") - F.col("share")) < 1e-9).alias("explained"), "in_order")


@query("n06_single_batch", f"{VLONG} SELECT cell_id, CAST(i AS INT) AS i, ROUND(x, 6) AS corrected FROM lv")
def n06_single(spark, d):
    return long(batch.harmony(fx.vectors(spark, d).withColumn("batch", F.lit(1)), rounds=3), "corrected", "cell_id")


@query("n06_batches_meet", "SELECT TRUE AS nearer, COUNT(*) AS n FROM embeddings")
def n06_meet(spark, d):
    """A shift that was added to one batch is mostly gone, and every cell is still there."""
    shifted = fx.vectors(spark, d).withColumn("v", F.expr("transform(v, (x, i) -> x + if(batch = 1 AND i < 4, 6, 0))"))
    fixed = batch.harmony(shifted, clusters=3, rounds=7)
    means = [F.abs(F.avg(F.when(F.col("batch") == 1, F.col(c)[0])) - F.avg(F.when(F.col("batch") != 1, F.col(c)[0]))).alias(c) for c in ("v", "corrected")]
    return fixed.agg(*means, F.count("*").alias("n")).select((F.col("corrected") < 0.5 * F.col("v")).alias("nearer"), "n")


#: Weights by batch (vec_id % 4) and cluster that SQL can state; a wide sigma, so that all clusters share.
WIDE = 0.5
TILTED = np.array([[1 + ((b + k) % 3) / 2 for k in range(3)] for b in range(4)])
SHARED = f"""{VLONG}, nn AS (SELECT cell_id, SQRT(SUM(x * x)) AS n FROM lv GROUP BY 1),
c AS (SELECT cell_id, batch, (v[1]) / n AS c0, (v[2] + v[3]) * SQRT(0.5) / n AS c1, (v[4] - v[5]) * SQRT(0.5) / n AS c2 FROM emb JOIN nn USING (cell_id)),
e AS (SELECT cell_id, batch, UNNEST([0, 1, 2]) AS k, UNNEST([EXP(2 * (c0 - 1) / 0.5), EXP(2 * (c1 - 1) / 0.5), EXP(2 * (c2 - 1) / 0.5)]) AS w FROM c),
f AS (SELECT cell_id, batch, k, w * (1 + ((batch + k) % 3) / 2.0) AS w FROM e),
r AS (SELECT cell_id, batch, k, w / SUM(w) OVER (PARTITION BY cell_id) AS r FROM f), o AS (SELECT batch, k, SUM(r) AS o FROM r GROUP BY 1, 2)"""


def one_round(spark, d):
    """Vectors, and their tally by given centres and weights in one block."""
    v = fx.vectors(spark, d)
    cells = v.select(F.lit(0).alias("block"), F.col("batch").cast("int").alias("code"), "v", F.col("v").alias("fixed"))
    return v, batch.tally(cells, GIVEN, TILTED[None], WIDE)


@query("n06_weights", f"""{SHARED}, p AS (SELECT batch, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM emb GROUP BY 1), t AS (SELECT k, SUM(o) AS t FROM o GROUP BY 1)
SELECT batch, k, ROUND(o, 6) AS members, ROUND(POWER((share * t + 1) / (o + 1), 2), 6) AS weight FROM o JOIN p USING (batch) JOIN t USING (k)""")
def n06_weights(spark, d):
    """Counts by batch and cluster of given centres and weights, and the weights that follow."""
    v, found = one_round(spark, d)
    sizes = np.array([r["count"] for r in v.groupBy("batch").count().orderBy("batch").collect()], dtype=float)
    weight = batch.weights_of(found.counts[0], sizes / sizes.sum(), 2.0)
    rows = [(b, k, round(float(found.counts[0, b, k]), 6), round(float(weight[b, k]), 6)) for b in range(4) for k in range(3)]
    return spark.createDataFrame(rows, "batch bigint, k int, members double, weight double")


@query("n06_correction", f"""{SHARED}, q AS (SELECT lv.batch, k, i, SUM(r * x) AS s FROM lv JOIN r USING (cell_id) GROUP BY 1, 2, 3),
a AS (SELECT k, i, SUM(s / (o + 1)) / SUM(o / (o + 1)) AS a FROM q JOIN o USING (batch, k) GROUP BY 1, 2),
z AS (SELECT batch, k, i, (s - o * a) / (o + 1) AS z FROM q JOIN o USING (batch, k) JOIN a USING (k, i))
SELECT lv.cell_id, CAST(lv.i AS INT) AS i, ROUND(MAX(x) - SUM(r * z), 6) AS corrected FROM lv JOIN r ON r.cell_id = lv.cell_id JOIN z ON z.batch = lv.batch AND z.k = r.k AND z.i = lv.i GROUP BY 1, 2""")
def n06_correction(spark, d):
    """One round of correction by given centres and weights."""
    v, found = one_round(spark, d)
    done = batch.Round(GIVEN, TILTED[None], batch.shifts(found.counts[0], found.raw[0], 1.0))
    return long(batch.apply(v, batch.HarmonyModel(("0", "1", "2", "3"), 1, WIDE, (done,))), "corrected", "cell_id")


@query("n15_norms", f"{VLONG}, mu AS (SELECT i, AVG(x) AS m FROM lv WHERE batch <> 3 GROUP BY 1) SELECT cell_id, ROUND(SUM((x - m) * (x - m)), 5) AS squares FROM lv JOIN mu USING (i) GROUP BY 1")
def n15_norms(spark, d):
    """With all components the scores are the centred vectors, turned; also of cells not fitted on."""
    v = fx.vectors(spark, d)
    scores = embed.project_dense(v, embed.pca(v.filter("batch <> 3"), SIZE))
    return scores.select("cell_id", F.round(F.expr("aggregate(pcs, 0D, (s, x) -> s + x * x)"), 5).alias("squares"))


@query("n15_variance", f"{VLONG}, mu AS (SELECT i, VAR_POP(x) AS s FROM lv WHERE batch <> 3 GROUP BY 1) SELECT ROUND(SUM(s), 5) AS total, TRUE AS explained, TRUE AS in_order, TRUE AS uncorrelated FROM mu")
def n15_variance(spark, d):
    train = fx.vectors(spark, d).filter("batch <> 3")
    basis = embed.pca(train, SIZE)
    scores = embed.project_dense(train, basis)
    found = scores.select(F.posexplode("pcs").alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("s"))
    shares = spark.createDataFrame([(i, float(s)) for i, s in enumerate(basis.variance_ratio)], "i int, share double")
    total = found.agg(F.sum("s").alias("total"))
    rows = found.join(shares, "i").crossJoin(F.broadcast(total))
    one = scores.agg(F.abs(F.corr(F.col("pcs")[0], F.col("pcs")[1])).alias("r"))
    checks = rows.agg(F.round(F.first("total"), 5).alias("total"), F.bool_and(F.abs(F.col("s") / F.col("total") - F.col("share")) < 1e-9).alias("explained"))
    return checks.crossJoin(one).select("total", "explained", F.lit(bool((np.diff(basis.variance_ratio) <= 1e-12).all())).alias("in_order"), (F.col("r") < 1e-9).alias("uncorrelated"))


@query("n16_projection", f"""{VLONG}, mu AS (SELECT i, AVG(x) AS m FROM lv WHERE batch <> 3 GROUP BY 1), c AS (SELECT cell_id, i, x - m AS x FROM lv JOIN mu USING (i))
SELECT cell_id, ROUND(SUM(CASE WHEN i = 1 THEN x END), 6) AS p0, ROUND(SUM(CASE WHEN i IN (2, 3) THEN x END) / SQRT(2), 6) AS p1, ROUND(SUM(CASE i WHEN 4 THEN x WHEN 5 THEN -x END) / SQRT(2), 6) AS p2 FROM c GROUP BY 1""")
def n16(spark, d):
    """Cells of any split on given components, less the mean of the training split."""
    v = fx.vectors(spark, d)
    mean = embed.pca(v.filter("batch <> 3"), 1).mean
    scores = embed.project_dense(v, basis_of(GIVEN, mean))
    return scores.select("cell_id", *[F.round(F.col("pcs")[i], 6).alias(f"p{i}") for i in range(3)])


# ---------------------------------------------------------------- doublets, lines, metacells

PAIRED = """, rk AS (SELECT cell_id, ROW_NUMBER() OVER (ORDER BY md5('42:' || cell_id), cell_id) AS a0, ROW_NUMBER() OVER (ORDER BY md5('43:' || cell_id), cell_id) AS b0,
ROW_NUMBER() OVER (ORDER BY md5('44:' || cell_id), cell_id) AS a1, ROW_NUMBER() OVER (ORDER BY md5('45:' || cell_id), cell_id) AS b1 FROM obs),
mk AS (SELECT -(a0 * 2) AS made, cell_id FROM rk UNION ALL SELECT -(b0 * 2), cell_id FROM rk UNION ALL SELECT -(a1 * 2 + 1), cell_id FROM rk UNION ALL SELECT -(b1 * 2 + 1), cell_id FROM rk)"""


@query("n07_simulated", f"{COARSE}{PAIRED} SELECT made AS cell_id, gene_name, SUM(value) AS value FROM mk JOIN x USING (cell_id) GROUP BY 1, 2")
def n07_simulated(spark, d):
    return doublets.simulate(fx.coarse(spark, d), 2, 42).x.select("cell_id", "gene_name", "value")


MIXED = """WITH e AS (SELECT CASE WHEN vec_id % 3 = 0 THEN -vec_id - 1 ELSE vec_id END AS cell_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
nn AS (SELECT a.cell_id, b.cell_id AS neighbour, ROW_NUMBER() OVER (PARTITION BY a.cell_id ORDER BY list_distance(a.v, b.v), b.cell_id) AS rn FROM e a JOIN e b ON a.cell_id <> b.cell_id)"""


@query("n07_scores", f"""{MIXED}, q AS (SELECT cell_id, (COUNT_IF(neighbour < 0) + 1) / 12.0 AS q FROM nn WHERE rn <= 10 GROUP BY 1)
SELECT cell_id, ROUND(q * 0.06 / 2 / (1 - 0.06 - q * (1 - 0.06 - 0.06 / 2)), 6) AS doublet_score FROM q""")
def n07_scores(spark, d):
    """Scores by the share of made cells (here every third) among the nearest ten."""
    v = fx.vectors(spark, d).select(F.expr("if(cell_id % 3 = 0, -cell_id - 1, cell_id)").alias("cell_id"), "v")
    return doublets.scores_of(neighbours.nearest(v, v, 10, exclude_self=True), 10, 0.06, 2.0).select("cell_id", r6("doublet_score"))


@query("n08_regression", f"""{KNN.format(on="q.batch = 1 AND c.batch <> 1", k=15)} SELECT cell_id, ROUND(AVG((neighbour % 13) / 13), 6) AS doublet_score FROM near GROUP BY 1""")
def n08(spark, d):
    """Cells that weren't scored take the mean of their 15 nearest scored ones."""
    v = fx.vectors(spark, d)
    seen = v.filter("batch <> 1")
    scores = seen.select("cell_id", (F.col("cell_id") % 13 / 13).alias("doublet_score"))
    return neighbours.regress(neighbours.nearest(v.filter("batch = 1"), seen, 15), scores, "doublet_score").select("cell_id", r6("doublet_score"))


def three_lines(spark, d):
    """The vectors, a third each moved far along another axis."""
    return fx.vectors(spark, d).withColumn("v", F.expr("transform(v, (x, i) -> x + if(cell_id % 3 = i, 60, 0))"))


@query("n09_planted_lines", "SELECT vec_id % 3 AS planted, 1 AS n_lines, COUNT(*) AS n_cells, 3 AS all_lines FROM embeddings GROUP BY 1")
def n09_planted(spark, d):
    v = three_lines(spark, d)
    found = lines.assign_lines(v.select("cell_id"), v, k=3).withColumn("planted", F.col("cell_id") % 3)
    every = found.agg(F.count_distinct("line").cast("int").alias("all_lines"))
    return found.groupBy("planted").agg(F.count_distinct("line").cast("int").alias("n_lines"), F.count("*").alias("n_cells")).crossJoin(F.broadcast(every))


@query("n10_planted_k", "SELECT CAST(COUNT(DISTINCT vec_id % 3) AS INT) AS k FROM embeddings")
def n10_planted(spark, d):
    return spark.createDataFrame([(lines.estimate_lines(three_lines(spark, d)),)], "k int")


@query("n13_sizes", f"""{VECTORS}, z AS (SELECT cell_line, pert, COUNT(*) AS n_cells FROM emb GROUP BY 1, 2)
SELECT cell_line, pert, n_cells, CASE WHEN n_cells < 30 THEN 1 END AS n_metacells, TRUE AS within FROM z""")
def n13_sizes(spark, d):
    """Every cell is in one metacell, a small group is one, no group has more than its graining."""
    found = metacells.cluster_metacells(fx.vectors(spark, d), "cell_line", "pert")
    sizes = found.groupBy("cell_line", "pert").agg(F.count("*").alias("n_cells"), F.count_distinct("metacell").alias("k"), F.count_distinct("cell_id").alias("cells"))
    within = (F.col("k") <= metacells.metacell_count("n_cells")) & (F.col("cells") == F.col("n_cells"))
    return sizes.select("cell_line", "pert", "n_cells", F.when(F.col("n_cells") < 30, F.col("k").cast("int")).alias("n_metacells"), within.alias("within"))


# ---------------------------------------------------------------- counterfactuals

@query("n17_systematic", f"""{VLONG}, df AS (SELECT i, AVG(CASE WHEN NOT is_control THEN x END) - AVG(CASE WHEN is_control THEN x END) AS dd FROM lv GROUP BY 1),
c AS (SELECT i, ABS(dd) / (SELECT SQRT(SUM(dd * dd)) FROM df) AS c FROM df)
SELECT 'above' AS rule, CAST(i - 1 AS INT) AS pc FROM c WHERE c > 0.12 UNION ALL SELECT 'nearest', CAST(i - 1 AS INT) FROM c WHERE c = (SELECT MAX(c) FROM c) AND c > 0.2""")
def n17(spark, d):
    """Components along the axes, by two thresholds; with the second none is above."""
    shift = counterfactual.effect(fx.vectors(spark, d))
    rows = [(rule, pc) for rule, least in (("above", 0.12), ("nearest", 0.999)) for pc in counterfactual.systematic(np.eye(SIZE), shift, least)]
    return spark.createDataFrame(rows, "rule string, pc int")


WITHOUT = """, w AS (SELECT cell_id, is_control, i, x, CASE WHEN i = 1 THEN 0 WHEN i IN (2, 3) THEN x - (SUM(CASE WHEN i IN (2, 3) THEN x END) OVER (PARTITION BY cell_id)) / 2 ELSE x END AS y FROM lv)"""
LONG = VLONG.removeprefix(VECTORS)
ALL_ON = "c.is_control AND q.cell_id <> c.cell_id"


@query("n20_control_deltas", f"""{KNN.format(on=CTRL_ON, k=3)}{LONG}, ba AS (SELECT n.cell_id, i, AVG(x) AS b FROM near n JOIN lv ON lv.cell_id = n.neighbour GROUP BY 1, 2)
SELECT cell_id, CAST(i AS INT) AS i, ROUND(x - b, 6) AS delta FROM ba JOIN lv USING (cell_id, i)""")
def n20(spark, d):
    """Controls against the other controls."""
    model, v = given_model(spark, d, "knn", 3)
    return long(model.transform(v.filter("is_control")), "delta", "cell_id")


@query("n21_hybrid_given", f"""{KNN.format(on=ALL_ON, k=5)}{LONG}{WITHOUT}, ba AS (SELECT n.cell_id, i, AVG(y) AS b FROM near n JOIN w ON w.cell_id = n.neighbour GROUP BY 1, 2)
SELECT cell_id, CAST(i AS INT) AS i, ROUND(y - b, 6) AS delta FROM ba JOIN w USING (cell_id, i)""")
def n21_given(spark, d):
    model, v = given_model(spark, d, "hybrid", 5)
    return long(model.transform(v), "delta", "cell_id")


@query("n22_pc_decomposition", f"{VLONG}{WITHOUT} SELECT cell_id, CAST(i AS INT) AS i, ROUND(CASE WHEN is_control THEN 0 ELSE y END, 6) AS delta FROM w")
def n22(spark, d):
    model, v = given_model(spark, d, "pc_decomposition", 1)
    return long(model.transform(v), "delta", "cell_id")


@query("n23_layers", f"""{KNN.format(on=ALL_ON, k=5)}{LONG}, ba AS (SELECT n.cell_id, i, AVG(x) AS b FROM near n JOIN lv ON lv.cell_id = n.neighbour GROUP BY 1, 2)
SELECT cell_id, is_control, ROUND(SUM(x), 6) AS pre, ROUND(SUM(b), 6) AS basal, ROUND(SUM(x - b), 6) AS delta FROM ba JOIN lv USING (cell_id, i) GROUP BY 1, 2""")
def n23(spark, d):
    model, v = given_model(spark, d, "knn", 5)
    return model.transform(v).select("cell_id", "is_control", *[F.round(F.expr(f"aggregate({c}, 0D, (s, x) -> s + x)"), 6).alias(c) for c in ("pre", "basal", "delta")])


@query("n33_fit_all", f"""{KNN.format(on="c.is_control AND c.batch <> 3 AND q.cell_id <> c.cell_id", k=5)}{LONG}, ba AS (SELECT n.cell_id, i, AVG(x) AS b FROM near n JOIN lv ON lv.cell_id = n.neighbour GROUP BY 1, 2)
SELECT CASE WHEN batch = 3 THEN 'other' ELSE 'train' END AS split, cell_id, ROUND(SUM(x - b), 5) AS total, ROUND(SUM((x - b) * (x - b)), 5) AS squares FROM ba JOIN lv USING (cell_id, i) GROUP BY 1, 2""")
def n33(spark, d):
    """Fitted on one split; as all components are kept, neighbours are those of the vectors."""
    v = fx.vectors(spark, d)
    found = counterfactual.fit_and_transform(v.filter("batch <> 3"), {"other": v.filter("batch = 3")}, replace(SPEC, n_pcs=SIZE, neighbours=5))
    sums = [F.round(F.expr(f"aggregate(delta, 0D, (s, x) -> s + {x})"), 5).alias(n) for n, x in (("total", "x"), ("squares", "x * x"))]
    rows = [frame.select(F.lit(split).alias("split"), "cell_id", *sums) for split, frame in found.items()]
    return rows[0].unionByName(rows[1])


@query("n24_knn_grid", f"""{KNN.format(on="NOT q.is_control AND c.is_control", k=20)}{LONG}, ks AS (SELECT 5 AS k UNION ALL SELECT 20),
ba AS (SELECT k, n.cell_id, i, AVG(x) AS b FROM near n JOIN ks ON rn <= k JOIN lv ON lv.cell_id = n.neighbour GROUP BY 1, 2, 3), dl AS (SELECT k, cell_id, i, x, x - b AS delta FROM ba JOIN lv USING (cell_id, i)),
r AS (SELECT k, i, RANK() OVER (PARTITION BY k, i ORDER BY x) + (COUNT(*) OVER (PARTITION BY k, i, x) - 1) / 2 AS a, RANK() OVER (PARTITION BY k, i ORDER BY delta) + (COUNT(*) OVER (PARTITION BY k, i, delta) - 1) / 2 AS b FROM dl),
rp AS (SELECT k, AVG(rho) AS rp FROM (SELECT k, i, CORR(a, b) AS rho FROM r GROUP BY 1, 2) GROUP BY 1), st AS (SELECT k, 1 / (STDDEV_POP(l) + 1e-6) AS st FROM (SELECT k, cell_id, SQRT(SUM(delta * delta)) AS l FROM dl GROUP BY 1, 2) GROUP BY 1),
o AS (SELECT cell_id, ROW_NUMBER() OVER (ORDER BY cell_id) - 1 AS j, COUNT(*) OVER () // 2 AS h FROM emb WHERE NOT is_control), pr AS (SELECT a.cell_id AS a, b.cell_id AS b FROM o a JOIN o b ON b.j = a.j + a.h WHERE a.j < LEAST(a.h, 500)),
cs AS (SELECT p.k, pr.a, 1 - SUM(p.x * q.x) / (SQRT(SUM(p.x * p.x)) * SQRT(SUM(q.x * q.x))) AS pre, 1 - SUM(p.delta * q.delta) / (SQRT(SUM(p.delta * p.delta)) * SQRT(SUM(q.delta * q.delta))) AS post FROM pr JOIN dl p ON p.cell_id = pr.a JOIN dl q ON q.cell_id = pr.b AND q.i = p.i AND q.k = p.k GROUP BY 1, 2, pr.b),
dc AS (SELECT k, 1 / (1 + ABS(AVG(post) / (AVG(pre) + 1e-10) - 1)) AS dc FROM cs GROUP BY 1)
SELECT 'knn:' || k || ':64:euclidean' AS point, ROUND(rp, 6) AS rank_preservation, ROUND(dc, 6) AS discrimination, ROUND(st, 6) AS stability FROM rp JOIN st USING (k) JOIN dc USING (k)""")
def n24_grid(spark, d):
    """A sweep whose sample is every perturbed cell and whose components are all."""
    spec = replace(SPEC, mode="knn", neighbour_grid=(5, 20))
    found = calibrate.sweep(fx.vectors(spark, d), spec, n_pcs=(SIZE,), metrics=("euclidean",), cells=None)
    return found.select("point", r6("rank_preservation"), r6("discrimination"), r6("stability"))
