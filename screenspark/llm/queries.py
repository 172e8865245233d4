"""The operators, bound to the test tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenspark.llm import bpe, copies, decontaminate, jaccard, langid, licenses, near_vectors, pii, prefix_trie, quality, secrets, warc
from screenspark.llm.common import Scratch, bucket_of, table


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"), pii.train())


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark) as tmp:
        path = tmp.path("archives")
        warc.write_archives(table(spark, sf_dir, "pages"), path)
        return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and item that occurs in it."""
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.item_id", "hit.edits")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumn("held_out", bucket_of("doc_id", 4) == 2).select("doc_id", "held_out", "score", "predicted")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs, langid.fit(docs))
    return found.withColumn("held_out", bucket_of("doc_id", 5) == 0).select("doc_id", "held_out", "lang_pred", "score")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The turns of every conversation c: the first h of conversation c - c % 5, then its
    own after its first h, where h is crc32(c as text) % 9; and one row for c itself."""
    h = bucket_of("conv_id", 9)
    whole = turns.filter("pos = 0").select("conv_id")
    place = F.struct(F.lit(1).alias("part"), "pos").alias("place")
    own = turns.filter((F.col("conv_id") % 5 == 0) | (F.col("pos") >= h)).select("conv_id", place, "label", "bytes")
    lent = turns.filter("conv_id % 5 = 0 AND pos < 8").withColumn("step", F.explode(F.array(*(F.lit(k) for k in range(-4, 5) if k))))
    lent = lent.select("conv_id", (F.col("conv_id") + F.col("step")).alias("to"), "pos", "label", "bytes").filter("to - to % 5 = conv_id").filter(F.col("pos") < bucket_of("to", 9))
    lent = lent.join(whole.withColumnRenamed("conv_id", "to"), "to", "left_semi").select(F.col("to").alias("conv_id"), F.struct(F.lit(0).alias("part"), "pos").alias("place"), "label", "bytes")
    bare = whole.select("conv_id", F.lit(None).cast(own.schema["place"].dataType).alias("place"), F.lit(b"").alias("label"), F.lit(0).cast("bigint").alias("bytes"))
    return bare.unionByName(own).unionByName(lent)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark) as tmp:
        turns = tmp.stored(prefix_trie.ranked_turns(table(spark, sf_dir, "conversations")), "turns")
        return prefix_trie.prefix_nodes(rebuilt(turns))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.find_copies(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        "op1_near_vectors": op1_near_vectors,
        "op2_bpe": op2_bpe,
        "op3_secrets": op3_secrets,
        "op4_licenses": op4_licenses,
        "op5_pii": op5_pii,
        "op6_warc": op6_warc,
        "op7_decontaminate": op7_decontaminate,
        "op8_quality": op8_quality,
        "op9_jaccard": op9_jaccard,
        "op10_langid": op10_langid,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_exact_dedup": op12_exact_dedup,
    }


OP1_SQL = """WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ln AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id, vec_id AS c FROM e UNION SELECT ln.b, reach.c FROM reach JOIN ln ON ln.a = reach.vec_id),
comp AS (SELECT vec_id, MIN(c) AS component_id FROM reach GROUP BY 1), cnt AS (SELECT a, COUNT(*) AS n FROM ln GROUP BY 1)
SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM comp LEFT JOIN cnt ON a = vec_id"""

OP6_SQL = """WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages), d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN MIN(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""

OP9_SQL = """WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, UNNEST(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w)),
n AS (SELECT doc_id, COUNT(*) AS n FROM sh GROUP BY 1), pr AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
ln AS (SELECT a, b FROM pr JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT ln.b, reach.c FROM reach JOIN ln ON ln.a = reach.doc_id)
SELECT doc_id, COALESCE(n, 0) AS n_shingles, component_id FROM (SELECT doc_id, MIN(c) AS component_id FROM reach GROUP BY 1) LEFT JOIN n USING (doc_id)"""

OP11_SQL = """WITH t AS (SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, xor(list_reduce(list_transform(range(1, len(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT)), lambda acc, x: list_reduce(CAST(range(8) AS BIGINT[]), lambda a, y: xor(a >> 1, 3988292384 * (a & 1)), xor(acc, x)), CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t)),
r AS (SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND pos < h UNION ALL SELECT conv_id, 1, pos, role, text FROM t JOIN c USING (conv_id) WHERE pos >= h),
l AS (SELECT conv_id, COALESCE(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS turns FROM c LEFT JOIN r USING (conv_id) GROUP BY 1),
p AS (SELECT conv_id, d, turns[1:d] AS k, d = len(turns) AS ends FROM (SELECT conv_id, turns, UNNEST(range(0, len(turns) + 1)) AS d FROM l)),
n AS (SELECT d, k, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY 1, 2),
ch AS (SELECT d - 1 AS d, k[1:d - 1] AS k, COUNT(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
w AS (SELECT n.*, COALESCE(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(k[d].text) END AS own FROM n LEFT JOIN ch USING (d, k)),
s AS (SELECT e AS d, k[1:e] AS k, CAST(SUM(own) AS BIGINT) AS saved_tokens, COUNT(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT k, own, n_children, UNNEST(range(0, d + 1)) AS e FROM w) GROUP BY 1, 2)
SELECT w.conv_id, w.d AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256 FROM w JOIN s USING (d, k) LEFT JOIN n u ON u.d = w.d - 1 AND u.k = w.k[1:w.d - 1]"""

OP12_SQL = """WITH d AS (SELECT doc_id, translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, MAX(doc_id) OVER (PARTITION BY t) AS keep_id, COUNT(*) OVER (PARTITION BY t) AS group_size, ROW_NUMBER() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM d"""


def oracle_sql() -> dict:
    """SQL for the operators that it can express; the others are tested by brute force."""
    return {"op1_near_vectors": OP1_SQL, "op6_warc": OP6_SQL, "op9_jaccard": OP9_SQL, "op11_prefix_trie": OP11_SQL, "op12_exact_dedup": OP12_SQL}
