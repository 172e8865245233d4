"""Exact duplicates of texts: a Bloom filter of what may repeat, then groups of only that.

The first pass hashes every text and counts, over the cluster, how many rows hit each cell
of a Bloom filter; cells that one row alone hits are no part of it.  A repeated hash hits
all its cells twice, so the filter has no false negatives.  The second pass holds each row
against the filter: rows whose cells are not all in it repeat nowhere and pass straight
through; the others, the true repeats and some false ones, are shuffled by the SHA-256 of
their normalised text and grouped.  The result is exact whatever the filter holds; its
size only settles how many rows are shuffled in vain.

All of this is DataFrame functions.  The cells of a hash lie in one 64-bit word, so one
join on the word number tests a row.  The filter is broadcast while it has at most
``MOST_WORDS`` words, which bounds it to some 100 MB in an executor; beyond that the
narrow rows of ``find_copies`` meet it by a shuffle of their hashes.  A group may hold
any share of the rows: counts and the row that stays are combined before the shuffle,
and the rows get them back by a join of two plain shuffles, which Spark splits where a
key is hot.

Texts are equal when identical after lower-casing A-Z only; null counts as empty, so
null and empty texts are one group.  Of equal texts the row with the largest id stays;
a null id is smaller than any other, and of rows that repeat the largest id one stays.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenspark.llm.common import Scratch, stored

#: Bits of the filter for each row, and cells that a hash has in its word.
BITS_PER_ROW, CELLS = 16, 3
#: Most 64-bit words of a filter that is broadcast.
MOST_WORDS = 1 << 21


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case; a null text is empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def hashed(docs: DataFrame, id_column: str, text_column: str, carry: list[str]) -> DataFrame:
    """row (the carried columns), id, sha and a 64-bit hash ``h`` of each row of ``docs``."""
    row = F.struct(*(docs[c] for c in carry))
    shas = docs.select(row.alias("row"), docs[id_column].alias("id"), F.unhex(F.sha2(normalised(docs[text_column]), 256)).alias("sha"))
    return shas.withColumn("h", F.xxhash64("sha"))


def word_of(words: int) -> Column:
    """The number of a hash's word, from its lower 40 bits."""
    return F.col("h").bitwiseAND(F.lit(words - 1)).alias("word")


def cells() -> Column:
    """The cells of a hash in its word, from its upper 18 bits."""
    return F.array_distinct(F.array(*(F.shiftrightunsigned("h", 46 + 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(CELLS))))


def mask_of(cell_array: Column) -> Column:
    return F.aggregate(cell_array, F.lit(0).cast("bigint"), lambda m, c: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), c)))


def words_for(rows: int) -> int:
    """Words of the filter for so many rows, a power of two below 2^40."""
    return 1 << min(40, max(0, (rows * BITS_PER_ROW // 64).bit_length()))


def repeat_filter(hashes: DataFrame, words: int) -> DataFrame:
    """(word, bits): the cells that two rows or more hit, without words that have none."""
    hits = hashes.select(word_of(words), F.explode(cells()).alias("cell")).groupBy("word", "cell").agg(F.count("*").alias("n"))
    return hits.filter("n > 1").groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, cell)")).alias("bits"))


def tested(rows: DataFrame, bloom: DataFrame, words: int, broadcast: bool) -> DataFrame:
    """``rows`` with ``maybe``: whether all cells of their hash are in the filter."""
    mask = mask_of(cells())
    probed = rows.withColumn("word", word_of(words)).withColumn("mask", mask)
    met = probed.join(F.broadcast(bloom) if broadcast else bloom, "word", "left")
    return met.withColumn("maybe", F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))).drop("word", "mask", "bits")


def marked(rows: DataFrame, hashes: DataFrame, tmp: Scratch, most_words: int = MOST_WORDS) -> DataFrame:
    """row, keep_id, group_size, kept and sha of each of ``rows``, which ``hashed`` made.

    ``hashes`` has their column ``h``.  The tables that the result reads belong to ``tmp``.
    """
    words = words_for(hashes.count())
    bloom = tmp.stored(repeat_filter(hashes, words), "repeat-filter")
    met = tested(rows, bloom, words, broadcast=bloom.count() <= most_words)
    alone = met.filter("NOT maybe").select("row", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "sha")
    flagged = tmp.stored(met.filter("maybe").select("row", "id", "sha", F.monotonically_increasing_id().alias("tag")), "maybe-repeated")
    groups = flagged.groupBy("sha").agg(F.count("*").alias("n"), F.max(F.struct("id", "tag")).alias("keep")).filter("n > 1")
    found = flagged.join(tmp.stored(groups, "copy-groups"), "sha", "left")
    alike = found.select(
        "row", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"), F.coalesce("n", F.lit(1)).alias("group_size"),
        (F.col("n").isNull() | F.col("keep").eqNullSafe(F.struct("id", "tag"))).alias("kept"), "sha",
    )
    return alone.unionByName(alike)


def find_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, keep_id (id of the row that stays), group_size,
    kept and text_sha256 (lowercase hex of the normalised text in UTF-8).

    The texts are read once; hashes and ids go through a table in the shared folder.  The
    result is a table there too, which stays.  Columns beside id and text count for nothing.
    """
    with Scratch(docs.sparkSession) as tmp:
        rows = tmp.stored(hashed(docs, id_column, text_column, [id_column]), "text-hashes")
        found = marked(rows, rows.select("h"), tmp)
        sha = F.lower(F.hex("sha")).alias("text_sha256")
        return stored(found.select(F.col("row").getField(id_column).alias(id_column), "keep_id", "group_size", "kept", sha), "copies")


def drop_copies(docs: DataFrame, tmp: Scratch, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, whole and with all their columns, that stay.

    Only rows that may repeat are shuffled; all others go from the scan to the result.  The
    texts are read again for that, once for each side.  The tables that the result reads
    belong to ``tmp``.
    """
    rows = hashed(docs, id_column, text_column, docs.columns)
    found = marked(rows, tmp.stored(rows.select("h"), "text-hashes"), tmp)
    return found.filter("kept").select("row.*")
