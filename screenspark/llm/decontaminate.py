"""Operator 7: benchmark decontamination by pigeonhole edit matching.

An item of the benchmark occurs in a document if some stretch of it differs by at most
k edits, k a share of the item's length.  The item is split into k+1 pieces; k edits
can't touch all of them, so one stands in the stretch unchanged.  An Aho-Corasick
automaton finds the pieces in each whole document; around each find the item is
verified by Myers' bit-parallel distance.  Texts are compared as their words in small
letters, with single spaces between, before and after them: so an item that starts or ends
inside a word of the document has that border as an edit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from screenspark.llm.common import Scratch, map_batches, stored

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class EditMatch:
    """``share`` of an item's characters may be edited, rounded down.  The items go to the
    tasks in blocks of at most ``block_chars`` characters, or of one item, so what is
    broadcast is bounded; a larger benchmark takes as many passes, one after the other."""

    share: float = 0.05
    block_chars: int = 4_000_000


def normalised(text: str | None) -> str:
    words = " ".join(WORD.findall((text or "").lower()))
    return f" {words} " if words else ""


def budget_of(item: str, rule: EditMatch) -> int:
    """The edits that a normalised item may have."""
    return int((len(item) - 2) * rule.share)


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece) of budget+1 pieces of nearly equal length."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, budget: int) -> tuple[int, int] | None:
    """(edits, end) of the best place of the pattern in the text, if within budget.

    Columns of the distance table are kept as bit vectors of their differences, one bit
    for each character of the pattern; of equally good ends the first is given.
    """
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    up, down, score = mask, 0, m
    best, end = m + 1, -1
    for j, c in enumerate(text):
        eq = where.get(c, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        more = down | (~(horizontal | up) & mask)
        less = up & horizontal
        score += bool(more & top) - bool(less & top)
        more = more << 1 & mask
        less = less << 1 & mask
        up = less | (~(vertical | more) & mask)
        down = more & vertical
        if score < best:
            best, end = score, j + 1
    return (best, end) if best <= budget else None


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rule: EditMatch):
        import ahocorasick

        self.items, self.budgets = [], []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normalised(text)
            if not text:
                continue
            budget = budget_of(text, rule)
            for offset, piece in pieces(text, budget):
                found.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, text))
            self.budgets.append(budget)
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def matches(self, text: str) -> dict[int, int]:
        """Fewest edits by item, over all its places in a normalised text."""
        out: dict[int, int] = {}
        if not self.items or not text:
            return out
        verified: dict[int, tuple[int, int]] = {}  # by item, the stretch verified last
        for last, (length, places) in self.automaton.iter(text):
            for which, offset in places:
                budget, (item_id, item) = self.budgets[which], self.items[which]
                start = last + 1 - length - offset
                a, b = max(0, start - budget), min(len(text), start + len(item) + budget)
                lo, hi = verified.get(which, (0, -1))
                if lo <= a and b <= hi or out.get(item_id) == 0:
                    continue
                # Wider than this find needs, so that finds of the item's other pieces fall inside.
                a, b = max(0, a - budget), min(len(text), b + budget)
                verified[which] = a, b
                got = myers(item, text[a:b], budget)
                if got:
                    out[item_id] = min(got[0], out.get(item_id, got[0]))
        return out


def item_blocks(benchmark: DataFrame, most: int):
    """The benchmark's items, some at a time."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        if block and size + len(row.text) > most:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text)
    yield block


HITS = StructField("hits", ArrayType(StructType([StructField("item_id", LongType()), StructField("edits", IntegerType())])))


def find_leaks(docs: DataFrame, benchmark: DataFrame, rule: EditMatch = EditMatch()) -> DataFrame:
    """``docs`` with ``hits``: an array of (item_id, edits) ordered by item, or empty.

    A null or empty text, and an item without words, match nothing; of rows that repeat an
    item_id the place with the fewest edits counts.  All rows and columns of ``docs`` stay,
    in place of a column ``hits``.  A benchmark of several blocks takes a pass over the texts
    for each, which keeps the hits alone, by the texts' digests; they are a table in the
    shared folder, which stays there, and meet the documents in one join.
    """
    rows = docs.select(*[c for c in docs.columns if c != "hits"])
    blocks = item_blocks(benchmark, rule.block_chars)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return matched(rows, first, rule)
    digest = F.sha2(F.col("text").cast("binary"), 256)
    with Scratch(docs.sparkSession) as tmp:
        passes = []
        for block in chain([first, second], blocks):
            found = matched(rows.filter("text <> ''").select("text", digest.alias("digest")), block, rule)
            passes.append(tmp.stored(found.filter(F.size("hits") > 0).select("digest", F.explode("hits").alias("hit")), "leaks-block"))
        hits = reduce(DataFrame.unionAll, passes).groupBy("digest", "hit.item_id").agg(F.min("hit.edits").alias("edits"))
        hits = hits.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("item_id", "edits"))).alias("hits"))
        hits = stored(hits, "leaks")
    name = next(n for n in map("_digest{}".format, range(len(rows.columns) + 1)) if n not in rows.columns)
    joined = rows.join(hits.withColumnRenamed("digest", name), F.col(name) == digest, "left")
    return joined.withColumn("hits", F.coalesce("hits", F.array().cast(HITS.dataType))).drop(name)


def matched(rows: DataFrame, block: list[tuple[int, str]], rule: EditMatch) -> DataFrame:
    """``rows`` with the ``hits`` of one block."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def make():
        matcher = Matcher(sent.value, rule)

        def step(cols):
            found = [matcher.matches(normalised(t)) for t in cols["text"]]
            return cols | {"hits": [[{"item_id": i, "edits": m[i]} for i in sorted(m)] for m in found]}

        return step

    return map_batches(rows, make, StructType([*rows.schema.fields, HITS]))
