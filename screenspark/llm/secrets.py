"""Operator 3: secrets, by patterns and by sliding-window entropy.

Patterns find assignments, access keys and long hexadecimal strings.  Besides, each
unbroken run of a character class is a candidate: a window slides over it, the counts of
its characters are kept by adding the one that enters and taking away the one that
leaves, and where the Shannon entropy of a window reaches the threshold of the class, the
window is suspicious.  A window that touches a word of the allow-list isn't, and of a
wider class none that lies wholly in a candidate of a narrower one.  Overlapping
suspicious windows are united into a span, unless all of it has an allowed shape.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from screenspark.llm.common import map_batches
from screenspark.llm.spans import digest, joined, merged

# The patterns of the contract, and the least lengths of their matches.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORD_PARTS = ("passw", "secret", "token", "api")


@dataclass(frozen=True)
class EntropyRule:
    """A character class of candidates and the entropy, in bits, that a window needs."""

    name: str
    letters: str
    bits: float


@dataclass(frozen=True)
class EntropyScan:
    window: int = 20
    #: From the narrowest class to the widest.
    rules: tuple[EntropyRule, ...] = (
        EntropyRule("hex_entropy", "0123456789abcdefABCDEF", 3.0),
        EntropyRule("mixed_entropy", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
    )
    #: Windows that touch one of these are left alone.
    words: tuple[str, ...] = (r"(?i:example|placeholder|changeme|dummy|sample|redacted)", r"(?i:0123456789|abcdefghij|qwertyuiop)")
    #: Spans that are nothing but one of these are left alone: words and paths of words, dates and numbers.
    shapes: tuple[str, ...] = (r"[A-Za-z]+", r"[-_/]*[A-Z]?[a-z]+(?:[-_/]+[A-Za-z]?[a-z]+)*[-_/]*", r"[-_/]*[0-9]+(?:[-/_]+[0-9]+)*[-_/]*")


def window_entropies(text: str, window: int):
    """(start, bits) of each window of a text, by incremental counts.

    With counts c over a window of w characters the entropy is
    log2(w) - sum(c * log2(c)) / w; a step changes two of the terms.
    """
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    for i, new in enumerate(text):
        if i >= window:
            old = text[i - window]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        c = counts.get(new, 0)
        total += term[c + 1] - term[c]
        counts[new] = c + 1
        if i >= window - 1:
            yield i - window + 1, math.log2(window) - total / window


class Scanner:
    def __init__(self, scan: EntropyScan):
        self.scan = scan
        self.words = re.compile("|".join(scan.words)) if scan.words else None
        self.shapes = re.compile("|".join(f"(?:{x})" for x in scan.shapes)) if scan.shapes else None
        self.candidates = [(r, re.compile(f"[{re.escape(r.letters)}]{{{scan.window},}}")) for r in scan.rules]

    def base(self, text: str) -> list[tuple[str, int, int]]:
        found = []
        low = text.lower()
        if any(part in low for part in KEYWORD_PARTS):
            found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
        return found + [("hex", *m.span()) for m in HEX.finditer(text)]

    def entropy(self, text: str) -> list[tuple[str, int, int]]:
        found, width = [], self.scan.window
        #: Places at which no window counts: those where one of a narrower class starts.
        taken = bytearray(len(text))
        for rule, candidates in self.candidates:
            runs = [m.span() for m in candidates.finditer(text)]
            for start, end in runs:
                idle = taken[start : end - width + 1]
                # Words that lie in the run or reach into it.
                for m in self.words.finditer(text, max(0, start - width), end + width) if self.words else ():
                    a, b = max(0, m.start() - width + 1 - start), min(m.end() - start, len(idle))
                    if a < b:
                        idle[a:b] = b"\1" * (b - a)
                hot = [(start + i, start + i + width) for i, bits in window_entropies(text[start:end], width) if bits >= rule.bits and not idle[i]]
                found += [(rule.name, a, b) for a, b in merged(hot) if not (self.shapes and self.shapes.fullmatch(text, a, b))]
            for start, end in runs:
                taken[start : end - width + 1] = b"\1" * (end - width + 1 - start)
        return found


def find_secrets(docs: DataFrame, scan: EntropyScan = EntropyScan()) -> DataFrame:
    """One row per document with the counts and places of what looks like a secret.

    A null or empty text has none: counts 0, an empty ``spans``.  Places are code
    points, the end exclusive.  Every row of ``docs`` gives a row, repeated ids too;
    other columns than doc_id and text are ignored.
    """

    def make():
        scanner = Scanner(scan)
        order = {k: i for i, k in enumerate((*KINDS, *(r.name for r in scan.rules)))}

        def by_place(span):
            return span[1], order[span[0]], span[2]

        def step(cols):
            out = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for doc_id, text in zip(cols["doc_id"], cols["text"]):
                base = sorted(scanner.base(text or ""), key=by_place)
                every = sorted(base + scanner.entropy(text or ""), key=by_place)
                kinds = [k for k, _, _ in base]
                out["doc_id"].append(doc_id)
                for kind in KINDS:
                    out[f"n_{kind}"].append(kinds.count(kind))
                out["base_sha256"].append(digest(base))
                out["spans"].append(joined(every))
            return out

        return step

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_batches(docs.select("doc_id", "text"), make, schema)
