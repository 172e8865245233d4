"""Operator 4: license scan by template-markup matching.

A template is license wording with two kinds of markup: ``[[optional words]]`` may
be missing, and ``{{n}}`` stands for any zero to n words (a name, a year); case and what
stands between words don't count.  It is compiled into an automaton over words.  A text is accepted where the mandatory
wording stands exactly, from some word on.  The automaton keeps the set of all its
positions that the words read so far can have led to, so that optional and
replaceable regions need no backtracking.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame

from screenspark.llm.common import kept, map_batches
from screenspark.llm.license_texts import WHOLE_TERMS

# The phrases of the contract and their labels.
PHRASES = ((("cc", "by"), "cc-by"), (("general", "public", "license"), "gpl"), (("all", "rights", "reserved"), "reserved"))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Bytes of words: in UTF-8 the bytes of all other characters are at least 0x80.
WORD_BYTES = np.array([48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90 or b >= 128 for b in range(256)])

#: A-Z alone are made small.
LOWER = {c: c + 32 for c in range(65, 91)}

# Wording of public licenses, of their notices, and of usual statements.
AS_IS = """the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a
particular purpose"""
DEALINGS = "whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"
#: Names that a tag can give, alone or as the first or a later choice; what follows a name (or-later, with an exception) adds nothing.
TAGGED = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "BSL-1.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0")
TEMPLATES = (
    ("mit", f"""permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files [[(the "software")]], to deal in the
    software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to
    permit persons to whom the software is furnished to do so, subject to the following conditions: the above copyright notice and this permission notice [[(including the next
    paragraph)]] shall be included in all copies or substantial portions of the software. {AS_IS} and noninfringement. in no event shall {{{{12}}}} be liable for any claim, damages or
    other liability, {DEALINGS}"""),
    ("bsd", """redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: [[1]] redistributions of
    source code must retain the above copyright notice, this list of conditions and the following disclaimer. [[2]] redistributions in binary form must reproduce the above copyright
    notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. [[ [[3]] neither the name of {{12}} nor
    the names of {{4}} contributors may be used to endorse or promote products derived from this software without specific prior written permission. ]] this software is provided by
    {{12}} "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.
    in no event shall {{12}} be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute
    goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort
    (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage"""),
    ("isc", """permission to use, copy, modify, and [[or]] distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and
    this permission notice appear in all copies. the software is provided "as is" and {{8}} disclaims all warranties with regard to this software including all implied warranties of
    merchantability and fitness. in no event shall {{8}} be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use,
    data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software"""),
    ("zlib", """this software is provided 'as-is', without any express or implied warranty. in no event will {{4}} be held liable for any damages arising from the use of this software.
    permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
    restrictions: [[1]] the origin of this software must not be misrepresented; you must not claim that you wrote the original software. if you use this software in a product, an
    acknowledgment in the product documentation would be appreciated but is not required. [[2]] altered source versions must be plainly marked as such, and must not be
    misrepresented as being the original software. [[3]] this notice may not be removed or altered from any source distribution"""),
    ("bsl-1.0", f"""permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
    (the "software") to use, reproduce, display, distribute, execute, and transmit the software, and to prepare derivative works of the software, and to permit third-parties to whom
    the software is furnished to do so, all subject to the following: the copyright notices in the software and this entire statement, including the above license grant, this
    restriction and the following disclaimer, must be included in all copies of the software, in whole or in part, and all derivative works of the software, unless such copies or
    derivative works are solely in the form of machine-executable object code generated by a source language processor. {AS_IS}, title and non-infringement. in no event shall the
    copyright holders or anyone distributing the software be liable for any damages or other liability, whether in contract, tort or otherwise, arising from, out of or in connection
    with the software or the use or other dealings in the software"""),
    ("unlicense", f"""this is free and unencumbered software released into the public domain. anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,
    either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. in jurisdictions that recognize copyright laws, the author or
    authors of this software dedicate any and all copyright interest in the software to the public domain. we make this dedication for the benefit of the public at large and to the
    detriment of our heirs and successors. we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
    copyright law. {AS_IS} and noninfringement. in no event shall the authors be liable for any claim, damages or other liability, {DEALINGS}"""),
    ("apache-2.0-notice", """licensed under the apache license, version 2.0 [[(the "license")]]; you may not use this file except in compliance with the license. you may obtain a copy
    of the license at {{8}} unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an "as is" basis, without warranties or
    conditions of any kind, either express or implied. see the license for the specific language governing permissions and limitations under the license"""),
    ("gpl-or-later", """this {{4}} is free software; you can redistribute it and/or modify it under the terms of the gnu [[lesser]] [[affero]] general public license as published by the
    free software foundation; either version {{2}} of the license, or (at your option) any later version. this {{4}} is distributed in the hope that it will be useful, but without any
    warranty; without even the implied warranty of merchantability or fitness for a particular purpose. see the gnu [[lesser]] [[affero]] general public license for more details"""),
    ("mpl-2.0", """this source code form is subject to the terms of the mozilla public license, v. 2.0. if a copy of the mpl was not distributed with this file, you can obtain one at"""),
    ("cc0", "to the extent possible under law, {{8}} waived all copyright and related or neighboring rights to"),
    ("copyright", "copyright [[c]] {{6}} all rights reserved"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("apache-2.0", "licensed under the apache [[license]] [[version]] 2.0"),
    ("gpl", "licensed under the gnu [[lesser]] [[affero]] general public license"),
    ("gpl", "[[gnu]] general public license [[as published by the free software foundation]] [[either]] version"),
    ("mpl-2.0", "licensed under the mozilla public license"),
    ("cc-by-nc", "licensed under [[a]] [[creative commons]] cc by nc"),
    ("cc-by-sa", "licensed under [[a]] [[creative commons]] cc by sa"),
    *WHOLE_TERMS,
    *((name.lower(), f"spdx-license-identifier: [[ {{{{4}}}} or ]] {name}") for name in TAGGED),
)
MARKUP = re.compile(r"\[\[|\]\]|\{\{(\d+)\}\}|" + WORD.pattern)


@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``words`` leads on one word, ``free`` on any, ``skips`` on none."""

    label: str
    words: tuple[dict[str, int], ...]
    free: tuple[int, ...]
    skips: tuple[tuple[int, ...], ...]
    #: First words that a match can start with.
    first: frozenset[str] = frozenset()
    #: The longest word that each match holds.
    rare: str = ""

    def closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for nxt in self.skips[todo.pop()]:
                if nxt not in states:
                    states.add(nxt)
                    todo.append(nxt)
        return states

    def match(self, words: list[str], start: int) -> int | None:
        """Where the shortest accepted wording from ``start`` on ends, if there is one."""
        last = len(self.words) - 1
        now = self.closed({0})
        for i in range(start, len(words)):
            then = set()
            for s in now:
                if words[i] in self.words[s]:
                    then.add(self.words[s][words[i]])
                if self.free[s] >= 0:
                    then.add(self.free[s])
            if not then:
                return None
            now = self.closed(then)
            if last in now:
                return i + 1
        return None


def compile_template(label: str, markup: str) -> Automaton:
    """Markup to automaton; the parts of an optional region can all be passed by.

    Wording outside of optional regions is mandatory: there must be some, and a match
    starts with a word of the template.
    """
    words: list[dict[str, int]] = [{}]
    free, skips, opened, mandatory = [-1], [[]], [], []

    def state() -> int:
        words.append({})
        free.append(-1)
        skips.append([])
        return len(words) - 1

    for m in MARKUP.finditer(markup.translate(LOWER)):
        here = len(words) - 1
        if m[0] == "[[":
            opened.append(here)
        elif m[0] == "]]":
            skips[opened.pop()].append(here)
        elif m[1] is not None:
            steps = [here]
            for _ in range(int(m[1])):
                free[steps[-1]] = state()
                steps.append(len(words) - 1)
            for s in steps[:-1]:
                skips[s].append(steps[-1])
        else:
            words[here][m[0]] = state()
            mandatory += [] if opened else [m[0]]
    if opened:
        raise ValueError(f"optional region without end: {markup}")
    if not mandatory:
        raise ValueError(f"no mandatory wording: {markup}")
    made = Automaton(label, tuple(words), tuple(free), tuple(map(tuple, skips)))
    start = made.closed({0})
    if any(free[s] >= 0 for s in start):
        raise ValueError(f"a template must start with wording: {markup}")
    return replace(made, first=frozenset(w for s in start for w in words[s]), rare=max(mandatory, key=len))


class LicenseScanner:
    def __init__(self, templates=TEMPLATES):
        automata = [compile_template(label, markup) for label, markup in templates]
        self.by_first: dict[str, list[Automaton]] = defaultdict(list)
        for automaton in automata:
            for word in automaton.first:
                self.by_first[word].append(automaton)
        #: Every match of a template or phrase holds one of these; most texts hold none.
        self.rare = sorted({a.rare for a in automata} | {max(p, key=len) for p, _ in PHRASES})
        self.phrases: dict[str, list] = defaultdict(list)
        for phrase, label in PHRASES:
            self.phrases[phrase[0]].append((phrase, label))

    def scan(self, text: str) -> tuple[int, list[int], set[str], set[str]]:
        """Words, starts of base places, base labels, template labels of one text."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        inside = WORD_BYTES[raw]
        n_words = int(inside[:1].sum() + np.count_nonzero(inside[1:] & ~inside[:-1]))
        low = text.translate(LOWER) if not text.isascii() else text.lower()
        present = {r for r in self.rare if r in low}
        if not present:
            return n_words, [], set(), set()
        words = WORD.findall(low)
        places, base, labels = [], set(), set()
        for i, word in enumerate(words):
            for phrase, label in self.phrases.get(word, ()):
                if tuple(words[i : i + len(phrase)]) == phrase:
                    places.append(i)
                    base.add(label)
            for automaton in self.by_first.get(word, ()):
                if automaton.rare in present and automaton.label not in labels and automaton.match(words, i) is not None:
                    labels.add(automaton.label)
        return n_words, places, base, labels


def scan_licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per document: its words, the places of the phrases, and its labels.

    ``score`` is 1 where a template is matched, 0.5 where a phrase alone is, else 0.
    A null or empty text has no words, no labels ('') and null first and last words.
    Every row of ``docs`` gives a row; other columns than doc_id and text are ignored.
    """
    key = f"licenses {zlib.crc32(repr(templates).encode())}"

    def make():
        scanner = kept(key, lambda: LicenseScanner(templates))

        def step(cols):
            out = {k: [] for k in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
            for doc_id, text in zip(cols["doc_id"], cols["text"]):
                n_words, places, base, found = scanner.scan(text or "")
                out["doc_id"].append(doc_id)
                out["n_words"].append(n_words)
                out["n_base"].append(len(places))
                out["first_word"].append(min(places, default=None))
                out["last_word"].append(max(places, default=None))
                out["base_labels"].append(",".join(sorted(base)))
                out["labels"].append(",".join(sorted(base | found)))
                out["score"].append(1.0 if found else 0.5 if base else 0.0)
            return out

        return step

    schema = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return map_batches(docs.select("doc_id", "text"), make, schema)
