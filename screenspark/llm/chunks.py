"""White-space-free chunks of texts, and tables of values remembered by chunk.

Words repeat: what a model gives a chunk is computed once for each worker and
kept in a table of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Most chunks that a worker remembers, and most characters that it splits at once.
MEMORY, AT_ONCE = 200_000, 2_000_000


def in_groups(texts: list[str | None]) -> Iterator[list[list[str]]]:
    """The chunks of each text, for some texts at a time; a null text has none."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text or "") > AT_ONCE:
            yield group
            group, size = [], 0
        group.append((text or "").split())
        size += len(text or "")
    if group:
        yield group


class ChunkTable:
    """Rows of numbers by chunk; ``compute`` gives those of new chunks, many at once."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], width: int, most: int = MEMORY):
        self.compute, self.most = compute, most
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, width), dtype=np.float64)

    def indices(self, texts: list[list[str]]) -> list[np.ndarray]:
        """For each text the places of its chunks' rows in ``rows``, until the next call."""
        if len(self.at) > self.most:
            self.at.clear()
        new = [c for c in set().union(*texts) if c not in self.at]
        if new:
            need = len(self.at) + len(new)
            if need > len(self.rows):
                self.rows = np.concatenate([self.rows[: len(self.at)], np.zeros((2 * need - len(self.at), self.rows.shape[1]))])
            for k in range(0, len(new), 20_000):
                some = new[k : k + 20_000]
                start = len(self.at)
                self.rows[start : start + len(some)] = self.compute(some)
                self.at.update(zip(some, range(start, start + len(some))))
        look = self.at.__getitem__
        return [np.fromiter(map(look, t), np.int64, len(t)) for t in texts]
