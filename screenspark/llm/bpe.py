"""Operator 2: byte-pair encoding and decoding by forced-boundary splitting.

Two neighbouring bytes that are neighbours inside no token of the vocabulary can
never be merged across, so the place between them is a certain cut.  A word falls
into fragments at its certain cuts; the fragments are encoded independently, their
ids concatenated.  Words and white-space-free chunks repeat a lot, so each worker
remembers what it has encoded, in tables of bounded size.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array

import numpy as np
from pyspark.sql import DataFrame

from screenspark.llm.common import kept, map_batches

#: Most entries of a worker's table of encoded words; the table of chunks has twice as many.
MEMORY = 130_000

# What the tokenizer's regular expression engine calls white space,
# its word pattern, and its end-of-word mark.
WHITE = "\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+".replace(r"\s", WHITE)
END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class _Memo(dict):
    """A dict that computes what is missing and forgets all when it is full."""

    def __init__(self, compute, most: int = MEMORY):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class WordBPE:
    """Encoder and decoder for a tokenizer file of kind BPE with word ends."""

    def __init__(self, spec: dict):
        import regex

        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.letters = byte_letters()
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: What each merge makes, and the merge of each pair of ids; of repeated pairs the first counts.
        self.made = [self.vocab[a + b] for a, b in pairs]
        self.ranks = {self.vocab[a] << 32 | self.vocab[b]: r for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.byte_ids = [self.vocab[c] for c in self.letters]
        self.last_byte_ids = [self.vocab[c + END] for c in self.letters]
        back = {letter: byte for byte, letter in enumerate(self.letters)}
        #: joined[a, b]: byte a stands right before byte b inside some token.
        self.joined = np.zeros((256, 256), dtype=bool)
        for token in self.vocab:
            inside = [back[c] for c in token.removesuffix(END) if c in back]
            self.joined[inside[:-1], inside[1:]] = True
        self.cuts = self.joined.tolist()
        self.pattern = regex.compile(WORDS)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.split_white = regex.compile(f"[{WHITE}]+").split
        self.word_ids = _Memo(self._word)
        self.chunks = _Memo(self._chunk, 2 * MEMORY)

    def fragments(self, word: bytes) -> list[bytes]:
        """The word, cut wherever two neighbouring bytes are joined by no token."""
        at = [0, *(i for i in range(1, len(word)) if not self.cuts[word[i - 1]][word[i]]), len(word)]
        return [word[a:b] for a, b in zip(at, at[1:])]

    def _merge(self, key: tuple[bytes, bool]) -> tuple[int, ...]:
        """Merge one fragment: the pair of lowest rank first, the leftmost of equals."""
        fragment, last = key
        ids = list(map(self.byte_ids.__getitem__, fragment))
        if last:
            ids[-1] = self.last_byte_ids[fragment[-1]]
        return tuple(ids) if len(ids) == 1 else self._merge_short(ids) if len(ids) <= 48 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> tuple[int, ...]:
        """By a list of the ranks of all neighbouring pairs."""
        rank_of, none = self.ranks.get, len(self.made)
        ranks = [rank_of(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) != none:
            i = ranks.index(rank)
            new = ids[i] = self.made[rank]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(new << 32 | ids[i + 1], none)
            if i:
                ranks[i - 1] = rank_of(ids[i - 1] << 32 | new, none)
        return tuple(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        """By a heap of pairs, in time n log n."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if (rank := self.ranks.get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(queue, (rank, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return tuple(x for x in ids if x >= 0)

    def _word(self, word: str) -> tuple[int, ...]:
        parts = self.fragments(word.encode("utf-8"))
        out: list[int] = []
        for k, part in enumerate(parts):
            out += self._merge((part, k == len(parts) - 1))
        return tuple(out)

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        """Ids, as little-endian 32-bit integers, and tokens of a text without white space."""
        text = chunk if chunk.isascii() or unicodedata.is_normalized("NFC", chunk) else unicodedata.normalize("NFC", chunk)
        text = text.replace("Σ", "σ").lower()  # character by character, so without a final sigma
        if text.isalpha() and text.isascii():
            ids = self.word_ids[text]
        else:
            ids = []
            for word in self.pattern.findall(text):
                ids += self.word_ids[word] if len(word) <= 64 else self._word(word)
        return array("I", ids).tobytes(), " ".join(map(self.names.__getitem__, ids))

    def _pieces(self, text: str) -> list[str]:
        plain = text.split()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # str.split() takes these for white space, the tokenizer doesn't
            plain = [c for c in self.split_white(text) if c]
        return plain

    def encode_both(self, text: str) -> tuple[bytes, str]:
        """The ids of a whole text, packed, and the text that they decode to."""
        if self.marks and any(mark in text for mark in self.special):
            parts = [
                (self.special[p].to_bytes(4, "little"), p) if p in self.special else self._plain(p)
                for p in self.marks.split(text)
                if p
            ]
            return b"".join(ids for ids, _ in parts), " ".join(names for ids, names in parts if ids)
        return self._plain(text)

    def _plain(self, text: str) -> tuple[bytes, str]:
        pieces = self._pieces(text)
        if max(map(len, pieces), default=0) > 256:  # long chunks are not worth remembering
            found = list(map(self._chunk, pieces))
        else:
            found = list(map(self.chunks.__getitem__, pieces))
        return b"".join([ids for ids, _ in found]), " ".join([names for _, names in found])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_both(text)[0], dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """What the tokenizer without a decoder gives: its tokens, joined by spaces."""
        return " ".join(self.names[i] for i in ids)


def load(path: str) -> WordBPE:
    """One encoder, with its memory, for each worker process."""

    def read() -> WordBPE:
        with open(path, encoding="utf-8") as f:
            return WordBPE(json.load(f))

    return kept(f"bpe {path}", read)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per document: its ids (on request), their count and both digests.

    ``path`` names the tokenizer file on every machine; None means the installed
    public one.  A null or empty text has no tokens, and the digests of nothing.
    Rows with a null or repeated doc_id each give a row.  Extra columns of ``docs``
    are ignored.
    """

    def make():
        model = load(path or default_path())

        def step(cols):
            out = {k: [] for k in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")}
            for doc_id, text in zip(cols["doc_id"], cols["text"]):
                ids, decoded = model.encode_both(text or "")
                out["doc_id"].append(doc_id)
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if keep_ids:
                    out["ids"].append(np.frombuffer(ids, dtype="<u4").tolist())
            return out

        return step

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select("doc_id", "text"), make, schema + (", ids array<bigint>" if keep_ids else ""))


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) to (doc_id, text); null ids give an empty text."""

    def make():
        model = load(path or default_path())

        def step(cols):
            return {"doc_id": cols["doc_id"], "text": [model.decode(x or []) for x in cols["ids"]]}

        return step

    return map_batches(encoded.select("doc_id", "ids"), make, "doc_id bigint, text string")
