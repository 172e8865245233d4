"""Operator 5: personal data, by patterns and by a character-level BiLSTM-CRF.

Patterns find the usual forms.  A bidirectional LSTM over characters with a linear
layer gives each character a score for each tag (outside, or begin/inside of a kind),
and a conditional random field adds learned scores of tag transitions.  Both are
trained together in numpy, by the forward-backward recursions, on labelled spans that
are made here from a seed: personal data in many written forms amid prose and decoys.

A text is read in overlapping windows.  Each window scores its characters; where
windows overlap their scores are averaged, the nearer to a window's middle the
heavier, and one Viterbi pass decodes the tags, so that the windows' readings are
reconciled globally.  Every kind holds a digit or an at sign, so by definition a
character that no window with one covers is outside, and a decoded span without one
doesn't count.  Each window that overlaps a covered stretch is read; as the tags around
it are fixed, decoding such stretches one by one gives what decoding whole texts would.
Of decoded spans those stay whose digits fit their kind (a card passes Luhn's test).
"""

from __future__ import annotations

import functools
import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from screenspark.llm.common import kept, map_batches
from screenspark.llm.langid import sigmoid
from screenspark.llm.spans import digest, joined

# The kinds, patterns and lengths of the contract.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
#: Windows of a long run that are decoded at once, and those beyond them on each side that
#: are decoded with them: a tag depends on what follows it by so many characters at most.
STRETCH, LAG = 256, 8

TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
SYMBOLS = 99


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches, found from their at signs, so in time linear in the text."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns, by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if not any(d in text for d in "0123456789"):
        return out
    for m in IP.finditer(text):
        if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


@dataclass(frozen=True)
class PiiParams:
    hidden: int = 16
    window: int = 128
    stride: int = 64
    steps: int = 420
    batch: int = 48
    length: int = 72
    rate: float = 0.02
    seed: int = 5


def symbols(text: str) -> np.ndarray:
    """A small code for each character: ASCII itself, else letter or other."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    ascii_code = np.where((codes >= 32) & (codes < 127), codes - 31, np.where((codes == 10) | (codes == 13) | (codes == 9), 96, 97))
    return np.where(codes >= 192, 98, ascii_code)


class Lstm:
    """One direction over characters; gates in the order input, forget, output, new."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.h = hidden
        self.x = rng.normal(0, 0.2, (SYMBOLS, 4 * hidden)).astype(np.float32)
        self.x[:, hidden : 2 * hidden] += 1
        self.u = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)

    def forward(self, codes: np.ndarray, order, keep: bool = False):
        n, h = codes.shape[1], self.h
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out = np.zeros((*codes.shape, h), np.float32)
        trace = []
        for t in order:
            a = self.x[codes[t]] + state @ self.u
            gates, fresh = sigmoid(a[:, : 3 * h]), np.tanh(a[:, 3 * h :])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            old_cell, old_state = cell, state
            cell = f * cell + i * fresh
            lit = np.tanh(cell)
            state = out[t] = o * lit
            if keep:
                trace.append((t, old_state, old_cell, i, f, o, fresh, lit))
        return out, trace

    def backward(self, codes: np.ndarray, back: np.ndarray, trace):
        d_state, d_cell = np.zeros_like(back[0]), np.zeros_like(back[0])
        inner, before = np.zeros((*codes.shape, 4 * self.h), np.float32), np.zeros_like(back)
        for t, old_state, old_cell, i, f, o, fresh, lit in reversed(trace):
            d_state = d_state + back[t]
            d_cell = d_cell + d_state * o * (1 - lit * lit)
            inner[t] = np.concatenate([d_cell * fresh * i * (1 - i), d_cell * old_cell * f * (1 - f), d_state * lit * o * (1 - o), d_cell * i * (1 - fresh * fresh)], axis=1)
            before[t] = old_state
            d_state, d_cell = inner[t] @ self.u.T, d_cell * f
        rows = inner.reshape(-1, 4 * self.h)
        which = (np.arange(SYMBOLS)[:, None] == codes.reshape(-1)).astype(np.float32)
        return which @ rows, before.reshape(-1, self.h).T @ rows


def log_times(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """log(exp(x) @ kernel) by rows, without overflow."""
    top = x.max(axis=1, keepdims=True)
    return top + np.log(np.maximum(np.exp(x - top) @ kernel, 1e-37))


@dataclass
class PiiModel:
    params: PiiParams
    ahead: Lstm
    behind: Lstm
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray  # tag before x tag after

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.x, self.ahead.u, self.behind.x, self.behind.u, self.out, self.bias, self.moves]

    def emissions(self, codes: np.ndarray, keep: bool = False):
        """Scores of the tags, time x text x tag."""
        f, tf = self.ahead.forward(codes, range(len(codes)), keep)
        b, tb = self.behind.forward(codes, reversed(range(len(codes))), keep)
        states = np.concatenate([f, b], axis=2)
        return states @ self.out + self.bias, states, tf, tb

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood of the tag sequences, and its gradients."""
        scores, states, tf, tb = self.emissions(codes, keep=True)
        length, n, k = scores.shape
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0]
        kernel = np.exp(self.moves)
        for t in range(1, length):
            alpha[t] = scores[t] + log_times(alpha[t - 1], kernel)
        for t in range(length - 2, -1, -1):
            beta[t] = log_times(scores[t + 1] + beta[t + 1], kernel.T)
        total = log_times(alpha[-1], np.ones((k, 1), np.float32))[:, 0]
        here = np.arange(length)[:, None], np.arange(n), tags
        gold = scores[here].sum(axis=0) + self.moves[tags[:-1], tags[1:]].sum(axis=0)
        back = np.exp(alpha + beta - total[None, :, None])
        back[here] -= 1
        # Expected moves less those of the labels, over all places at once.
        left, right = alpha[:-1], scores[1:] + beta[1:]
        a, b = left.max(axis=2, keepdims=True), right.max(axis=2, keepdims=True)
        left = np.exp(left - a) * np.exp(a + b - total[None, :, None])
        g_moves = kernel * (left.reshape(-1, k).T @ np.exp(right - b).reshape(-1, k))
        np.add.at(g_moves, (tags[:-1], tags[1:]), -1)
        size = n * length
        back = (back / size).astype(np.float32)
        h = self.params.hidden
        down = back @ self.out.T
        fx, fu = self.ahead.backward(codes, down[:, :, :h], tf)
        bx, bu = self.behind.backward(codes, down[:, :, h:], tb)
        g_out = states.reshape(-1, 2 * h).T @ back.reshape(-1, k)
        return float((total - gold).sum() / size), [fx, fu, bx, bu, g_out, back.sum(axis=(0, 1)), (g_moves / size).astype(np.float32)]

    def viterbi(self, scores: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Best tags of each of some texts, time x text x tag, each with its length."""
        steps, n, k = scores.shape
        best = scores[0].copy()
        came = np.zeros((steps, n, k), dtype=np.int8)
        last = np.where((lengths == 1)[:, None], best, 0)
        for t in range(1, steps):
            through = best[:, :, None] + self.moves
            came[t] = through.argmax(axis=1)
            best = through.max(axis=1) + scores[t]
            last = np.where((lengths == t + 1)[:, None], best, last)
        out = []
        for j in range(n):
            tag = int(last[j].argmax())
            path = np.zeros(lengths[j], dtype=np.int8)
            for t in range(lengths[j] - 1, -1, -1):
                path[t] = tag
                tag = came[t, j, tag]
            out.append(path)
        return out


def new_model(params: PiiParams) -> PiiModel:
    rng = np.random.default_rng(params.seed)
    k = len(TAGS)
    out = rng.normal(0, 0.1, (2 * params.hidden, k)).astype(np.float32)
    return PiiModel(params, Lstm(params.hidden, rng), Lstm(params.hidden, rng), out, np.zeros(k, np.float32), np.zeros((k, k), np.float32))


class Examples:
    """Labelled texts of a fixed length, made from a seed."""

    def __init__(self, rng: random.Random, length: int):
        self.rng, self.length = rng, length

    def pick(self, options):
        return options[int(self.rng.random() * len(options))]

    def digits(self, n: int) -> str:
        return f"{self.rng.randrange(10**n):0{n}}"

    def word(self) -> str:
        parts = ("an", "the", "er", "tion", "en", "sch", "de", "os", "la", "que", "ß", "ó", "re", "in", "st", "ou", "eau", "ment", "ti")
        w = "".join(self.pick(parts) for _ in range(self.rng.randrange(1, 4)))
        return w.capitalize() if self.rng.random() < 0.15 else w

    def email(self) -> str:
        name = self.word().lower() + self.pick(("", ".", "_", "-", "+")) + self.pick((self.word().lower(), self.digits(2)))
        at = self.pick(("@", "@", "@", "@", " @ ", "@ "))
        return name + at + self.word().lower() + self.pick((".com", ".org", ".net", ".example.com", ".de", ".co.uk"))

    def ip(self) -> str:
        return self.pick((".", ".", ".", " . ", "[.]")).join(str(self.rng.randrange(256)) for _ in range(4))

    def card(self) -> str:
        d = self.pick(("4", "5", "37", "6011")) + self.digits(15)
        d = d[: self.pick((15, 16, 16, 16))]
        gap = self.pick(("", "", " ", "-", "."))
        return gap.join(d[i : i + 4] for i in range(0, len(d), 4))

    def phone(self) -> str:
        a, b, c = self.digits(3), self.digits(3), self.digits(4)
        return self.pick((f"+1 ({a}) {b}-{c}", f"+{self.digits(2)} {a} {b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1-{a}-{b}-{c}", f"+{self.digits(2)}.{a}.{b}.{c}", f"00{self.digits(2)} {a} {b} {c}"))

    def decoy(self) -> str:
        hexed = f"{self.rng.getrandbits(160):040x}"
        return self.pick((f"version {self.digits(1)}.0", f"{self.rng.randrange(1900, 2030)}", hexed, f"{self.digits(2)}:{self.digits(2)}", f"{self.digits(2)}.{self.digits(2)}", f"{self.digits(3)},{self.digits(3)}", f"@{self.word()}", f"#{self.digits(4)}", f"token = \"{hexed}\"", self.digits(8), f"v{self.digits(1)}.{self.digits(2)}.{self.digits(1)}", f"2024-{self.digits(2)}-{self.digits(2)}"))

    def one(self) -> tuple[np.ndarray, np.ndarray]:
        text, tags = "", []
        while len(text) < self.length:
            roll = self.rng.random()
            kind = self.pick(KINDS) if roll < 0.13 else None
            part = getattr(self, kind)() if kind else self.decoy() if roll < 0.22 else self.word()
            after = self.pick((" ", " ", " ", " ", ". ", ", ", "\n", ": ", " | "))
            tags += [TAGS.index(f"B-{kind}")] + [TAGS.index(f"I-{kind}")] * (len(part) - 1) if kind else [0] * len(part)
            tags += [0] * len(after)
            text += part + after
        start = self.rng.randrange(len(text) - self.length + 1)
        return symbols(text)[start : start + self.length], np.array(tags)[start : start + self.length]


@functools.cache
def train(params: PiiParams = PiiParams()) -> PiiModel:
    """Adam on batches of made examples; the same parameters give the same model, which a
    process makes once."""
    model = new_model(params)
    examples = Examples(random.Random(params.seed + 1), params.length)
    weights = model.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, params.steps + 1):
        pairs = [examples.one() for _ in range(params.batch)]
        _, grads = model.gradients(np.stack([c for c, _ in pairs], 1), np.stack([t for _, t in pairs], 1))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = params.rate * (1 - step / (params.steps + 1))
        for w, g, m, v in zip(weights, grads, first, second):
            g = g * min(1.0, 0.5 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def plausible(kind: str, text: str) -> bool:
    """Whether a decoded span can be of its kind, by its digits."""
    digits = "".join(c for c in text if c in "0123456789")
    if kind == "email":
        return "@" in text and "." in text[text.index("@") :]
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


class Reader:
    """Decodes whole texts with a model, many windows at once."""

    def __init__(self, model: PiiModel, at_once: int = 256):
        self.model, self.at_once = model, at_once
        p = model.params
        near = np.minimum(np.arange(1, p.window + 1), np.arange(p.window, 0, -1))
        self.weight = near.astype(np.float64)

    def covered(self, text: str) -> list[tuple[int, int]]:
        """The parts of a text (start, end) that windows with a trigger cover, joined where they touch."""
        p = self.model.params
        out: list[tuple[int, int]] = []
        for m in TRIGGER.finditer(text):
            first = max(0, (m.start() - p.window) // p.stride + 1) * p.stride
            end = min(m.start() // p.stride * p.stride + p.window, len(text))
            if out and first <= out[-1][1]:
                out[-1] = out[-1][0], end
            else:
                out.append((first, end))
        return out

    def windows(self, start: int, end: int) -> range:
        """Starts, multiples of the stride, of all windows that overlap a part of a text."""
        p = self.model.params
        return range(max(0, (start - p.window) // p.stride + 1) * p.stride, end, p.stride)

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        runs = [(k, a, b) for k, text in enumerate(texts) for a, b in self.covered(text)]
        # A long run is decoded in stretches that overlap, so that memory doesn't grow with it.
        pieces = []
        for r, (_, a, b) in enumerate(runs):
            windows = self.windows(a, b)
            for i in range(0, len(windows), STRETCH):
                decided = windows[i] if i else a, windows[i + STRETCH] if i + STRETCH < len(windows) else b
                pieces.append((r, decided, windows[max(0, i - LAG) : i + STRETCH + LAG]))
        pieces.sort(key=lambda piece: len(piece[2]))
        tags = [np.zeros(b - a, np.int8) for _, a, b in runs]
        at = 0
        while at < len(pieces):
            some, size = [], 0
            while at < len(pieces) and (not some or size + len(pieces[at][2]) <= self.at_once):
                some.append(pieces[at])
                size += len(pieces[at][2])
                at += 1
            for (r, (first, end), windows), read in zip(some, self._decode(texts, [(*runs[r], windows) for r, _, windows in some])):
                zero, begin = runs[r][1], max(runs[r][1], windows[0])
                tags[r][first - zero : end - zero] = read[first - begin : end - begin]
        for (k, start, _), read in zip(runs, tags):
            found[k] += self._spans(texts[k], start, read)
        return found

    def _decode(self, texts, runs):
        """Tags of each (text, start, end, windows), from its first window on and to its last."""
        p, k = self.model.params, len(TAGS)
        windows = [(t, s) for t, _, _, starts in runs for s in starts]
        scores = np.zeros((p.window, len(windows), k), dtype=np.float32)
        codes = np.full((p.window, len(windows)), 96)
        for j, (t, s) in enumerate(windows):
            piece = symbols(texts[t][s : s + p.window])
            codes[: len(piece), j] = piece
        for a in range(0, len(windows), self.at_once):
            scores[:, a : a + self.at_once] = self.model.emissions(codes[:, a : a + self.at_once])[0]
        parts = [(max(a, starts[0]), min(b, starts[-1] + p.window)) for _, a, b, starts in runs]
        lengths = np.array([b - a for a, b in parts])
        # A window's length of room before and behind, for windows that begin before a part or end behind it.
        total = np.zeros((lengths.max() + 2 * p.window, len(runs), k))
        weight = np.zeros((lengths.max() + 2 * p.window, len(runs)))
        j = 0
        for r, (_, _, _, starts) in enumerate(runs):
            for s in starts:
                at = s - parts[r][0] + p.window
                total[at : at + p.window, r] += scores[:, j] * self.weight[:, None]
                weight[at : at + p.window, r] += self.weight
                j += 1
        inner = slice(p.window, p.window + lengths.max())
        mean = total[inner] / np.maximum(weight[inner], 1e-9)[:, :, None]
        # Beside a run stands a character that is outside, unless the text begins or ends there.
        for r, ((t, a, b, _), (first, end)) in enumerate(zip(runs, parts)):
            if first == a > 0:
                mean[0, r] += self.model.moves[0]
            if end == b < len(texts[t]):
                mean[end - first - 1, r] += self.model.moves[:, 0]
        return self.model.viterbi(mean, lengths)

    def _spans(self, text: str, offset: int, tags: np.ndarray):
        """Begin tags open a span, inside tags of its kind lengthen it."""
        out, here = [], np.flatnonzero(tags)
        kind, begin, end = None, 0, 0
        for i in here.tolist():
            name = KINDS[(tags[i] - 1) // 2]
            if kind == name and i == end and tags[i] % 2 == 0:
                end += 1
                continue
            if kind:
                out.append((kind, offset + begin, offset + end))
            kind, begin, end = name, i, i + 1
        if kind:
            out.append((kind, offset + begin, offset + end))
        return [(f"lstm_{n}", a, b) for n, a, b in out if TRIGGER.search(text, a, b) and plausible(n, text[a:b])]


ORDER = {k: i for i, k in enumerate((*KINDS, *(f"lstm_{k}" for k in KINDS)))}


def _reader_maker(docs: DataFrame, model: PiiModel):
    key = f"pii {zlib.crc32(b''.join(w.tobytes() for w in model.weights()))}"
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return lambda: kept(key, lambda: Reader(sent.value))


def all_spans(texts: list[str], reader: Reader) -> list[tuple[list, list]]:
    """For each text the pattern spans and all spans; a read span that touches one that
    a pattern found adds nothing."""
    out = []
    for text, read in zip(texts, reader.spans(texts)):
        base = base_spans(text)
        more = [s for s in read if not any(s[1] < b and a < s[2] for _, a, b in base)]
        out.append((base, sorted(base + more, key=lambda s: (ORDER[s[0]], s[1], s[2]))))
    return out


def find_pii(docs: DataFrame, model: PiiModel) -> DataFrame:
    """One row per document with the counts and places of personal data.

    A null or empty text has none: counts 0, an empty ``spans``.  Places are code
    points, the end exclusive.  Every row of ``docs`` gives a row, repeated ids too;
    other columns than doc_id and text are ignored.
    """
    get = _reader_maker(docs, model)

    def make():
        reader = get()

        def step(cols):
            out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
            for base, every in all_spans([t or "" for t in cols["text"]], reader):
                kinds = [k for k, _, _ in base]
                for kind in KINDS:
                    out[f"n_{kind}"].append(kinds.count(kind))
                out["base_sha256"].append(digest(base))
                out["spans"].append(joined(every))
            return out | {"doc_id": cols["doc_id"]}

        return step

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return map_batches(docs.select("doc_id", "text"), make, schema)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlaps count once."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.removeprefix('lstm_').upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: PiiModel) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; null texts stay null."""
    get = _reader_maker(docs, model)

    def make():
        reader = get()

        def step(cols):
            found = all_spans([t or "" for t in cols["text"]], reader)
            return cols | {"text": [t if t is None else redacted(t, every) for t, (_, every) in zip(cols["text"], found)]}

        return step

    return map_batches(docs, make, docs.schema)
