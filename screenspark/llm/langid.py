"""Operator 10: language identification by a bidirectional gated recurrent network.

The network reads the bytes of a text in small letters and labels every position with
probabilities of the languages; a document's probabilities are their mean over all its
positions.  A text is read in windows that overlap: each position is labelled by the window
in which it has most bytes on either side, so that both directions have read the words
around it when they come there.

It is trained in numpy by backpropagation through time, with Adam.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.llm.common import bucket_of, has_letter, kept, map_batches, sample_per_class


@dataclass(frozen=True)
class LangParams:
    """``per_language`` and ``longest`` bound the documents learned from, and their
    characters; ``window``: bytes that are read at once, of which ``context`` at either end
    are labelled by the windows before and after."""

    per_language: int = 150
    longest: int = 20_000
    hidden: int = 8
    window: int = 256
    context: int = 16
    steps: int = 400
    batch: int = 128
    taught: int = 80
    rate: float = 0.02
    seed: int = 10


def read_bytes(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def by_time(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of some windows, time x window; after a window's end anything."""
    at = starts[None, :] + np.arange(lengths.max())[:, None]
    return raw[np.minimum(at, len(raw) - 1)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Direction:
    """One gated recurrent layer over bytes; ``x`` holds the input's part by byte.

    Windows are in the order of their lengths: those that have a byte at time t are the
    last ones, from ``live[t]`` on.
    """

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.h = hidden
        self.x = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.u = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)

    def forward(self, codes: np.ndarray, live: list[int], order, trace: list | None = None) -> np.ndarray:
        """The states, time x window x hidden; ``trace`` takes what ``backward`` needs."""
        h = self.h
        state = np.zeros((codes.shape[1], h), dtype=np.float32)
        out = np.zeros((*codes.shape, h), dtype=np.float32)
        for t in order:
            k = live[t]
            before = state[k:]
            a, b = self.x[codes[t, k:]], before @ self.u
            gates = sigmoid(a[:, : 2 * h] + b[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            fresh = np.tanh(a[:, 2 * h :] + r * b[:, 2 * h :])
            new = fresh + z * (before - fresh)
            if trace is not None:
                trace.append((t, k, before.copy(), z, r, fresh, b[:, 2 * h :]))
            state[k:] = out[t, k:] = new
        return out

    def backward(self, codes: np.ndarray, back: np.ndarray, trace: list) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``x`` and ``u`` from those of the states, back through time."""
        gu = np.zeros_like(self.u)
        seen, given = [], []
        flow = np.zeros_like(back[0])
        for t, k, before, z, r, fresh, b_new in reversed(trace):
            live = flow[k:] + back[t, k:]
            d_fresh = live * (1 - z) * (1 - fresh * fresh)
            d_z = live * (before - fresh) * z * (1 - z)
            d_r = d_fresh * b_new * r * (1 - r)
            d_b = np.concatenate([d_z, d_r, d_fresh * r], axis=1)
            seen.append(codes[t, k:])
            given.append(np.concatenate([d_z, d_r, d_fresh], axis=1))
            gu += before.T @ d_b
            flow[k:] = live * z + d_b @ self.u.T
        codes, given = np.concatenate(seen), np.concatenate(given)
        gx = np.stack([np.bincount(codes, weights=g, minlength=256) for g in given.T], axis=1)
        return gx.astype(np.float32), gu


def live_from(lengths: np.ndarray) -> list[int]:
    """By time, the first of the windows (in order of length) that reach it."""
    return np.searchsorted(lengths, np.arange(lengths.max()), side="right").tolist()


@dataclass
class LangModel:
    languages: list[str]
    params: LangParams
    ahead: Direction
    behind: Direction
    out: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.x, self.ahead.u, self.behind.x, self.behind.u, self.out, self.bias]

    def states(self, codes: np.ndarray, lengths: np.ndarray, traces: tuple[list | None, list | None] = (None, None)) -> np.ndarray:
        live, steps = live_from(lengths), range(len(codes))
        return np.concatenate([self.ahead.forward(codes, live, steps, traces[0]), self.behind.forward(codes, live, reversed(steps), traces[1])], axis=2)

    def label_positions(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities of the languages, time x window x language."""
        return softmax(self.states(codes, lengths) @ self.out + self.bias)

    def gradients(self, codes: np.ndarray, lengths: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients."""
        ahead, behind = [], []
        states = self.states(codes, lengths, (ahead, behind))
        p = softmax(states @ self.out + self.bias)
        mask, n = np.arange(len(codes))[:, None] < lengths, lengths.sum()
        columns = np.arange(len(target))
        loss = -np.log(p[:, columns, target] + 1e-9)[mask].sum() / n
        p[:, columns, target] -= 1
        p = np.where(mask[:, :, None], p / n, 0).astype(np.float32)
        h = self.params.hidden
        back = p @ self.out.T
        g_out = states.reshape(-1, 2 * h).T @ p.reshape(-1, p.shape[2])
        fx, fu = self.ahead.backward(codes, back[:, :, :h], ahead)
        bx, bu = self.behind.backward(codes, back[:, :, h:], behind)
        return float(loss), [fx, fu, bx, bu, g_out, p.sum(axis=(0, 1))]

    def pooled(self, texts: list[bytes], at_once: int = 2048) -> np.ndarray:
        """By text, the mean over all its positions of the probabilities; 0 for an empty one."""
        p = self.params
        total = np.zeros((len(texts), len(self.languages)))
        size = np.array([len(t) for t in texts], dtype=np.int64)
        if not size.sum():
            return total
        raw, first = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum(size) - size
        core = p.window - 2 * p.context
        count = -(-size // core)
        owner = np.repeat(np.arange(len(texts)), count)
        at = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * core
        start, end = np.maximum(at - p.context, 0), np.minimum(at + core + p.context, size[owner])
        order = np.argsort(end - start, kind="stable")
        for some in np.array_split(order, -(-len(order) // at_once)):
            lengths = (end - start)[some]
            positions = self.label_positions(by_time(raw, first[owner[some]] + start[some], lengths), lengths)
            place = start[some][None, :] + np.arange(len(positions))[:, None]
            own = (place >= at[some]) & (place < np.minimum(at[some] + core, size[owner[some]]))
            np.add.at(total, owner[some], (positions * own[:, :, None]).sum(axis=0, dtype=np.float64))
        return total / np.maximum(size, 1)[:, None]


def new_model(languages: list[str], params: LangParams) -> LangModel:
    rng = np.random.default_rng(params.seed)
    out = rng.normal(0, 0.1, (2 * params.hidden, len(languages))).astype(np.float32)
    return LangModel(languages, params, Direction(params.hidden, rng), Direction(params.hidden, rng), out, np.zeros(len(languages), dtype=np.float32))


def train(texts: list[str], langs: list[str], params: LangParams = LangParams()) -> LangModel:
    """Learn from windows of the texts, as many of each language, cut at any byte."""
    rng = np.random.default_rng(params.seed)
    languages = sorted(set(langs))
    model = new_model(languages, params)
    pools = [np.frombuffer(b"".join(read_bytes(t) + b" " for t, x in zip(texts, langs) if x == lang), dtype=np.uint8) for lang in languages]
    if len(pools) < 2:
        return model
    raw, size = np.concatenate(pools), np.array([len(p) for p in pools])
    first = np.cumsum(size) - size
    weights = model.weights()
    one, two = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, params.steps + 1):
        target = rng.integers(len(pools), size=params.batch)
        lengths = np.sort(np.minimum(rng.integers(8, params.taught + 1, size=params.batch), size[target].min()))
        starts = first[target] + (rng.random(params.batch) * (size[target] - lengths + 1)).astype(np.int64)
        _, grads = model.gradients(by_time(raw, starts, lengths), lengths, target)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = params.rate * (1 - step / (params.steps + 1))
        for w, g, m, v in zip(weights, grads, one, two):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, params: LangParams = LangParams(), hold_out: bool = True) -> LangModel:
    """Fit on at most ``per_language`` documents of each language, of at most ``longest``
    characters each.

    With ``hold_out`` rows whose crc32(doc_id) mod 5 is 0 are never learned from.  Rows
    without id, language or letters teach nothing.
    """
    known = docs.select("doc_id", "text", "lang").filter("doc_id IS NOT NULL AND lang IS NOT NULL AND length(trim(text)) > 0")
    known = known.filter(F.length("text") <= params.longest)
    if hold_out:
        known = known.filter(bucket_of("doc_id", 5) != 0)
    ids = sample_per_class(known.select("doc_id", "lang"), "doc_id", "lang", params.per_language)
    rows = known.join(F.broadcast(ids.distinct()), ["doc_id", "lang"])
    rows = [r for r in sample_per_class(rows, "doc_id", "lang", params.per_language).orderBy("doc_id", "lang", "text").collect() if has_letter(r.text)]
    return train([r.text for r in rows], [r.lang for r in rows], params)


def predict(docs: DataFrame, model: LangModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``, other columns ignored.

    ``score`` is the mean probability of the predicted language over all positions.  A
    text that is null or has no letter gives ``und`` with score 0, as does a model that
    has seen no language; of equal probabilities the first language in order is taken.
    """
    key = "langid %d" % (zlib.crc32(b"".join(w.tobytes() for w in model.weights())))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        reader = kept(key, lambda: sent.value)
        names = reader.languages

        def step(cols):
            out = {"doc_id": cols["doc_id"], "lang_pred": [], "score": []}
            readable = [bool(names) and bool(t) and has_letter(t) for t in cols["text"]]
            means = reader.pooled([read_bytes(t) if ok else b"" for t, ok in zip(cols["text"], readable)]) if names else []
            for k, ok in enumerate(readable):
                best = int(np.argmax(means[k])) if ok else 0
                out["lang_pred"].append(names[best] if ok else "und")
                out["score"].append(min(1.0, float(means[k][best])) if ok else 0.0)
            return out

        return step

    return map_batches(docs.select("doc_id", "text"), make, "doc_id bigint, lang_pred string, score double")
