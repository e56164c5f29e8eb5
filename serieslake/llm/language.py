"""Language of texts by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a text's bytes forwards and backwards; a softmax over both states
labels every position, and a document's probabilities are the mean over its positions.  The network
is trained in numpy by backpropagation through time on windows of a bounded labelled sample, of all languages; its size and training
grow with their number.  To run many
positions at once, a text is read in windows of ``WINDOW`` bytes, each entered ``LEAD`` bytes early in
either direction, so every byte of the whole text is read and labelled exactly once.

A text that is null or has no letter is ``und`` with score 0.  Null languages are not learnt from; if
none is left, all texts are ``und``.  Repeated rows are labelled each.  Other columns are not read by
``predict`` and kept by ``keep_identified``.  Ties fall to the language first in order.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.llm.common import crc32_of, on_batches, portions, texts_of

HELD_OUT = (4, 2)  # a row is held out if the crc32 of its id leaves this remainder
WINDOW, LEAD = 240, 16
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_PAD = 256  # the byte outside a text


class Network(NamedTuple):
    """Per direction: byte tables for update, reset and candidate, and their recurrent weights."""

    tables: np.ndarray  # 2 x 3 x 257 x hidden
    recurrent: np.ndarray  # 2 x 3 x hidden x hidden
    output: np.ndarray  # 2 x hidden x languages
    bias: np.ndarray  # languages

    @classmethod
    def random(cls, hidden: int, languages: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        tables = rng.normal(0, 0.3, (2, 3, 257, hidden))
        tables[:, 0] -= 1.0  # states change slowly at first
        made = (tables, rng.normal(0, hidden**-0.5, (2, 3, hidden, hidden)), rng.normal(0, 0.3, (2, hidden, languages)), np.zeros(languages))
        return cls(*(a.astype(np.float32) for a in made))


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(x * 0.25 + 0.5, 0, 1)


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def forward(net: Network, windows: np.ndarray) -> tuple[np.ndarray, list]:
    """States of both directions at every step, and what backpropagation needs.  windows: steps x rows."""
    steps, rows = windows.shape
    hidden = net.recurrent.shape[-1]
    states = np.zeros((2, steps, rows, hidden), np.float32)
    trace = []
    for side in (0, 1):
        h = np.zeros((rows, hidden), np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            x = windows[t]
            update = _gate(net.tables[side, 0][x] + h @ net.recurrent[side, 0])
            reset = _gate(net.tables[side, 1][x] + h @ net.recurrent[side, 1])
            inner = h @ net.recurrent[side, 2]
            candidate = _squash(net.tables[side, 2][x] + reset * inner)
            trace.append((side, t, h, update, reset, inner, candidate))
            h = h + update * (candidate - h)
            states[side, t] = h
    return states, trace


def _softmax(logits: np.ndarray) -> np.ndarray:
    made = np.exp(logits - logits.max(-1, keepdims=True))
    return made / made.sum(-1, keepdims=True)


def gradients(net: Network, windows: np.ndarray, label: np.ndarray, counted: np.ndarray) -> tuple[float, Network]:
    """Mean cross-entropy over the counted positions, and its gradient through time."""
    states, trace = forward(net, windows)
    logits = states[0] @ net.output[0] + states[1] @ net.output[1] + net.bias
    chance = _softmax(logits)
    rows = np.arange(windows.shape[1])
    total = counted.sum()
    loss = -(np.log(chance[:, rows, label] + 1e-9) * counted).sum() / total
    slope = chance * counted[..., None]
    slope[:, rows, label] -= counted
    slope /= total
    grown = Network(*(np.zeros_like(a) for a in net))
    grown.bias[:] = slope.sum((0, 1))
    for side in (0, 1):
        grown.output[side] = np.einsum("trh,trc->hc", states[side], slope)
    carried = {}
    for side, t, h, update, reset, inner, candidate in reversed(trace):
        d = slope[t] @ net.output[side].T + carried.get(side, 0)
        d_update = d * (candidate - h) * 0.25 * ((update > 0) & (update < 1))
        d_candidate = d * update * (1 - np.abs(candidate)) ** 2
        d_reset = d_candidate * inner * 0.25 * ((reset > 0) & (reset < 1))
        d_inner = d_candidate * reset
        for gate, change, to_h in ((0, d_update, d_update), (1, d_reset, d_reset), (2, d_candidate, d_inner)):
            np.add.at(grown.tables[side, gate], windows[t], change)
            grown.recurrent[side, gate] += h.T @ to_h
        carried[side] = d * (1 - update) + d_update @ net.recurrent[side, 0].T + d_reset @ net.recurrent[side, 1].T + d_inner @ net.recurrent[side, 2].T
    return float(loss), grown


def train(texts: list[str], label: np.ndarray, languages: int, hidden: int = 8, steps: int = 450, batch: int = 128, rate: float = 0.02, seed: int = 3) -> Network:
    """Adam over ``steps`` batches of random windows, as many of each language."""
    rng = np.random.default_rng(seed)
    net = Network.random(hidden, languages, seed)
    data = [np.frombuffer(text.encode(), np.uint8) for text in texts]
    of = [rows for rows in (np.flatnonzero(label == k) for k in range(languages)) if len(rows)]
    longest = 64
    first, second = [np.zeros_like(a) for a in net], [np.zeros_like(a) for a in net]
    for step in range(1, steps + 1):
        rows = np.array([rng.choice(of[k % len(of)]) for k in range(batch)])
        windows = np.full((longest, batch), _PAD, np.int64)
        for k, i in enumerate(rows):
            at = rng.integers(0, max(1, len(data[i]) - longest + 1))
            piece = data[i][at : at + rng.integers(6, longest + 1)]  # short texts must be told apart as well
            windows[: len(piece), k] = piece
        _, slope = gradients(net, windows, label[rows], (windows != _PAD).astype(np.float32))
        pace = rate * (1 - (step - 1) / steps)
        for a, g, m, v in zip(net, slope, first, second, strict=True):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


class Reader:
    """Runs a trained network with its gates' scale folded into the weights."""

    def __init__(self, net: Network) -> None:
        gates = np.array([0.25, 0.25, 1], np.float32)[:, None, None]
        self.tables = np.ascontiguousarray(net.tables * gates + np.array([0.5, 0.5, 0], np.float32)[:, None, None])
        self.recurrent = np.ascontiguousarray(net.recurrent * gates)
        self.output, self.bias = net.output, net.bias

    def _step(self, side: int, x: np.ndarray, h: np.ndarray) -> None:
        """One byte of every window; ``h`` changes in place."""
        update, reset, candidate = (table.take(x, 0) for table in self.tables[side])
        u, r, c = self.recurrent[side]
        update += h @ u
        reset += h @ r
        np.clip(update, 0, 1, out=update)
        np.clip(reset, 0, 1, out=reset)
        reset *= h @ c
        candidate += reset
        np.abs(candidate, out=reset)
        reset += 1
        candidate /= reset
        candidate -= h
        candidate *= update
        h += candidate

    def windows(self, windows: np.ndarray) -> np.ndarray:
        """Summed probabilities over the inner positions of each window (LEAD + WINDOW + LEAD bytes)."""
        rows, hidden = windows.shape[1], self.output.shape[1]
        ahead = np.empty((WINDOW, rows, hidden), np.float32)
        h = np.zeros((rows, hidden), np.float32)
        for t in range(LEAD + WINDOW):
            self._step(0, windows[t], h)
            if t >= LEAD:
                ahead[t - LEAD] = h
        h[:] = 0
        total = np.zeros((rows, len(self.bias)), np.float32)
        for t in range(LEAD + WINDOW + LEAD - 1, LEAD - 1, -1):
            self._step(1, windows[t], h)
            if t < LEAD + WINDOW:
                logits = ahead[t - LEAD] @ self.output[0]
                logits += h @ self.output[1]
                logits += self.bias
                np.clip(logits, -30, 30, out=logits)
                np.exp(logits, out=logits)
                logits *= (windows[t] != _PAD)[:, None] / (logits @ np.ones(logits.shape[1], np.float32))[:, None]
                total += logits
        return total

    def probabilities(self, texts: list[str], most: int = 4096) -> np.ndarray:
        """Mean position probabilities of each text; zeros where there is no byte."""
        out = np.zeros((len(texts), len(self.bias)))
        for start, stop in portions(texts, most * WINDOW // 2):
            data = [text.encode() for text in texts[start:stop]]
            lengths = np.fromiter(map(len, data), np.int64, len(data))
            pad = np.full(LEAD, _PAD, np.int16)
            # Texts stand in one array, each at a multiple of WINDOW and so far apart that windows see padding.
            slots = -(-lengths // WINDOW) + 1
            begins = (np.cumsum(slots) - slots) * WINDOW
            stream = np.full(int(slots.sum()) * WINDOW, _PAD, np.int16)
            joined = np.frombuffer(b"".join(data), np.uint8)
            offsets = np.cumsum(lengths) - lengths
            stream[np.arange(len(joined)) + np.repeat(begins - offsets, lengths)] = joined
            stream = np.concatenate([pad, stream, pad])
            owner = np.repeat(np.arange(len(data)), slots - 1)
            heads = begins[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(slots - 1) - (slots - 1), slots - 1)) * WINDOW
            sums = np.zeros((len(data), len(self.bias)))
            views = np.lib.stride_tricks.sliding_window_view(stream, LEAD + WINDOW + LEAD)
            for a in range(0, len(heads), most):
                piece = np.ascontiguousarray(views[heads[a : a + most]].T)
                np.add.at(sums, owner[a : a + most], self.windows(piece))
            out[start:stop] = sums / np.maximum(lengths, 1)[:, None]
        return out


class Model(NamedTuple):
    net: Network | None
    languages: list[str]


def held_out() -> Column:
    return crc32_of("doc_id") % HELD_OUT[0] == HELD_OUT[1]


def sizes(languages: int) -> dict[str, int]:
    """Hidden states, steps and rows of a batch; more languages need a larger network and a longer training."""
    doublings = max(2, math.ceil(math.log2(max(languages, 1))))
    return {"hidden": 4 * doublings, "steps": 225 * doublings, "batch": max(128, min(512, 2 * languages))}


def least_probability(model: Model) -> float:
    """Below this a text's language is uncertain: a fifth above an even guess, 0.3 at most."""
    return min(0.3, 1.2 / max(1, len(model.languages)))


def sample(docs: DataFrame, per_language: int, most_texts: int, characters: int) -> list:
    """key, lang, text of the learnable texts with the smallest keys of each language.

    A text's key is a hash, so a language's share of keys below a threshold follows from its count: only those
    few leave the scan, and the smallest key always.
    """
    key = F.xxhash64("doc_id", "text")
    usable = docs.select("doc_id", "text", "lang").filter(~held_out()).filter("lang is not null and text is not null and text <> ''").withColumn("key", key)
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("key").alias("least"))
    found = counts.count()  # languages
    if not found:
        return []
    each = min(per_language, max(1, most_texts // found))
    share = F.least(F.lit(1.0), (1.5 * each + 20) / F.col("n"))
    below = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise((F.lit(-(2.0**63)) + share * 2.0**64).cast("long"))
    limits = counts.select("lang", F.greatest(below, F.col("least")).alias("below"))  # a row per language
    middle = F.greatest(F.lit(1), ((F.length("text") - characters) / 2).cast("int"))
    few = usable.join(F.broadcast(limits), "lang").filter(F.col("key") <= F.col("below"))
    rows = few.select("key", "lang", F.substring("text", middle, F.lit(characters)).alias("text")).dropDuplicates(["key", "lang"]).collect()
    kept: dict[str, int] = defaultdict(int)
    made = []
    for row in sorted(rows, key=lambda row: (row.key, row.lang)):
        kept[row.lang] += 1
        if kept[row.lang] <= each:
            made.append(row)
    return made


def fit(docs: DataFrame, per_language: int = 1200, characters: int = 1024, most_texts: int = 24_000, **training: int) -> Model:
    """Train on a bounded sample of the texts that may be learnt from, of every language.

    It holds up to ``per_language`` texts of each, ``most_texts`` in all unless there are more languages (then one of each).
    Of each such text a stretch of ``characters`` from its middle is used; prediction reads whole texts.
    """
    rows = sample(docs, per_language, most_texts, characters)
    languages = sorted({row.lang for row in rows})
    if not languages:
        return Model(None, [])
    place = {name: k for k, name in enumerate(languages)}
    label = np.array([place[row.lang] for row in rows])
    return Model(train([row.text for row in rows], label, len(languages), **(sizes(len(languages)) | training)), languages)


def label_texts(model: Model, reader: Reader | None, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The language and its probability for each text."""
    if reader is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    chance = reader.probabilities(texts)
    best = chance.argmax(1)
    lettered = np.fromiter((_LETTER.search(text) is not None for text in texts), bool, len(texts))
    names = [model.languages[k] if found else UNKNOWN for k, found in zip(best, lettered, strict=True)]
    return names, np.where(lettered, np.clip(chance.max(1), 0, 1), 0.0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs(doc_id, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value.net) if sent.value.net else None
        for batch in batches:
            names, score = label_texts(sent.value, reader, texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    made = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return made.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` with a recognized language of at least that probability, with all columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    reader: list[Reader | None] = []

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not reader:
            reader.append(Reader(sent.value.net) if sent.value.net else None)
        names, score = label_texts(sent.value, reader[0], texts_of(batch))
        return batch.filter(pa.array([name != UNKNOWN and s >= least for name, s in zip(names, score, strict=True)], pa.bool_()))

    return on_batches(docs, make, docs.schema)
