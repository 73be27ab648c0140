"""Language identification by a bidirectional gated recurrent network over bytes.

The network labels every byte of a text: one recurrent layer reads forwards, one backwards,
and both states at a position give the probabilities of the languages there. A document's
probabilities are the mean over the positions of its letters. It is trained here in numpy by
backpropagation through time, on windows of ``STEPS`` bytes drawn from a bounded sample
(``PER_LANGUAGE`` documents of each language, drawn by hash, outside the held-out fold).

Texts are read whole, in windows of ``STEPS`` bytes that all advance together, so a step is a
few matrix operations on thousands of windows.

Defined results: a null text, or one without a letter, is ``und`` with score 0; a text is read
as UTF-8 bytes whatever it holds; without any labelled document all texts are ``und`` with
score 0; if only one language is known, everything with a letter is that language; repeated
rows give repeated results; columns other than ``doc_id``, ``text`` and ``lang`` are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import documents, fold, prepare, stage, text_bytes

PER_LANGUAGE = 250
HIDDEN = 8
STEPS = 64
BATCH = 256
ROUNDS = 300
DRAWN_IN = 16
AT_ONCE = 4096
LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
UNKNOWN = "und"


class Layer:
    """A gated recurrent layer over bytes; matrices have one column per hidden unit's gate."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.byte = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.state = rng.normal(0, 0.3, (hidden, 3 * hidden)).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.byte, self.state]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 6):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.layers = [Layer(hidden, rng), Layer(hidden, rng)]
        self.out = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [p for layer in self.layers for p in layer.parameters()] + [self.out, self.bias]

    def learn_from(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy over all positions; x is (steps, windows)."""
        steps, n = x.shape
        h_size = self.hidden
        states, tapes = [], []
        for layer, order in zip(self.layers, (range(steps), range(steps - 1, -1, -1))):
            h = np.zeros((n, h_size), np.float32)
            all_h, tape = np.zeros((steps, n, h_size), np.float32), {}
            for t in order:
                a, b = layer.byte[x[t]], h @ layer.state
                z = sigmoid(a[:, :h_size] + b[:, :h_size])
                r = sigmoid(a[:, h_size : 2 * h_size] + b[:, h_size : 2 * h_size])
                c = np.tanh(a[:, 2 * h_size :] + r * b[:, 2 * h_size :])
                tape[t] = (h, z, r, c, b[:, 2 * h_size :])
                h = h + z * (c - h)
                all_h[t] = h
            states.append(all_h)
            tapes.append(tape)
        both = np.concatenate(states, axis=2)
        logits = both @ self.out + self.bias
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(n), y] -= 1
        p *= (weight / max(weight.sum(), 1))[:, :, None]
        g_out = np.einsum("tnh,tnl->hl", both, p)
        d_both = p @ self.out.T
        grads = []
        for k, (layer, tape) in enumerate(zip(self.layers, tapes)):
            d_states = d_both[:, :, k * h_size : (k + 1) * h_size]
            g_byte, g_state = np.zeros_like(layer.byte), np.zeros_like(layer.state)
            d_h = np.zeros((n, h_size), np.float32)
            order = range(steps - 1, -1, -1) if k == 0 else range(steps)
            for t in order:
                h, z, r, c, b_c = tape[t]
                d_h = d_h + d_states[t]
                d_z = d_h * (c - h) * z * (1 - z)
                d_c = d_h * z * (1 - c * c)
                d_r = d_c * b_c * r * (1 - r)
                d_a = np.concatenate([d_z, d_r, d_c], axis=1)
                d_b = np.concatenate([d_z, d_r, d_c * r], axis=1)
                np.add.at(g_byte, x[t], d_a)
                g_state += h.T @ d_b
                d_h = d_h * (1 - z) + d_b @ layer.state.T
            grads += [g_byte, g_state]
        return [*grads, g_out, p.sum(axis=(0, 1))]

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int, batch: int, seed: int, rate: float = 0.02):
        """Adam on random batches of the windows ``x`` (windows, steps) with languages ``y``."""
        rng = np.random.default_rng(seed)
        m = [np.zeros_like(p) for p in self.parameters()]
        v = [np.zeros_like(p) for p in self.parameters()]
        for step in range(1, rounds + 1):
            at = rng.integers(0, len(x), batch)
            own = np.ascontiguousarray(x[at].T)
            grads = self.learn_from(own, y[at], LETTER[own].astype(np.float32))
            scale = rate * (1 - step / (rounds + 1))
            for p, g, a, b in zip(self.parameters(), grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= scale * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Sums of the positions' probabilities over the letters of each window (steps, windows).

        Arrays here are (units, windows): gates are then whole rows, and every operation runs
        over contiguous memory.
        """
        steps, n = x.shape
        k = self.hidden
        states = [np.empty((steps, k, n), np.float32) for _ in self.layers]
        for layer, own, order in zip(self.layers, states, (range(steps), range(steps - 1, -1, -1))):
            half = np.concatenate([np.full(2 * k, 0.5), np.ones(k)]).astype(np.float32)
            byte = np.ascontiguousarray((layer.byte * half).T)
            state = np.ascontiguousarray((layer.state * half).T)
            h = np.zeros((k, n), np.float32)
            for t in order:
                a = byte.take(x[t], axis=1)
                b = state @ h
                gates = a[: 2 * k]
                gates += b[: 2 * k]
                np.tanh(gates, out=gates)
                gates *= 0.5
                gates += 0.5
                c = b[2 * k :]
                c *= gates[k:]
                c += a[2 * k :]
                np.tanh(c, out=c)
                c -= h
                c *= gates[:k]
                c += h
                own[t] = h = c
        total = np.zeros((len(self.languages), n), np.float32)
        out = np.ascontiguousarray(self.out.T)
        for t in range(steps):
            p = out[:, :k] @ states[0][t]
            p += out[:, k:] @ states[1][t]
            p += self.bias[:, None]
            np.exp(p, out=p)
            p *= LETTER[x[t]] / p.sum(axis=0)
            total += p
        return total.T


def windows(texts: list[bytes], steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in windows (windows, steps), the last of a text filled up with spaces, and
    the number of windows of each text."""
    counts = np.array([-(-len(t) // steps) for t in texts], np.int64)
    data = b"".join(t + b" " * (-len(t) % steps) for t in texts)
    return np.frombuffer(data, np.uint8).reshape(-1, steps), counts


def sample_of(docs: DataFrame, per_language: int, folds: int = 5, left_out: int = 0) -> DataFrame:
    """``lang, data`` of at most ``per_language`` documents of each language."""
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & (fold(folds) != left_out)).distinct()
    known = known.withColumn("part", F.pmod(F.xxhash64("doc_id", "lang"), F.lit(DRAWN_IN)))
    for group in (["lang", "part"], ["lang"]):  # the first of each part hold the first of all
        order = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id")
        known = known.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language)
    drawn = stage(known.select("doc_id", "lang"), "drawn_lang")
    texts = docs.select("doc_id", text_bytes().alias("data")).where(F.octet_length("data") > 0)
    return texts.join(F.broadcast(drawn), "doc_id")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, per_text: int = 32) -> Network | None:
    """Learns from ``lang`` outside the held-out fold; None if nothing is labelled.

    ``per_text`` bounds the windows one document contributes, spread over the whole text.
    """
    prepare(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                x, _ = windows([text.as_py()])
                at = np.unique(np.linspace(0, len(x) - 1, min(per_text, len(x))).astype(np.int64))
                rows.append(x[at].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["lang", "x"])

    sample = sample_of(docs, per_language).select("lang", "data")
    rows = sample.mapInArrow(cut, "lang string, x binary").toArrow()
    labels, cells = rows.column("lang").to_pylist(), rows.column("x").to_pylist()
    languages = sorted(set(labels))
    if not languages:
        return None
    order = sorted(range(len(cells)), key=lambda i: (labels[i], cells[i]))  # whatever came first
    x = np.frombuffer(b"".join(cells[i] for i in order), np.uint8).reshape(-1, STEPS)
    y = np.repeat([languages.index(labels[i]) for i in order], [len(cells[i]) // STEPS for i in order])
    # Languages count alike, however many windows they have.
    rng = np.random.default_rng(5)
    most = np.bincount(y).max()
    even = np.concatenate([rng.choice(np.flatnonzero(y == k), most) for k in range(len(languages))])
    network = Network(languages)
    if len(languages) > 1:
        network.fit(x[even], y[even], ROUNDS, BATCH, seed=7)
    return network


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id, lang_pred, score``."""
    prepare(docs.sparkSession)

    def probabilities(texts: list[bytes]) -> np.ndarray:
        x, counts = windows(texts)
        sums = [network.pooled(np.ascontiguousarray(x[i : i + AT_ONCE].T)) for i in range(0, len(x), AT_ONCE)]
        sums = np.concatenate([*sums, np.zeros((1, len(network.languages)))]).astype(np.float64)
        total = np.cumsum(np.concatenate([np.zeros((1, sums.shape[1])), sums]), axis=0)
        ends = np.cumsum(counts)
        p = total[ends] - total[ends - counts]
        return p / np.maximum(p.sum(axis=1, keepdims=True), 1e-9)

    def has_letter(data: bytes) -> bool:
        text = data.translate(None, delete=_NO_LETTERS)
        if not text or text[0] < 128:
            return bool(text)
        if min(text) < 128:
            return True
        return any(c.isalpha() for c in data.decode(errors="ignore"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for texts in lots(batch.column(1)):
                if network is None:
                    names += [UNKNOWN] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                p = probabilities(texts)
                for text, best, score in zip(texts, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    known = has_letter(text)
                    names.append(network.languages[best] if known else UNKNOWN)
                    scores.append(score if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    columns = documents(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), text_bytes().alias("data")
    )
    return columns.mapInArrow(run, "doc_id long, lang_pred string, score double")


_NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())


def lots(column) -> Iterator[list[bytes]]:
    """The texts in lots of about a full step of windows."""
    lot, size = [], 0
    for cell in column:
        lot.append(cell.as_py())
        size += len(lot[-1])
        if size >= AT_ONCE * STEPS:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def op6_recurrent_language(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs, train(docs))
    return found.select(
        "doc_id",
        F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
