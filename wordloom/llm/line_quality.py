"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's score comes from its own shape and the shapes of
the lines before and after it; neighbouring labels are tied by transition weights. Forward and
backward sums give each line's marginal probability of being good, and a document's quality is
their mean, weighted by the lines' lengths, brought to the scale of the labels by a logistic
curve. The labels mark documents; while learning, every line bears its document's label.

The sample to learn from is bounded (``PER_CLASS`` documents of each label, outside the
held-out fold, in stretches of at most ``STRETCH`` lines); scores cover all lines of all
documents.

Defined results: a null or empty text is one empty line; a document whose lines are all empty
is scored likewise; without labels of both kinds every score is 0.5; repeated rows give
repeated results; columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import documents, fold, prepare, text_bytes
from wordloom.llm.samples import labelled_sample

PER_CLASS = 2000
STRETCH = 64
AT_ONCE = 1 << 20


def _table(members: str) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[[ord(c) for c in members]] = 1
    return table


_ASCII = [chr(i) for i in range(128)]
KINDS = [
    _table("".join(c for c in _ASCII if c.isupper())),
    _table("".join(c for c in _ASCII if c.islower())) | (np.arange(256) >= 128),
    _table("0123456789"),
    _table(".,;:'\"-()?"),
    _table("!"),
    _table("|"),
    _table("#$%&*@^~_=+<>/\\[]{}`"),
    _table(" \t\r\v\f"),
]
SHAPES = len(KINDS) + 6
FEATURES = 3 * SHAPES + 1


def line_shapes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shapes of all lines of some texts, the lines' lengths, and each text's first line.

    ``data`` holds the texts one after the other, each followed by a line break; ``ends`` are
    the places of those last breaks.
    """
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], breaks[:-1] + 1])
    size = breaks - starts
    counts = np.stack([np.add.reduceat(kind[data], starts) for kind in KINDS], axis=1)
    blank = KINDS[-1][data].astype(bool) | (data == 10)
    begin = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    stop = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    line = np.searchsorted(starts, begin, "right") - 1
    words = np.bincount(line, minlength=len(starts))
    # A word's first eight bytes and length tell it from its neighbour well enough.
    long = stop - begin
    head = np.ndarray((len(data),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))[begin]
    keep = np.minimum(long, 8).astype(np.uint64) * np.uint64(8)
    head = np.where(long >= 8, head, head & ((np.uint64(1) << (keep % np.uint64(64))) - np.uint64(1)))
    same = (head[1:] == head[:-1]) & (long[1:] == long[:-1])
    repeats = np.bincount(line[1:][same], minlength=len(starts))
    full = np.maximum(size, 1)[:, None]
    some = np.maximum(words, 1)
    last = data[np.maximum(breaks - 1, 0)]
    shape = np.concatenate(
        [
            counts / full,
            (repeats / some)[:, None],
            np.minimum(size / np.maximum(words, 1) / 20, 2)[:, None],
            np.minimum(np.log1p(size) / 8, 2)[:, None],
            (size == 0)[:, None],
            (np.isin(last, [46, 63]) & (size > 0))[:, None],
            np.minimum(np.log1p(words) / 6, 2)[:, None],
        ],
        axis=1,
    )
    first = np.concatenate([[0], np.searchsorted(breaks, ends)[:-1] + 1])
    return shape, size, first


def with_neighbours(shape: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own shape, that of the line before and after (nothing beyond the text), and 1."""
    before, after = np.zeros_like(shape), np.zeros_like(shape)
    before[1:], after[:-1] = shape[:-1], shape[1:]
    before[first] = 0
    after[np.append(first[1:], len(shape)) - 1] = 0
    return np.concatenate([shape, before, after, np.ones((len(shape), 1))], axis=1)


def marginals(unary: np.ndarray, transition: np.ndarray, first: np.ndarray, count: np.ndarray):
    """P(good) per line, log partition per sequence, and expected transitions.

    ``unary`` are scores (lines, 2) of the labels bad and good; sequences begin at ``first``.
    All sequences advance together, longest first, so that those at work are always in front.
    """
    order = np.argsort(-count, kind="stable")
    at, n = first[order], count[order]
    steps = int(n.max(initial=0))
    active = np.searchsorted(-n, -np.arange(steps), "left")  # sequences longer than t
    forward, backward = np.empty_like(unary), np.zeros_like(unary)
    forward[at] = unary[at]
    for t in range(1, steps):
        i = at[: active[t]] + t
        forward[i] = np.logaddexp.reduce(forward[i - 1][:, :, None] + transition, axis=1) + unary[i]
    for t in range(steps - 1, 0, -1):
        i = at[: active[t]] + t
        backward[i - 1] = np.logaddexp.reduce((backward[i] + unary[i])[:, None, :] + transition, axis=2)
    total = np.logaddexp.reduce(forward[first + count - 1], axis=1)
    of = np.repeat(np.arange(len(first)), count)
    good = np.exp(forward[:, 1] + backward[:, 1] - total[of])
    inner = np.ones(len(unary), bool)
    inner[first] = False
    i = np.flatnonzero(inner)
    pair = forward[i - 1][:, :, None] + transition + (unary[i] + backward[i])[:, None, :]
    expected = np.exp(pair - total[of[i], None, None]).sum(axis=0)
    return good, total, expected


@dataclass
class LineModel:
    weights: np.ndarray  # of the label good against bad
    transition: np.ndarray  # [from, to], labels bad and good
    slope: float = 1.0
    shift: float = 0.0

    def quality(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The length-weighted mean marginal of each text."""
        shape, size, first = line_shapes(data, ends)
        score = with_neighbours(shape, first) @ self.weights
        count = np.diff(np.append(first, len(shape)))
        unary = np.stack([np.zeros(len(score)), score], axis=1)
        good, _, _ = marginals(unary, self.transition, first, count)
        weight = size + 1.0
        return np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        z = self.slope * (self.quality(data, ends) - 0.5) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_chain(
    x: np.ndarray, y: np.ndarray, first: np.ndarray, count: np.ndarray, rounds: int = 150, rate: float = 0.1
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions of the greatest conditional likelihood, by Adam."""
    d = x.shape[1]
    p = np.zeros(d + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    inner = np.ones(len(y), bool)
    inner[first] = False
    i = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[i - 1], y[i]), 1)
    for step in range(1, rounds + 1):
        unary = np.stack([np.zeros(len(y)), x @ p[:d]], axis=1)
        good, _, expected = marginals(unary, p[d:].reshape(2, 2), first, count)
        g = np.concatenate([x.T @ (good - y), (expected - seen).ravel()]) / len(y) + 1e-4 * p
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return p[:d], p[d:].reshape(2, 2)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a line break after each, and the places of those breaks."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    return data, np.cumsum([len(t) + 1 for t in texts]) - 1


def in_lots(batch_column) -> Iterator[list[bytes]]:
    lot, size = [], 0
    for cell in batch_column:
        lot.append(cell.as_py())
        size += len(lot[-1])
        if size >= AT_ONCE:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> LineModel:
    """Learns from the labels ``quality`` outside the fold held out."""
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", per_class)

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1):
                shape, size, _ = line_shapes(*joined([text.as_py()]))
                out.append((shape.astype(np.float32).tobytes(), size.astype(np.int64).tobytes()))
            x, n = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.binary()), pa.array(n, pa.binary())], ["label", "x", "n"]
            )

    rows = sample.select("label", "data").mapInArrow(shapes, "label int, x binary, n binary").toArrow()
    label = rows.column("label").to_numpy().astype(np.int64)
    if set(label.tolist()) != {0, 1}:
        return LineModel(np.zeros(FEATURES), np.zeros((2, 2)))
    x = [np.frombuffer(b, np.float32).reshape(-1, SHAPES) for b in rows.column("x").to_pylist()]
    n = [np.frombuffer(b, np.int64) for b in rows.column("n").to_pylist()]
    count = np.array([len(own) for own in x])
    first = np.cumsum(count) - count
    full = with_neighbours(np.concatenate(x).astype(np.float64), first)
    own = np.repeat(label, count)
    cut = [np.arange(a, a + c, STRETCH) for a, c in zip(first, count)]
    starts = np.concatenate(cut)
    parts = np.diff(np.append(starts, len(full)))
    model = LineModel(*fit_chain(full, own, starts, parts))
    unary = np.stack([np.zeros(len(full)), full @ model.weights], axis=1)
    good, _, _ = marginals(unary, model.transition, first, count)
    weight = np.concatenate(n) + 1.0
    quality = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
    for _ in range(100):  # Newton steps of the two-parameter logistic curve
        z = model.slope * (quality - 0.5) + model.shift
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        a = np.stack([quality - 0.5, np.ones(len(p))], axis=1)
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        move = np.linalg.solve(h, a.T @ (label - p) - 1e-3 * np.array([model.slope, model.shift]))
        move = np.clip(move, -1, 1)
        model.slope, model.shift = model.slope + move[0], model.shift + move[1]
        if np.abs(move).max() < 1e-6:
            break
    return model


def score_documents(docs: DataFrame, model: LineModel) -> DataFrame:
    """``doc_id, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.scores(*joined(lot)) for lot in in_lots(batch.column(1))]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    columns = documents(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), text_bytes().alias("data")
    )
    return columns.mapInArrow(run, "doc_id long, score double")


def op1_line_quality(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_documents(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
