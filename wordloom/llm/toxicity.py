"""Toxicity by cumulative-link ordinal regression on sparse text features.

A document has a severity grade from 0 (clean) to ``GRADES``. The model is
``P(grade >= k) = sigmoid(w . x - t_k)`` with one weight vector for all thresholds
``t_1 < t_2 < …``; its output is the expected grade, the sum of these probabilities. A
document is toxic if ``P(grade >= 1)`` is at least ``REJECT``, which is below one half: toxic
documents are few, and one that stays costs more than a clean one that goes.

Features are words without punctuation and digits, lower-cased, and the first four to eight
bytes of longer words, since insults are inflected; the value is log(1 + count). Only features that
lean clearly to one side among the labelled documents are used. The labels know toxic and not
toxic only; grades above 0 follow from how much leaning evidence a toxic document holds: the
thirds of toxic documents by the number of such words.

The sample to learn from is bounded (``PER_CLASS`` documents of each label, drawn by hash,
outside the held-out fold); everything else covers all documents.

Defined results: a null or empty text has no features and gets the severity of such a text;
without labels of both kinds every severity is 0; repeated rows give repeated results; texts
of any length are read whole; columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import documents, give_back, prepare, text_bytes
from wordloom.llm.samples import labelled_sample

PER_CLASS = 3000
GRADES = 3
FEATURES = 1000
LEANING = 4.0
RARE = 4
REJECT = 0.3
STEMS = (4, 5, 6, 7, 8)
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
SCHEMA = "doc_id long, severity double, p_toxic double, grade int"


def words(data: bytes) -> list[bytes]:
    return data.lower().translate(LETTERS).split()


def features(data: bytes) -> Counter:
    """Counts of words, and of their beginnings where they are longer."""
    counts = Counter(words(data))
    for word, n in list(counts.items()):
        for size in STEMS:
            if len(word) > size:
                counts[word[:size] + b"*"] += n
    return counts


class OrdinalModel:
    """Weights and ordered thresholds."""

    def __init__(self, weights: dict[bytes, float], thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds
        self.begins = {feature.rstrip(b"*")[: STEMS[0]] for feature in weights}

    def grades(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, … per value of w . x."""
        z = np.clip(x[:, None] - self.thresholds[None, :], -40, 40)
        return np.where(np.isinf(self.thresholds), 0.0, 1 / (1 + np.exp(-z)))

    def evidence(self, data: bytes) -> float:
        begins, weights = self.begins, self.weights
        counts: dict[bytes, int] = {}
        for word in [w for w in words(data) if w[:4] in begins]:
            stems = [word[:size] + b"*" for size in STEMS if len(word) > size]
            for feature in (word, *stems):
                if feature in weights:
                    counts[feature] = counts.get(feature, 0) + 1
        return float(sum(self.weights[f] * np.log1p(n) for f, n in counts.items()))


def fit_ordinal(
    x: np.ndarray, y: np.ndarray, grades: int, rounds: int = 400, rate: float = 0.1, decay: float = 1e-3
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the greatest likelihood, by gradient steps (Adam).

    The thresholds are kept in order by learning the first and the logarithms of the gaps.
    """
    n, d = x.shape
    p = np.zeros(d + grades)
    share = np.clip([(y >= k).mean() for k in range(1, grades + 1)], 1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    p[d], p[d + 1 :] = start[0], np.log(np.maximum(np.diff(start), 0.1))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, rounds + 1):
        gaps = np.exp(p[d + 1 :])
        t = p[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = x @ p[:d]
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - t, -40, 40)))  # P(y >= k)
        full = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        slope = full * (1 - full)
        at = np.arange(n)
        like = np.maximum(full[at, y] - full[at, y + 1], 1e-12)
        lower, upper = slope[at, y] / like / n, slope[at, y + 1] / like / n
        d_score = -(lower - upper)
        d_t = np.zeros(grades + 2)
        np.add.at(d_t, y, lower)
        np.add.at(d_t, y + 1, -upper)
        d_t = d_t[1:-1]
        tail = np.cumsum(d_t[::-1])[::-1]
        g = np.concatenate([x.T @ d_score + decay * p[:d], [tail[0]], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return p[:d], p[d] + np.concatenate([[0.0], np.cumsum(np.exp(p[d + 1 :]))])


def leaning_features(sample: DataFrame) -> dict[bytes, float]:
    """The features that lean to one label most clearly, and the log odds of each.

    How clearly is the root of the likelihood ratio between a feature's share of each label's
    documents and one share for both.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for label, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[label].update(features(data.as_py()).keys())
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.binary()),
                pa.array([seen[0][f] for f in names], pa.int64()),
                pa.array([seen[1][f] for f in names], pa.int64()),
            ],
            ["feature", "clean", "toxic"],
        )

    counts = sample.select("label", "data").mapInArrow(count, "feature binary, clean long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / F.lit(sizes[1] + 0.5)) - F.log(b / F.lit(sizes[0] + 0.5))
    n = sizes[0] + sizes[1]
    seen = F.col("toxic") + F.col("clean")

    def gain(found, documents):
        """Of one label, the log likelihood won by its own share over the common one."""
        def part(x, expected):
            return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

        return part(found, seen * (documents / n)) + part(documents - found, (n - seen) * (documents / n))

    z = F.sqrt(2 * F.greatest(gain(F.col("toxic"), sizes[1]) + gain(F.col("clean"), sizes[0]), F.lit(0.0)))
    leaning = counts.where(seen >= RARE).select("feature", odds.alias("odds"), z.alias("z"))
    rows = leaning.where(F.col("z") >= LEANING).orderBy(F.desc("z"), "feature").limit(FEATURES).collect()
    return {bytes(r["feature"]): r["odds"] for r in rows}


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> OrdinalModel:
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", per_class)
    kinds = {r["label"] for r in sample.select("label").distinct().collect()}
    chosen = leaning_features(sample) if kinds == {0, 1} else {}
    if not chosen:
        return OrdinalModel({}, np.full(GRADES, np.inf))
    names = list(chosen)
    place = {f: i for i, f in enumerate(names)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column(1):
                x = np.zeros(len(place), np.uint16)
                for f, n in features(data.as_py()).items():
                    if f in place:
                        x[place[f]] = min(n, 65535)
                rows.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["label", "x"])

    rows = sample.select("label", "data").mapInArrow(vectors, "label int, x binary").toArrow()
    counts = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.uint16).reshape(-1, len(names))
    label = rows.column("label").to_numpy()
    toxic_side = np.array([chosen[f] > 0 for f in names])
    hits = counts[:, toxic_side].sum(axis=1)
    cuts = np.quantile(hits[label == 1], np.arange(1, GRADES) / GRADES)
    grade = np.where(label == 1, 1 + (hits[:, None] > cuts).sum(axis=1), 0)
    weights, thresholds = fit_ordinal(np.log1p(counts.astype(np.float64)), grade, GRADES)
    return OrdinalModel(dict(zip(names, weights.tolist())), thresholds)


def severity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``doc_id, severity, p_toxic, grade`` (the grade nearest to the expected one)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([model.evidence(data.as_py()) for data in batch.column(1)], np.float64)
            above = model.grades(x)
            expected = above.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(expected),
                    pa.array(np.ascontiguousarray(above[:, 0])),
                    pa.array(np.rint(expected).astype(np.int32)),
                ],
                ["doc_id", "severity", "p_toxic", "grade"],
            )
        give_back()

    columns = documents(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), text_bytes().alias("data")
    )
    return columns.mapInArrow(run, SCHEMA)


def without_toxic(docs: DataFrame, model: OrdinalModel, bound: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that are not toxic, as they are; nothing is moved."""
    prepare(docs.sparkSession)

    @F.arrow_udf("double")
    def p_toxic(data: pa.Array) -> pa.Array:
        x = np.array([model.evidence(cell.as_py()) for cell in data], np.float64)
        return pa.array(np.ascontiguousarray(model.grades(x)[:, 0]))

    return docs.where(p_toxic(text_bytes()) < bound)


def op5_ordinal_toxicity(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return severity(docs, model).withColumn("toxic", F.col("p_toxic") >= REJECT)
