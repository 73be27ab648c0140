"""Quality, toxicity and language: the mathematics by brute force, the results held out."""

import itertools
import zlib

import numpy as np
import pytest

from wordloom.llm import language_id, line_quality, toxicity

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def held_out(doc_id, folds, left_out):
    return zlib.crc32(str(doc_id).encode()) % folds == left_out


def numeric_gradient(loss, p, at, step=1e-4):
    old = p[at]
    p[at] = old + step
    up = loss()
    p[at] = old - step
    down = loss()
    p[at] = old
    return (up - down) / (2 * step)


# Quality


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    count = np.array([3, 1, 5, 2])
    first = np.cumsum(count) - count
    unary, transition = rng.normal(size=(11, 2)), rng.normal(size=(2, 2))
    good, total, expected = line_quality.marginals(unary, transition, first, count)
    pairs = np.zeros((2, 2))
    for f, c, z in zip(first, count, total):
        weights, ones, own_pairs = 0.0, np.zeros(c), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(c)):
            w = sum(unary[f + i, y] for i, y in enumerate(labels))
            w = np.exp(w + sum(transition[a, b] for a, b in zip(labels, labels[1:])))
            weights += w
            ones += w * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                own_pairs[a, b] += w
        assert np.isclose(np.log(weights), z)
        assert np.allclose(ones / weights, good[f : f + c])
        pairs += own_pairs / weights
    assert np.allclose(pairs, expected)


def test_line_shapes_of_several_texts():
    texts = [b"One two.\nTHREE!!\n", b"", b"a a a a"]
    shape, size, first = line_quality.line_shapes(*line_quality.joined(texts))
    assert size.tolist() == [8, 7, 0, 0, 7] and first.tolist() == [0, 3, 4]
    alone = [line_quality.line_shapes(*line_quality.joined([t]))[0] for t in texts]
    assert np.allclose(shape, np.concatenate(alone))
    repeats = shape[:, len(line_quality.KINDS)]
    assert repeats.tolist() == [0, 0, 0, 0, 0.75]


def test_quality_held_out(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = line_quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in line_quality.score_documents(docs, model).collect()}
    known = [r for r in labels.collect() if held_out(r.doc_id, 3, 1)]
    right = [(scores[r.doc_id] >= 0.5) == (r.quality == 1) for r in known]
    assert len(known) > 50 and np.mean(right) > 0.95
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())


def test_quality_of_nasty_documents(spark, nasty, documents):
    labels = spark.createDataFrame([(4, 1, None), (13, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = line_quality.train(nasty, labels)
    rows = line_quality.score_documents(nasty, model).collect()
    assert len(rows) == nasty.count() and all(0 <= r.score <= 1 for r in rows)
    unlabelled = line_quality.train(nasty, labels.where("false"))
    assert {r.score for r in line_quality.score_documents(nasty, unlabelled).collect()} == {0.5}
    assert line_quality.score_documents(documents([]), model).collect() == []


# Toxicity


def test_ordinal_fit_finds_the_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3))
    z = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=3000)
    y = np.digitize(z, [-1.0, 0.5, 2.0])
    weights, thresholds = toxicity.fit_ordinal(x, y, 3, rounds=600)
    assert np.allclose(weights, [2.0, -1.0, 0.0], atol=0.25)
    assert np.allclose(thresholds, [-1.0, 0.5, 2.0], atol=0.25) and (np.diff(thresholds) > 0).all()


def test_features_are_words_and_stems():
    found = toxicity.features(b"Scum*** scummy, SCUMMY 12 \xc3\xa9")
    assert found[b"scum"] == 1 and found[b"scummy"] == 2 and found[b"scum*"] == 2
    assert b"12" not in found and found["é".encode()] == 1


def test_toxicity_held_out(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = toxicity.train(docs, labels)
    found = {r.doc_id: r for r in toxicity.severity(docs, model).collect()}
    known = [r for r in labels.collect() if held_out(r.doc_id, 3, 1)]
    toxic = [found[r.doc_id].p_toxic for r in known if r.toxic == 1]
    clean = [found[r.doc_id].p_toxic for r in known if r.toxic == 0]
    assert np.mean([(t > c) + (t == c) / 2 for t in toxic for c in clean]) > 0.8
    assert np.mean(np.array(clean) >= toxicity.REJECT) < 0.05
    assert all(0 <= r.severity <= toxicity.GRADES for r in found.values())
    kept = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {d for d, r in found.items() if r.p_toxic < toxicity.REJECT}


def test_toxicity_of_nasty_documents(spark, nasty, documents):
    labels = spark.createDataFrame([(4, 0), (12, 1), (13, 1), (9, 0), (None, 1)], "doc_id long, toxic int")
    for known in (labels, labels.where("false"), labels.where("toxic = 1")):
        model = toxicity.train(nasty, known)
        rows = toxicity.severity(nasty, model).collect()
        assert len(rows) == nasty.count() and all(np.isfinite(r.severity) for r in rows)
    assert {r.severity for r in rows} == {0.0}
    kept = toxicity.without_toxic(nasty, model)
    assert kept.columns == nasty.columns and kept.count() == nasty.count()
    assert toxicity.severity(documents([]), model).collect() == []


# Language


def test_backpropagation_equals_numeric_gradients():
    rng = np.random.default_rng(2)
    net = language_id.Network(["a", "b", "c"], hidden=3)
    x = rng.integers(97, 103, (6, 4)).astype(np.uint8)
    y, weight = np.array([0, 1, 2, 1]), rng.random((6, 4)).astype(np.float32)
    for layer in net.layers:
        layer.byte, layer.state = layer.byte.astype(np.float64), layer.state.astype(np.float64)
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)

    def loss():
        total = 0.0
        states = []
        for layer, order in zip(net.layers, (range(6), range(5, -1, -1))):
            h, own, k = np.zeros((4, 3)), {}, 3
            for t in order:
                a, b = layer.byte[x[t]], h @ layer.state
                z, r = (language_id.sigmoid(a[:, i : i + k] + b[:, i : i + k]) for i in (0, k))
                h = (1 - z) * h + z * np.tanh(a[:, 2 * k :] + r * b[:, 2 * k :])
                own[t] = h
            states.append(own)
        for t in range(6):
            logits = np.concatenate([states[0][t], states[1][t]], axis=1) @ net.out + net.bias
            log_p = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
            total -= (log_p[np.arange(4), y] * weight[t]).sum()
        return total / weight.sum()

    for p, g in zip(net.parameters(), net.learn_from(x, y, weight)):
        for at in [(np.unravel_index(i, p.shape)) for i in rng.integers(0, p.size, 6)]:
            assert np.isclose(g[at], numeric_gradient(loss, p, at), atol=2e-4)
    at = (98, 0)
    assert np.isclose(net.learn_from(x, y, weight)[0][at], numeric_gradient(loss, net.layers[0].byte, at), atol=2e-4)


def test_pooled_probabilities_equal_the_plain_pass():
    rng = np.random.default_rng(3)
    net = language_id.Network(["a", "b"], hidden=4)
    x = rng.integers(30, 130, (10, 7)).astype(np.uint8)
    states = []
    for layer, order in zip(net.layers, (range(10), range(9, -1, -1))):
        h, own = np.zeros((7, 4)), {}
        for t in order:
            a, b = layer.byte[x[t]], h @ layer.state
            z = language_id.sigmoid(a[:, :4] + b[:, :4])
            r = language_id.sigmoid(a[:, 4:8] + b[:, 4:8])
            h = h + z * (np.tanh(a[:, 8:] + r * b[:, 8:]) - h)
            own[t] = h
        states.append(own)
    expected = np.zeros((7, 2))
    for t in range(10):
        p = np.exp(np.concatenate([states[0][t], states[1][t]], axis=1) @ net.out + net.bias)
        expected += p / p.sum(axis=1, keepdims=True) * language_id.LETTER[x[t]][:, None]
    assert np.allclose(net.pooled(x), expected, atol=1e-4)


def test_language_held_out(spark):
    docs = table(spark, "documents")
    found = {r.doc_id: r for r in language_id.predict(docs, language_id.train(docs, per_language=60)).collect()}
    known = [r for r in docs.select("doc_id", "lang").collect() if held_out(r.doc_id, 5, 0)]
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in known]) > 0.95
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found.values())


@pytest.mark.parametrize("languages", [0, 1])
def test_language_of_nasty_documents(nasty, documents, languages):
    docs = nasty.drop("lang").selectExpr("*", "'xx' AS lang" if languages else "CAST(NULL AS STRING) AS lang")
    rows = language_id.predict(docs, language_id.train(docs)).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in nasty.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            letters = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert r.lang_pred == ("xx" if languages and letters else "und")
    assert language_id.predict(documents([]), None).collect() == []
