"""Nearest neighbours and decontamination against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import decontamination as dc
from wordloom.llm.hash_forest import nearest, op4_hash_forest

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>"


def brute_nearest(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        cosine = x @ x[np.flatnonzero(ids == q)[0]]
        order = [i for i in np.lexsort((ids, -cosine.round(12))) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), cosine[i]) for i in order]
    return out


def test_recall_on_the_table(spark):
    found = {}
    for r in op4_hash_forest(spark, SF).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    best = brute_nearest(rows, [i for i, _ in rows if i % 50 == 0], 5)
    assert found.keys() == best.keys()
    hits = sum(len({v for _, v, _ in found[q]} & {v for v, _ in best[q]}) for q in best)
    assert hits >= 0.9 * 5 * len(best)
    for q, own in found.items():
        own.sort()
        assert [n for n, _, _ in own] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in own] == sorted((s for _, _, s in own), reverse=True)
        exact = {v: c for v, c in brute_nearest(rows, [q], len(rows))[q]}
        assert all(abs(exact[v] - s) < 1e-9 for _, v, s in own)


def test_everything_is_found_with_the_whole_share(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]  # one vector holds a third
    df = spark.createDataFrame(rows, VECTORS)
    found = {}
    for r in nearest(df, F.col("vec_id") % 10 == 0, k=5, trees=4, share=4.0).collect():
        found.setdefault(r.query_id, {})[r.rank] = r.vec_id
    rows = [(i, np.float32(v)) for i, v in rows]
    for q, best in brute_nearest(rows, range(0, 420, 10), 5).items():
        assert [found[q][n] for n in range(1, 6)] == [v for v, _ in best]


def test_an_id_with_several_vectors_and_multiples_of_one(spark):
    """Every row by itself against all others, ties by id; found among all, so nothing is left out."""
    rows = [(1, [10.0, 1.0]), (5, [10.0, 1.0]), (1, [1.0, 2.0]), (7, [1.0, 2.0]), (50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [1.0, 0.0])]
    rows += [(i, [30.0 * i, 3.0 * i]) for i in (2, 3, 4, 6, 8, 9)]
    found = nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, k=6, share=40.0)
    own = sorted({(i, tuple(v)) for i, v in rows})
    expected = []
    for q, x in own:
        if q == 50:
            others = [(round(np.dot(x, v) / np.linalg.norm(x) / np.linalg.norm(v), 9), i) for i, v in own if (i, v) != (q, x)]
            order = sorted(others, key=lambda t: (-t[0], t[1]))[:6]
            expected += [(q, n + 1, i, c) for n, (c, i) in enumerate(order)]
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in found.collect()) == sorted(expected)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]),
        (5, [None, 1.0]), (6, []), (7, [1.0, 1.0, 1.0]), (None, [1.0, 2.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]),
        (100, [0.0, 0.0]), (9, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("x")).withColumn("id", F.lit(1))
    found = nearest(df, F.col("vec_id") % 50 == 0, share=32.0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == [
        (0, 1, 50), (0, 2, 8), (0, 3, 9), (50, 1, 0), (50, 2, 8), (50, 3, 9)
    ]
    assert nearest(df.where("false"), F.lit(True)).collect() == []


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence_equals_the_table():
    rng = random.Random(0)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 70))]
        b = [rng.randrange(6) for _ in range(rng.randrange(90))]
        mask = {}
        for i, word in enumerate(a):
            mask[word] = mask.get(word, 0) | 1 << i
        assert dc.common_length(mask, len(a), b) == longest_common(a, b)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(900)]
    weights = [1 / (i + 3) for i in range(900)]
    say = lambda n: rng.choices(words, weights, k=n)
    items = [(i, " ".join(say(rng.randrange(16, 60)))) for i in range(12)]
    rows, leaked = [], set()
    for i in range(n):
        text = say(rng.randrange(0, 400))
        if i % 5 == 0:
            item = rng.randrange(12)
            own = items[item][1].split()
            if i % 10 == 0:  # a paraphrase: some words replaced, one in ten dropped
                own = [rng.choice(words) if rng.random() < 0.15 else w for w in own if rng.random() > 0.1]
            at = rng.randrange(len(text) + 1)
            text = text[:at] + own + text[at:]
            leaked.add((i, item))
        rows.append((i, " ".join(text).upper() + "."))
    return rows, items, leaked


def test_leaks_and_paraphrases_are_found(spark, documents):
    rows, items, leaked = corpus(4)
    benchmark = spark.createDataFrame([*items, (99, None), (98, ""), (97, "?!")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(documents(rows), benchmark).collect()}
    assert len(found & leaked) >= 0.9 * len(leaked)
    exact = {(d, i) for d, i in leaked if d % 10}
    assert exact <= found and not found - leaked


def test_copies_of_long_items_are_found(spark, documents):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, say(n)) for i, n in enumerate((20, 65, 129, 260, 700, 1500))]
    rows = [(i, f"{say(37 * i + 5)} {text} {say(90)}") for i, text in items]
    rows += [(i + 100, say(300)) for i in range(60)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = dc.contaminated(documents(rows), benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.common) for r in found) == [(i, i, 1.0) for i, _ in items]


def test_verbatim_copies_among_hot_passages_are_found(spark, documents):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    say = lambda n: rng.choices(words, k=n)
    hot = [say(60) for _ in range(80)]
    items = [(i, " ".join(say(rng.randrange(5, 50)))) for i in range(60)]
    rows = []
    for i in range(800):
        text = say(rng.randrange(30, 90))
        for passage in rng.sample(hot, 4):
            text += passage + say(rng.randrange(20))
        at = rng.randrange(len(text))
        rows.append((i, " ".join([*text[:at], items[i][1], *text[at:]] if i < 60 else text)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(documents(rows), benchmark).collect()}
    assert {(i, i) for i in range(60)} <= found


@pytest.mark.parametrize("copies", [1, 3])
def test_a_table_of_nothing_but_the_item(spark, documents, copies):
    text = "one short document that is the benchmark item as it stands"
    benchmark = spark.createDataFrame([(1, text)], "item_id long, text string")
    found = dc.contaminated(documents([(i, text) for i in range(copies)]), benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.common) for r in found) == [(i, 1, 1.0) for i in range(copies)]


def test_latent_space_is_the_singular_subspace(documents):
    rows, _, _ = corpus(5, 60)
    words = dc.hashed_words(documents(rows)).cache()
    space = dc.latent_space(words, rank=6, extra=40)
    a = []
    for r in sorted(words.collect()):
        own = np.frombuffer(bytes(r.words), np.uint32) % dc.FEATURES
        for lo in range(0, len(own), dc.PASSAGE):
            x = np.zeros(dc.FEATURES)
            x[own[lo : lo + dc.PASSAGE]] = 1
            a.append(x)
    a = np.array(a)
    weights = np.log1p(len(a) / (1 + a.sum(axis=0)))
    assert np.allclose(weights, space.weights)
    tf_idf = a * weights
    tf_idf /= np.linalg.norm(tf_idf, axis=1, keepdims=True)
    _, s, vt = np.linalg.svd(tf_idf, full_matrices=False)
    mine = space.places / np.where(weights == 0, 1, weights)[:, None]
    # The leading direction, scaled by its singular value.
    top = mine[:, 0] * s[0]
    assert abs(top @ vt[0]) > 0.99 and np.isclose(np.linalg.norm(top), 1, atol=0.02)


@pytest.mark.parametrize("empty", ["corpus", "benchmark", "both"])
def test_empty_tables(spark, documents, empty):
    docs = documents([] if empty != "benchmark" else [(1, "a b c"), (2, None)])
    items = [] if empty != "corpus" else [(1, "a b c")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert dc.contaminated(docs, benchmark).collect() == []


def test_nasty_documents(spark, nasty):
    benchmark = spark.createDataFrame([(1, "lorem ipsum dolor sit amet " * 5), (None, "the cat")], "item_id long, text string")
    found = dc.contaminated(nasty, benchmark).collect()
    assert {r.doc_id for r in found} <= {4, 12, None} and (12, 1) in {(r.doc_id, r.item_id) for r in found}


def every_passage_and_item(docs, items):
    """(doc_id, item_id): leaks by the longest common subsequence of every passage's surroundings
    with every item; only bags of words that are too small are passed over, which is exact."""
    found = set()
    for doc_id, text in docs:
        words = dc.word_hashes((text or "").encode()).tolist()
        passages = [words[i : i + dc.PASSAGE] for i in range(0, len(words), dc.PASSAGE)]
        for item_id, item in items:
            own = dc.word_hashes(item.encode()).tolist()
            sentences = [dc.word_hashes(s.encode()).tolist() for s in re.split(r"[.!?\n]+", item)]
            answer = ([s for s in sentences if len(s) >= dc.ANSWER] or [[]])[-1]
            reach, mask = max(1, -(-len(own) // dc.PASSAGE)), {}
            for i, word in enumerate(own):
                mask[word] = mask.get(word, 0) | 1 << i
            for p in range(len(passages)):
                around = [w for x in passages[max(0, p - reach) : p + reach + 2] for w in x]
                if sum(w in mask for w in around) < dc.PARAPHRASED * len(own):
                    continue
                common = dc.common_length(mask, len(own), around) / len(own)
                if common >= dc.COMMON or (common >= dc.PARAPHRASED and dc.holds(around, answer)):
                    found.add((doc_id, item_id))
    return found


def test_whole_query_against_every_passage_and_item(spark):
    sf = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for n, (_, text) in enumerate(items[:30]):  # every fourth word of an item goes, in a text of another
        words = text.split()
        left = " ".join(w for i, w in enumerate(words) if i % 4 or i > len(words) * 0.6)
        rows.append((10_000 + n, f"{rows[n][1][:300]} {left} {rows[n + 1][1][:300]}"))
    found = dc.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    expected = every_passage_and_item(rows, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
    assert sum(d >= 10_000 for d, _ in expected) >= 20 and any(d < 10_000 for d, _ in expected)


def test_a_paraphrase_in_a_table_of_one_vocabulary(spark, documents):
    """Every word is in every passage."""
    words = [f"w{i}" for i in range(dc.PASSAGE)]
    draw = np.random.default_rng(5)
    rows = [(i, " ".join(draw.permutation(words))) for i in range(30)]
    item = " ".join(draw.permutation(words))
    rows.append((99, " ".join(w for i, w in enumerate(item.split()) if i % 4)))
    found = dc.contaminated(documents(rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == every_passage_and_item(rows, [(1, item)]) == {(99, 1)}


def test_sums_of_runs():
    draw = np.random.default_rng(1)
    for sizes in ([1], [3, 1, 500, 2], draw.integers(1, 9, 300).tolist()):
        n = sum(sizes)
        row, weight, y = draw.integers(0, 50, n), draw.random(n), draw.random((50, 3))
        first = np.cumsum([0, *sizes[:-1]])
        expected = [sum(weight[i] * y[row[i]] for i in range(a, a + s)) for a, s in zip(first, sizes)]
        assert np.allclose(dc.sums_of_runs(first, row, weight, y), expected)
