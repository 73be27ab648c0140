"""The steps of decontamination on arrays, against plain loops, and what they hold at once."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from wordloom.llm import decontamination as dc


def lot_of_texts(texts):
    words = [dc.word_hashes(text.encode()).tobytes() for text in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(words))), pa.array(words, pa.binary())], ["doc_id", "words"])
    (lot,) = dc.lots(batch)
    return lot


def items_of(texts):
    places = np.random.default_rng(2).standard_normal((dc.FEATURES, dc.RANK)).astype(np.float32)
    space = dc.LatentSpace(np.ones(dc.FEATURES), places)
    return dc.describe_items(list(range(len(texts))), texts, space), space


def some_texts(seed, documents, longest, kinds=400):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(kinds)]
    return [" ".join(draw.choices(words, k=draw.randrange(1, longest))) for _ in range(documents)]


def peak_mb(call):
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_lot_is_taken_in_pieces():
    """No array with a row of the table, or a byte for each feature, for all words of a lot."""
    lot = lot_of_texts(some_texts(1, 300, 400))
    items, space = items_of(some_texts(2, 40, 60))
    draw = np.random.default_rng(3)
    passage, item = draw.integers(0, len(lot.words), 2000), draw.integers(0, 40, 2000)
    assert len(lot.words) > 1500
    assert peak_mb(lambda: space.sums(lot)) < 6
    assert peak_mb(lambda: dc.likely(lot, items, passage, item)) < 8


def test_sums_are_those_of_the_words_in_use():
    lot = lot_of_texts(some_texts(4, 300, 200))
    _, space = items_of(["a b c"])
    expected = [space.places[np.unique(f[u])].sum(axis=0) for f, u in zip(lot.features, lot.used)]
    assert np.allclose(space.sums(lot), expected, atol=1e-3)


def test_word_hashes_of_many_texts():
    texts = ["", "a", " -a- ", "A1b c" * 90, "x" * 33 + " " + "y" * 32, "z" * 5000, "Ä日本語 ß é", "", "\x00q\x1c\x85"]
    texts = [text.encode() for text in texts] + [b"\xff\xfe a\xc3", b"", *(t.encode() for t in some_texts(5, 50, 90))]
    for some in [texts, texts[:1], texts[1:2], [b"", b""], [b"a", b"b"]]:
        found = dc.hashes_side_by_side(some)
        assert [f.tolist() for f in found] == [dc.word_hashes(text).tolist() for text in some]


@pytest.mark.parametrize("size", range(1, dc.RUN + 1))
def test_run_hashes_tell_runs_apart(size):
    words = np.random.default_rng(size).integers(0, 3, 600).astype(np.uint32)
    runs = [tuple(words[i : i + size].tolist()) for i in range(len(words) - size + 1)]
    hashes = dc.run_hashes(words, size).tolist()
    assert len(hashes) == len(runs) and len(set(zip(hashes, runs))) == len(set(hashes)) == len(set(runs))
    assert len(dc.run_hashes(words[: size - 1], size)) == 0


def test_same_runs_are_those_of_a_plain_search():
    items = some_texts(6, 20, 40, 12) + ["w1", "w1 w2", "w3 w1 w2 w5"]
    texts = some_texts(7, 60, 90, 12) + items[:5] + ["w1", "w2"]
    lot, (described, _) = lot_of_texts(texts), items_of(items)
    expected, at = set(), 0
    for text in texts:
        own = text.split()
        for k, item in enumerate(items):
            words = item.split()
            n = min(dc.RUN, len(words))
            runs = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
            expected |= {(at + i // dc.PASSAGE, k) for i in range(len(own)) if tuple(own[i : i + n]) in runs}
        at += -(-len(own) // dc.PASSAGE)
    passages, found = dc.same_runs(lot, described)
    assert set(zip(passages.tolist(), found.tolist())) == expected


@pytest.mark.parametrize("texts", [some_texts(8, 40, 300), some_texts(9, 1, 20), some_texts(10, 3, 40)])
def test_likely_counts_the_words_around(texts):
    items = [" ".join(some_texts(11 + n, 1, 2)[0] for _ in range(n)) for n in (3, 31, 32, 33, 70, 128, 129, 260)]
    items += some_texts(12, 30, 60, 60)
    lot, (described, _) = lot_of_texts(texts), items_of(items)
    passage, item = (x.ravel() for x in np.indices((len(lot.words), len(items))))
    expected = []
    for p, k in zip(passage.tolist(), item.tolist()):
        own = dc.word_hashes(items[k].encode()) % dc.FEATURES
        reach = -(-len(own) // dc.PASSAGE)
        near = [q for q in range(max(0, p - reach), min(len(lot.words), p + reach + 2)) if lot.owner[q] == lot.owner[p]]
        held = {int(f) for q in near for f in lot.features[q][lot.used[q]]}
        expected.append(sum(int(f) in held for f in own) >= dc.PARAPHRASED * len(own))
    assert dc.likely(lot, described, passage, item).tolist() == expected


def test_bounds_decide_as_before():
    bounds = np.random.default_rng(1).random(1000)
    near = bounds.astype(np.float32)
    for x in (near, np.nextafter(near, np.float32(0)), np.nextafter(near, np.float32(2))):
        assert ((x >= dc.least_float32(bounds)) == (x.astype(np.float64) >= bounds)).all()
