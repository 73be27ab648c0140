"""SimHash components and removal of repeated passages against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wordloom.llm.simhash import list_bytes, near_duplicates, near_links, split_bytes
from wordloom.llm.suffix_dedup import bucket_pointers, merged, remove_repeats, window_buckets


def reference_fingerprint(text, size):
    words = (text or "").encode().lower().split()
    shingles = [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, distance):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    values = sorted(set(fps))
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return [find(f) for f in fps]


def check_components(docs, words, distance):
    rows = docs.select("doc_id", "text").collect()
    fps = [reference_fingerprint(r.text, words) for r in rows]
    least = {}
    for r, c in zip(rows, components(fps, distance)):
        known = [x for x in (least.get(c), r.doc_id) if x is not None]
        least[c] = min(known, default=None)
    expected = sorted(
        ((r.doc_id, f, least[c]) for r, f, c in zip(rows, fps, components(fps, distance))), key=repr
    )
    found = near_duplicates(docs, words, distance).collect()
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found), key=repr) == expected
    return expected


def test_nasty_documents(nasty):
    check_components(nasty, 3, 2)


def test_an_empty_table_has_no_components(documents):
    assert near_duplicates(documents([])).collect() == []


@pytest.mark.parametrize("distance", [1, 2, 4])
def test_chains_of_near_copies(documents, distance):
    rng = random.Random(distance)
    words = [f"w{i}" for i in range(300)]
    rows, text = [], [rng.choice(words) for _ in range(150)]
    for i in range(120):
        if i % 12 == 0:
            text = [rng.choice(words) for _ in range(150)]
        text = list(text)
        text[rng.randrange(150)] = rng.choice(words)
        rows.append((1000 - i, " ".join(text)))
    expected = check_components(documents(rows), 3, distance)
    assert 1 < len({c for _, _, c in expected}) < len(rows)


@pytest.mark.parametrize("distance", range(1, 8))
def test_every_near_pair_meets_in_a_list(distance):
    rng = random.Random(distance)
    kinds = list_bytes(distance)
    for _ in range(300):
        flips = {rng.randrange(64) // 8 for _ in range(distance)}
        met = [taken for taken in kinds if not flips & set(taken)]
        assert met
        assert any(not flips & set(more) for more in split_bytes(met[0], distance))


def test_two_bits_take_six_lists():
    assert len(list_bytes(2)) == 6 and all(len(taken) == 4 for taken in list_bytes(2))
    assert {len(taken) for taken in split_bytes(list_bytes(2)[0], 2)} == {6}


@pytest.mark.parametrize("large", [3, 10_000])
def test_large_lists_are_split_without_losing_links(spark, large):
    rng = random.Random(large)
    fps = {rng.randrange(16) << 40 | rng.getrandbits(6) for _ in range(150)}
    fps |= {f ^ 1 << rng.randrange(64) for f in sorted(fps)[:60]}
    fps = sorted({f - 2**64 if f >> 63 else f for f in fps})
    rows = near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, large).collect()
    assert all(0 < ((r.a ^ r.b) % 2**64).bit_count() <= 2 for r in rows)
    group = {f: f for f in fps}
    for r in rows:
        old, new = group[r.a], group[r.b]
        group = {f: new if g == old else g for f, g in group.items()}
    found = [group[f] for f in fps]
    expected = components([f % 2**64 for f in fps], 2)
    assert len(set(found)) == len(set(expected)) == len(set(zip(found, expected))) < len(fps)


def reference_removal(rows, length):
    """Removed positions of each text, by all strings of the given length."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        key = float("inf") if doc_id is None else doc_id
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            first[w] = min(first.get(w, key), key)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        key = float("inf") if doc_id is None else doc_id
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < key:
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int)) == 1).sum() + gone[:1].sum())
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removal(docs, length, **more):
    rows = remove_repeats(docs, length, **more).collect()
    return sorted(
        ((r.c0, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows),
        key=repr,
    )


def test_removal_from_nasty_documents(nasty):
    expected = reference_removal([(r.doc_id, r.text) for r in nasty.collect()], 50)
    assert removal(nasty, 50) == expected


def test_removal_from_an_empty_table(documents):
    assert removal(documents([]), 50) == []


@pytest.mark.parametrize("length, hot", [(50, 100_000), (32, 100_000), (17, 0), (50, 2)])
def test_removal_of_overlapping_passages(documents, length, hot):
    rng = random.Random(length + hot)
    passages = ["".join(rng.choice("ab é") for _ in range(rng.randrange(20, 200))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [
            rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("abcdefgh ") for _ in range(60))
            for _ in range(rng.randrange(4))
        ]
        rows.append((rng.randrange(50), "".join(parts)[rng.randrange(5) :]))
    rows += [(99, "xy" * 4000), (98, "yx" * 3000), (None, passages[0]), (None, "xy" * 100)]
    expected = reference_removal(rows, length)
    assert sum(r[2] for r in expected) > 500
    assert removal(documents(rows), length, hot=hot) == expected


@pytest.mark.parametrize("length", [17, 32, 50])
def test_pointers_bring_equal_strings_together(length):
    rng = random.Random(length)
    for letters in (1, 2, 26):
        parts = [bytes(rng.randrange(letters) for _ in range(rng.randrange(1, 90))) for _ in range(5)]
        text = b"".join(rng.choice(parts) for _ in range(25)) + bytes(length)
        starts = np.arange(len(text) - length + 1)
        ids = window_buckets(np.frombuffer(text, np.uint8), starts, length)
        windows = [text[i : i + length] for i in starts]
        assert len(set(zip(ids.tolist(), windows))) == len(set(ids.tolist())) == len(set(windows))


def test_refinement_sorts_less_than_doubling_on_repetitive_text():
    """Doubling sorts every position at 8, 16, 32 and 50 bytes. Updates reused save work: small
    lots, which see more of them, sort less than one lot of everything."""
    rng = random.Random(5)
    parts = [bytes(rng.randrange(97, 123) for _ in range(300)) for _ in range(40)]
    data = np.frombuffer(b"".join(rng.choice(parts) for _ in range(200)), np.uint8)
    work = [bucket_pointers(data, 50, at_once)[2] for at_once in (1024, len(data) + 1)]
    assert work[0] < work[1] < 4 * len(data)
    plain = np.frombuffer(bytes(rng.randrange(256) for _ in range(20_000)), np.uint8)
    assert bucket_pointers(plain, 50)[2] < 1.1 * len(plain)


def test_rows_without_an_id_are_dealt_to_several_chunks(documents, spark):
    from wordloom.llm import suffix_dedup

    rng = random.Random(3)
    same = "".join(rng.choice("abcdefgh") for _ in range(90))
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"{i:03d}{same[i % 20:]}") for i in range(120)]
    sizes = []
    original = suffix_dedup.minimizer_counts
    try:
        suffix_dedup.minimizer_counts = lambda rows, *more: sizes.extend(
            r.n for r in rows.where("doc is null").groupBy("chunk").agg(F.count("*").alias("n")).collect()
        ) or original(rows, *more)
        assert removal(documents(rows), 50) == reference_removal(rows, 50)
    finally:
        suffix_dedup.minimizer_counts = original
    assert len(sizes) > 1 and sum(sizes) == 40
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("texts_")]


def test_long_texts_are_cut_into_overlapping_blocks(documents, monkeypatch):
    from wordloom.llm import suffix_dedup

    rng = random.Random(1)
    long = "".join(rng.choice("abcd") for _ in range(3000))
    rows = [(1, long), (2, "Q" + long[500:2600] + "Z"), (3, long[::-1] + long[100:300])]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 128)
    import pyarrow as pa

    data = pa.chunked_array([pa.array([t.encode() for _, t in rows], pa.binary())])
    windows = 0
    for block, segments in suffix_dedup.blocks(data, 50):
        first, many, _, segment = suffix_dedup.runs(block, segments, 50)
        windows += int(many.sum())
        assert (first + many + 49 <= segments[segment, 2] + segments[segment, 3]).all()
    assert windows == sum(len(t) - 49 for _, t in rows)
    assert removal(documents(rows), 50) == reference_removal(rows, 50)


def test_other_columns_survive_and_text_can_be_decoded(documents):
    docs = documents([(1, "é" * 60), (2, "x" + "é" * 60)])
    rows = {r.c0: r for r in remove_repeats(docs, decode=True).collect()}
    assert rows[2].kept == "x" and rows[1].kept == "é" * 60 and rows[1].c2 == "x"


def test_merged_stretches():
    a, b = merged(np.array([5, 0, 9, 2]), np.array([7, 3, 12, 5]))
    assert a.tolist() == [0, 9] and b.tolist() == [7, 12]
