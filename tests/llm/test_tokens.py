"""Token counts and packed ids against the tokenizer library."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wordloom.llm.packing import CapacityTree, best_fit_plan, encoder, pack_documents, sequences
from wordloom.llm.token_counts import count_tokens, counter, proved_strings

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(nasty):
    rows = nasty.collect()
    expected = Counter(
        (r.doc_id, len((r.text or "").encode()), len(ids))
        for r, ids in zip(rows, library(BYTES, [r.text or "" for r in rows]))
    )
    assert Counter(tuple(r) for r in count_tokens(nasty, BYTES).collect()) == expected


def test_counting_an_empty_table(documents):
    assert count_tokens(documents([]), BYTES).collect() == []


def test_proved_strings_are_single_tokens():
    proved = proved_strings(open(BYTES, encoding="utf-8").read())
    assert len(proved) > 40_000
    assert {len(ids) for ids in library(BYTES, [p for p in proved if p.strip()][::37])} == {1}


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    file = open(BYTES, encoding="utf-8").read()
    assert _counter(file)(text) == len(library(BYTES, [text])[0])
    ids = np.frombuffer(encoder(open(WORDS, encoding="utf-8").read())(text.encode()), "<u4")
    assert ids.tolist() == library(WORDS, [text])[0]


_made = {}


def _counter(file):
    if "c" not in _made:
        _made["c"] = counter(file, tuple(proved_strings(file)))
    return _made["c"]


def test_packed_pieces_hold_every_id_once(nasty):
    capacity = 64
    packed = pack_documents(nasty, WORDS, capacity).collect()
    rows = nasty.collect()
    ids = defaultdict(list)
    for r, own in zip(rows, library(WORDS, [r.text or "" for r in rows])):
        ids[r.doc_id].append([*own, 1])
    pieces = defaultdict(Counter)
    for p in packed:
        pieces[p.doc_id][p.start, p.length, p.ids_crc32, p.doc_tokens] += 1
    for doc_id, texts in ids.items():
        expected = Counter()
        for own in texts:
            for a in range(0, len(own), capacity):
                part = np.array(own[a : a + capacity], "<u4")
                expected[a, len(part), zlib.crc32(part.tobytes()), len(own)] += 1
        assert pieces[doc_id] == expected
    windows = defaultdict(list)
    for p in packed:
        windows[p.sequence_id].append((p.offset, p.length))
    assert sorted(windows) == list(range(len(windows)))
    for own in windows.values():
        ends = [a + n for a, n in sorted(own)]
        assert [a for a, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= capacity


def test_packing_an_empty_table(documents):
    assert pack_documents(documents([]), WORDS).collect() == []


def test_sequences_are_the_documents_ids(documents):
    docs = documents([(i, "one two three " * (5 * i)) for i in range(9)])
    packed = pack_documents(docs, WORDS, 64).cache()
    rows = {r.sequence_id: r.ids for r in sequences(docs, packed, WORDS, 64).collect()}
    assert {len(ids) for ids in rows.values()} == {64}
    for p in packed.collect():
        own = np.array(rows[p.sequence_id][p.offset : p.offset + p.length], "<u4")
        assert zlib.crc32(own.tobytes()) == p.ids_crc32


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    """The plan on the histogram against placing piece by piece."""
    capacity, open_windows = 40, []
    for length in sorted(lengths, reverse=True):
        fits = [w for w in open_windows if capacity - sum(w) >= length]
        best = max(fits, key=sum, default=None)
        if best is None:
            open_windows.append([length])
        else:
            best.append(length)
    plan, opened = best_fit_plan(dict(Counter(lengths)), capacity)
    windows = defaultdict(list)
    placed = Counter()
    for length, lo, hi, first, per, base in plan:
        placed[length] += hi - lo
        for nth in range(hi - lo):
            windows[first + nth // per].append((base + nth % per * length, length))
    assert placed == Counter(lengths) and opened == len(open_windows) == len(windows)
    # Which of several windows with equal room takes a piece is free; the room left is not.
    assert Counter(sum(n for _, n in w) for w in windows.values()) == Counter(map(sum, open_windows))
    for w in windows.values():
        ends = [a + n for a, n in sorted(w)]
        assert [a for a, _ in sorted(w)] == [0, *ends[:-1]] and ends[-1] <= capacity


@given(st.sets(st.integers(1, 50)), st.integers(1, 50))
def test_tree_finds_the_least_capacity(present, at):
    tree = CapacityTree(50)
    for p in present:
        tree.put(p, True)
    assert tree.least(at) == min((p for p in present if p >= at), default=None)
