"""The whole pipeline against a plain Python calculation on random lines."""

import random
import re
from collections import defaultdict

import pytest
from tables import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wordloom.plans.knowledge_base import KnowledgeBase, counts_of_lines

LINE = re.compile(r"([A-Z]+ [A-Z]+ [A-Z]+)\t[0-9]{4}\t([0-9]+).*")


def table_of(lines):
    counts = defaultdict(lambda: [0, 0])
    for line_id, line in lines:
        match = LINE.fullmatch(line)
        if match:
            counts[match[1]][line_id % 2] += int(match[2])
    nr, tr = defaultdict(int), defaultdict(int)
    for pair in counts.values():
        for part in (0, 1):
            nr[part, pair[part]] += 1
            tr[part, pair[part]] += pair[1 - part]
    n = sum(map(sum, counts.values()))
    out = []
    for trigram, (r1, r2) in counts.items():
        top = float(tr[0, r1] + tr[1, r2])
        bottom = float(n) * float(nr[0, r1] + nr[1, r2])
        out.append((*trigram.split(" "), top / bottom if bottom else None))
    return out


def ranked(table):
    by_pair = defaultdict(list)
    for w1, w2, w3, p in table:
        by_pair[w1, w2].append((0.0 if p is None else -p, w3, p))
    return [
        (*pair, w3, p, i + 1)
        for pair in sorted(by_pair)
        for i, (_, w3, p) in enumerate(sorted(by_pair[pair], key=lambda r: r[:2]))
    ]


def random_lines(seed, size):
    rng = random.Random(seed)
    word = lambda k: rng.choice(["A", "AB", "B", "BA", "C", "THE", "ZZ"][:k])
    out = []
    for _ in range(size):
        trigram = f"{word(4)} {word(3)} {word(7)}{rng.choice(['', '', 'X', 'x', chr(39)])}"
        year = rng.choice(["1990", "2008", "99"])
        out.append((rng.randrange(-50, 10**6), f"{trigram}\t{year}\t{rng.randrange(4)}\t1\t1"))
    return out


@pytest.mark.parametrize("seed, size, parts", [(1, 30, 1), (2, 500, 3), (3, 2000, 7)])
def test_random_lines(frame, seed, size, parts):
    lines = random_lines(seed, size)
    kb = KnowledgeBase(counts_of_lines(frame(lines).repartition(parts)))
    assert [tuple(r) for r in kb.ranked.collect()] == ranked(table_of(lines))


def test_partitioning_changes_nothing(frame):
    lines = random_lines(5, 800)
    one, many = (KnowledgeBase(counts_of_lines(frame(lines).repartition(n))) for n in (1, 16))
    assert [tuple(r) for r in one.ranked.collect()] == [tuple(r) for r in many.ranked.collect()]


def test_a_trigram_with_a_third_of_all_lines(frame):
    lines = random_lines(6, 1000) + [(i, "OF THE HOT\t2000\t1\t1\t1") for i in range(500)]
    kb = KnowledgeBase(counts_of_lines(frame(lines).repartition(8)), max_broadcast_rows=2)
    assert rows(kb.table) == sorted(table_of(lines), key=repr)


lines_strategy = st.lists(
    st.tuples(
        st.integers(-5, 5),
        st.builds(
            "{} {} {}\t2000\t{}".format,
            st.sampled_from(["A", "B"]),
            st.sampled_from(["A", "B"]),
            st.sampled_from(["A", "B", "C", "d", ""]),
            st.integers(0, 3),
        ),
    ),
    max_size=25,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines_strategy)
def test_any_lines(frame, lines):
    kb = KnowledgeBase(counts_of_lines(frame(lines)))
    assert [tuple(r) for r in kb.ranked.collect()] == ranked(table_of(lines))
