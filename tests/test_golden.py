"""The worked example, from lines to the ranked table."""

import pytest
from tables import rows
from pyspark.sql import functions as F

from wordloom.operators.counts import corpus_total
from wordloom.operators.frequency import frequency_cells, frequency_stats, step_union, unpivot_counts
from wordloom.operators.parse import parse_lines, parse_report, rejected_lines, split_corpus
from wordloom.plans.knowledge_base import KnowledgeBase, counts_of_lines
from wordloom.sinks.text import table_lines

KB = [
    ("A", "B", "C", 10 / 60, 1),
    ("A", "B", "E", 10 / 60, 2),
    ("A", "B", "D", 1 / 24, 3),
    ("X", "Y", "Z", 9 / 48, 1),
]


@pytest.fixture
def counts(golden):
    return counts_of_lines(golden)


@pytest.fixture
def kb(counts):
    return KnowledgeBase(counts)


def test_parsed_and_rejected(golden):
    assert [r[0] for r in rows(parse_lines(golden), "line_id")] == [0, 1, 2, 3, 4, 5, 8]
    assert [r[0] for r in rows(rejected_lines(golden), "line_id")] == [6, 7, 9]
    assert rows(parse_report(golden)) == [(7, 3)]


def test_corpus_parts(golden):
    parts = split_corpus(parse_lines(golden))
    assert rows(parts.groupBy("part").agg(F.sum("occurrences").alias("n"))) == [(1, 9), (2, 3)]


def test_counts_and_total(golden, counts):
    assert rows(counts) == [
        ("A", "B", "C", 3, 1),
        ("A", "B", "D", 1, 0),
        ("A", "B", "E", 3, 1),
        ("X", "Y", "Z", 2, 1),
    ]
    assert rows(corpus_total(parse_lines(golden))) == [(12,)]


def test_unpivoted(counts):
    assert rows(unpivot_counts(counts)) == [
        (0, 2, 1), (1, 1, 0), (1, 2, 2), (1, 2, 3), (1, 2, 3), (2, 1, 1), (3, 1, 1), (3, 1, 1),
    ]


def test_statistics(counts, kb):
    seen = frequency_stats(frequency_cells(counts))
    assert rows(seen) == [(0, 2, 1, 1), (1, 1, 1, 0), (1, 2, 3, 8), (2, 1, 1, 1), (3, 1, 2, 2)]
    assert rows(kb.stats) == [
        (0, 0, 0, 1, 1), (1, 1, 0, 3, 8), (2, 1, 1, 0, 0), (3, 2, 2, 0, 0),
    ]
    assert rows(kb.total) == [(12,)]


def test_joined_statistics(kb):
    assert rows(kb.stats_rows) == [
        ("A", "B", "C", 1, 2, 2), ("A", "B", "C", 2, 3, 8),
        ("A", "B", "D", 1, 1, 0), ("A", "B", "D", 2, 1, 1),
        ("A", "B", "E", 1, 2, 2), ("A", "B", "E", 2, 3, 8),
        ("X", "Y", "Z", 1, 1, 1), ("X", "Y", "Z", 2, 3, 8),
    ]


def test_union_of_steps(counts):
    union = step_union(counts, frequency_stats(frequency_cells(counts)))
    assert union.columns == ["src", "w1", "w2", "w3", "r1", "r2", "r", "part", "nr", "tr"]
    assert rows(union.groupBy("src").count()) == [("counts", 4), ("nr_tr", 5)]
    assert union.where("src = 'nr_tr'").where("w1 IS NULL AND r1 IS NULL").count() == 5


def test_probabilities_both_ways(kb):
    expected = sorted(r[:4] for r in KB)
    assert rows(kb.table) == expected
    assert rows(kb.table_from_rows) == expected


def test_order(kb):
    assert [tuple(r) for r in kb.sorted.collect()] == [r[:4] for r in KB]
    assert [tuple(r) for r in kb.ranked.collect()] == KB


def test_next_words(kb):
    assert rows(kb.next_words(2)) == [KB[0], KB[1], KB[3]]


def test_text_form(kb):
    assert [r.line for r in table_lines(kb.sorted).collect()] == [
        "A B C\t0.16666666666666666",
        "A B E\t0.16666666666666666",
        "A B D\t0.041666666666666664",
        "X Y Z\t0.1875",
    ]
