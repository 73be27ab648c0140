"""Which lines count, and what is read from them."""

import pytest
from tables import rows

from wordloom.functions.ngrams import capture_groups
from wordloom.operators.counts import corpus_total
from wordloom.operators.parse import check_lines, parse_lines, rejected_lines, split_corpus
from wordloom.plans.knowledge_base import KnowledgeBase, counts_of_lines


@pytest.mark.parametrize(
    "line",
    [
        "A  B C\t1990\t3",
        " A B C\t1990\t3",
        "A B C \t1990\t3",
        "A'S B C\t1990\t3",
        "A1 B C\t1990\t3",
        "É B C\t1990\t3",
        "A B C D\t1990\t3",
        "a b c\t1990\t3",
        "Ab B C\t1990\t3",
        "A B C\t19900\t3",
        "A B C\t1990\t",
        "A B C\t1990\t-3",
        "A B C 1990 3",
        "x\nA B C\t1990\t3",
        "A B C\t1990\t3\n",
        "A B C\t1990\t3\t1\r",
        "",
        None,
    ],
)
def test_rejected(frame, line):
    lines = frame([(0, line)])
    assert rows(parse_lines(lines)) == []
    assert rejected_lines(lines).count() == 1


@pytest.mark.parametrize(
    "line, occurrences",
    [
        ("A B C\t1990\t3", 3),
        ("A B C\t1990\t3abc", 3),
        ("A B C\t1990\t3.5\t1", 3),
        ("A B C\t1990\t003\t7\t8", 3),
        ("A B C\t1990\t0", 0),
        ("A B C\t1990\t9223372036854775807", 9223372036854775807),
    ],
)
def test_kept(frame, line, occurrences):
    assert rows(parse_lines(frame([(4, line)]))) == [(4, "A B C", occurrences)]


def test_count_beyond_bigint_raises(frame):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_lines(frame([(0, "A B C\t1990\t99999999999999999999")])).collect()


def test_sum_beyond_bigint_raises(frame):
    top = "A B C\t1990\t9223372036854775807"
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        counts_of_lines(frame([(0, top), (2, top)])).collect()


def test_parts_of_negative_and_large_ids(frame):
    occurrences = parse_lines(frame([(i, "A B C\t1990\t1") for i in (-2, -1, 2**40, 2**40 + 1)]))
    assert [p for _, p, _ in rows(split_corpus(occurrences))] == [1, 1, 2, 2]


def test_other_word_pattern(frame):
    lines = frame([(0, "don't stop now\t1990\t3")])
    assert rows(parse_lines(lines)) == []
    assert rows(parse_lines(lines, word="[A-Za-z']+")) == [(0, "don't stop now", 3)]


@pytest.mark.parametrize(
    "word, kept",
    [
        ("[A-Z]+|[0-9]+", [(0, "A 7 C", 3)]),
        ("([A-Z])+|(?:([0-9])+)", [(0, "A 7 C", 3)]),
        ("[^ ]+", [(0, "A 7 C", 3), (2, "don't\tstop me now", 4), (3, "é ( [", 5)]),
        (r"\S+", [(0, "A 7 C", 3), (3, "é ( [", 5)]),
        (r"[\](A-Z]+", []),
    ],
)
def test_any_word_pattern(frame, word, kept):
    lines = frame(
        [
            (0, "A 7 C\t1990\t3\t1\t1"),
            (1, "HELLO this is junk"),
            (2, "don't\tstop me now\t1990\t4"),
            (3, "é ( [\t1990\t5"),
            (4, None),
            (5, "A B\t1990\t6"),
        ]
    )
    assert rows(parse_lines(lines, word)) == kept
    checked = rows(check_lines(lines, word), "ok", "line_id")
    assert len(checked) == 6 and sum(ok for ok, _ in checked) == len(kept)
    known = lines.where("line is not null")
    assert rejected_lines(known, word).count() + len(kept) == known.count()


def test_capture_groups_are_counted():
    patterns = {"a": 0, "(a)": 1, "(?:a)": 0, r"\(a": 0, "[(]": 0, "(?<x>a)(?<=b)(?<!c)": 1, r"\Q(\E(b)": 1}
    assert {p: capture_groups(p) for p in patterns} == patterns


def test_empty_input(frame):
    lines = frame([])
    kb = KnowledgeBase(counts_of_lines(lines))
    assert rows(corpus_total(parse_lines(lines))) == [(0,)]
    assert rows(kb.total) == [(0,)]
    for df in (kb.counts, kb.stats, kb.stats_rows, kb.table, kb.sorted, kb.ranked, kb.next_words(1)):
        assert df.count() == 0


def test_trigram_in_one_part_only(frame):
    kb = KnowledgeBase(counts_of_lines(frame([(1, "A B C\t1990\t2"), (0, "A B D\t1990\t1")])))
    # A B C: r1 = 0, so part 1 contributes the statistics of frequency 0.
    assert rows(kb.with_stats) == [
        ("A", "B", "C", 0, 2, 1, 2, 1, 0),
        ("A", "B", "D", 1, 0, 1, 0, 1, 1),
    ]


def test_zero_counts_give_no_probability(frame):
    kb = KnowledgeBase(counts_of_lines(frame([(0, "A B C\t1990\t0"), (1, "A B D\t1990\t0")])))
    assert rows(kb.table) == [("A", "B", "C", None), ("A", "B", "D", None)]
    assert rows(kb.table_from_rows) == rows(kb.table)
    assert rows(kb.ranked, "w3", "pos") == [("C", 1), ("D", 2)]
