"""The join with the statistics, broadcast or shuffled."""

import random

import pytest
from tables import rows

from wordloom.plans.knowledge_base import KnowledgeBase

COUNTS = "w1 STRING, w2 STRING, w3 STRING, r1 BIGINT, r2 BIGINT"


@pytest.fixture
def counts():
    """Most trigrams are seen once, a few hundred frequencies are seen at all."""
    rng = random.Random(11)
    out = []
    for i in range(3000):
        r = rng.choice([(1, 0), (0, 1), (1, 0), (0, 1), (rng.randrange(300), rng.randrange(1, 300))])
        out.append((f"A{i % 50}", f"B{i % 7}", f"C{i}", *r))
    return out


def brute_force(counts):
    nr, tr = {}, {}
    for *_, r1, r2 in counts:
        for key, other in (((1, r1), r2), ((2, r2), r1)):
            nr[key] = nr.get(key, 0) + 1
            tr[key] = tr.get(key, 0) + other
    n = sum(r1 + r2 for *_, r1, r2 in counts)
    out = []
    for w1, w2, w3, r1, r2 in counts:
        one, two = (1, r1), (2, r2)
        p = float(tr[one] + tr[two]) / (float(n) * float(nr[one] + nr[two]))
        out.append((w1, w2, w3, r1, r2, nr[one], tr[one], nr[two], tr[two], p))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_broadcast_rows", [1_000_000, 100, 10, 3, 1, 0])
def test_all_ways_agree_with_brute_force(frame, counts, max_broadcast_rows):
    kb = KnowledgeBase(frame(counts, COUNTS), max_broadcast_rows=max_broadcast_rows)
    expected = brute_force(counts)
    assert rows(kb.with_stats) == sorted((r[:9] for r in expected), key=repr)
    assert rows(kb.table) == sorted(((*r[:3], r[9]) for r in expected), key=repr)


def test_way_is_chosen_by_the_number_of_statistics(frame, counts):
    def plan(limit):
        df = KnowledgeBase(frame(counts, COUNTS), max_broadcast_rows=limit).with_stats
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "Union" not in plan(1_000_000)
    assert "Union" in plan(5)


def test_equal_frequencies_give_equal_probabilities(frame, counts):
    from pyspark.sql import functions as F

    kb = KnowledgeBase(frame(counts, COUNTS))
    joined = kb.table.join(kb.counts, ["w1", "w2", "w3"])
    per_cell = joined.groupBy("r1", "r2").agg(F.count_distinct("p").alias("n"))
    assert rows(per_cell.select("n").distinct()) == [(1,)]


def test_sums_of_statistics(frame, counts):
    kb = KnowledgeBase(frame(counts, COUNTS))
    sums = kb.stats.groupBy().sum("nr1", "nr2", "tr1", "tr2").first()
    r1, r2 = sum(c[3] for c in counts), sum(c[4] for c in counts)
    assert tuple(sums) == (len(counts), len(counts), r2, r1)
    assert rows(kb.total) == [(r1 + r2,)]


def test_swapping_the_parts_changes_nothing(frame, counts):
    swapped = [(*c[:3], c[4], c[3]) for c in counts]
    one, two = (rows(KnowledgeBase(frame(c, COUNTS)).table) for c in (counts, swapped))
    assert one == two
