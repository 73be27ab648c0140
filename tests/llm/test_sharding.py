"""Ring sharding: counts, slots, and what moves when a shard is added."""

from collections import Counter

import zlib

from wordloom.llm.sharding import capacities, place_arcs, ring_points, shard_documents


def test_counts_are_at_most_one_apart_and_slots_gapless(documents, nasty):
    rows = shard_documents(nasty, shards=5).collect()
    assert len(rows) == nasty.count()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 5
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    texts = [((r.text or "").encode(), r.doc_id) for r in nasty.collect()]
    expected = Counter((d, len(t) + 16, zlib.crc32(t)) for t, d in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected


def test_one_key_may_hold_most_rows(documents):
    rows = shard_documents(documents([(7, "same")] * 90 + [(i, "x") for i in range(30)]), shards=4).collect()
    assert Counter(Counter(r.shard for r in rows).values()) == {30: 4}


def test_empty_table(documents):
    assert shard_documents(documents([]), shards=4).collect() == []


def test_a_row_goes_to_the_first_point_with_room():
    """The arcs' placing against a walk of every single row."""
    owners = [shard for _, shard in ring_points(6, 8)]
    arc_rows = [(7 * i * i) % 23 for i in range(len(owners))]
    room = capacities(sum(arc_rows), 6, 0.0)
    placed = place_arcs(arc_rows, owners, room)
    left, walk = list(room), Counter()
    waiting = list(enumerate(arc_rows))
    for step in range(len(owners)):  # rows that found no room ask the next point, arc by arc
        nxt = []
        for arc, n in waiting:
            shard = owners[(arc + step) % len(owners)]
            for _ in range(n):
                if left[shard]:
                    left[shard] -= 1
                    walk[arc, shard] += 1
                    n -= 1
            nxt.append((arc, n))
        waiting = nxt
    mine = Counter()
    for arc, lo, hi, shard, _ in placed:
        mine[arc, shard] += hi - lo
    assert mine == walk and sum(walk.values()) == sum(arc_rows)


def test_adding_a_shard_moves_a_limited_part(documents):
    docs = documents([(i, "t") for i in range(4000)])
    placed = {
        n: {r.doc_id: r.shard for r in shard_documents(docs, shards=n, slack=0.5).collect()} for n in (20, 21)
    }
    counts = Counter(placed[20].values())
    assert max(counts.values()) <= 1.5 * 4000 / 20 + 1
    moved = sum(placed[20][d] != placed[21][d] for d in placed[20])
    assert 0 < moved < 3 * 4000 / 21
