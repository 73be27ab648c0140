"""SimHash near-duplicates with a byte-position inverted index and count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at most ``d`` bits
share at least ``8 - d`` positional bytes; that is the guaranteed minimum of matches. The lists
of the index are keyed by several positional bytes at once (for two bits, two of four
neighbouring pairs of bytes), such that every pair that reaches the minimum meets in one: a list
of a single byte would hold 1/256 of all fingerprints. Inside a list the positional bytes that
each pair shares are tallied; pairs below the minimum are dropped, the others verified bit by
bit. Lists work on distinct fingerprints. One of more than ``LARGE_LIST`` of them is split by
all but ``d`` of the bytes left over, so that for two bits no list exceeds the greater of that
and ``256**2`` (four bits or more leave no byte to split by). A list passes on a spanning set of its
links instead of all pairs; components are the same.

Defined results: an empty or null text, or one of white space only, has fingerprint zero and
links like any other; fewer words than a shingle make one shingle of the whole sequence; equal
texts share a fingerprint and so a component; a null ``doc_id`` takes part, but is never a
component's id unless all of its ids are null; columns other than ``doc_id`` and ``text`` are
not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import documents, give_back, partitions, prepare, stage, text_bytes
from wordloom.llm.components import connected_components

SEED = 42
SHINGLES_AT_ONCE = 50_000
LARGE_LIST = 10_000


def fingerprint(data: bytes, words: int) -> int:
    """64 bits, each set if set in over half of the shingles' hashes."""
    tokens = data.lower().split()  # of ASCII letters and white space only, as bytes have it
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    count, ones = len(tokens) - words + 1, np.zeros(64, np.int64)
    for lo in range(0, count, SHINGLES_AT_ONCE):
        part = tokens[lo : lo + SHINGLES_AT_ONCE + words - 1]
        shingles = zip(*(part[i:] for i in range(words)))
        hashes = np.array([digest(join(s), SEED) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fp`` with the fingerprint's 64 bits in a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(data.as_py(), words) for data in batch.column(1)]
            values = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"]
            )
        give_back()

    columns = documents(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), text_bytes().alias("data")
    )
    return columns.mapInArrow(run, "doc_id long, fp long")


def byte_matches(x: np.ndarray, y: np.uint64) -> np.ndarray:
    """The tally: how many positional bytes each of ``x`` shares with ``y``."""
    return 8 - np.count_nonzero((x ^ y).view(np.uint8).reshape(-1, 8), axis=1)


def spanning_links(values: list[int], distance: int) -> list[tuple[int, int]]:
    """Pairs within ``distance`` bits that connect what all such pairs would connect.

    Shared bytes are tallied for every pair of the list; only pairs that reach the guaranteed
    minimum are verified bit by bit.
    """
    x = np.array(values, np.int64).view(np.uint64)
    root = list(range(len(x)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i in range(len(x) - 1):
        rest = x[i + 1 :]
        at = np.flatnonzero(byte_matches(rest, x[i]) >= 8 - distance)
        near = at[np.bitwise_count(rest[at] ^ x[i]) <= distance] + i + 1
        for j in near.tolist():
            if (a := find(i)) != (b := find(j)):
                root[b] = a
                links.append((values[i], values[j]))
    return links


def list_bytes(distance: int) -> list[tuple[int, ...]]:
    """The byte positions that key each kind of list.

    The eight positions are cut into twice as many stretches as bits may differ (eight at most).
    A pair within ``distance`` bits agrees on all but ``distance`` stretches, so it meets in a
    list that is keyed by the others: six kinds of four bytes for two bits.
    """
    stretches = min(8, 2 * distance)
    cuts = [round(8 * i / stretches) for i in range(stretches + 1)]
    parts = [range(a, b) for a, b in zip(cuts, cuts[1:])]
    return [
        tuple(p for part in kept for p in part) for kept in combinations(parts, stretches - distance)
    ]


def split_bytes(taken: tuple[int, ...], distance: int) -> list[tuple[int, ...]]:
    """The positions that key the lists into which a large list is split: those of the list and
    all but ``distance`` of the others, or only the list's own if no other is sure to agree."""
    others = [p for p in range(8) if p not in taken]
    return [taken + more for more in combinations(others, max(0, len(others) - distance))]


def masked(positions: tuple[int, ...]) -> Column:
    mask = sum(0xFF << (8 * p) for p in positions)
    return F.col("fp").bitwiseAND(F.lit(mask - 2**64 if mask >> 63 else mask).cast("long"))


def near_links(fps: DataFrame, distance: int = 2, large: int = LARGE_LIST) -> DataFrame:
    """``a, b``: links among distinct fingerprints (column ``fp``) within ``distance`` bits.

    Not all links, but enough of them to give the same components. Lists of more than ``large``
    fingerprints are found by counting and split by further bytes before they are gathered.
    """
    if not 0 < distance < 8:
        raise ValueError("between 1 and 7 bits leave a byte to look up")
    fps = fps.select("fp").repartition(partitions(fps.sparkSession))
    kinds = list_bytes(distance)
    keys = F.array(*[F.struct(F.lit(i).alias("kind"), masked(p).alias("key")) for i, p in enumerate(kinds)])
    postings = fps.select("fp", F.explode(keys).alias("l")).select("fp", "l.*")
    hot = stage(postings.groupBy("kind", "key").count().where(F.col("count") > large), "large_lists")
    part = F.lit(-1).alias("part")
    if hot.isEmpty():
        postings = postings.select("fp", "kind", part, "key")
    else:
        hot = hot.select("kind", "key", F.lit(True).alias("hot"))
        joined = postings.join(hot, ["kind", "key"], "left")
        finer = F.lit(None)
        for i, taken in enumerate(kinds):
            each = [
                F.struct(F.lit(j).alias("part"), masked(p).alias("key"))
                for j, p in enumerate(split_bytes(taken, distance))
            ]
            finer = F.when(F.col("kind") == i, F.array(*each)).otherwise(finer)
        own = F.array(F.struct(part, F.col("key").alias("key")))
        lists = F.when(F.col("hot"), finer).otherwise(own)
        postings = joined.select("fp", "kind", F.explode(lists).alias("l")).select("fp", "kind", "l.*")
    members = postings.groupBy("kind", "part", "key").agg(F.collect_list("fp").alias("fps"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [p for own in batch.column(0).to_pylist() for p in spanning_links(own, distance)]
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

    several = members.where(F.size("fps") > 1).select("fps")
    return several.mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """``doc_id, fp, component_id``: components of documents linked by their fingerprints."""
    prepare(docs.sparkSession)
    fps = stage(fingerprints(docs, words), "fingerprints")
    distinct = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(near_links(distinct.select("fp"), distance))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    rooted = stage(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stage(rooted.join(least, "root").select("fp", "component_id"), "classes")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def op3_simhash(spark, sf_dir) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
