"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

Words come from the texts with their number of occurrences (:func:`vocabulary`). Two words are
near if one inserted, deleted or replaced character makes one of the other. If so, and the shorter
has ``m`` characters, they share their first ``ceil(m / 2)`` or their last ``floor(m / 2)``
characters, since an edit has a whole half of the shorter word on one of its sides. So the
vocabulary is laid out in two sorted lists, of words and of words reversed, and each list in
blocks: words of ``m`` or ``m + 1`` characters with the same first half. Near words meet in a
block of one of the lists at least, and a pair that meets in both is taken from the first.

A block is compared with itself by edit matrices of which only the three diagonals next to the
main one are kept, as larger distances do not count. Words of a sorted list that agree with the
word before in their first ``l`` characters (``l`` is their longest common prefix) have the first
``l`` rows of the matrix in common with it. So rows are worked out once per range of words that
share a prefix, for all the words compared with it at once; where a row holds nothing below two,
the whole range is skipped.

Blocks are dealt by hash and sorted by Spark. A block of more than ``SLICE`` words is cut into
slices, and each two slices are compared by themselves, so a task holds two slices at a time and no
pair is left out. Rows of matrices are kept for at most about ``AT_ONCE`` pairs.

A word's form is its most frequent near word (ties: the smallest in code-point order) if that is
at least ``TIMES`` as frequent as the word. Forms lead to ever more frequent words, so following
them ends; the last one, the root, is found by pointer doubling, in as many rounds as the binary
logarithm of the longest chain.

Defined results: null and empty texts have no words; a null id is the empty string where ids are
hashed; repeated rows count again; words of any length are compared whole; an empty table gives no
rows; columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import documents, give_back, prepare, stage
from wordloom.plans.staging import broadcast_if_small

# What a character of Latin-1 becomes: letters (A-Z, a-z and those from U+00C0 on) stay, A-Z in
# lower case; all others part words, and characters beyond Latin-1 have become question marks.
LETTERS = bytes(b if b >= 0xC0 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
TYPO_EVERY = 97
TALLY = 300_000
SLICE = 20_000
AT_ONCE = 1_000_000
BATCH_WORDS, BATCH_CELLS = 20_000, 20_000_000
PAIRS = "a string, a_n long, b string, b_n long"
FAR = 2  # a distance that is too large, whatever it is


class _Tally(dict):
    """Occurrences of words (in Latin-1, which holds every letter), with the misspellings put in."""

    def __init__(self, length: int, typo_every: int):
        super().__init__()
        self.length, self.typo_every = length, typo_every

    def add(self, doc_id: int | None, text: str) -> None:
        runs = text.encode("latin-1", "replace").translate(LETTERS).split(b" ")
        own = Counter([run for run in runs if len(run) >= self.length])
        head = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
        crc32, get = zlib.crc32, self.get
        for run, n in own.items():
            code = crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
            if code % self.typo_every == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < self.length:
                    continue
            self[run] = get(run, 0) + n

    def taken(self) -> pa.RecordBatch:
        words = [word.decode("latin-1") for word in self]
        columns = [pa.array(words, pa.string()), pa.array(list(self.values()), pa.int64())]
        self.clear()
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])


def vocabulary(
    docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT, typo_every: int = TYPO_EVERY
) -> DataFrame:
    """``word, n``: the words of at least ``length`` characters that occur ``count`` times.

    A run of letters loses one character if the hash of document and run is divisible by
    ``typo_every``: misspellings that any engine can make again. Words are tallied per task, up
    to ``TALLY`` at a time, before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(length, typo_every)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tally.add(doc_id, text.as_py())
                if len(tally) >= TALLY:
                    yield tally.taken()
        yield tally.taken()
        give_back()

    columns = documents(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").where("text is not null")
    tallied = columns.mapInArrow(run, "word string, n long")
    return tallied.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def blocks(words: DataFrame) -> DataFrame:
    """``way, m, half, spelled, n``: the words' places in the blocks of both lists."""
    size = F.char_length("word")
    each = words.select(
        "n",
        F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("word").alias("spelled")), F.struct(F.lit(1).alias("way"), F.reverse("word").alias("spelled")))).alias("l"),
        F.explode(F.array(size, size - 1)).alias("m"),
    ).select("n", "m", "l.*")
    half = F.when(F.col("way") == 0, F.floor((F.col("m") + 1) / 2)).otherwise(F.floor(F.col("m") / 2))
    half = half.cast("int")
    return each.select("way", "m", F.substr("spelled", F.lit(1), half).alias("half"), "spelled", "n")


def sliced(placed: DataFrame, slice_words: int) -> DataFrame:
    """Blocks of two words or more, with ``slices``: large ones are compared slice by slice.

    ``x, y`` name the two slices a row is there for, ``listed`` and ``asked`` tell in which role.
    """
    block = ["way", "m", "half"]
    sizes = placed.groupBy(*block).agg(F.count("*").alias("size")).where("size > 1")
    large = sizes.where(F.col("size") > slice_words).select(
        *block, F.ceil(F.col("size") / slice_words).cast("int").alias("slices")
    )
    placed = placed.join(broadcast_if_small(large), block, "left")
    slices = F.coalesce("slices", F.lit(1))
    own = F.pmod(F.xxhash64("spelled"), slices).cast("int")
    rows = placed.select(*block, "spelled", "n", own.alias("own"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("other"))
    return rows.select(
        *block, "spelled", "n",
        F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") <= F.col("other")).alias("listed"), (F.col("own") >= F.col("other")).alias("asked"),
    )


class _Sorted:
    """Sorted words of several blocks as a matrix of characters, with common prefixes."""

    def __init__(self, words: list[str], block: np.ndarray):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        width = int(self.size.max(initial=0)) + 2
        text = "".join([w.ljust(width, "\0") for w in words])
        self.chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(words), width)
        same = self.chars[1:] == self.chars[:-1]
        prefix = np.where(same.all(axis=1), width, same.argmin(axis=1))
        prefix = np.minimum(prefix, np.minimum(self.size[1:], self.size[:-1]))
        # -1: a block's first word has nothing in common with the word before
        self.prefix = np.concatenate([[-1], np.where(block[1:] == block[:-1], prefix, -1)])[: len(words)]


def _near(listed: _Sorted, asked: _Sorted, lo: np.ndarray, hi: np.ndarray, q: np.ndarray, depth: int):
    """Positions (in ``listed``, in ``asked``) of words exactly one edit apart.

    Word ``q[i]`` is compared with the listed words ``lo[i]:hi[i]``; all of them share their first
    ``depth`` characters.
    """
    bounds: dict[int, np.ndarray] = {}
    n = len(listed.prefix)
    start = np.tile(np.array([1, 0, 1], np.int8), (len(q), 1))
    work = [(depth, lo, hi, q, start)]
    while work:
        depth, lo, hi, q, row = work.pop()
        # A range's first word ends here if it is as long as the prefix.
        ends = np.flatnonzero(listed.size[lo] == depth)
        if len(ends):
            off = asked.size[q[ends]] - depth
            ok = np.abs(off) <= 1
            ends, off = ends[ok], off[ok]
            hit = ends[row[ends, off + 1] == 1]
            if len(hit):
                yield lo[hit], q[hit]
        if depth not in bounds:
            bounds[depth] = np.flatnonzero(listed.prefix <= depth)
        edge = bounds[depth]
        # Longer prefixes: the ranges between the bounds, but for the word that ends here.
        first = np.searchsorted(edge, lo + (listed.size[lo] == depth))
        last = np.searchsorted(edge, hi)
        many = last - first
        total = np.cumsum(many)
        at = 0
        while at < len(q):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + AT_ONCE, side="right")))
            part, parent = many[at:to], np.repeat(np.arange(at, to), many[at:to])
            if len(parent):
                inner = np.arange(len(parent)) - np.repeat(np.cumsum(part) - part, part)
                child = first[parent] + inner
                child_lo = edge[child]
                child_hi = np.append(edge, n)[child + 1]
                child_q, old = q[parent], row[parent]
                new = _next_row(old, listed.chars[child_lo, depth], asked.chars, child_q, depth)
                alive = np.flatnonzero(new.min(axis=1) < FAR)
                if len(alive):
                    work.append((depth + 1, child_lo[alive], child_hi[alive], child_q[alive], new[alive]))
            at = to


def _next_row(old: np.ndarray, c: np.ndarray, chars: np.ndarray, q: np.ndarray, depth: int) -> np.ndarray:
    """The matrix rows after one more listed character ``c``, on the diagonals -1, 0 and 1."""
    width = chars.shape[1]

    def differs(at: int) -> np.ndarray:
        if not 0 <= at < width:
            return np.ones(len(c), np.int8)
        return (chars[q, at] != c).astype(np.int8)

    new = np.empty_like(old)
    new[:, 0] = np.minimum(old[:, 1] + 1, old[:, 0] + differs(depth - 1))
    new[:, 1] = np.minimum(np.minimum(old[:, 2], new[:, 0]) + 1, old[:, 1] + differs(depth))
    new[:, 2] = np.minimum(new[:, 1] + 1, old[:, 2] + differs(depth + 1))
    return np.minimum(new, FAR, out=new)


def compare(rows: pa.Table) -> pa.RecordBatch:
    """Near pairs among the rows of whole blocks of one ``way`` and ``m``, sorted."""
    way, m = rows["way"][0].as_py(), rows["m"][0].as_py()
    depth = (m + 1) // 2 if way == 0 else m // 2
    words, counts = rows["spelled"].to_pylist(), rows["n"].to_numpy()
    listed_here, asked_here = (rows[c].to_numpy(zero_copy_only=False) for c in ("listed", "asked"))
    block = np.zeros(len(words), np.int64)
    keys = list(zip(rows["half"].to_pylist(), rows["x"].to_pylist(), rows["y"].to_pylist()))
    block[1:] = np.cumsum([a != b for a, b in zip(keys, keys[1:])])
    own, theirs = np.flatnonzero(listed_here), np.flatnonzero(asked_here)
    listed = _Sorted([words[i] for i in own], block[own])
    asked = _Sorted([words[i] for i in theirs], block[theirs])
    lo = np.searchsorted(block[own], block[theirs])
    hi = np.searchsorted(block[own], block[theirs], side="right")
    q = np.flatnonzero(lo < hi)
    a, b = [], []
    for found, by in _near(listed, asked, lo[q], hi[q], q, depth):
        i, j = own[found], theirs[by]
        x, y = listed.chars[found], asked.chars[by]
        # Within one slice a pair is found from both of its words.
        ok = (~(asked_here[i] & listed_here[j]) | (i < j)) & (np.minimum(listed.size[found], asked.size[by]) == m)
        if way == 1:  # the pair is the first list's if it shares the first half of characters too
            head = (m + 1) // 2
            ok &= ~_share_last(x, listed.size[found], y, asked.size[by], head)
        a.append(i[ok])
        b.append(j[ok])
    a = np.concatenate(a) if a else np.zeros(0, np.int64)
    b = np.concatenate(b) if b else np.zeros(0, np.int64)
    spelled = [w[::-1] for w in words] if way else words
    columns = [
        pa.array([spelled[i] for i in a], pa.string()), pa.array(counts[a], pa.int64()),
        pa.array([spelled[i] for i in b], pa.string()), pa.array(counts[b], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["a", "a_n", "b", "b_n"])


def _share_last(x, x_size, y, y_size, many: int) -> np.ndarray:
    """If two words (rows of characters) share their last ``many`` characters."""
    back = np.arange(1, many + 1)
    rows = np.arange(len(x))[:, None]
    return (x[rows, x_size[:, None] - back] == y[rows, y_size[:, None] - back]).all(axis=1)


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole blocks, of one ``way`` and ``m`` each, from sorted rows."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        rows = sum(b.num_rows for b in kept)
        if rows >= BATCH_WORDS:
            yield from _cut(pa.Table.from_batches(kept), kept)
    if kept:
        yield from _cut(pa.Table.from_batches(kept), kept, last=True)


def _cut(table: pa.Table, kept: list, last: bool = False) -> Iterator[pa.Table]:
    """Cut off what is whole; the block that may go on stays in ``kept``."""
    names = ["way", "m", "half", "x", "y"]
    columns = [table[c].to_pylist() for c in names]
    keys = list(zip(*columns))
    edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
    if not last:
        edges.pop()
    kept[:] = [] if last else table.slice(edges[-1]).combine_chunks().to_batches()
    start = 0
    for i in range(1, len(edges)):
        size = edges[i] - edges[start]
        other = i + 1 < len(edges) and keys[edges[i]][:2] != keys[edges[start]][:2]
        longest = keys[edges[start]][1] + 1
        if i + 1 == len(edges) or other or size >= BATCH_WORDS or size * longest >= BATCH_CELLS:
            yield table.slice(edges[start], size)
            start = i


def near_words(words: DataFrame, slice_words: int = SLICE) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of near words of ``words(word, n)`` once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            if table.num_rows > 1:
                yield compare(table)
        give_back()

    rows = sliced(blocks(words), slice_words)
    key = ["way", "m", "half", "x", "y"]
    return rows.repartition(*key).sortWithinPartitions(*key, "spelled").mapInArrow(run, PAIRS)


def roots_of(forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``forms(word, form)`` ends, for every word with a form."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = roots.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        jumped = stage(jumped, "spelling_roots")
        roots = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return roots


def group_variants(words: DataFrame, times: int = TIMES, slice_words: int = SLICE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the vocabulary ``words(word, n)``."""
    prepare(words.sparkSession)
    pairs = stage(near_words(words, slice_words), "near_words")
    both = pairs.select("a", "b", "b_n").union(pairs.select("b", "a", "a_n")).toDF("word", "near", "near_n")
    best = F.min(F.struct((-F.col("near_n")).alias("key"), F.col("near"))).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(near, "word", "left")
    enough = -F.col("best.key") >= times * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.key")).alias("form_n"),
    )
    known = stage(known, "spelling_forms")
    roots = roots_of(known.where("form is not null"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling_variants(spark, sf_dir) -> DataFrame:
    prepare(spark)
    words = stage(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet")), "vocabulary")
    return group_variants(words)
