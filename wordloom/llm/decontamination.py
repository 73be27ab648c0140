"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into passages of ``PASSAGE`` words. Passages are TF-IDF vectors over hashed
words (a word counts once per passage; vectors have length 1), and the whole corpus of them is
a matrix A that is never built. Its leading right singular vectors come from a randomised SVD
in passes over the passages: one gives ``A'(A W)`` for a random W, whose orthonormal basis Q
spans the range; one gives ``(AQ)'(AQ)``, whose eigenvectors turn Q into the singular vectors
and whose eigenvalues are the squared singular values. Both are sums over passages, of fixed
size, added up in Spark. Passages and benchmark items are compared by cosine in that space, each
direction scaled by its singular value, so that what all texts of a language share does not
drown what they differ in.

Passages, and pairs of neighbouring ones, with a cosine of at least ``COSINE`` are candidates;
for an item shorter than a passage, which fills less of it, the bound falls with the square
root of its share.
Whatever the cosine, the passage in which a text has a run of ``RUN`` words in common with an item
(all of a shorter item) is a candidate too: so no verbatim copy depends on how well the latent
space, which follows the corpus, tells it apart.
An item of more than two passages is also looked up by parts of about a passage each.
A candidate counts as a leak if the longest common subsequence of its words (with as many passages
as the item fills on either side) and the item's words covers ``COMMON`` of the item, or, as a paraphrase,
``PARAPHRASED`` of it and holds the item's answer as it stands. An item's answer is its last
sentence of at least ``ANSWER`` words.

Words are runs of letters and digits, lower-cased. Texts are tokenized once; later passes read
word hashes. The benchmark is searched for in slices of some ``ITEMS_AT_ONCE`` items, which bounds
what is broadcast, and every slice meets all passages.

Defined results: null or empty texts and items without words match nothing; repeated rows of
an item are one item; equal items under several ids are each reported; a null ``doc_id`` or
``item_id`` is kept; an empty benchmark or corpus gives no rows; other columns are not used.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import documents, give_back, prepare, stage, text_bytes

PASSAGE = 32
FEATURES = 1 << 13
RANK, EXTRA = 64, 16
COSINE = 0.36
COMMON, PARAPHRASED, ANSWER = 0.6, 0.5, 3
RUN = 8
ITEMS_AT_ONCE = 2_000
WORDS_AT_ONCE = 1 << 16
# Up to so many passages, an item's candidates are checked for its words all at once.
FEW_PASSAGES = 4
PASSAGES_AT_ONCE = 1 << 12
# Rows of a table gathered for one product, and bytes of text hashed side by side: what stays in a
# processor's cache costs a third of what does not.
ROWS_AT_ONCE = 1 << 12
BYTES_AT_ONCE = 1 << 19
# Words of up to so many bytes are hashed side by side.
SHORT = 32
ALNUM = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
HITS = "doc_id long, item_id long, cosine double, common double, answer boolean"


def word_hashes(data: bytes) -> np.ndarray:
    words = data.lower().translate(ALNUM).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def crc_table() -> np.ndarray:
    """What CRC-32 makes of each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


CRC = crc_table()


def hashes_side_by_side(texts: list[bytes]) -> list[np.ndarray]:
    """:func:`word_hashes` of each text; the n-th bytes of all words are taken at once, longer words
    first, so that those not at their end are always the first ones."""
    flat = np.frombuffer(b" ".join([b"", *texts, b""]).lower().translate(ALNUM), np.uint8)
    inside = flat != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, size = edges[::2], edges[1::2] - edges[::2]
    short = np.where(size > SHORT, 0, size)
    order = np.argsort((SHORT - short).astype(np.uint8), kind="stable")
    at, state = start[order], np.full(len(start), 0xFFFFFFFF, np.uint32)
    left = len(start) - np.cumsum(np.bincount(short, minlength=SHORT + 1))
    for nth, n in enumerate(left[left > 0].tolist()):
        own = state[:n]
        state[:n] = CRC[(own ^ flat[at[:n] + nth]) & 0xFF] ^ (own >> np.uint32(8))
    hashes = np.empty_like(state)
    hashes[order] = ~state
    for i in np.flatnonzero(size > SHORT).tolist():
        hashes[i] = zlib.crc32(flat[start[i] : start[i] + size[i]])
    ends = np.cumsum([len(text) + 1 for text in texts])
    return np.split(hashes, np.searchsorted(start, ends[:-1]))


def hashed_words(docs: DataFrame) -> DataFrame:
    """``doc_id, words``: 32-bit hashes of the words of each text that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, texts, size = [], [], 0
            for left, text in zip(range(batch.num_rows - 1, -1, -1), batch.column(1)):
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= BYTES_AT_ONCE or not left:
                    words += [own.tobytes() for own in hashes_side_by_side(texts)]
                    texts, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.binary())], ["doc_id", "words"]
            )
        give_back()

    columns = documents(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), text_bytes().alias("data")
    )
    words = columns.mapInArrow(run, "doc_id long, words binary")
    return words.where(F.octet_length("words") > 0)


@dataclass
class Lot:
    """Some documents' words in rows of ``PASSAGE``, filled up at each document's end."""

    words: np.ndarray  # (passages, PASSAGE), uint32
    used: np.ndarray  # which of them are words, and the first of their kind in the passage
    owner: np.ndarray  # the document of each passage
    first: np.ndarray  # the first passage of that document, and the one after its last
    end: np.ndarray
    features: np.ndarray


def lot_of(texts: list[np.ndarray], owners: list[int]) -> Lot:
    counts = np.array([-(-len(t) // PASSAGE) for t in texts])
    words = np.zeros((counts.sum(), PASSAGE), np.uint32)
    used = np.zeros(words.shape, bool)
    flat, real = words.ravel(), used.ravel()
    for at, text in zip((np.cumsum(counts) - counts) * PASSAGE, texts):
        flat[at : at + len(text)] = text
        real[at : at + len(text)] = True
    features = (words % FEATURES).astype(np.int64)
    # Sorting puts equal features of a passage side by side; fillers sort behind everything.
    keyed = np.where(used, features, FEATURES).astype(np.int32) * PASSAGE + np.arange(PASSAGE, dtype=np.int32)
    keyed.sort(axis=1)
    kinds = keyed // PASSAGE
    row, at = np.nonzero(kinds[:, 1:] == kinds[:, :-1])
    used[row, keyed[row, at + 1] % PASSAGE] = False
    end = np.cumsum(counts)
    owner, first = np.repeat(owners, counts), np.repeat(end - counts, counts)
    return Lot(words, used, owner, first, np.repeat(end, counts), features)


def lots(batch: pa.RecordBatch, twice: int = 2) -> Iterator[Lot]:
    """The rows of a batch, some at a time; a longer text is cut after whole passages, with so
    many passages said ``twice`` that no neighbours are parted."""
    texts, owners, size = [], [], 0
    for i, cell in enumerate(batch.column(1)):
        words = np.frombuffer(cell.as_py(), np.uint32)
        for lo in range(0, len(words), WORDS_AT_ONCE):
            texts.append(words[lo : lo + WORDS_AT_ONCE + twice * PASSAGE * (lo + WORDS_AT_ONCE < len(words))])
            owners.append(i)
            size += len(texts[-1])
            if size >= WORDS_AT_ONCE:
                yield lot_of(texts, owners)
                texts, owners, size = [], [], 0
    if texts:
        yield lot_of(texts, owners)


def added_up(words: DataFrame, matrix, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all lots of ``matrix(lot)``, an array of the given shape.

    Tasks send their sums in groups of rows, which are added where they meet, one after the
    other; only the total comes to the driver.
    """
    group = max(1, shape[0] // 256)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for lot in lots(batch):
                matrix(lot, total)
        parts = range(0, shape[0], group)
        values = [total[p : p + group].tobytes() for p in parts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parts), pa.int64()), pa.array(values, pa.binary())], ["part", "values"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(values.as_py())
                totals[part] = totals[part] + own if part in totals else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int64()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
            ["part", "values"],
        )

    kind = "part long, values binary"
    sums = words.mapInArrow(partial, kind).repartition("part").mapInArrow(add, kind)
    total = np.zeros(shape)
    for row in sums.collect():
        total[row["part"] : row["part"] + group] += np.frombuffer(row["values"]).reshape(-1, shape[1])
    return total


def products(lot: Lot, weights: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each passage the sum of its features' rows of ``table``, by ``weights`` of its words."""
    out = np.empty((len(weights), 1, table.shape[1]), np.float32)
    step = ROWS_AT_ONCE // PASSAGE
    for lo in range(0, len(out), step):
        some = slice(lo, lo + step)
        np.matmul(weights[some, None, :], table.take(lot.features[some], axis=0), out=out[some])
    return out[:, 0]


@dataclass
class LatentSpace:
    """Weights of features, and their places in the latent space (weights included)."""

    weights: np.ndarray
    places: np.ndarray

    def sums(self, lot: Lot) -> np.ndarray:
        """The passages' vectors in the latent space, not brought to length 1."""
        return products(lot, lot.used.astype(np.float32), self.places)


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def passage_weights(lot: Lot, weights: np.ndarray) -> np.ndarray:
    return unit_rows(np.where(lot.used, weights[lot.features], 0)).astype(np.float32)


def sums_of_runs(first: np.ndarray, row: np.ndarray, weight: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sums of ``weight[i] * y[row[i]]`` over each run ``first[j] <= i < first[j + 1]``.

    Runs of about the same length are one product, the shorter filled up with weights of 0.
    """
    size = np.diff(first, append=len(row))
    order = np.argsort(-size, kind="stable")
    size, start = size[order], first[order]
    total = np.empty((len(first), y.shape[1]), y.dtype)
    lo = 0
    while lo < len(first):
        longest = int(size[lo])
        hi = lo + max(1, ROWS_AT_ONCE // longest)
        nth = np.arange(longest)
        at = np.minimum(start[lo:hi, None] + nth, len(row) - 1)
        own = weight.take(at)
        own[nth >= size[lo:hi, None]] = 0
        total[order[lo:hi]] = np.einsum("nk,nkj->nj", own, y.take(row.take(at), axis=0))
        lo = hi
    return total


def latent_space(words: DataFrame, rank: int = RANK, extra: int = EXTRA, seed: int = 3) -> LatentSpace:
    """The randomised SVD of all passages of ``words``."""

    def frequencies(lot: Lot, total: np.ndarray) -> None:
        total[:FEATURES, 0] += np.bincount(lot.features[lot.used], minlength=FEATURES)
        total[FEATURES, 0] += len(lot.words)

    counted = added_up(words, frequencies, (FEATURES + 1, 1))[:, 0]
    # Positive even for a word of every passage, so that no table is without weights.
    weights = np.log1p(counted[FEATURES] / (1 + counted[:FEATURES]))
    size = rank + extra
    probe = np.random.default_rng(seed).standard_normal((FEATURES, size)).astype(np.float32)
    context = words.sparkSession.sparkContext
    shared = context.broadcast((weights, probe))

    def project(lot: Lot, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tf_idf = passage_weights(lot, shared.value[0])
        return tf_idf, products(lot, tf_idf, basis)

    def reach(lot: Lot, total: np.ndarray) -> None:
        tf_idf, y = project(lot, shared.value[1])
        passage, at = np.nonzero(lot.used)
        feature = lot.features[passage, at]
        order = np.argsort(feature.astype(np.uint16), kind="stable")
        passage, at, feature = passage[order], at[order], feature[order]
        first = np.flatnonzero(np.concatenate([[True], feature[1:] != feature[:-1]]))
        total[feature[first]] += sums_of_runs(first, passage, tf_idf[passage, at], y)

    basis, _ = np.linalg.qr(added_up(words, reach, (FEATURES, size)))
    narrow = context.broadcast(basis.astype(np.float32))

    def gram(lot: Lot, total: np.ndarray) -> None:
        _, y = project(lot, narrow.value)
        total += y.T @ y

    values, vectors = np.linalg.eigh(added_up(words, gram, (size, size)))
    top = np.argsort(values)[::-1][:rank]
    # Scaling would blow up what is less than half a passage in the whole corpus: the difference
    # of one paraphrase from everything else, where all texts have the same words.
    top = top[values[top] >= min(0.5, values.max())]
    top = top[values[top] > 1e-12]
    places = basis @ (vectors[:, top] / np.sqrt(values[top]))
    return LatentSpace(weights, (weights[:, None] * places).astype(np.float32))


@dataclass
class Items:
    """Benchmark items: their ids, words, answers and vectors."""

    ids: list[int | None]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vectors: np.ndarray
    bounds: np.ndarray
    owner: np.ndarray  # the item of each vector and bound
    whole: np.ndarray  # the vector of each item as a whole
    sizes: np.ndarray
    reach: np.ndarray  # the passages that each item fills
    masks: list[dict[int, int]]
    has: np.ndarray  # which features each item has
    column: np.ndarray  # the number of each feature that some item has, from 1; 0: no item has it
    wanted: dict[int, tuple[np.ndarray, np.ndarray]]  # by reach: the row of each item, their columns
    runs: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]  # length; sorted hashes, the item of each, marks


def describe_items(ids: list[int | None], texts: list[str], space: LatentSpace) -> Items:
    words, answers, vectors, owner, filled = [], [], [], [], []
    for text in texts:
        own = word_hashes(text.encode())
        sentences = [word_hashes(s.encode()) for s in re.split(r"[.!?\n]+", text)]
        long = [s for s in sentences if len(s) >= ANSWER]
        words.append(own)
        answers.append(long[-1] if long else own[:0])
        parts = -(-len(own) // PASSAGE)
        for part in [own, *(np.array_split(own, parts) if parts > 2 else [])]:
            vectors.append(space.places[np.unique(part % FEATURES)].sum(axis=0))
            filled.append(min(1, len(part) / PASSAGE))
            owner.append(len(words) - 1)
    masks, has = [], np.zeros((len(words), FEATURES), bool)
    for k, own in enumerate(words):
        has[k, own % FEATURES] = True
        mask: dict[int, int] = {}
        for i, word in enumerate(own.tolist()):
            mask[word] = mask.get(word, 0) | 1 << i
        masks.append(mask)
    bounds = least_float32(np.where(np.array(filled) > 0, COSINE * np.sqrt(filled), 2))
    sizes = np.array([len(own) for own in words], np.int64)
    vectors = unit_rows(np.array(vectors).reshape(len(owner), -1)).astype(np.float32)
    reach = np.maximum(1, -(-sizes // PASSAGE))
    whose = np.array(owner, np.int64)
    whole = np.searchsorted(whose, np.arange(len(words)))
    column, wanted = np.zeros(FEATURES, np.int64), {}
    column[has.any(axis=0)] = np.arange(1, np.count_nonzero(has.any(axis=0)) + 1)
    for far in np.unique(reach[reach <= FEW_PASSAGES]).tolist():
        mine = np.flatnonzero(reach == far)
        row, columns = np.zeros(len(words), np.int64), np.zeros((len(mine), far * PASSAGE), np.int64)
        row[mine] = np.arange(len(mine))
        for own, k in zip(columns, mine.tolist()):
            own[: sizes[k]] = column[words[k] % FEATURES]
        wanted[far] = row, columns
    runs = []
    for size in sorted({min(RUN, len(own)) for own in words if len(own)}):
        mine = [i for i, own in enumerate(words) if min(RUN, len(own)) == size]
        own = [np.unique(run_hashes(words[i], size)) for i in mine]
        hashes, holder = np.concatenate(own), np.repeat(mine, [len(h) for h in own])
        order = np.argsort(hashes, kind="stable")
        marks = np.zeros(1 << (16 * len(hashes)).bit_length(), bool)
        marks[hashes & np.uint64(len(marks) - 1)] = True
        runs.append((size, hashes[order], holder[order], marks))
    return Items(ids, words, answers, vectors, bounds, whose, whole, sizes, reach, masks, has, column, wanted, runs)


def least_float32(x: np.ndarray) -> np.ndarray:
    """The least float32 that is no smaller, so that comparing float32 with it decides the same."""
    near = x.astype(np.float32)
    return np.where(near < x, np.nextafter(near, np.float32(np.inf)), near)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words, made of those of runs of 1, 2, 4 and so on."""

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mixed = (a * np.uint64(0xC2B2AE3D27D4EB4F) + b + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        return mixed

    number = max(0, len(words) - size + 1)
    part = words.astype(np.uint64)
    mixed, done, width = np.zeros(number, np.uint64), 0, 1
    while width <= size:
        if size & width:
            mixed = joined(mixed, part[done : done + number])
            done += width
        if 2 * width <= size:
            part = joined(part[:-width], part[width:])
        width *= 2
    return mixed


def same_runs(lot: Lot, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Passages in which a run of an item's words begins, and these items."""
    flat, passages, found = lot.words.ravel(), [], []
    for size, hashes, holder, marks in items.runs:
        own = run_hashes(flat, size)
        at = np.flatnonzero(marks.take((own & np.uint64(len(marks) - 1)).view(np.int64)))
        at = at[lot.owner[at // PASSAGE] == lot.owner[(at + size - 1) // PASSAGE]]
        lo = np.searchsorted(hashes, own[at])
        many = np.searchsorted(hashes, own[at], "right") - lo
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        passages.append(np.repeat(at // PASSAGE, many))
        found.append(holder[np.repeat(lo, many) + nth])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(passages), np.concatenate(found)


def stretch(lot: Lot, passage: int, reach: int) -> slice:
    """The passages that hold a copy which ``passage`` or the pair it begins is part of."""
    return slice(max(int(lot.first[passage]), passage - reach), min(int(lot.end[passage]), passage + reach + 2))


def likely(lot: Lot, items: Items, passage: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Which candidates hold enough of the item's words, in whatever order, to be a leak.

    No common subsequence is longer than the number of the item's words that occur at all.
    """
    row, at = np.nonzero(lot.used)
    column = items.column.take(lot.features[row, at])
    # A bit per feature that some item has, in whole 64-bit numbers; column 0 is in no passage.
    width = -(-(int(items.column.max()) + 1) // 64) * 64
    present = np.zeros((len(lot.words), width), bool)
    present[row, column] = True
    present[:, 0] = False
    present = np.packbits(present, axis=1, bitorder="little").view(np.uint64)
    number = np.zeros(len(passage), np.int64)
    reaches = items.reach[item]
    for reach, (place, columns) in items.wanted.items():
        # What the passages around each one hold, in one text.
        around = present.copy()
        for step in [*range(-reach, 0), *range(1, reach + 2)]:
            pairs = max(0, len(present) - abs(step))
            here, there = (slice(lo, lo + pairs) for lo in (max(0, -step), max(0, step)))
            same = lot.owner[here] == lot.owner[there]
            around[here] |= np.where(same[:, None], present[there], np.uint64(0))
        held = around.view(np.uint8).ravel()
        which = np.flatnonzero(reaches == reach)
        at, bit = columns >> 3, (1 << (columns & 7)).astype(np.uint8)
        for lo in range(0, len(which), PASSAGES_AT_ONCE):
            some = which[lo : lo + PASSAGES_AT_ONCE]
            nth = place.take(item[some])
            found = held.take(at.take(nth, axis=0) + passage[some, None] * (width // 8))
            found &= bit.take(nth, axis=0)
            number[some] = np.count_nonzero(found, axis=1)
    for i in np.flatnonzero(reaches > FEW_PASSAGES).tolist():
        rows = stretch(lot, int(passage[i]), int(reaches[i]))
        there = np.zeros(FEATURES, bool)
        there[lot.features[rows][lot.used[rows]]] = True
        number[i] = there[items.words[item[i]] % FEATURES].sum()
    return number >= PARAPHRASED * items.sizes[item]


def common_length(mask: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence; a column of the table is one number's bits."""
    full = (1 << size) - 1
    v = full
    for word in words:
        if m := mask.get(word):
            v = (v + (v & m)) | (v & ~m)
    return size - (v & full).bit_count()


def holds(words: list[int], answer: list[int]) -> bool:
    n = len(answer)
    return bool(n) and any(
        words[i] == answer[0] and words[i : i + n] == answer for i in range(len(words) - n + 1)
    )


def leaks(words: DataFrame, space: LatentSpace, items: Items) -> DataFrame:
    """One row per row of ``words`` and item that leaked into it; see :data:`HITS`."""
    shared = words.sparkSession.sparkContext.broadcast((space, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, items = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            best: dict[tuple[int, int], tuple] = {}
            for lot in lots(batch, int(items.reach.max(initial=1)) + 1):
                sums = space.sums(lot)
                pairs = sums.copy()
                same = lot.owner[1:] == lot.owner[:-1]
                pairs[:-1][same] += sums[1:][same]
                cosine = np.maximum(unit_rows(sums) @ items.vectors.T, unit_rows(pairs) @ items.vectors.T)
                passage, vector = np.nonzero(cosine >= items.bounds)
                item, score = items.owner[vector], cosine[passage, vector]
                # A shared run is scored by the item's own vector.
                begins, whose = same_runs(lot, items)
                own_score = cosine[begins, items.whole[whose]]
                passage, item = np.concatenate([passage, begins]), np.concatenate([item, whose])
                score = np.concatenate([score, own_score])
                met = passage * len(items.words) + item
                order = np.argsort(met, kind="stable")
                first = np.flatnonzero(np.diff(met[order], prepend=-1))
                passage, item = passage[order][first], item[order][first]
                highest = np.maximum.reduceat(score[order], first) if len(first) else score
                use = likely(lot, items, passage, item)
                for p, k, c in zip(passage[use].tolist(), item[use].tolist(), highest[use].tolist()):
                    rows = stretch(lot, p, int(items.reach[k]))
                    size = len(items.words[k])
                    # Other words than the item's are in no common subsequence.
                    own = lot.words[rows][items.has[k, lot.features[rows]]]
                    if len(own) < PARAPHRASED * size:
                        continue
                    common = common_length(items.masks[k], size, own.tolist()) / size
                    if common < PARAPHRASED:
                        continue
                    answer = holds(lot.words[rows].ravel().tolist(), items.answers[k].tolist())
                    if common >= COMMON or answer:
                        key, found = (int(lot.owner[p]), k), (common, answer, c)
                        best[key] = max(best.get(key, found), found)
            rows = [(ids[d], items.ids[k], c, common, a) for (d, k), (common, a, c) in best.items()]
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
            names = ["doc_id", "item_id", "cosine", "common", "answer"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)
        give_back()

    return words.mapInArrow(run, HITS)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, common, answer`` of every leak found."""
    spark = docs.sparkSession
    prepare(spark)
    words = stage(hashed_words(docs), "hashed_words")
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text <> ''").distinct()
    items = stage(items, "items")
    space = latent_space(words) if not words.isEmpty() else None
    slices = -(-items.count() // ITEMS_AT_ONCE) if space else 0
    found = spark.createDataFrame([], HITS)
    for nth in range(slices):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == nth)
        rows = own.orderBy("item_id", "text").collect()
        described = describe_items([r["item_id"] for r in rows], [r["text"] for r in rows], space)
        found = found.unionByName(leaks(words, space, described))
    best = found.groupBy("doc_id", "item_id")
    strongest = F.max(F.struct("common", "answer", "cosine"))
    return best.agg(strongest.alias("s")).select("doc_id", "item_id", "s.cosine", "s.common", "s.answer")


def op2_latent_decontamination(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
