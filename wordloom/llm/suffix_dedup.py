"""Removal of repeated passages by sorting suffixes with bucket-pointer refinement.

A byte goes if it is covered by a string of ``length`` bytes that also starts in a document
with a smaller id. The strings ("windows") are grouped by a suffix sort cut off at ``length``:
positions are first put in buckets by 8-grams; a bucket is refined by sorting on the bucket
identifiers of a later offset, which are written back at once, so that buckets refined later
sort by finer ones, and a bucket that refers to itself doubles its depth. Buckets of one
position are left alone, and so are those that agree on ``length`` bytes. Equal windows are
then neighbours; of these the least document id keeps its windows, and all other documents
lose theirs. Comparison is exact; hashes only decide what is compared where.

What has to be sorted is found first, in three passes over the texts, which are written once
in chunks that later passes read without moving them:

1. Each window has a minimizer, the least hash of its 16-grams; windows in a row with the same
   one form a run, and equal windows have equal minimizers. Chunks send their distinct
   minimizers, with the number of documents, to be counted; those of one document only are
   done with, which is most of them. Equal texts are found by their digest: all but the one of
   smallest id are covered whole and take no further part.
2. Chunks send their runs with a repeated minimizer to the place where its windows are sorted.
   A run of the same bytes in several documents of a chunk is sent once, for the smallest id;
   the others are known to be covered. So a passage that a third of all documents share
   arrives once per chunk. Minimizers of more than ``HOT`` documents, which are frequent by
   chance in ever new surroundings, are split: their windows are dealt out by content.
3. Covered stretches return to the chunks, which cut them out.

Defined results: matches never cross documents; an empty or null text has nothing to remove;
a null ``doc_id`` counts as greater than any other; rows of the same id never cover each
other; texts of any length are searched whole, in overlapping blocks; an empty table gives no
rows; all columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import give_back, partitions, prepare, stage, text_bytes
from wordloom.plans.staging import new_path

LENGTH = 50
GRAM = 16
BLOCK_BYTES = 1 << 19
LONGEST_RUN = 4096
HOT = 100_000
NO_ID = np.iinfo(np.int64).max
WINDOWS_AT_ONCE = 150_000
GRAM_BYTES = 8  # of the first buckets
REFINED_AT_ONCE = 1 << 16
_PAIR = np.dtype([("h", "<u8"), ("d", "<i8")])  # a minimizer and a document


def sliding(values: np.ndarray, least: np.ufunc, width: int) -> np.ndarray:
    """``least`` over each stretch of ``width`` values."""
    step, done = 1, values
    while 2 * step <= width:
        done = least(done[:-step], done[step:])
        step *= 2
    if step < width:
        shift = width - step
        done = least(done[:-shift], done[shift:])
    return done


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each position on."""
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    x = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += words[8:]
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def blocks(texts: pa.ChunkedArray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' bytes in blocks, and segments (document, its byte, block byte, bytes).

    A long text is cut into segments that overlap by ``length - 1`` bytes, so each window lies
    in exactly one segment; texts shorter than a window are left out.
    """
    parts, segments, size, first = [], [], 0, 0
    for array in texts.chunks:
        data = np.frombuffer(array.buffers()[2] or b"", np.uint8)
        ends = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]
        for i in np.flatnonzero(np.diff(ends) >= length).tolist():
            at, end = int(ends[i]), int(ends[i + 1])
            for lo in range(at, end - length + 1, BLOCK_BYTES):
                hi = min(end, lo + BLOCK_BYTES + length - 1)
                if size and size + hi - lo > BLOCK_BYTES + length:
                    yield np.concatenate(parts), np.array(segments, np.int64)
                    parts, segments, size = [], [], 0
                parts.append(data[lo:hi])
                segments.append((first + i, lo - at, size, hi - lo))
                size += hi - lo
        first += len(array)
    if size:
        yield np.concatenate(parts), np.array(segments, np.int64)


def runs(data: np.ndarray, segments: np.ndarray, length: int):
    """Runs of windows with one minimizer: first window, windows, minimizer, segment."""
    least = sliding(gram_hashes(data), np.minimum, length - GRAM + 1)
    start = segments[:, 2]
    valid = np.zeros(len(least) + 1, np.int8)
    valid[start] += 1
    np.subtract.at(valid, start + segments[:, 3] - length + 1, 1)
    valid = np.cumsum(valid[:-1]).astype(bool)
    change = np.empty(len(least), bool)
    change[0] = True
    np.not_equal(least[1:], least[:-1], out=change[1:])
    change[1:] |= valid[1:] != valid[:-1]
    change[start[start < len(least)]] = True
    first = np.flatnonzero(change)
    many = np.diff(np.append(first, len(least)))
    keep = valid[first]
    first, many = first[keep], many[keep]
    if many.size and many.max() > LONGEST_RUN:
        pieces = -(-many // LONGEST_RUN)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        ends = np.repeat(first + many, pieces)
        first = np.repeat(first, pieces) + nth * LONGEST_RUN
        many = np.minimum(LONGEST_RUN, ends - first)
    return first, many, least[first], np.searchsorted(start, first, "right") - 1


def refine(members: np.ndarray, pointer: np.ndarray, deep: np.ndarray, length: int) -> int:
    """Refine the buckets of ``members``, given bucket by bucket, until each holds one position
    or positions that agree on ``length`` bytes. Returns how many positions were sorted.

    A bucket whose positions agree on ``deep`` bytes is sorted by the pointers that many bytes
    later. Sub-buckets then agree on those bytes and on what the later bucket agrees on, which is
    more than a q-gram where that one has been refined before.
    """
    work = 0
    while len(members):
        work += len(members)
        later = members + deep[members]
        key = (pointer[members] << 32) | pointer[later]
        order = np.argsort(key)
        key, members, later = key[order], members[order], later[order]
        own = key >> 32
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        at = np.arange(len(key))
        parent = np.maximum.accumulate(np.where(np.concatenate([[True], own[1:] != own[:-1]]), at, 0))
        alone = np.repeat(size == 1, size)
        depth = np.where(alone, length, deep[members] + deep[later])
        pointer[members] = own + np.repeat(begin, size) - parent
        deep[members] = depth
        members = members[depth < length]
    return work


def bucket_pointers(
    data: np.ndarray, length: int, at_once: int = REFINED_AT_ONCE
) -> tuple[np.ndarray, np.ndarray, int]:
    """Pointers of all positions, their q-grams, and how many positions were sorted.

    A pointer is the place of a bucket's first position in suffix order, counted from 1; 0 is
    what lies behind the end. Buckets are refined some at a time, in order, and write their
    pointers back at once, so that later ones sort by them.
    """
    n = len(data)
    padded = np.zeros(n + GRAM_BYTES, np.uint8)
    padded[:n] = data
    grams = np.ndarray((n,), ">u8", padded, 0, (1,)).astype("<u8")
    order = np.argsort(grams)
    ordered = grams[order]
    begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.diff(np.append(begin, n))
    pointer = np.zeros(n + length, np.int64)
    pointer[order] = np.repeat(begin, size) + 1
    deep = np.full(n + length, length, np.int64)
    members = order[np.repeat(size > 1, size)]
    deep[members] = GRAM_BYTES
    ends = np.cumsum(size[size > 1])
    lot = (ends - 1) // at_once
    work, lo = n, 0
    for hi in ends[np.flatnonzero(np.append(lot[1:] != lot[:-1], len(lot) > 0))].tolist():
        work += refine(members[lo:hi], pointer, deep, length)
        lo = hi
    return pointer, grams, work


def window_buckets(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Equal identifiers for equal strings of ``length`` bytes at ``starts``.

    Pointers may tell positions apart by what comes after ``length`` bytes. Equal strings are
    neighbours in suffix order all the same, and neighbours are compared.
    """
    pointer, grams, _ = bucket_pointers(data, length)
    order = np.argsort(pointer[starts])
    a, b = starts[order[:-1]], starts[order[1:]]
    same = np.ones(len(a), bool)
    for at in (*range(0, length - GRAM_BYTES, GRAM_BYTES), length - GRAM_BYTES):
        same &= grams[a + at] == grams[b + at]
    ids = np.zeros(len(starts), np.int64)
    ids[order[1:]] = np.cumsum(~same)
    return ids


def covered(
    contents: list[bytes], docs: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (content, start, end) whose windows also lie in a content of a smaller id."""
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    data = np.frombuffer(b"".join(contents), np.uint8)
    at = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    content = np.repeat(np.arange(len(contents)), windows)
    offset = np.arange(len(content)) - np.repeat(np.cumsum(windows) - windows, windows)
    buckets = window_buckets(data, at[content] + offset, length)
    least = np.full(int(buckets.max()) + 1, NO_ID)
    np.minimum.at(least, buckets, docs[content])
    gone = docs[content] > least[buckets]
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    # A stretch also ends where its content does.
    breaks = (offset == 0) & gone
    begins = np.flatnonzero((edge[:-1] == 1) | breaks)
    stops = np.flatnonzero(np.append(edge[1:] == -1, True)[: len(gone)] | np.append(breaks[1:], False) & gone)
    return content[begins], offset[begins], offset[stops] + length


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching stretches."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], begins[1:] > ends[:-1]])
    last = np.flatnonzero(np.append(new[1:], True))
    return begins[new], ends[last]


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy()


def minimizer_counts(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """``part, chunk, hashes, docs``: distinct minimizers per chunk and their documents."""

    def send(chunk: int, found: list) -> Iterator[pa.RecordBatch]:
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, _PAIR)
        hashes, docs = np.unique(pairs["h"], return_counts=True)
        docs = np.minimum(docs, 65535).astype("<u2")
        part = (hashes >> np.uint64(20)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        hashes, docs = hashes[order], docs[order]
        mine = [(p, cuts[p], cuts[p + 1]) for p in range(parts) if cuts[p] < cuts[p + 1]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _, _ in mine], pa.int32()),
                pa.array([chunk] * len(mine), pa.int64()),
                pa.array([hashes[a:b].tobytes() for _, a, b in mine], pa.binary()),
                pa.array([docs[a:b].tobytes() for _, a, b in mine], pa.binary()),
            ],
            ["part", "chunk", "hashes", "docs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, found, seen = None, [], 0
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            for chunk in np.unique(chunks).tolist():
                if chunk != current and current is not None:
                    yield from send(current, found)
                    found = []
                current = chunk
                own = batch.filter(pa.array(chunks == chunk)).column(1)
                for data, segments in blocks(pa.chunked_array([own]), length):
                    _, _, hashes, segment = runs(data, segments, length)
                    pairs = np.empty(len(hashes), _PAIR)
                    pairs["h"], pairs["d"] = hashes, segments[segment, 0] + seen
                    found.append(np.unique(pairs))
                seen += len(own)
        if current is not None:
            yield from send(current, found)
        give_back()

    return rows.select("chunk", "data").mapInArrow(
        run, "part int, chunk long, hashes binary, docs binary"
    )


def repeated_minimizers(counts: DataFrame, hot: int) -> DataFrame:
    """``chunk, hashes, hot``: per chunk those that two or more documents have."""

    def run(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, "<u8") for x in table.column("hashes").to_pylist()]
        docs = [np.frombuffer(x, "<u2") for x in table.column("docs").to_pylist()]
        chunks = table.column("chunk").to_numpy()
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        values, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(docs), len(values))[inverse]
        owner, inverse, total = (x[total > 1] for x in (owner, inverse, total))
        cuts = np.searchsorted(owner, np.arange(len(hashes) + 1))
        out = []
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a < b:
                flags = (total[a:b] > hot).astype(np.uint8)
                out.append((int(chunks[i]), values[inverse[a:b]].tobytes(), flags.tobytes()))
        columns = list(zip(*out)) or [[]] * 3
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["chunk", "hashes", "hot"])

    return counts.groupBy("part").applyInArrow(run, "chunk long, hashes binary, hot binary")


def sendings(rows: DataFrame, notes: DataFrame, length: int) -> DataFrame:
    """``key, chunk, row, doc, start, stop, content``: runs to sort, and (without content)
    stretches that are covered within their chunk."""

    def run(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        copies = replies.filter(replies.column("hashes").is_null()).column("row").to_numpy()
        replies = replies.filter(replies.column("hashes").is_valid())
        hashes = np.frombuffer(b"".join(replies.column("hashes").to_pylist()), "<u8")
        hot = np.frombuffer(b"".join(replies.column("hot").to_pylist()), np.uint8)
        order = np.argsort(hashes)
        hashes, hot = hashes[order], hot[order]
        row, doc = table.column("row").to_numpy(), _ids(table.column("doc"))
        copy = np.isin(row, copies)
        sent: dict[bytes, list] = {}  # content: minimizer, hot, [(document, start)]
        if len(hashes):
            for data, segments in blocks(table.column("data"), length):
                first, many, minimizer, segment = runs(data, segments, length)
                at = np.minimum(np.searchsorted(hashes, minimizer), len(hashes) - 1)
                use = (hashes[at] == minimizer) & ~copy[segments[segment, 0]]
                owner, start = segments[segment, 0], segments[segment, 1] + first - segments[segment, 2]
                whole = data.tobytes()
                for a, b, h, f, d, s in zip(
                    first[use].tolist(), (first + many + length - 1)[use].tolist(),
                    minimizer[use].tolist(), hot[at[use]].tolist(), owner[use].tolist(), start[use].tolist(),
                ):
                    sent.setdefault(whole[a:b], [h, f]).append((d, s))
        out = ([], [], [], [], [], [])
        own = ([], [], [])

        def ship(k, d, s, content):
            for column, value in zip(out, (k, row[d], doc[d], s, s + len(content), content)):
                column.append(value)

        for content, (h, f, *places) in sent.items():
            least = min(doc[d] for d, _ in places) if len(places) > 1 else doc[places[0][0]]
            for d, s in places:
                if doc[d] > least:
                    for column, value in zip(own, (d, s, s + len(content))):
                        column.append(value)
                elif f:
                    for i in range(len(content) - length + 1):
                        window = content[i : i + length]
                        ship(hash_of(window), d, s + i, window)
                else:
                    ship(h, d, s, content)
        for d, a, b in zip(*stretches(*own)):
            ship(int(row[d]), d, a, b"")
            out[4][-1], out[5][-1] = b, None
        sent.clear()
        give_back()
        keys = np.array(out[0], np.uint64).view(np.int64)
        chunk = np.full(len(keys), key[0].as_py(), np.int64)
        arrays = [keys, chunk, *(np.array(c, np.int64) for c in out[1:5])]
        return pa.table(
            [*map(pa.array, arrays), pa.array(out[5], pa.binary())],
            ["key", "chunk", "row", "doc", "start", "stop", "content"],
        )

    return (
        rows.select("chunk", "row", "doc", "data")
        .groupBy("chunk")
        .cogroup(notes.groupBy("chunk"))
        .applyInArrow(run, "key long, chunk long, row long, doc long, start long, stop long, content binary")
    )


def hash_of(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "big")


def stretches(docs: list, begins: list, ends: list):
    """The merged stretches of every document."""
    docs, begins, ends = (np.array(x, np.int64) for x in (docs, begins, ends))
    if not len(docs):
        return docs, begins, ends
    order = np.lexsort((begins, docs))
    docs, begins, ends = docs[order], begins[order], ends[order]
    cuts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1], [True]]))
    found = [(docs[a], *merged(begins[a:b], ends[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]
    return (
        np.concatenate([np.repeat(d, len(b)) for d, b, _ in found]),
        np.concatenate([b for _, b, _ in found]),
        np.concatenate([e for _, _, e in found]),
    )


def lot_covered(own: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (row of ``own``, start, end) that are covered.

    Rows with the same content as one of a smaller id are covered whole. What is left to sort
    is each content once, and only where a key has different ones.
    """
    contents = own.column("content").combine_chunks().dictionary_encode()
    which, doc = contents.indices.to_numpy(), own.column("doc").to_numpy()
    least = np.full(len(contents.dictionary), NO_ID)
    np.minimum.at(least, which, doc)
    copies = np.flatnonzero(doc > least[which])
    sizes = (own.column("stop").to_numpy() - own.column("start").to_numpy())[copies]
    found = [(copies, np.zeros(len(copies), np.int64), sizes)]
    first = np.flatnonzero(doc == least[which])
    first = first[np.argsort(which[first], kind="stable")]
    kinds, at = np.unique(which[first], return_index=True)
    _, key, times = np.unique(
        own.column("key").to_numpy()[first[at]], return_inverse=True, return_counts=True
    )
    several = kinds[times[key] > 1]
    if len(several):
        texts = contents.dictionary.take(pa.array(several)).to_pylist()
        content, lo, hi = covered(texts, least[several], length)
        begin = np.searchsorted(which[first], several[content])
        many = np.searchsorted(which[first], several[content], "right") - begin
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        found.append((first[np.repeat(begin, many) + nth], np.repeat(lo, many), np.repeat(hi, many)))
    return tuple(np.concatenate(c) for c in zip(*found))


def sort_windows(sent: DataFrame, length: int) -> DataFrame:
    """``chunk, row, start, stop``: all covered stretches. Equal keys have to be together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        names = ["chunk", "row", "start", "stop"]
        for batch in batches:
            table = pa.Table.from_batches([batch])
            to_sort = table.column("content").is_valid()
            held.append(table.filter(to_sort))
            known = table.filter(pc.invert(to_sort)).select(names)
            yield from known.to_batches()
        table = pa.concat_tables(held) if held else None
        if table is None or not table.num_rows:
            return
        key = table.column("key").to_numpy().view(np.uint64)
        stop = table.column("stop").to_numpy()
        windows = stop - table.column("start").to_numpy() - length + 1
        lots = int(windows.sum()) // WINDOWS_AT_ONCE + 1
        lot = (key >> np.uint64(7)) % np.uint64(lots)
        for i in range(lots):
            own = table.filter(pa.array(lot == i))
            if own.num_rows:
                row, lo, hi = lot_covered(own, length)
                base = own.column("start").to_numpy()[row]
                columns = [own.column(c).to_numpy()[row] for c in ("chunk", "row")]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(base + lo), pa.array(base + hi)], names
                )
        give_back()

    return sent.mapInArrow(run, "chunk long, row long, start long, stop long")


def cut_out(data: bytes, begins: np.ndarray, ends: np.ndarray) -> bytes:
    kept, at = [], 0
    for a, b in zip(begins.tolist(), ends.tolist()):
        kept.append(data[at:a])
        at = b
    return b"".join(kept) + data[at:]


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, hot: int = HOT, decode: bool = False
) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans`` and ``kept``, the bytes that stay.

    ``docs`` needs ``doc_id`` and ``text``; its columns but ``text`` are called ``c0, c1, …`` in
    the result, by their places. With ``decode``, ``kept`` is a text, without the bytes that no
    longer make a character.
    """
    if length <= GRAM:
        raise ValueError(f"strings of more than {GRAM} bytes are needed")
    spark = docs.sparkSession
    prepare(spark)
    chunks = partitions(spark)
    # Keys that Spark's own hash puts one into each bucket.
    bucket = F.pmod(F.hash("id"), F.lit(chunks))
    ids = spark.range(chunks * 24 + 64).groupBy(bucket.alias("b")).agg(F.min("id").alias("id"))
    keys = [r["id"] for r in ids.collect()]
    plain = [docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)]
    data = text_bytes()
    # By id and text, so that rows of one id, or of none, are dealt to all chunks.
    nth = F.pmod(F.xxhash64("doc_id", "text"), F.lit(len(keys))).cast("int")
    rows = docs.select(
        F.element_at(F.array(*[F.lit(k).cast("long") for k in keys]), nth + 1).alias("chunk"),
        F.col("doc_id").cast("long").alias("doc"),
        F.unhex(F.md5(data)).alias("digest"),
        data.alias("data"),
        *[c for c, name in zip(plain, docs.columns) if name != "text"],
    ).repartition(chunks, "chunk")
    name = f"texts_{uuid.uuid4().hex}"
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    path = new_path(spark, "texts")
    rows.write.bucketBy(chunks, "chunk").option("compression", "zstd").option(
        "path", path
    ).saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its name: the files are staged ones, and are read below

    alike = rows.groupBy("digest").agg(F.min("doc").alias("least"), F.count("*").alias("n"))
    alike = stage(alike.where("n > 1").select("digest", "least"), "alike")
    copies = rows.select("chunk", "row", "doc", "digest").join(alike, "digest")
    copies = copies.where("least is not null and (doc is null or doc > least)").select("chunk", "row")
    copies = stage(copies, "copies")

    counts = minimizer_counts(rows, length, chunks)
    replies = stage(repeated_minimizers(counts, hot), "repeated")
    nothing = F.lit(None)
    notes = replies.select("chunk", nothing.cast("long").alias("row"), "hashes", "hot").unionByName(
        copies.select("chunk", "row", nothing.cast("binary").alias("hashes"), nothing.cast("binary").alias("hot"))
    )
    sent = sendings(rows, notes, length).repartition(chunks, "key")
    gone = stage(sort_windows(sent, length), "covered")
    gone = gone.unionByName(copies.withColumns({"start": F.lit(0).cast("long"), "stop": F.lit(-1).cast("long")}))

    def cut(table: pa.Table, own: pa.Table) -> pa.Table:
        row = table.column("row").to_numpy()
        order = np.argsort(own.column("row").to_numpy(), kind="stable")
        owner, begins, ends = (own.column(c).to_numpy()[order] for c in ("row", "start", "stop"))
        lo, hi = np.searchsorted(owner, row), np.searchsorted(owner, row, "right")
        kept, n_bytes, n_removed, n_spans = [], [], [], []
        for i, cell in enumerate(table.column("data")):
            text = cell.as_py()
            removed = spans = 0
            if hi[i] > lo[i]:
                a, b = begins[lo[i] : hi[i]], ends[lo[i] : hi[i]]
                if (b < 0).any():  # a copy of a whole text
                    a, b = (np.array([0]), np.array([len(text)])) if len(text) >= length else (a[:0], b[:0])
                if len(a):
                    a, b = merged(a, b)
                    text = cut_out(text, a, b)
                    removed, spans = int((b - a).sum()), len(a)
            kept.append(text.decode(errors="ignore") if decode else text)
            n_bytes.append(len(cell.as_py()))
            n_removed.append(removed)
            n_spans.append(spans)
        out = table.drop_columns(["chunk", "row", "doc", "digest", "data"])
        for column, values, kind in (
            ("n_bytes", n_bytes, pa.int64()),
            ("n_removed", n_removed, pa.int64()),
            ("n_spans", n_spans, pa.int64()),
            ("kept", kept, pa.string() if decode else pa.binary()),
        ):
            out = out.append_column(column, pa.array(values, kind))
        return out

    fields = [f for f in rows.schema.fields if f.name not in ("chunk", "row", "doc", "digest", "data")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return (
        rows.groupBy("chunk")
        .cogroup(gone.groupBy("chunk"))
        .applyInArrow(
            cut,
            f"{schema}n_bytes long, n_removed long, n_spans long, kept {'string' if decode else 'binary'}",
        )
    )


def op10_suffix_dedup(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = remove_repeats(docs)
    return found.select(
        F.col("c0").cast("long").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )
