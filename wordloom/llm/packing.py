"""Packing token sequences: best-fit decreasing with a segment tree over remaining capacity.

A document is its token ids and an end id. An overlong one is first cut into full windows and
a rest; rests are then placed in the order of falling length, each into the open window with
the least capacity left that still holds it, or a new one. Pieces of one length are alike, so
the placing works on the histogram of lengths, a table of at most ``capacity`` rows however
large the corpus: windows with the same capacity left are kept as ranges of window numbers, a
segment tree indexed by remaining capacity finds the tightest one that is not empty, and
placing many pieces of one length into a range of windows is one entry of the plan: "pieces
lo..hi of this length go into the windows from first on, so many per window, at this offset".
That is the same result as placing the pieces one by one. A piece finds its entry by its rank
among the pieces of its length; ranks come from counts per (length, hash group), and a length
has a group for every ``GROUP_ROWS`` pieces, so one that a third of all pieces share is numbered
in many tasks, and the counts are few beside the pieces.

Token ids are taken per white-space chunk, since this tokenizer never joins text across white
space; ids of chunks and words are remembered in caches of bounded size.

Defined results: a null or empty text is the end id alone; a repeated row is packed again
(its rows are told apart by their place only); a null ``doc_id`` is kept; an empty table gives
no rows; columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.llm.common import documents, give_back, prepare, stage, text_bytes
from wordloom.llm.token_counts import byte_letters

CAPACITY = 2048
END_ID = 1
GROUP_ROWS = 50_000
CHUNK_CACHE, WORD_CACHE, LONG_CHUNK = 300_000, 200_000, 64
# Fixed value: the pre-token pattern of this tokenizer family.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Below this character a text is its own composed form and lower-casing is per character.
PLAIN_BELOW = "ɐ"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class _Words(dict):
    """Ids of a lower-cased word, as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.merge, self.letters = tokenizer.model.tokenize, byte_letters()

    def __missing__(self, word: str) -> bytes:
        letters = self.letters
        plain = word.isascii() and word.isprintable()
        tokens = self.merge(word if plain else "".join([letters[b] for b in word.encode()]))
        ids = struct.pack(f"<{len(tokens)}I", *[token.id for token in tokens])
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = ids
        return ids


class _Chunks(dict):
    """Ids of a chunk of UTF-8 without white space, in the same form."""

    def forget(self) -> None:
        self.clear()
        self.words.clear()

    def __init__(self, file: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_str(file)
        self.words = _Words(self.tokenizer)
        self.pieces = regex.compile(PRE_TOKEN)
        self.marks = {s[0] for s in (t.content for t in self.tokenizer.get_added_tokens_decoder().values())}

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode(errors="replace")
        if len(text) > LONG_CHUNK or max(text) >= PLAIN_BELOW or not self.marks.isdisjoint(text):
            encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            ids = struct.pack(f"<{len(encoded)}I", *encoded)
        else:
            text = text.lower()
            if text.isalpha():
                ids = self.words[text]
            else:
                ids = b"".join([self.words[w] for w in self.pieces.findall(text)])
        if len(chunk) <= LONG_CHUNK:
            if len(self) >= CHUNK_CACHE:
                self.clear()
            self[chunk] = ids
        return ids


@lru_cache(maxsize=2)
def encoder(file: str) -> Callable[[bytes], bytes]:
    """Function from UTF-8 to token ids, as little-endian unsigned 32-bit bytes."""
    chunks = _Chunks(file)

    def encode(data: bytes) -> bytes:
        return b"".join(map(chunks.__getitem__, data.split()))

    encode.forget = chunks.forget
    return encode


def cut_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of all documents: full windows first, then what is left. See :data:`PIECES`."""
    with open(tokenizer, encoding="utf-8") as opened:
        file = docs.sparkSession.sparkContext.broadcast(opened.read())
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file.value)
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(data.as_py()) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )
        encode.forget()
        give_back()

    columns = documents(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), text_bytes().alias("data")
    )
    return columns.mapInArrow(run, PIECES)


class CapacityTree:
    """Which remaining capacities have open windows; finds the least one that is enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def put(self, at: int, present: bool) -> None:
        node = at + self.leaves
        self.any[node] = present
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def least(self, at: int) -> int | None:
        """The least present capacity that is ``at`` or more."""
        node = at + self.leaves
        while not self.any[node]:
            while node & 1:  # a right child: its parent's right neighbour comes next
                node //= 2
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node + (not self.any[2 * node])
        return node - self.leaves


def best_fit_plan(
    histogram: dict[int, int], capacity: int = CAPACITY
) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Plan entries (length, lo, hi, first window, pieces per window, offset), and windows.

    ``histogram`` has the number of pieces per length. Windows are numbered from 0.
    """
    tree = CapacityTree(capacity)
    windows: dict[int, list[tuple[int, int]]] = {}  # capacity left: ranges of window numbers
    plan, opened = [], 0

    def add(left: int, lo: int, hi: int) -> None:
        if left and lo < hi:
            if not windows.get(left):
                tree.put(left, True)
            windows.setdefault(left, []).append((lo, hi))

    for length in sorted(histogram, reverse=True):
        placed, count = 0, histogram[length]
        while placed < count:
            left = tree.least(length)
            if left is None:
                left = capacity
                per = left // length
                lo, hi = opened, opened + -(-(count - placed) // per)
                opened = hi
            else:
                per = left // length
                lo, hi = windows[left].pop()
                if not windows[left]:
                    tree.put(left, False)
            used = min(hi - lo, -(-(count - placed) // per))
            add(left, lo + used, hi)
            pieces = min(count - placed, used * per)
            plan.append((length, placed, placed + pieces, lo, per, capacity - left))
            full, rest = divmod(pieces, per)
            add(left - per * length, lo, lo + full)
            if rest:
                add(left - rest * length, lo + full, lo + full + 1)
            placed += pieces
    return plan, opened


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` (from 0, none empty) and ``offset`` (gapless)."""
    spark = pieces.sparkSession
    pieces = stage(pieces, "pieces")
    # One row per length here, and per GROUP_ROWS pieces below.
    of_length = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    groups = [1 + of_length.get(length, 0) // GROUP_ROWS for length in range(capacity + 1)]
    own_groups = F.element_at(F.array(*map(F.lit, groups)), F.col("length").cast("int") + 1)
    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), own_groups).cast("int")
    pieces = pieces.withColumn("hash_group", group)
    sizes = pieces.groupBy("length", "hash_group").agg(F.count("*").alias("n"))
    histogram, offsets = {}, []
    for row in sorted(sizes.collect()):
        before = histogram.get(row["length"], 0)
        offsets.append((row["length"], row["hash_group"], before))
        histogram[row["length"]] = before + row["n"]
    plan, _ = best_fit_plan(histogram, capacity)
    groups = spark.createDataFrame(offsets, "length long, hash_group int, before long")
    entries = spark.createDataFrame(
        plan, "length long, lo long, hi long, first long, per long, base long"
    )
    order = Window.partitionBy("length", "hash_group").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("place", F.row_number().over(order))
        .join(F.broadcast(groups), ["length", "hash_group"])
        .withColumn("rank", F.col("before") + F.col("place") - 1)
    )
    inside = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    placed = ranked.alias("p").join(
        F.broadcast(entries.alias("e")), (F.col("p.length") == F.col("e.length")) & inside
    )
    nth = F.col("rank") - F.col("lo")
    return placed.select(
        "doc_id",
        "start",
        "p.length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("base") + F.pmod(nth, F.col("per")) * F.col("p.length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents packed into sequences of at most ``capacity`` tokens."""
    prepare(docs.sparkSession)
    return pack_pieces(cut_documents(docs, tokenizer, capacity), capacity)


def sequences(
    docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = CAPACITY
) -> DataFrame:
    """The training rows themselves: ``sequence_id, ids`` of ``capacity`` ids, padded with 0.

    The ids are made again from the texts instead of having been kept. ``doc_id`` has to be
    unique here.
    """
    with open(tokenizer, encoding="utf-8") as opened:
        file = docs.sparkSession.sparkContext.broadcast(opened.read())
    end = struct.pack("<I", END_ID)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file.value)
        for batch in batches:
            rows = []
            for data, pieces in zip(batch.column(0), batch.column(1).to_pylist()):
                ids = encode(data.as_py()) + end
                for p in pieces:
                    own = ids[4 * p["start"] : 4 * (p["start"] + p["length"])]
                    rows.append((p["sequence_id"], p["offset"], np.frombuffer(own, "<u4").tolist()))
            columns = list(zip(*rows)) if rows else [[]] * 3
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                ["sequence_id", "offset", "ids"],
            )

    piece = F.struct("start", "length", "sequence_id", "offset")
    per_doc = packed.groupBy("doc_id").agg(F.collect_list(piece).alias("pieces"))
    texts = documents(docs, "doc_id", "text").join(per_doc, "doc_id")
    rows = texts.select(text_bytes().alias("data"), "pieces").mapInArrow(
        cut, "sequence_id long, offset long, ids array<long>"
    )
    joined = rows.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids")
    )
    padding = F.array_repeat(F.lit(0).cast("long"), capacity - F.size("ids"))
    return joined.select("sequence_id", F.concat("ids", padding).alias("ids"))


def op7_best_fit_packing(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
