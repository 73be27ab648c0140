"""Alignment of two tokenizers by interval coalescing, and how well their ids go together.

A byte-level BPE (A) encodes a space and the text, a sentencepiece model (B) the text, before
which it puts a space itself; so both cover the same bytes. A text is cut before each single space
between other characters, where neither tokenizer has a token that goes across (checked on the
vocabulary of B, whose texts stay whole if it fails; pre-tokens of A begin there). Tokens of all
new pieces of a batch lie on one line of bytes, end to end. All A and B tokens are sorted by start
(``lexsort``), a running maximum of their ends is kept (``maximum.accumulate``), and a group ends
where the next start reaches that maximum; tokens that overlap stay in one group. The last A and the
last B token of a group end together and are linked. What a piece gives is remembered, up to
``KNOWN`` pieces, and documents are put together from it.

How often an id pair is linked in the whole corpus comes from a shuffle of the batches' distinct
pairs, not of links. Each batch numbers its distinct pairs; links are kept as these numbers (a list
per document, staged). The counts of a batch's pairs, and whether a pair is the most frequent one
of its B id, come back to the batch by its name, where the documents' sums are worked out. A batch
holds ``BATCH_BYTES`` of text, or one longer text.

Tables broadcast are as large as B's vocabulary, whatever the corpus.

Defined results: a text that is null or empty, or of which one of the tokenizers does not give the
bytes back, has no tokens: zeros and an empty digest; strings of special tokens are plain text; a
null id stays; repeated rows are documents of their own and count again; an empty table gives no
rows; columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import documents, give_back, partitions, prepare, stage
from wordloom.llm.token_counts import PRE_TOKEN, SAME_CLASSES_BELOW, byte_letters

BATCH_BYTES = 4_000_000
AT_ONCE = 5_000
PART, KNOWN = 100_000, 600_000
NEXT = "\n"  # stands between the groups of different pieces
SPACE = "▁"  # fixed value: how sentencepiece writes a space
# A cut is between a character that is no white space and a space before another such character.
CUT = re.compile(r"(?<=\S) (?=\S)")
DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, batch long, links array<int>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Tokenizers:
    """Both tokenizers with what has to be known of their ids: bytes, lengths, decimal text."""

    def __init__(self, a_file: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_file)
        self.a.encode_special_tokens = True
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            plain = token not in special
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if plain else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = [
            bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        self.divisible = not any(SPACE in piece.lstrip(SPACE) for piece in map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self.quick = self._quick(a_file, special)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # Text of an id that begins a piece, or after a comma, a bar or a semicolon.
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.text = [mark + str(i) for mark in (NEXT, ",", "|", ";") for i in range(most)]
        self.most = most

    def _quick(self, a_file: str, special: set[str]) -> tiktoken.Encoding | None:
        """The same merges in a faster library, if the ids of A's tokens follow its merges' order."""
        model = json.loads(a_file)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(model["vocab"][x + y] != 256 + i for i, (x, y) in enumerate(pairs)):
            return None
        ranks = {self.a_bytes[i]: i for token, i in model["vocab"].items() if token not in special}
        return tiktoken.Encoding("a", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, text: str) -> list[int]:
        if self.quick is None or max(text) >= SAME_CLASSES_BELOW:
            return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return self.quick.encode_ordinary(text)

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, some at a time; the space before each is left out."""
        start = 0
        while self.divisible and len(text) - start > PART:
            cut = CUT.search(text, start + PART)
            if cut is None:
                break
            yield CUT.split(text[start : cut.start()])
            start = cut.end()
        text = text[start:]
        yield CUT.split(text) if self.divisible else [text]

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, ...] | None:
        """Ids of A, ids of B, and the end of each piece in both, for pieces one after another with a
        space before each; None if a tokenizer does not give them back with tokens of their own."""
        text = " " + " ".join(pieces)
        data = text.encode()
        a, b_lists = self.encode_a(text), self.b.encode(pieces, num_threads=1)
        b = list(chain.from_iterable(b_lists))
        if not b"".join([self.a_bytes[i] for i in a]) == data == b"".join([self.b_bytes[i] for i in b]):
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends = np.cumsum([len(piece.encode()) + 1 for piece in pieces])
        found = []
        for size in (self.a_size[a], self.b_size[b]):
            reach = np.cumsum(size)
            at = np.searchsorted(reach, ends)
            if not (reach[at] == ends).all():
                return None
            found.append(at + 1)
        return a, b, *found


class _Numbers(dict):
    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Known:
    """Pieces by number, with their tokens, links and groups as text."""

    def __init__(self, t: Tokenizers):
        self.t = t
        self.clear()

    def clear(self) -> None:
        self.number = _Numbers()
        self.texts: list[str] = []
        # Per piece: if both tokenizers give it back, tokens of A, tokens of B, end of its links.
        self.facts = np.zeros((0, 4), np.int64)
        self.links = np.zeros(0, np.int64)

    def learn(self, pieces: list[str]) -> None:
        """Learn pieces that are not known yet, in the order of their numbers.

        Pieces that begin or end with white space cannot stand beside others.
        """
        alone = [i for i, p in enumerate(pieces) if not p or p[0].isspace() or p[-1].isspace()]
        start = 0
        for i in [*alone, len(pieces)]:
            for at in range(start, i, AT_ONCE):
                self.add(pieces[at : min(i, at + AT_ONCE)])
            if i < len(pieces):
                self.add(pieces[i : i + 1])
            start = i + 1

    def add(self, pieces: list[str]) -> None:
        encoded = self.t.encode(pieces)
        if encoded is None and len(pieces) > 1:
            half = len(pieces) // 2
            self.add(pieces[:half])
            self.add(pieces[half:])
            return
        if encoded is None:
            facts, links, texts = np.array([[0, 0, 0, 0]]), np.zeros(0, np.int64), [""]
        else:
            a_ends, b_ends = encoded[2:]
            links, ends, texts = align(self.t, *encoded)
            facts = np.stack([np.ones_like(ends), np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0), ends], axis=1)
        facts[:, 3] += len(self.links)
        self.facts = np.concatenate([self.facts, facts])
        self.links = np.concatenate([self.links, links])
        self.texts.extend(texts)

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of the pieces of each text; a null or empty text has none."""
        if len(self.texts) > KNOWN:
            self.clear()
        result = []
        for text in texts:
            own = array("q")
            for pieces in self.t.pieces(text) if text else ():
                own.extend(map(self.number.__getitem__, pieces))
            result.append(np.frombuffer(own, np.int64) if own else np.zeros(0, np.int64))
        self.learn(list(islice(self.number, len(self.texts), None)))
        return result

    def document(self, own: np.ndarray) -> tuple[int, int, np.ndarray, str]:
        """Tokens of A, tokens of B, links and digest of a text of these pieces."""
        facts = self.facts[own]
        if not len(own) or not facts[:, 0].all():
            return 0, 0, np.zeros(0, np.int64), ""
        ends = facts[:, 3]
        starts = np.where(own > 0, self.facts[own - 1, 3], 0)
        sizes = ends - starts
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        digest = hashlib.sha256(";".join([self.texts[i] for i in own.tolist()]).encode())
        return int(facts[:, 1].sum()), int(facts[:, 2].sum()), self.links[np.repeat(starts, sizes) + inner], digest.hexdigest()


@lru_cache(maxsize=1)
def tokenizers(a_file: str, b_model: bytes) -> Tokenizers:
    """Made once per worker; its tables do not change."""
    return Tokenizers(a_file, b_model)


def coalesce(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of every A and every B token, both end to end from byte 0 on, with these sizes."""
    ends = np.concatenate([np.cumsum(a_size), np.cumsum(b_size)])
    starts = ends - np.concatenate([a_size, b_size])
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    opens = np.ones(len(order), bool)
    opens[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    return group[: len(a_size)], group[len(a_size) :]


def align(
    t: Tokenizers, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """For pieces on one line, which end after these tokens: all links as ``a << 32 | b``, the end of
    each piece's links, and each piece's groups as text."""
    in_a, in_b = coalesce(t.a_size[a], t.b_size[b])
    # The tokens group by group, A's before B's, with the mark that each has before it.
    key = np.concatenate([2 * in_a, 2 * in_b + 1])
    order = np.argsort(key, kind="stable")
    key, ids = key[order], np.concatenate([a, b])[order]
    mark = np.ones(len(key), np.int64)
    step = np.diff(key, prepend=-2)
    mark[(step > 0) & (key % 2 == 1)] = 2
    mark[(step > 0) & (key % 2 == 0)] = 3
    last = np.diff(key, append=-2) != 0  # the last token of its kind in its group
    links = (ids[last & (key % 2 == 0)] << 32) | ids[last & (key % 2 == 1)]
    mark[np.concatenate([[0], (a_ends + b_ends)[:-1]])] = 0  # a piece's first token
    text = "".join([t.text[c] for c in (mark * t.most + ids).tolist()])
    return links, in_a[a_ends - 1] + 1, text.split(NEXT)[1:]


def _lots(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """Rows in lots of about ``most`` bytes of text."""
    lot, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            lot.append((doc_id, text))
            size += len(text or "") + 16
            if size >= most:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def aligned(docs: DataFrame, a_path: str, b_path: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Rows of documents (:data:`DOCUMENT`) and of their batches' distinct pairs, told apart by
    ``kind``: one pass gives both."""
    with open(a_path, encoding="utf-8") as opened:
        a_file = opened.read()
    with open(b_path, "rb") as opened:
        b_model = opened.read()
    shared = docs.sparkSession.sparkContext.broadcast((a_file, b_model))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("batch", pa.int64()), ("links", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(tokenizers(*shared.value))
        name = TaskContext.get().partitionId() << 32
        for lot in _lots(batches, batch_bytes):
            found = [known.document(own) for own in known.numbers([text for _, text in lot])]
            sizes = [len(own) for _, _, own, _ in found]
            links = np.concatenate([own for _, _, own, _ in found])
            pairs, numbers, counts = np.unique(links, return_inverse=True, return_counts=True)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(numbers.astype(np.int32)))
            # Every group ends with one link.
            columns = [
                pa.array([doc_id for doc_id, _ in lot], pa.int64()),
                *[pa.array(n, pa.int64()) for n in ([x for x, *_ in found], [y for _, y, *_ in found], sizes, sizes)],
                pa.array([digest for *_, digest in found], pa.string()), pa.array([name] * len(lot), pa.int64()), lists,
                pa.nulls(len(lot), schema.field("pairs").type), pa.nulls(len(lot), schema.field("counts").type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            yield pa.RecordBatch.from_pylist([{"batch": name, "pairs": pairs, "counts": counts}], schema=schema)
            name += 1
        give_back()

    columns = documents(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return columns.mapInArrow(run, f"{DOCUMENT}, pairs array<long>, counts array<long>")


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per row of ``docs``: see :data:`RESULT`."""
    spark = docs.sparkSession
    prepare(spark)
    staged = stage(aligned(docs, a_path, b_path, batch_bytes), "token_links")
    named = staged.where("pairs is null").drop("pairs", "counts")
    pairs = staged.where("pairs is not null").select(
        "batch", F.posexplode(F.arrays_zip("pairs", "counts")).alias("number", "p")
    ).select("batch", "number", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    counts = stage(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "token_pairs")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).alias("b")
    best = counts.groupBy(b_id).agg(F.max("n").alias("most"))  # at most a row per id of B
    counts = counts.withColumn("b", b_id).join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    known = pairs.drop("n").join(counts, "pair").select(F.col("batch").alias("lot"), "number", "n", "best")

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        n, best = (np.zeros(right.num_rows, np.int64) for _ in range(2))
        number = right["number"].to_numpy()
        n[number] = right["n"].to_numpy()
        best[number] = right["best"].to_numpy(zero_copy_only=False)
        links = left["links"].combine_chunks()
        edges = links.offsets.to_numpy()
        own = links.values.to_numpy()
        total, good = (np.concatenate([[0], np.cumsum(x[own])]) for x in (n, best))
        picked = {"n_best": good[edges[1:]] - good[edges[:-1]], "count_sum": total[edges[1:]] - total[edges[:-1]]}
        for name, column in picked.items():
            left = left.append_column(name, pa.array(column, pa.int64()))
        return left.select([c.split()[0] for c in RESULT.split(", ")])

    # Batches are whole groups: a few MB each, dealt to partitions that hold some of them.
    n = partitions(spark)
    left = named.repartition(n, "batch").groupBy("batch")
    return left.cogroup(known.repartition(n, "lot").groupBy("lot")).applyInArrow(sums, RESULT)


def op11_token_alignment(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_tokenizers(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
