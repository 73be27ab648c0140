"""Token counts of a byte-level BPE by the whole-token shortcut.

Texts are cut into pre-tokens; most pre-tokens are single tokens. Which vocabulary strings
encode alone as one token is proved beforehand, on the driver: each string of the vocabulary
is merged by the rules and counts as proved if its own token is all that is left. A pre-token
among the proved strings counts 1 without merging. Only the others are merged, and their
counts are remembered in a cache of bounded size.

The tokenizer file and the proved strings are as large as the vocabulary, whatever the
corpus, and are broadcast; executors need no file of their own.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings inside a text
are one token each, as the library treats them by default; texts of any length are counted
whole; repeated rows give repeated results; columns other than ``doc_id`` and ``text`` are
not used.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.llm.common import documents, prepare

# Fixed value: the pre-token pattern of this tokenizer family.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Below this character, ``regex`` and the tokenizer's own engine class all characters alike;
# above it, characters of the newest Unicode versions differ, so the library cuts such texts.
SAME_CLASSES_BELOW = "՘"
CACHE_SIZE = 400_000
LONG_PIECE = 64
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [letters[b] for b in range(256)]


def special_strings(file: str) -> list[str]:
    return [token["content"] for token in json.loads(file)["added_tokens"]]


def proved_strings(file: str) -> list[str]:
    """Vocabulary strings that, as a pre-token, encode as exactly one token.

    Strings that are no valid UTF-8 are parts of characters and never whole pre-tokens.
    """
    description = json.loads(file)
    shape = description["pre_tokenizer"]
    if description["normalizer"] is not None or shape["type"] != "ByteLevel":
        raise ValueError("a byte-level BPE that keeps its text as it is is needed")
    merge = Tokenizer.from_str(file).model.tokenize
    special = set(special_strings(file))
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    proved = []
    for string, token_id in description["model"]["vocab"].items():
        if string in special or not all(c in byte_of for c in string):
            continue
        if [token.id for token in merge(string)] != [token_id]:
            continue
        try:
            proved.append(bytes(byte_of[c] for c in string).decode())
        except UnicodeDecodeError:
            pass
    return proved


class _Counts(dict):
    """Tokens per pre-token: 1 for proved strings, the others merged when first met."""

    def __init__(self, proved: list[str], merge: Callable):
        super().__init__(dict.fromkeys(proved, 1))
        self.proved, self.merge, self.letters = proved, merge, byte_letters()

    def __missing__(self, piece: str) -> int:
        letters = self.letters
        n = len(self.merge("".join([letters[b] for b in piece.encode()])))
        if len(piece) <= LONG_PIECE:
            if len(self) >= len(self.proved) + CACHE_SIZE:
                self.clear()
                self.update(dict.fromkeys(self.proved, 1))
            self[piece] = n
        return n


@lru_cache(maxsize=2)
def counter(file: str, proved: tuple[str, ...]) -> Callable[[str], int]:
    """Function from a text to its number of tokens."""
    tokenizer = Tokenizer.from_str(file)
    merge, cut = tokenizer.model.tokenize, tokenizer.pre_tokenizer.pre_tokenize_str
    counts = _Counts(list(proved), merge)
    pieces = regex.compile(PRE_TOKEN)
    unsure = regex.compile(f"[{SAME_CLASSES_BELOW}-\U0010ffff]")
    strings = special_strings(file)
    special = regex.compile("|".join(map(regex.escape, strings))) if strings else None

    def ordinary(text: str) -> int:
        if not text.isascii() and unsure.search(text):
            return sum(len(merge(letters)) for letters, _ in cut(text))
        if len(text) < 1_000_000:
            return sum(map(counts.__getitem__, pieces.findall(text)))
        return sum(counts[found.group()] for found in pieces.finditer(text))

    def count(text: str) -> int:
        if special is None or not (found := special.findall(text)):
            return ordinary(text)
        return len(found) + sum(map(ordinary, special.split(text)))

    return count


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for the byte-level BPE file at path ``tokenizer``."""
    prepare(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as opened:
        file = opened.read()
    rules = docs.sparkSession.sparkContext.broadcast((file, tuple(proved_strings(file))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(*rules.value)
        for batch in batches:
            n_tokens = [count(text.as_py()) if text.is_valid else 0 for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    columns = documents(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"),
        "text",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return columns.mapInArrow(run, SCHEMA)


def op8_token_counts(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)
