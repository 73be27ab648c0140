"""N-gram lines to occurrences, and the lines that are turned away."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.ngrams import (
    WORD,
    corpus_part,
    fields_occurrences,
    fields_trigram,
    is_ngram_line,
    line_fields,
    words,
)


def check_lines(lines: DataFrame, word: str = WORD) -> DataFrame:
    """``ok, line_id, trigram, occurrences, line`` of every line.

    Lines that match as a whole have a trigram and a count and give up their text; the others
    (a null line among them) keep it and have nothing else.
    """
    line = F.col("line")
    checked = lines.select("line_id", "line", line_fields(line, word).alias("fields"))
    ok = F.coalesce(F.col("fields") != line, F.lit(False))
    return checked.select(
        ok.alias("ok"),
        "line_id",
        F.when(ok, fields_trigram(F.col("fields"))).alias("trigram"),
        F.when(ok, fields_occurrences(F.col("fields"))).alias("occurrences"),
        F.when(~ok, line).alias("line"),
    )


def parse_lines(lines: DataFrame, word: str = WORD) -> DataFrame:
    """``line_id, trigram, occurrences`` of the lines that match as a whole."""
    return check_lines(lines, word).where("ok").select("line_id", "trigram", "occurrences")


def rejected_lines(lines: DataFrame, word: str = WORD) -> DataFrame:
    return lines.where(~is_ngram_line(F.col("line"), word))


def parse_report(lines: DataFrame, word: str = WORD) -> DataFrame:
    """One row ``kept, rejected``, from one scan."""
    kept = F.count_if(is_ngram_line(F.col("line"), word))
    return lines.agg(kept.alias("kept"), (F.count("*") - kept).alias("rejected"))


def split_corpus(occurrences: DataFrame) -> DataFrame:
    """``trigram, part, occurrences``: the corpus part of every occurrence row."""
    return occurrences.select(
        "trigram", corpus_part(F.col("line_id")).alias("part"), "occurrences"
    )


def split_words(df: DataFrame) -> DataFrame:
    """Replace ``trigram`` by w1, w2, w3."""
    out: list = []
    for name in df.columns:
        out += words(F.col(name)) if name == "trigram" else [F.col(name)]
    return df.select(*out)
