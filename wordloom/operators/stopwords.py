"""Optional removal of trigrams that contain a stop word.

Words are compared in upper case on both sides, so a list fits whatever ``--word`` lets through.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.ngrams import text_letters

WORDS = ("w1", "w2", "w3")
# Stands for a stop word in a text: neither a letter nor a space, so no trigram spans it.
GAP = "0"


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """``word``: the words of text files, upper-cased, each once, one or more to a line."""
    fields = F.explode(F.split(F.upper("value"), r"\s+"))
    return spark.read.text(path).select(fields.alias("word")).where("word <> ''").distinct()


def without_stop_words(counts: DataFrame, stop_words: DataFrame) -> DataFrame:
    """``counts`` without trigrams of which any word is in ``stop_words(word)``.

    Three anti joins in one pass if ``stop_words`` is broadcast, which is for the caller to decide;
    :func:`wordloom.plans.stop_list.remove_stop_words` does, and has a plan for long lists.
    """
    stop_words = stop_words.select(F.upper("word").alias("word")).distinct()
    for w in WORDS:
        counts = counts.join(stop_words, F.upper(counts[w]) == stop_words["word"], "left_anti")
    return counts


def words_in_use(counts: DataFrame) -> DataFrame:
    """``word, trigrams``: the words of ``counts`` in upper case, with the number of trigrams each
    is in. Words are few beside trigrams, and counted in every map task first."""
    own = F.array_distinct(F.array(*[F.upper(w) for w in WORDS]))
    return counts.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("trigrams"))


def without_listed(counts: DataFrame, listed: DataFrame) -> DataFrame:
    """As :func:`without_stop_words`, for a list that is not broadcast: one row per trigram and
    word meets the list once, and the trigrams found are taken out by one join on all their words.

    No word of ``listed(word)`` may be in a large share of the trigrams.
    """
    own = F.array_distinct(F.array(*[F.upper(w) for w in WORDS]))
    found = counts.select(*WORDS, F.explode(own).alias("word")).join(listed, "word", "left_semi")
    return counts.join(found.select(*WORDS).distinct(), list(WORDS), "left_anti")


def words_of_texts(docs: DataFrame) -> DataFrame:
    """``row, doc_id, letters, words``: the texts of ``docs(doc_id, text)`` reduced to letters, and their
    distinct words. ``row`` is unique, but another one whenever it is worked out: to be staged."""
    letters = docs.select("doc_id", text_letters(F.col("text")).alias("letters"))
    return letters.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "letters",
        F.array_distinct(F.split("letters", " ")).alias("words"),
    )


def listed_words(words: DataFrame, hot: DataFrame, listed: DataFrame) -> DataFrame:
    """``row, listed``: of every row of ``words(row, word)``, those words that ``hot(word, listed)`` or
    ``listed(word)`` have on the list. ``hot`` is broadcast and has all words, on the list or not,
    that are too frequent to be shuffled."""
    found = words.join(F.broadcast(hot.where("listed").select("word")), "word", "left_semi")
    others = words.join(F.broadcast(hot.select("word")), "word", "left_anti")
    found = found.unionByName(others.join(listed, "word", "left_semi"))
    return found.groupBy("row").agg(F.collect_list("word").alias("listed"))


def without_words(letters: Column, listed: Column) -> Column:
    """``letters`` with a gap for every word that is in the array ``listed`` (null: none).

    In Python, since Spark's functions look arrays up from end to end: the time would grow with
    the product of a text's words and those listed.
    """

    @F.pandas_udf("string")
    def gaps(letters: pd.Series, listed: pd.Series) -> pd.Series:
        def cut(text: str, words) -> str:
            words = set(words)
            return " ".join([GAP if word in words else word for word in text.split(" ")])

        cuts = [t if t is None or w is None else cut(t, w) for t, w in zip(letters, listed)]
        return pd.Series(cuts, dtype=object)

    return gaps(letters, listed)
