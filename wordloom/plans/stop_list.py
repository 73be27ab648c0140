"""Removal of stop words, planned by the size of the list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.counts import count_trigrams
from wordloom.operators.parse import split_corpus
from wordloom.operators.stopwords import (
    listed_words,
    without_listed,
    without_stop_words,
    without_words,
    words_in_use,
    words_of_texts,
)
from wordloom.plans.knowledge_base import counts_of_documents
from wordloom.plans.staging import MAX_BROADCAST_ROWS, new_path, stage
from wordloom.sources.documents import letter_occurrences


def remove_stop_words(
    counts: DataFrame, stop_words: DataFrame, below: str | None = None, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """``counts`` without trigrams of which any word is in ``stop_words(word)``; exact.

    - A list of up to ``max_rows`` words is broadcast: one pass, nothing is shuffled.
    - Of a longer one, only words that the trigrams use can match. They are found by a join of the
      vocabulary with the list, neither of which has a word twice, so no key is hot there. As a
      rule they are few enough to be broadcast.
    - If not, the words that are in more than ``1 / max_rows`` of the trigrams' places are broadcast
      (there are at most ``3 * max_rows``), which takes every hot word out; the others, none of
      them frequent, are shuffled once for all three words.

    Tables are staged in ``below``, a folder of :func:`wordloom.plans.staging.new_path`.
    """
    listed = stage(stop_words.select(F.upper("word").alias("word")).distinct(), "stop_list", below=below)
    if listed.count() <= max_rows:
        return without_stop_words(counts, F.broadcast(listed))
    counts = stage(counts, "counts_with_stop_words", below=below)
    used = stage(words_in_use(counts).join(listed, "word", "left_semi"), "stop_words_in_use", below=below)
    if used.count() <= max_rows:
        return without_stop_words(counts, F.broadcast(used.select("word")))
    share = max(1, counts.count() // max(1, max_rows))
    hot, others = used.where(F.col("trigrams") > share), used.where(F.col("trigrams") <= share)
    return without_listed(without_stop_words(counts, F.broadcast(hot.select("word"))), others.select("word"))


def count_without_stop_words(
    docs: DataFrame, stop_words: DataFrame, below: str | None = None, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Trigram counts of ``docs(doc_id, text)`` without trigrams of which any word is in
    ``stop_words(word)``; exact, and the same rows as :func:`remove_stop_words` on all counts.

    - A list of up to ``max_rows`` words is broadcast to the counts; so are the listed words in use
      if only they are as few. These are found by a join of the texts' vocabulary with the list.
    - Of more, no trigram is shuffled to meet the list: the distinct words of every text are, which
      are far fewer, and only those that are not in more than ``1 / max_rows`` of such rows (the
      others, fewer than ``max_rows``, are broadcast). The listed words of each text then meet the text
      in a shuffle of the texts, and leave gaps there. Only trigrams that stay are made and counted.
    """
    below = below or new_path(docs.sparkSession, "stop_words")
    listed = stage(stop_words.select(F.upper("word").alias("word")).distinct(), "stop_list", below=below)
    if listed.count() <= max_rows:
        return without_stop_words(counts_of_documents(docs), F.broadcast(listed))
    texts = stage(words_of_texts(docs), "words_of_texts", below=below)
    words = texts.select("row", F.explode("words").alias("word"))
    vocabulary = words.groupBy("word").agg(F.count("*").alias("texts"))
    on_list = listed.select("word", F.lit(True).alias("on_list"))
    vocabulary = vocabulary.join(on_list, "word", "left").select(
        "word", "texts", F.coalesce("on_list", F.lit(False)).alias("listed")
    )
    vocabulary = stage(vocabulary, "vocabulary", below=below)
    # A table of its own, so that Spark knows its size.
    used = stage(vocabulary.where("listed"), "stop_words_in_use", below=below)
    if used.count() <= max_rows:
        return without_stop_words(counts_of_documents(docs), F.broadcast(used.select("word")))
    share = max(1, vocabulary.agg(F.sum("texts")).first()[0] // max(1, max_rows))
    hot, others = vocabulary.where(F.col("texts") > share), used.where(F.col("texts") <= share)
    found = listed_words(words, hot, others.select("word"))
    gaps = without_words(F.col("letters"), F.col("listed")).alias("letters")
    letters = texts.join(found, "row", "left").select("doc_id", gaps)
    return count_trigrams(split_corpus(letter_occurrences(letters)))
