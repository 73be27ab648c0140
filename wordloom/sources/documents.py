"""Running text as a trigram source: documents to trigrams and to n-gram lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.ngrams import letter_trigrams, text_trigrams

DOCUMENTS_SCHEMA = "doc_id BIGINT, text STRING"

# The fields of a rendered line that documents do not have.
RENDERED_YEAR = "2000"
RENDERED_PAGES = "1"
RENDERED_BOOKS = "1"
# What a text with a trigram has, and no other.
THREE_WORDS = "[A-Za-z][^A-Za-z]++[A-Za-z]++[^A-Za-z]++[A-Za-z]"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Read ``doc_id, text`` and give every core a share of the tokenizing.

    Spark cuts a small table into about one split per core, but a split without the start of
    a row group stays empty. A table of less than two splits per core is therefore
    spread first: its text is moved once, before it grows into trigrams. A larger one is
    left as it is, so no text is shuffled there.
    """
    docs = spark.read.schema(DOCUMENTS_SCHEMA).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() < 2 * cores:
        docs = docs.repartition(4 * cores)
    return docs


def document_trigrams(docs: DataFrame) -> DataFrame:
    """``doc_id, trigram``: one row per three consecutive words."""
    return docs.select("doc_id", F.explode(text_trigrams(F.col("text"))).alias("trigram"))


def document_occurrences(docs: DataFrame) -> DataFrame:
    """The trigrams of documents in the shape of parsed lines, each occurring once."""
    return _once_each(document_trigrams(docs))


def letter_occurrences(letters: DataFrame) -> DataFrame:
    """The same of ``letters(doc_id, letters)``, texts that are reduced to letters already."""
    return _once_each(
        letters.select("doc_id", F.explode(letter_trigrams(F.col("letters"))).alias("trigram"))
    )


def _once_each(trigrams: DataFrame) -> DataFrame:
    return trigrams.select(
        F.col("doc_id").alias("line_id"), "trigram", F.lit(1).cast("bigint").alias("occurrences")
    )


def _spelled(spelled_every: int | None) -> Column | None:
    return None if spelled_every is None else F.col("doc_id") % spelled_every == 0


def _is_last(at: Column) -> Column:
    """Whether the trigram at this place of ``every``, a sorted array, is the last of its kind."""
    return (at < F.size("every")) & ~F.get("every", at).eqNullSafe(F.get("every", at + 1))


def _line(trigram: Column, n: Column) -> Column:
    return F.concat_ws(
        "\t",
        trigram,
        F.lit(RENDERED_YEAR),
        n.cast("string"),
        F.lit(RENDERED_PAGES),
        F.lit(RENDERED_BOOKS),
    )


def _text_counts(docs: DataFrame, spelled_every: int | None) -> DataFrame:
    """``doc_id, trigram, n``: the distinct trigrams of every row, without a shuffle.

    In the sorted array of a text's trigrams, equal ones stand together. ``ends`` has the places
    where one is the last of its kind; the distance to the place before is its count.
    """
    spelled = _spelled(spelled_every)
    every = docs.select(
        "doc_id", F.sort_array(text_trigrams(F.col("text"), keep_case=spelled)).alias("every")
    )
    ends = F.filter(F.sequence(F.lit(0), F.size("every")), _is_last)
    # Before a plain posexplode, Spark would look for empty arrays, and sort once more for each place.
    placed = every.select("doc_id", "every", ends.alias("ends")).select(
        "doc_id", "every", "ends", F.posexplode_outer("ends").alias("i", "at")
    ).where("at is not null")
    before = F.coalesce(F.get("ends", F.col("i") - 1), F.lit(-1))
    return placed.select(
        "doc_id",
        F.get("every", F.col("at")).alias("trigram"),
        (F.col("at") - before).cast("bigint").alias("n"),
    )


def _by_id(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts whose id no other row has, and those whose id several rows share."""
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1")
    same = docs["doc_id"].eqNullSafe(repeated["doc_id"])
    return docs.join(repeated, same, "left_anti"), docs.join(repeated, same, "left_semi")


def _summed(several: DataFrame, spelled_every: int | None) -> DataFrame:
    counts = _text_counts(several, spelled_every)
    return counts.groupBy("doc_id", "trigram").agg(F.sum("n").alias("n"))


def document_lines(docs: DataFrame, spelled_every: int | None = None) -> DataFrame:
    """``line_id, line``: one n-gram line in upper case per document and trigram.

    With ``spelled_every`` n, documents whose id is divisible by n keep their spelling, so
    that there are lines in lower and mixed case too, which the line pattern rejects.

    A text's trigrams are counted in its own row, so no trigram is shuffled: only the texts are
    dealt by ``doc_id``, to find ids that several rows share. The counts of these are summed.
    """
    once, several = _by_id(docs)
    per_document = _text_counts(once, spelled_every).unionByName(_summed(several, spelled_every))
    return per_document.select(
        F.col("doc_id").alias("line_id"), _line(F.col("trigram"), F.col("n")).alias("line")
    )


def line_sources(docs: DataFrame) -> DataFrame:
    """``line_id, line, text``: what :func:`document_lines` makes its lines of, to be dealt and
    sorted by ``line_id, line`` while it is small.

    A text whose id no other row has stands for its lines; ids of several rows have a row for
    each line. :func:`source_lines` makes the lines, in this order.
    """
    once, several = _by_id(docs.where(F.col("text").rlike(THREE_WORDS)))
    texts = once.select(
        F.col("doc_id").alias("line_id"), F.lit(None).cast("string").alias("line"), "text"
    )
    lines = _summed(several, None).select(
        F.col("doc_id").alias("line_id"),
        _line(F.col("trigram"), F.col("n")).alias("line"),
        F.lit(None).cast("string").alias("text"),
    )
    return texts.unionByName(lines)


def source_lines(sources: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and ``line`` of every row of :func:`line_sources`: its line, or all lines of its
    text in their order, with line feeds between. Rows stay where they are and in their order.
    """
    every = sources.select(*columns, "line", F.sort_array(text_trigrams(F.col("text"))).alias("every"))
    ends = F.filter(F.sequence(F.lit(0), F.size("every")), _is_last)
    placed = every.select(*columns, "line", "every", ends.alias("ends"))

    def line(at: Column, i: Column) -> Column:
        return _line(F.get("every", at), at - F.coalesce(F.get("ends", i - 1), F.lit(-1)))

    lines = F.array_join(F.transform("ends", line), "\n")
    return placed.select(*columns, F.coalesce("line", lines).alias("line"))
