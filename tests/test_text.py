"""Running text to trigrams and to n-gram lines."""

import re
from collections import Counter

import pytest
from tables import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.operators.parse import parse_lines, split_words
from wordloom.sources.documents import document_lines, document_trigrams, read_documents

DOCS = "doc_id BIGINT, text STRING"


def trigrams(text, upper=True):
    tokens = re.findall("[A-Za-z]+", text)
    tokens = [t.upper() for t in tokens] if upper else tokens
    return [" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("one two three four", ["ONE TWO THREE", "TWO THREE FOUR"]),
        ("It's 3 o'clock", ["IT S O", "S O CLOCK"]),
        ("  a,b;\n\tc  ", ["A B C"]),
        ("straße über ı ſ x", ["STRA E BER", "E BER X"]),
        ("a a a a", ["A A A", "A A A"]),
        ("two words", []),
        ("", []),
        ("123 !?", []),
        (None, []),
    ],
)
def test_trigrams(frame, text, expected):
    found = document_trigrams(frame([(1, text)], DOCS))
    assert sorted(r.trigram for r in found.collect()) == sorted(expected)


ANY_TEXT = st.one_of(st.sampled_from("aBc Z.\n"), st.characters(exclude_categories=["Cs"]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(ANY_TEXT, max_size=60), min_size=1, max_size=40))
def test_any_text(frame, texts):
    found = document_trigrams(frame(list(enumerate(texts)), DOCS))
    expected = Counter((i, t) for i, text in enumerate(texts) for t in trigrams(text))
    assert Counter((r.doc_id, r.trigram) for r in found.collect()) == expected


def test_long_text_and_long_words(frame):
    text = " ".join(["x" * 50_000, "y" * 200_000, "z"] + [f"w{chr(97 + i % 26)}" for i in range(60_000)])
    found = document_trigrams(frame([(1, text)], DOCS))
    assert Counter(r.trigram for r in found.collect()) == Counter(trigrams(text))


def test_lines_are_counted_per_document(frame):
    docs = frame([(1, "a b c a b c"), (2, "A b c"), (10, "A B C a b c")], DOCS)
    assert rows(document_lines(docs, spelled_every=10)) == sorted(
        [
            (1, "A B C\t2000\t2\t1\t1"),
            (1, "B C A\t2000\t1\t1\t1"),
            (1, "C A B\t2000\t1\t1\t1"),
            (2, "A B C\t2000\t1\t1\t1"),
            (10, "A B C\t2000\t1\t1\t1"),
            (10, "B C a\t2000\t1\t1\t1"),
            (10, "C a b\t2000\t1\t1\t1"),
            (10, "a b c\t2000\t1\t1\t1"),
        ],
        key=repr,
    )


def test_lines_parse_back(frame):
    docs = frame([(1, "a b c a b c d"), (10, "A B C d")], DOCS)
    parsed = rows(split_words(parse_lines(document_lines(docs))))
    assert (1, "A", "B", "C", 2) in parsed and (10, "A", "B", "C", 1) in parsed
    assert len(parsed) == 6


def test_small_tables_are_spread_over_the_cores(spark):
    docs = read_documents(spark, "/root/testdata/sf0.001/documents.parquet")
    assert docs.columns == ["doc_id", "text"]
    per_task = docs.groupBy(F.spark_partition_id()).count()
    assert per_task.count() >= spark.sparkContext.defaultParallelism


def test_tables_with_many_splits_are_not_moved(spark):
    settings = {
        "spark.sql.files.maxPartitionBytes": "20000",
        "spark.sql.files.openCostInBytes": "0",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        docs = read_documents(spark, "/root/testdata/sf0.001/documents.parquet")
        assert docs.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
        assert "Exchange" not in docs._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_sequence_lines_are_written_in_the_jvm(spark):
    from wordloom.plans.staging import new_path
    from wordloom.sinks.sequence import write_sequence_lines
    from wordloom.sources.lines import read_sequence_lines

    path = new_path(spark, "sequence")
    lines = [(-3, "a"), (0, ""), (7, "ä b\tc"), (1 << 40, "d")]
    write_sequence_lines(spark.createDataFrame(lines, "line_id long, line string"), path)
    assert sorted(map(tuple, read_sequence_lines(spark, path).collect())) == lines
