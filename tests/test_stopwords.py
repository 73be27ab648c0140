import re

import pytest
from tables import rows

import __spark_entry__ as contract
from wordloom import job
from wordloom.plans.next_words import NextWordTable
from wordloom.plans.stop_list import count_without_stop_words, remove_stop_words
from wordloom.operators.stopwords import listed_words, without_stop_words


def test_any_position_counts(frame):
    counts = frame(
        [
            ("THE", "B", "C", 1, 0),
            ("A", "THE", "C", 1, 0),
            ("A", "B", "OF", 1, 0),
            ("A", "B", "C", 1, 2),
        ],
        "w1 STRING, w2 STRING, w3 STRING, r1 BIGINT, r2 BIGINT",
    )
    stop = frame([("THE",), ("OF",), ("THE",)], "word STRING")
    assert rows(without_stop_words(counts, stop)) == [("A", "B", "C", 1, 2)]
    assert without_stop_words(counts, stop.where("false")).count() == 4


COUNTS = "w1 string, w2 string, w3 string, r1 long, r2 long"


@pytest.fixture(scope="module")
def counts(spark):
    """A word in a third of the trigrams; words in both cases."""
    made = [("the" if i % 3 == 0 else f"a{i % 50}", f"B{i}", f"c{i % 7}", i, 1) for i in range(900)]
    return spark.createDataFrame(made, COUNTS)


@pytest.mark.parametrize("stop", [["THE"], ["the", "C3"], ["a1", "A2", "b5", "b6", "zzz"], ["c0", "c1", "the", "b1", "a4", "x"], []])
@pytest.mark.parametrize("max_rows", [1, 2, 4, 1000])
def test_any_plan_takes_out_the_same(spark, counts, stop, max_rows):
    listed = spark.createDataFrame([(w,) for w in stop], "word string")
    upper = {w.upper() for w in stop}
    expected = [tuple(r) for r in counts.collect() if not upper & {r.w1.upper(), r.w2.upper(), r.w3.upper()}]
    assert rows(remove_stop_words(counts, listed, max_rows=max_rows)) == sorted(expected, key=repr)


def test_a_hot_word_is_not_shuffled(spark, counts):
    """The list is not broadcast, and one word is in a third of the trigrams."""
    listed = spark.createDataFrame([("the",), ("b1",), ("b2",), ("b3",)], "word string")
    left = remove_stop_words(counts, listed, max_rows=2)
    hot, others = [], []
    for part in left._jdf.queryExecution().optimizedPlan().toString().split("LeftAnti")[1:]:
        (hot if "broadcast" in part.splitlines()[0] else others).append(part)
    # The trigrams left by the hot words are read twice: to find the others, and to take them out.
    assert len(hot) == 6 and len(others) == 1


def test_lower_case_words_of_the_job(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("the b c\t2000\t3\nx y z\t2000\t2\n")
    (tmp_path / "stop.txt").write_text("the\n")
    out = str(tmp_path / "out")
    argv = [str(tmp_path / "lines.txt"), out, "--input-format", "text", "--word", "[a-z]+", "--stop-words", str(tmp_path / "stop.txt"), "--lookup", str(tmp_path / "lookup")]
    job.run(spark, job.arguments(argv))
    assert [r.value.split("\t")[0] for r in spark.read.text(out).collect()] == ["x y z"]
    found = NextWordTable(spark, str(tmp_path / "lookup")).lookup(spark.createDataFrame([("x", "y")], "w1 string, w2 string"), 1)
    assert [r.w3 for r in found.collect()] == ["z"]


# Repeated and missing ids, missing and empty texts, letters outside ASCII, copies, mixed case.
TEXTS = [(1, "the a b the c d e"), (1, "The B c d"), (None, "c d e f"), (None, "c d e f"), (2, None), (3, ""), (4, "..."),
         (5, "caña b c d SS e f"), (-7, "of the a b c d"), (8, "x y z"), (8, "d e 0 f x1y z")] + [(i, f"the q{i} a b c d e f") for i in range(9, 60)]
LISTS = [["the"], ["the", "OF", "f"], ["the", "c", "x", "ca", None, "", "zzz"], ["ß", "q", "Y", "z", "of", "e", "the"], ["zzz", "zz", "z z"], []]


def expected_counts(stop):
    listed, counts = {w.upper() for w in stop if w}, {}
    for doc_id, text in TEXTS:
        found = [w.upper() for w in re.findall("[A-Za-z]+", text or "")]
        for three in zip(found, found[1:], found[2:]):
            if not listed & set(three):
                counts.setdefault(three, [0, 0])[doc_id is None or doc_id % 2] += 1
    return sorted(((*three, *r) for three, r in counts.items()), key=repr)


@pytest.mark.parametrize("stop", LISTS)
@pytest.mark.parametrize("max_rows", [0, 2, 1000])
def test_texts_lose_the_same_as_counts(spark, stop, max_rows):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    listed = spark.createDataFrame([(w,) for w in stop], "word string")
    assert rows(count_without_stop_words(docs, listed, max_rows=max_rows)) == expected_counts(stop)


def test_a_long_list_meets_texts_and_no_trigram(spark):
    """Only trigrams that stay are made, and their one shuffle is that of the counting."""
    left = contract.queries()["trigrams_without_stopwords_long"](spark, "/root/testdata/sf0.001")
    text = left._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Join \[?\(?(?:upper\()?w[123]#", text)
    assert len(re.findall(r"Exchange hashpartitioning\((?:trigram|w[123])#", text)) == 1


def test_hot_words_are_not_shuffled_by_word(spark):
    """Frequent words, on the list or not, are left out before words are joined by shuffle."""
    words = spark.createDataFrame([(i, w) for i in range(50) for w in ("the", "a", f"b{i}")], "row long, word string")
    hot = spark.createDataFrame([("the", True), ("a", False)], "word string, listed boolean")
    found = listed_words(words, hot, spark.createDataFrame([("b1",), ("b2",)], "word string"))
    assert {r.row: sorted(r.listed) for r in found.collect()} == {i: ["b%d" % i] * (i in (1, 2)) + ["the"] for i in range(50)}
    joins = re.findall(r"Join (\w+),.*", found._jdf.queryExecution().optimizedPlan().toString())
    assert sorted(joins) == ["LeftAnti", "LeftSemi", "LeftSemi"]
    below = found._jdf.queryExecution().optimizedPlan().toString().split("Join LeftAnti")[0].splitlines()[-2]
    assert "Join LeftSemi" in below and "broadcast" not in below
