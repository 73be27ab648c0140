"""N-gram lines of documents: counted in the row, summed where rows share an id."""

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tables import rows

import __spark_entry__ as contract
from wordloom.plans.staging import new_path
from wordloom.sources.documents import _text_counts, document_lines, line_sources, source_lines

TEXTS = [(1, "a b c a b c"), (2, None), (3, "x y"), (4, ""), (5, "A b C. a B c"), (5, "a b c d"), (None, "p q r"), (None, "p q r s"), (-6, "m n o p m n o")]


def test_lines_are_counted_by_id(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    expected = Counter()
    for doc_id, text in TEXTS:
        found = (text or "").replace(".", "").upper().split()
        expected.update((doc_id, " ".join(found[i : i + 3])) for i in range(len(found) - 2))
    lines = [(doc_id, f"{trigram}\t2000\t{n}\t1\t1") for (doc_id, trigram), n in expected.items()]
    assert rows(document_lines(docs)) == rows(spark.createDataFrame(lines, "line_id long, line string"))


def test_a_text_is_counted_without_a_shuffle(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    plan = _text_counts(docs, None)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_every_text_file_has_a_task_of_its_own(spark, monkeypatch):
    made = []
    monkeypatch.setattr(contract, "new_path", lambda *names: made.append(new_path(*names)) or made[-1])
    contract.queries()["text_scan"](spark, "/root/testdata/sf0.001")
    files = spark.read.text(made[0]).select("file", F.input_file_name().alias("path")).distinct().collect()
    tasks = [re.search(r"part-(\d+)", row["path"])[1] for row in files]
    assert len(tasks) == len(set(tasks)) == contract.TEXT_FILES


@pytest.mark.parametrize("texts", [TEXTS, [*TEXTS, *TEXTS], []])
def test_sources_give_the_lines_of_documents_in_their_order(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sources = line_sources(docs).coalesce(1).sortWithinPartitions("line_id", "line")
    found = [(r.line_id, line) for r in source_lines(sources, "line_id").collect() for line in r.line.split("\n")]
    expected = [(r.line_id, r.line) for r in document_lines(docs).orderBy("line_id", "line").collect()]
    assert found == expected


def test_text_scan_shuffles_texts_and_compresses_its_files(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(contract, "new_path", lambda *names: made.append(new_path(*names)) or made[-1])
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    texts = [(i, " ".join(words[(i * j) % 5] for j in range(i % 90))) for i in range(-40, 200)]
    texts += [(7, "one more text"), (7, "alpha alpha alpha"), (39, "x y"), (55, "x"), (55, "y z")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    expected, offset, last = [], 0, None
    lines = sorted(map(tuple, document_lines(docs).collect()), key=lambda x: (x[0] % contract.TEXT_FILES, x))
    for line_id, line in lines:
        offset = 0 if line_id % contract.TEXT_FILES != last else offset
        last = line_id % contract.TEXT_FILES
        expected.append((offset, line))
        offset += len(line) + 1
    assert rows(contract.queries()["text_scan"](spark, str(tmp_path))) == sorted(expected, key=repr)
    files = list(Path(made[0].removeprefix("file:")).rglob("part-*"))
    assert len(files) == contract.TEXT_FILES
    assert 2 * sum(f.stat().st_size for f in files) < sum(len(line) + 1 for _, line in lines)
