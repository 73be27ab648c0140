"""What queries that write and read files leave in the shared folder."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tables import rows

import __spark_entry__ as contract
from wordloom.plans import staging
from wordloom.sinks.sequence import write_sequence_lines
from wordloom.sources.lines import read_sequence_lines

TEXTS = [(i, " ".join(f"{w}{'xyz'[i % 3]}" for w in ("ab", "cd", "ef", "gh") * (i % 7))) for i in range(-30, 90)]


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """The application's folder, empty as yet; ``documents`` lie beside it."""
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path / "shared"))
    spark.createDataFrame(TEXTS, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return tmp_path / "shared" / spark.sparkContext.applicationId


def files(folder: Path) -> list[Path]:
    return [p for p in folder.rglob("part-*") if p.is_file()]


def test_kb_import_leaves_compressed_text_only(spark, tmp_path, folder):
    found = contract.queries()["kb_import"](spark, str(tmp_path))
    assert [p.name.split("-")[0] for p in folder.iterdir()] == ["kb_text"]
    assert {p.suffix for p in files(folder)} == {".gz"}
    assert rows(found) == rows(contract.queries()["kb_table_sorted"](spark, str(tmp_path)))


def test_text_arity_leaves_compressed_text_only(spark, tmp_path, folder):
    found = contract.queries()["text_arity"](spark, str(tmp_path))
    assert [p.name.split("-")[0] for p in folder.iterdir()] == ["steps_text"]
    assert {p.suffix for p in files(folder)} == {".gz"}
    trigrams = contract.queries()["trigram_counts"](spark, str(tmp_path)).count()
    assert sorted(map(tuple, found.groupBy("kind").count().collect())) == [
        ("counts", trigrams), ("other", 2 * trigrams), ("table", trigrams)
    ]


def test_sequence_scan_writes_compressed_blocks_that_can_be_split(spark, tmp_path, folder):
    found = contract.queries()["sequence_scan"](spark, str(tmp_path))
    written = [p.read_bytes() for p in files(folder)]
    assert written and all(b"org.apache.hadoop.io.Text\x01\x01" in data[:100] for data in written)  # compressed, in blocks
    assert rows(found) == rows(contract.queries()["ngram_lines"](spark, str(tmp_path)))
    lines = spark.range(400_000).selectExpr("id * 7 - 1000 AS line_id", "concat('A B ', hex(hash(id))) AS line")
    write_sequence_lines(lines.coalesce(1), str(tmp_path / "long"))
    back = read_sequence_lines(spark, str(tmp_path / "long"))
    assert back.rdd.getNumPartitions() > 1
    assert back.exceptAll(lines).isEmpty() and back.count() == 400_000
    assert back.groupBy(F.spark_partition_id()).count().count() > 1
