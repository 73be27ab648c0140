"""Sources, sinks, the shared folder and the job."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tables import GOLDEN_LINES, rows

from wordloom.job import arguments, run
from wordloom.plans import staging
from wordloom.plans.knowledge_base import KnowledgeBase, counts_of_lines
from wordloom.sinks.text import (
    COUNT_FIELDS,
    TABLE_FIELDS,
    key_value_lines,
    other_lines,
    parse_fields,
    read_named,
    read_text,
    table_lines,
    tag_lines,
    write_lines,
    write_named,
)
from wordloom.sources.lines import read_sequence_lines, read_text_lines

GOLDEN_TEXT = [
    "A B C\t0.16666666666666666",
    "A B E\t0.16666666666666666",
    "A B D\t0.041666666666666664",
    "X Y Z\t0.1875",
]


def hadoop_sequence_file(spark, path, pairs, compression="NONE"):
    """Write (LongWritable, Text) records with Hadoop's own writer."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    io = jvm.org.apache.hadoop.io
    options = gateway.new_array(io.SequenceFile.Writer.Option, 4)
    options[0] = io.SequenceFile.Writer.file(jvm.org.apache.hadoop.fs.Path(path))
    options[1] = io.SequenceFile.Writer.keyClass(jvm.java.lang.Class.forName("org.apache.hadoop.io.LongWritable"))
    options[2] = io.SequenceFile.Writer.valueClass(jvm.java.lang.Class.forName("org.apache.hadoop.io.Text"))
    options[3] = io.SequenceFile.Writer.compression(io.SequenceFile.CompressionType.valueOf(compression))
    writer = io.SequenceFile.createWriter(spark.sparkContext._jsc.hadoopConfiguration(), options)
    for key, value in pairs:
        writer.append(io.LongWritable(key), io.Text(value))
    writer.close()


def test_sequence_file_keeps_keys(spark, tmp_path):
    pairs = [(0, "A B C\t1990\t3"), (-7, "é"), (2**40, ""), (2**62, "x")]
    hadoop_sequence_file(spark, str(tmp_path / "in/part-0"), pairs)
    lines = read_sequence_lines(spark, str(tmp_path / "in"))
    assert lines.dtypes == [("line_id", "bigint"), ("line", "string")]
    assert rows(lines) == sorted(pairs, key=repr)


@pytest.mark.parametrize("compression", ["NONE", "RECORD", "BLOCK"])
def test_sequence_files_are_split_at_sync_marks(spark, tmp_path, compression):
    """Every record is read once, whatever the compression and however many splits a file has."""
    pairs = [(i * 3 - 1000, f"W{i} X Y\t1990\t{i * 7919 % 10007}" + "z" * (i % 50)) for i in range(20000)]
    hadoop_sequence_file(spark, str(tmp_path / "in/part-0"), pairs, compression)
    hadoop_sequence_file(spark, str(tmp_path / "in/part-1"), [], compression)
    hadoop_sequence_file(spark, str(tmp_path / "in/part-2"), pairs[:5], compression)
    lines = read_sequence_lines(spark, str(tmp_path / "in"))
    assert rows(lines) == sorted(pairs + pairs[:5], key=repr)
    if compression == "NONE":
        assert lines.groupBy(F.spark_partition_id()).count().count() > 2


def test_sequence_records_stay_out_of_python(spark, tmp_path):
    hadoop_sequence_file(spark, str(tmp_path / "in/part-0"), [(1, "A B C")])
    lines = read_sequence_lines(spark, str(tmp_path / "in"))
    plan = lines._jdf.queryExecution().toString()
    assert "SerializeFromObject" in plan and "Python" not in plan and "Scan ExistingRDD" not in plan


def test_sequence_files_without_records_or_with_other_bytes(spark, tmp_path):
    hadoop_sequence_file(spark, str(tmp_path / "none/part-0"), [])
    assert rows(read_sequence_lines(spark, str(tmp_path / "none"))) == []
    broken = [(1, bytearray(b"a\xffb")), (1, bytearray(b"a\xffb")), (2, bytearray(b"\r\n"))]
    hadoop_sequence_file(spark, str(tmp_path / "in/part-0"), broken)
    assert rows(read_sequence_lines(spark, str(tmp_path / "in"))) == [(1, "a\ufffdb"), (1, "a\ufffdb"), (2, "\r\n")]
    with pytest.raises(Exception, match="does not exist"):
        read_sequence_lines(spark, str(tmp_path / "missing")).collect()


def test_text_lines_have_byte_offsets(spark, tmp_path):
    (tmp_path / "a").write_bytes("A B C\t1990\t3\né\nlast".encode())
    (tmp_path / "b").write_bytes(b"other\n")
    lines = read_text_lines(spark, str(tmp_path))
    assert rows(lines) == sorted([(0, "A B C\t1990\t3"), (13, "é"), (16, "last"), (0, "other")], key=repr)


def test_table_round_trip_is_exact(spark, frame, tmp_path):
    values = [1 / 3, 1e-300, 5e-324, 0.0, 1.0, 2.5e-9, 1.7976931348623157e308]
    table = [("A", "B", f"C{chr(65 + i)}", v) for i, v in enumerate(values)]
    write_lines(table_lines(frame(table, TABLE_FIELDS)), str(tmp_path / "t"))
    assert rows(parse_fields(read_text(spark, str(tmp_path / "t")), TABLE_FIELDS)) == table


def test_missing_probability_is_nan_in_text(frame):
    assert [r.line for r in table_lines(frame([("A", "B", "C", None)], TABLE_FIELDS)).collect()] == ["A B C\tNaN"]


def test_fields_by_arity(frame):
    lines = frame(
        [("A B C\t1 2",), ("A B C\t0.5",), ("A B C  0.25\t \r\x0b\f",), ("3\t1 2 2",), ("A B",), ("",)],
        "line STRING",
    )
    assert rows(parse_fields(lines, COUNT_FIELDS)) == [("A", "B", "C", 1, 2)]
    assert rows(other_lines(lines, 4, 5)) == [("",), ("A B",)]
    table = parse_fields(lines.where("line LIKE 'A%'"), TABLE_FIELDS)
    assert rows(table) == [("A", "B", "C", 0.25), ("A", "B", "C", 0.5)]


def test_field_of_wrong_type_raises(frame):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_fields(frame([("A B C\tx y",)], "line STRING"), COUNT_FIELDS).collect()


def test_statistics_lines_round_trip(golden):
    kb = KnowledgeBase(counts_of_lines(golden))
    lines = key_value_lines(kb.stats_rows, ["w1", "w2", "w3"], ["part", "nr", "tr"])
    back = parse_fields(lines, StructType.fromDDL("w1 STRING, w2 STRING, w3 STRING, part INT, nr BIGINT, tr BIGINT"))
    assert rows(back) == rows(kb.stats_rows)


def test_named_outputs(spark, golden, tmp_path):
    write_named(tag_lines(golden), str(tmp_path / "named"))
    kept, rejected = (
        {r.line for r in read_named(spark, str(tmp_path / "named"), n).collect()}
        for n in ("kept", "rejected")
    )
    assert rejected == {GOLDEN_LINES[i][1] for i in (6, 7, 9)}
    assert kept == {line for _, line in GOLDEN_LINES} - rejected


def test_order_survives_in_text(spark, golden, tmp_path):
    write_lines(table_lines(KnowledgeBase(counts_of_lines(golden)).sorted), str(tmp_path / "kb"))
    written = [
        line
        for part in sorted((tmp_path / "kb").glob("part-*"))
        for line in part.read_text().splitlines()
    ]
    assert written == GOLDEN_TEXT


@pytest.mark.parametrize("kind", ["sequence", "parquet"])
def test_job_from_lines(spark, golden, tmp_path, kind):
    source, out, rejects = (str(tmp_path / d) for d in ("in", "out", "rejects"))
    if kind == "sequence":
        hadoop_sequence_file(spark, source + "/part-0", GOLDEN_LINES)
    else:
        golden.write.parquet(source)
    argv = [source, out, "--input-format", kind, "--rejects", rejects]
    assert run(spark, arguments(argv)) == {"kept": 7, "rejected": 3}
    assert sorted(r.line for r in read_text(spark, out).collect()) == sorted(GOLDEN_TEXT)
    assert read_text(spark, rejects).count() == 3


def test_job_from_text(spark, tmp_path):
    # The byte offsets 0 and 13 put the first line in part 1, the second in part 2.
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a").write_text("A B C\t1990\t3\nA B C\t1991\t1\n")
    argv = [str(tmp_path / "in"), str(tmp_path / "out"), "--input-format", "text"]
    assert run(spark, arguments(argv)) == {}
    assert [r.line for r in read_text(spark, str(tmp_path / "out")).collect()] == ["A B C\t0.5"]


def test_job_with_another_word_pattern(spark, frame, tmp_path):
    source, out, rejects = (str(tmp_path / d) for d in ("in", "out", "rejects"))
    lines = [(0, "a b c\t1990\t3"), (1, "a b c\t1991\t1"), (2, "A B C\t1990\t1")]
    frame(lines).write.parquet(source)
    argv = [source, out, "--input-format", "parquet", "--word", "[a-z]+", "--rejects", rejects]
    assert run(spark, arguments(argv)) == {"kept": 2, "rejected": 1}
    assert [r.line for r in read_text(spark, out).collect()] == ["a b c\t0.5"]


def test_job_from_documents(spark, frame, tmp_path):
    frame([(1, "a b c"), (2, "a b c d")], "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "in"))
    argv = [str(tmp_path / "in"), str(tmp_path / "out"), "--input-format", "documents", "--output-format", "parquet"]
    assert run(spark, arguments(argv)) == {}
    assert rows(spark.read.parquet(str(tmp_path / "out")), "w1", "w2", "w3") == [("A", "B", "C"), ("B", "C", "D")]


class FakeSession:
    """The settings ``shared_folder`` looks at."""

    def __init__(self, master, setting=None, checkpoint_dir=None):
        self.settings = {"spark.checkpoint.dir": setting} if setting else {}
        self.master, self.checkpoint_dir = master, checkpoint_dir
        self.conf = self.sparkContext = self

    def get(self, name, default):
        return self.settings.get(name, default)

    def getCheckpointDir(self):
        return self.checkpoint_dir

    def setCheckpointDir(self, folder):
        self.checkpoint_dir = folder


def test_folder_is_the_one_the_session_names():
    folder = staging.shared_folder(FakeSession("yarn", "hdfs://shared/x/", "hdfs://other"))
    assert folder == "hdfs://shared/x"
    assert staging.shared_folder(FakeSession("yarn", None, "hdfs://other")) == "hdfs://other"


def test_a_cluster_must_name_the_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(FakeSession("yarn"))


def test_local_mode_must_name_it_too_but_local_sessions_do(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(FakeSession("local[2]"))
    assert staging.shared_folder(spark)


def test_what_a_knowledge_base_staged_can_be_freed(golden, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    kb = KnowledgeBase(counts_of_lines(golden)).build()
    (folder,) = (tmp_path / golden.sparkSession.sparkContext.applicationId).iterdir()
    assert {p.name for p in folder.iterdir()} == {"trigram_counts", "frequency_cells", "nr_tr"}
    kb.free()
    assert not folder.exists()


def test_job_leaves_nothing_staged(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path / "shared"))
    frame(GOLDEN_LINES).write.parquet(str(tmp_path / "in"))
    argv = [str(tmp_path / "in"), str(tmp_path / "out"), "--input-format", "parquet"]
    assert run(spark, arguments([*argv, "--rejects", str(tmp_path / "no")])) == {"kept": 7, "rejected": 3}
    assert not list((tmp_path / "shared" / spark.sparkContext.applicationId).iterdir())


def test_job_scans_its_input_once(spark, frame, tmp_path, monkeypatch):
    from wordloom import job

    reads = []
    real = job.check_lines

    def counted_lines(lines, word):
        seen = spark.sparkContext.accumulator(0)
        reads.append(seen)
        return real(spark.createDataFrame(lines.rdd.map(lambda r: seen.add(1) or r), lines.schema), word)

    monkeypatch.setattr(job, "check_lines", counted_lines)
    frame(GOLDEN_LINES).write.parquet(str(tmp_path / "in"))
    argv = [str(tmp_path / "in"), str(tmp_path / "out"), "--input-format", "parquet"]
    run(spark, arguments([*argv, "--rejects", str(tmp_path / "no")]))
    assert [seen.value for seen in reads] == [len(GOLDEN_LINES)]
    assert [r.line for r in read_text(spark, str(tmp_path / "out")).collect()] == GOLDEN_TEXT


def test_job_with_top_stop_words_and_step_tables(spark, frame, tmp_path):
    source, out, counts, stats = (str(tmp_path / d) for d in ("in", "out", "counts", "stats"))
    frame(GOLDEN_LINES).write.parquet(source)
    (tmp_path / "stop").write_text("x  foo\n\ny\n")
    argv = [source, out, "--input-format", "parquet", "--stop-words", str(tmp_path / "stop")]
    argv += ["--top", "2", "--counts", counts, "--statistics", stats]
    assert run(spark, arguments(argv)) == {}
    lines = [r.line.split("\t") for r in read_text(spark, out).collect()]
    assert [(key, value.split(" ")[1]) for key, value in lines] == [("A B C", "1"), ("A B E", "2")]
    assert rows(spark.read.parquet(counts), "w1", "w2", "w3") == [("A", "B", w) for w in "CDE"]
    assert "nr1" in spark.read.parquet(stats).columns


@pytest.mark.parametrize("option", [["--rejects", "r"], ["--word", "[a-z]+"], ["--top", "0"]])
def test_options_that_make_no_sense_are_errors(option, capsys):
    with pytest.raises(SystemExit):
        arguments(["in", "out", "--input-format", "documents", *option])


def test_named_output_without_rows_is_empty(spark, frame, tmp_path):
    write_named(tag_lines(frame([(0, "A B C\t1990\t3")])), str(tmp_path / "some"))
    assert rows(read_named(spark, str(tmp_path / "some"), "rejected")) == []
    assert rows(read_named(spark, str(tmp_path / "some"), "kept")) == [("A B C\t1990\t3",)]
    write_named(tag_lines(frame([])), str(tmp_path / "none"))
    assert rows(read_named(spark, str(tmp_path / "none"), "kept")) == []


def test_fields_can_be_decimals(frame):
    fields = StructType.fromDDL("k STRING, v DECIMAL(10,2)")
    assert [str(v) for _, v in rows(parse_fields(frame([("a 1.50",)], "line STRING"), fields))] == ["1.50"]


def test_stage_writes_below_the_folder(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    staged = staging.stage(frame([(1, "x")]), "some_table")
    application = tmp_path / spark.sparkContext.applicationId
    assert [p.name.split("-")[0] for p in application.iterdir()] == ["some_table"]
    assert staged.inputFiles()[0].removeprefix("file://").startswith(str(tmp_path))
    assert rows(staged) == [(1, "x")]


def test_broadcast_hint_depends_on_size(frame):
    words = frame([("THE",), ("OF",)], "word STRING")
    hint = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hint(staging.broadcast_if_small(words))
    assert not hint(staging.broadcast_if_small(words, max_rows=1))
