"""N-gram lines as SequenceFiles."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_sequence_lines(lines: DataFrame, path: str) -> None:
    """``line_id, line`` as SequenceFiles of (LongWritable, Text), a file per partition.

    Records are compressed in blocks, by the codec of the session's Hadoop settings; such files can
    still be split at sync marks. The way back of :func:`wordloom.sources.lines.read_sequence_lines`: an encoder and Spark's
    converters make the pairs in the JVM, no record passes through Python.
    """
    spark = lines.sparkSession
    jvm = spark.sparkContext._jvm
    conf = jvm.org.apache.hadoop.conf.Configuration(spark.sparkContext._jsc.hadoopConfiguration())
    conf.set("mapreduce.output.fileoutputformat.compress", "true")
    conf.set("mapreduce.output.fileoutputformat.compress.type", "BLOCK")
    conf.setIfUnset("zlib.compress.level", "BEST_SPEED")
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()

    def named(name: str):
        return jvm.java.lang.Class.forName(f"org.apache.hadoop.{name}", True, loader)

    encoders, python = jvm.org.apache.spark.sql.Encoders, jvm.org.apache.spark.api.python
    pairs = lines.select("line_id", "line").toDF("_1", "_2")._jdf
    rows = getattr(pairs, "as")(encoders.tuple(encoders.LONG(), encoders.STRING())).rdd()
    convert = python.JavaToWritableConverter()
    written = python.PythonHadoopUtil.convertRDD(rows, convert, convert)
    tag = jvm.scala.reflect.ClassTag.apply(named("io.Writable"))
    jvm.org.apache.spark.api.java.JavaPairRDD.fromRDD(written, tag, tag).saveAsNewAPIHadoopFile(
        path,
        named("io.LongWritable"),
        named("io.Text"),
        named("mapreduce.lib.output.SequenceFileOutputFormat"),
        conf,
    )
