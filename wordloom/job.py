"""The whole pipeline as one job:  INPUT and OUTPUT are the caller's paths.

    spark-submit build_kb.py INPUT OUTPUT --input-format sequence
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from wordloom.functions.ngrams import WORD
from wordloom.operators.counts import count_trigrams
from wordloom.operators.parse import check_lines, split_corpus
from wordloom.operators.stopwords import read_stop_words
from wordloom.plans.knowledge_base import KnowledgeBase, counts_of_documents, counts_of_lines
from wordloom.plans.next_words import write_knowledge_base
from wordloom.plans.staging import free, new_path, stage
from wordloom.plans.stop_list import remove_stop_words
from wordloom.sinks.text import key_value_lines, table_lines, write_lines
from wordloom.sources.documents import read_documents
from wordloom.sources.lines import READERS


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Build a next-word table from 3-gram counts.")
    parser.add_argument("input", help="n-gram lines, or documents(doc_id, text)")
    parser.add_argument("output", help="folder for the sorted table; must not exist")
    parser.add_argument("--input-format", choices=[*READERS, "documents"], default="sequence")
    parser.add_argument("--output-format", choices=["text", "parquet"], default="text")
    parser.add_argument("--word", help=f"regular expression of one word; default {WORD}")
    parser.add_argument("--rejects", help="folder for the lines that are not n-gram lines")
    parser.add_argument("--stop-words", help="text of words; trigrams with one are left out")
    parser.add_argument("--top", type=int, help="only so many third words of every pair")
    parser.add_argument("--lookup", help="folder for the table laid out for lookups of word pairs")
    parser.add_argument("--counts", help="folder for the trigram counts (Parquet)")
    parser.add_argument("--statistics", help="folder for the frequency statistics (Parquet)")
    args = parser.parse_args(argv)
    if args.input_format == "documents" and (args.word or args.rejects):
        parser.error("--word and --rejects are about n-gram lines, not documents")
    if args.top is not None and args.top < 1:
        parser.error("--top has to be 1 or more")
    return args


def counted(
    spark: SparkSession, args: argparse.Namespace, folder: str
) -> tuple[DataFrame, dict[str, int]]:
    """Trigram counts; with ``--rejects`` also the rejected lines' files and a report.

    Rejects, report and counts come from one pass over the input: it is checked once, and
    written by whether a line was kept. The report counts rows of what was written, which
    Parquet knows.
    """
    if args.input_format == "documents":
        return counts_of_documents(read_documents(spark, args.input)), {}
    lines, word = READERS[args.input_format](spark, args.input), args.word or WORD
    if not args.rejects:
        return counts_of_lines(lines, word), {}
    checked = stage(check_lines(lines, word), "checked", by="ok", below=folder)
    kept, rejected = checked.where("ok"), checked.where("not ok")
    write_lines(rejected.select("line").where("line is not null"), args.rejects)
    report = {"kept": kept.count(), "rejected": rejected.count()}
    return count_trigrams(split_corpus(kept)), report


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """Write the table; with ``--rejects`` also return how many lines were kept and rejected."""
    folder = new_path(spark, "job")
    counts, report = counted(spark, args, folder)
    if args.stop_words:
        counts = remove_stop_words(counts, read_stop_words(spark, args.stop_words), below=folder)
    kb = KnowledgeBase(counts).build()
    if args.counts:
        kb.counts.write.parquet(args.counts)
    if args.statistics:
        kb.stats.write.parquet(args.statistics)
    if args.lookup:
        write_knowledge_base(kb, args.lookup)
    if args.top:
        table = kb.next_words(args.top).orderBy("w1", "w2", "pos")
        lines = key_value_lines(table, ["w1", "w2", "w3"], ["p", "pos"])
    else:
        table = kb.sorted
        lines = table_lines(table)
    if args.output_format == "text":
        write_lines(lines, args.output)
    else:
        table.write.parquet(args.output)
    kb.free()
    free(spark, folder)
    return report


def main(argv: list[str] | None = None) -> None:
    spark = SparkSession.builder.appName("build_kb").getOrCreate()
    for name, value in run(spark, arguments(argv)).items():
        print(f"{name} lines: {value}")


if __name__ == "__main__":
    main()
