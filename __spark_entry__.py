"""

Every query reads the whole ``documents`` table. Its texts are cut into trigrams, or
rendered as n-gram lines first where a query is about lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.counts import corpus_total
from wordloom.operators.frequency import (
    frequency_cells,
    frequency_stats,
    frequency_stats_wide,
    step_union,
    unpivot_counts,
)
from wordloom.operators.parse import (
    parse_lines,
    parse_report,
    rejected_lines,
    split_corpus,
    split_words,
)
from wordloom.operators.probability import WORDS
from wordloom.plans.knowledge_base import KnowledgeBase, counts_of_documents, counts_of_lines
from wordloom.plans.next_words import write_knowledge_base
from wordloom.plans.staging import drop_shuffles, new_path
from wordloom.plans.stop_list import count_without_stop_words
from wordloom.sinks.sequence import write_sequence_lines
from wordloom.sinks.text import (
    COUNT_FIELDS,
    FAST_GZIP,
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
from wordloom.sources.documents import (
    document_lines,
    document_occurrences,
    document_trigrams,
    line_sources,
    read_documents,
    source_lines,
)
from wordloom.sources.lines import read_sequence_lines, read_text_lines

try:  # the training-data operators are optional: a copy without their files still works
    import corpus_pipeline
    from wordloom.llm import queries as llm_queries
except ImportError as missing:
    if not (missing.name or "").startswith(("corpus_pipeline", "wordloom.llm")):
        raise
    corpus_pipeline = llm_queries = None

# Common English function words for the stop-word query.
STOP_WORDS = [
    "a", "about", "after", "all", "also", "an", "and", "any", "are", "as", "at", "be",
    "been", "but", "by", "can", "could", "did", "do", "for", "from", "had", "has", "have",
    "he", "her", "him", "his", "how", "i", "if", "in", "into", "is", "it", "its", "me",
    "more", "my", "no", "not", "of", "on", "or", "our", "out", "she", "so", "some", "than",
    "that", "the", "their", "them", "then", "there", "these", "they", "this", "to", "up",
    "was", "we", "were", "what", "when", "which", "who", "will", "with", "would", "you",
    "your",
]
TOP_K = 3
# More than Spark limits per group before a shuffle (1,000).
MANY = 2000
# Every tenth document keeps its spelling where rejecting lines is the point.
SPELLED_EVERY = 10
TEXT_FILES = 16
# Bounds so small that the plans for large tables are taken at any scale.
FEW_BROADCAST_ROWS, SMALL_SLICE = 5, 20


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-gram lines of all documents, all of which the line pattern keeps."""
    return document_lines(_docs(spark, sf_dir))


def _spelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with some in lower and mixed case, for the queries about rejecting lines."""
    return document_lines(_docs(spark, sf_dir), SPELLED_EVERY)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_of_documents(_docs(spark, sf_dir))


def _kb(spark: SparkSession, sf_dir: str) -> KnowledgeBase:
    return KnowledgeBase(_counts(spark, sf_dir))


def _sequence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sequence_lines")
    write_sequence_lines(_spelled_lines(spark, sf_dir), path)
    return read_sequence_lines(spark, path)


def _text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their byte offsets, from text files with the lines in a fixed order, so that
    offsets can be worked out from the lengths of the lines before. What is dealt to the files and
    sorted are the texts; their lines are made in order where they are written."""
    path = new_path(spark, "text_lines")
    drop_shuffles(spark)
    sources = line_sources(_docs(spark, sf_dir)).withColumn("file", F.pmod("line_id", F.lit(TEXT_FILES)))
    sources = sources.repartitionById(TEXT_FILES, F.col("file").cast("int"))  # a task for every file
    sources = sources.sortWithinPartitions("file", "line_id", "line")
    source_lines(sources, "file").write.partitionBy("file").options(**FAST_GZIP).text(path)
    return read_text_lines(spark, f"{path}/*")


def _kb_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "kb_text")
    drop_shuffles(spark)
    kb = _kb(spark, sf_dir)
    write_lines(table_lines(kb.sorted), path, **FAST_GZIP)
    kb.free()  # all that is left to read is the text
    return parse_fields(read_text(spark, path), TABLE_FIELDS)


def _mixed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of different shapes in one text folder, told apart by field count: counts,
    probabilities, and two that are neither (three and six fields)."""
    path = new_path(spark, "steps_text")
    drop_shuffles(spark)
    kb = _kb(spark, sf_dir)
    counts = key_value_lines(kb.counts, WORDS, ["r1", "r2"])
    table = table_lines(kb.table)
    words = kb.counts.select(F.concat_ws(" ", *WORDS).alias("line"))
    wide = key_value_lines(kb.counts, [*WORDS, "r1"], ["r2", "r1"])
    write_lines(counts.unionByName(table).unionByName(words).unionByName(wide), path, **FAST_GZIP)
    kb.free()  # all that is left to read is the text
    return read_text(spark, path)


def _text_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _mixed_text(spark, sf_dir)
    counts = parse_fields(text, COUNT_FIELDS).select(F.lit("counts").alias("kind"), "*")
    table = parse_fields(text, TABLE_FIELDS).select(F.lit("table").alias("kind"), "*")
    other = other_lines(text, 4, 5).select(F.lit("other").alias("kind"), "line")
    return counts.unionByName(table, True).unionByName(other, True)


def _named_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "named_lines")
    write_named(tag_lines(_spelled_lines(spark, sf_dir)), path)
    kept, rejected = (read_named(spark, path, name) for name in ("kept", "rejected"))
    return kept.select(F.lit("kept").alias("output"), "line").unionByName(
        rejected.select(F.lit("rejected").alias("output"), "line")
    )


def _nr_tr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency_stats(frequency_cells(_counts(spark, sf_dir)))


def _step_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _kb(spark, sf_dir).counts
    return step_union(counts, frequency_stats(frequency_cells(counts)))


def _without_stop_words(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    words = spark.createDataFrame([(w,) for w in STOP_WORDS], "word STRING")
    return count_without_stop_words(_docs(spark, sf_dir), words, **options)


def _next_word_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows the last two words of each document, wherever else they stand."""
    table = write_knowledge_base(_kb(spark, sf_dir), new_path(spark, "next_words"))
    # Read from the end, a text gives its last two words without a look at the rest.
    last = r"\A[^A-Za-z]*+([A-Za-z]++)[^A-Za-z]++([A-Za-z]++)"
    first, second = (F.upper(F.reverse(F.regexp_extract(F.reverse("text"), last, i))) for i in (2, 1))
    ends = _docs(spark, sf_dir).select(first.alias("w1"), second.alias("w2")).where("w2 <> ''")
    return table.lookup(ends, TOP_K)


def entry(spark: SparkSession) -> DataFrame:
    """Which third word follows any two words, most probable first."""
    return _kb(spark, "/root/testdata/sf0.001").ranked


def _optional_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return {}
    return llm_queries.queries() | {"pipeline": corpus_pipeline.run}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _optional_queries() | {
        # Text and lines
        "doc_trigrams": lambda s, d: split_words(document_trigrams(_docs(s, d))),
        "ngram_lines": _spelled_lines,
        "text_scan": _text_scan,
        "sequence_scan": _sequence_scan,
        "ngram_parse": lambda s, d: split_words(parse_lines(_spelled_lines(s, d))),
        "ngram_rejects": lambda s, d: rejected_lines(_spelled_lines(s, d)),
        "ngram_parse_report": lambda s, d: parse_report(_spelled_lines(s, d)),
        "named_outputs": _named_outputs,
        "corpus_split": lambda s, d: split_words(split_corpus(parse_lines(_lines(s, d)))),
        # Counts and statistics
        "trigram_counts": _counts,
        "corpus_total": lambda s, d: corpus_total(document_occurrences(_docs(s, d))),
        "counts_unpivot": lambda s, d: unpivot_counts(_counts(s, d)),
        "nr_tr": _nr_tr,
        "nr_tr_wide": lambda s, d: frequency_stats_wide(frequency_cells(_counts(s, d))),
        "step_union": _step_union,
        "trigram_nrtr": lambda s, d: _kb(s, d).stats_rows,
        "trigram_nrtr_wide": lambda s, d: _kb(s, d).with_stats,
        "trigram_nrtr_shuffled": lambda s, d: KnowledgeBase(
            _counts(s, d), max_broadcast_rows=FEW_BROADCAST_ROWS
        ).stats_rows,
        # Probabilities and order
        "trigram_probability": lambda s, d: _kb(s, d).table,
        "trigram_probability_long": lambda s, d: _kb(s, d).table_from_rows,
        "kb_sorted": lambda s, d: _kb(s, d).ranked,
        "kb_sorted_sliced": lambda s, d: KnowledgeBase(
            _counts(s, d), min_slice_rows=SMALL_SLICE
        ).ranked,
        "kb_table_sorted": lambda s, d: _kb(s, d).sorted,
        "kb_from_lines": lambda s, d: KnowledgeBase(counts_of_lines(_lines(s, d))).ranked,
        "next_word_topk": lambda s, d: _kb(s, d).next_words(TOP_K),
        "next_word_many": lambda s, d: _kb(s, d).next_words(MANY),
        "next_word_lookup": _next_word_lookup,
        "trigrams_without_stopwords": _without_stop_words,
        "trigrams_without_stopwords_long": lambda s, d: _without_stop_words(
            s, d, max_rows=FEW_BROADCAST_ROWS
        ),
        # Text out and in
        "kb_export_lines": lambda s, d: table_lines(_kb(s, d).sorted),
        "kb_import": _kb_import,
        "text_arity": _text_arity,
    }


# The SQL is built from named steps; each query lists the ones it needs.
_STEPS = {
    "tok": """
        SELECT doc_id, regexp_extract_all(text, '[A-Za-z]+') AS t FROM documents""",
    "word3": """
        SELECT doc_id, t[i] AS a, t[i + 1] AS b, t[i + 2] AS c
        FROM (SELECT doc_id, t, unnest(range(1, len(t) - 1)) AS i FROM tok)""",
    "tri": """
        SELECT doc_id, upper(a) AS w1, upper(b) AS w2, upper(c) AS w3 FROM word3""",
    "lines": """
        SELECT doc_id AS line_id,
               g || chr(9) || '2000' || chr(9) || CAST(count(*) AS VARCHAR)
                 || chr(9) || '1' || chr(9) || '1' AS line
        FROM (SELECT doc_id,
                     CASE WHEN doc_id % 10 = 0 THEN a || ' ' || b || ' ' || c
                          ELSE upper(a || ' ' || b || ' ' || c) END AS g
              FROM word3)
        GROUP BY doc_id, g""",
    "upper_lines": """
        SELECT doc_id AS line_id,
               g || chr(9) || '2000' || chr(9) || CAST(count(*) AS VARCHAR)
                 || chr(9) || '1' || chr(9) || '1' AS line
        FROM (SELECT doc_id, upper(a || ' ' || b || ' ' || c) AS g FROM word3)
        GROUP BY doc_id, g""",
    "checked": r"""
        SELECT line_id, line,
               regexp_full_match(line, '[A-Z]+ [A-Z]+ [A-Z]+\t[0-9]{4}\t[0-9]+.*') AS ok
        FROM {lines}""",
    "parsed": r"""
        SELECT line_id,
               regexp_extract(line, '^([A-Z]+) ([A-Z]+) ([A-Z]+)\t', 1) AS w1,
               regexp_extract(line, '^([A-Z]+) ([A-Z]+) ([A-Z]+)\t', 2) AS w2,
               regexp_extract(line, '^([A-Z]+) ([A-Z]+) ([A-Z]+)\t', 3) AS w3,
               CAST(regexp_extract(line, '\t[0-9]{4}\t([0-9]+)', 1) AS BIGINT) AS occurrences
        FROM checked WHERE ok""",
    "split": """
        SELECT w1, w2, w3, CASE WHEN line_id % 2 = 0 THEN 1 ELSE 2 END AS part, occurrences
        FROM parsed""",
    "doc_split": """
        SELECT w1, w2, w3, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END AS part,
               CAST(1 AS BIGINT) AS occurrences
        FROM tri""",
    "counts": """
        SELECT w1, w2, w3,
               CAST(sum(CASE WHEN part = 1 THEN occurrences ELSE 0 END) AS BIGINT) AS r1,
               CAST(sum(CASE WHEN part = 2 THEN occurrences ELSE 0 END) AS BIGINT) AS r2
        FROM {split} GROUP BY w1, w2, w3""",
    "total": "SELECT CAST(sum(r1 + r2) AS BIGINT) AS n FROM counts",
    "unpivoted": """
        SELECT r1 AS r, 1 AS part, r2 AS other FROM counts
        UNION ALL SELECT r2 AS r, 2 AS part, r1 AS other FROM counts""",
    "nr_tr": """
        SELECT r, part, count(*) AS nr, CAST(sum(other) AS BIGINT) AS tr
        FROM unpivoted GROUP BY r, part""",
    "nrtr": """
        SELECT w1, w2, w3, part, coalesce(nr, 0) AS nr, coalesce(tr, 0) AS tr
        FROM (SELECT w1, w2, w3, r1 AS r, 1 AS part FROM counts
              UNION ALL SELECT w1, w2, w3, r2 AS r, 2 AS part FROM counts)
        LEFT JOIN nr_tr USING (r, part)""",
    "wide": """
        SELECT w1, w2, w3, r1, r2,
               coalesce(a.nr, 0) AS nr1, coalesce(a.tr, 0) AS tr1,
               coalesce(b.nr, 0) AS nr2, coalesce(b.tr, 0) AS tr2
        FROM counts
        LEFT JOIN nr_tr a ON a.r = r1 AND a.part = 1
        LEFT JOIN nr_tr b ON b.r = r2 AND b.part = 2""",
    "prob": """
        SELECT w1, w2, w3,
               CAST(tr1 + tr2 AS DOUBLE)
                 / (CAST((SELECT n FROM total) AS DOUBLE) * CAST(nr1 + nr2 AS DOUBLE)) AS p
        FROM wide""",
    # A double as Java prints it: digits with a point from 1e-3 on, d.dddE-n below.
    "printed": r"""
        SELECT w1, w2, w3,
               CASE WHEN p IS NULL OR isnan(p) THEN 'NaN'
                    WHEN p = 0 OR p >= 1e-3 THEN s
                    ELSE left(digits, 1) || '.'
                      || CASE WHEN length(digits) > 1 THEN substr(digits, 2) ELSE '0' END
                      || 'E' || CAST(exponent AS VARCHAR) END AS t
        FROM (SELECT *,
                     CASE WHEN contains(s, 'e') THEN replace(split_part(s, 'e', 1), '.', '')
                          ELSE regexp_replace(s, '^0\.0*', '') END AS digits,
                     CASE WHEN contains(s, 'e') THEN CAST(split_part(s, 'e', 2) AS INTEGER)
                          ELSE 1 - length(regexp_extract(s, '^0\.0*')) END AS exponent
              FROM (SELECT w1, w2, w3, p, CAST(p AS VARCHAR) AS s FROM prob))""",
    "kb": """
        SELECT w1, w2, w3, p,
               row_number() OVER (PARTITION BY w1, w2 ORDER BY p DESC, w3) AS pos
        FROM prob""",
}
_LINES = ["tok", "word3", "lines"]
_PARSED = [*_LINES, "checked", "parsed"]
_UPPER = ["tok", "word3", "upper_lines"]
_UPPER_PARSED = [*_UPPER, "checked", "parsed"]
_COUNTS = ["tok", "word3", "tri", "doc_split", "counts"]
_NR_TR = [*_COUNTS, "unpivoted", "nr_tr"]
_WIDE = [*_NR_TR, "wide"]
_PROB = [*_WIDE, "total", "prob"]


def _sql(steps: list[str], select: str) -> str:
    names = {
        "{split}": "split" if "split" in steps else "doc_split",
        "{lines}": "upper_lines" if "upper_lines" in steps else "lines",
    }
    ctes = ",\n".join(f"{s} AS ({_STEPS[s]})" for s in steps)
    for name, step in names.items():
        ctes = ctes.replace(name, step)
    return f"WITH {ctes}\n{select}"


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query."""
    stop = ", ".join(f"'{w.upper()}'" for w in STOP_WORDS)
    optional = llm_queries.oracle_sql() if llm_queries else {}
    without_stop = _sql(
        _COUNTS,
        "SELECT w1, w2, w3, r1, r2 FROM counts "
        f"WHERE w1 NOT IN ({stop}) AND w2 NOT IN ({stop}) AND w3 NOT IN ({stop})",
    )
    line_kb = [*_UPPER_PARSED, "split", "counts", "unpivoted", "nr_tr", "wide", "total", "prob", "kb"]
    return optional | {
        "doc_trigrams": _sql(["tok", "word3", "tri"], "SELECT doc_id, w1, w2, w3 FROM tri"),
        "ngram_lines": _sql(_LINES, "SELECT line_id, line FROM lines"),
        "sequence_scan": _sql(_LINES, "SELECT line_id, line FROM lines"),
        "ngram_parse": _sql(_PARSED, "SELECT line_id, w1, w2, w3, occurrences FROM parsed"),
        "ngram_rejects": _sql(
            [*_LINES, "checked"], "SELECT line_id, line FROM checked WHERE NOT ok"
        ),
        "ngram_parse_report": _sql(
            [*_LINES, "checked"],
            "SELECT count(*) FILTER (WHERE ok) AS kept, "
            "count(*) FILTER (WHERE NOT ok) AS rejected FROM checked",
        ),
        "named_outputs": _sql(
            [*_LINES, "checked"],
            "SELECT CASE WHEN ok THEN 'kept' ELSE 'rejected' END AS output, line FROM checked",
        ),
        "text_scan": _sql(
            _UPPER,
            "SELECT CAST(coalesce(sum(octet_length(encode(line)) + 1) OVER (PARTITION BY line_id % "
            f"{TEXT_FILES} ORDER BY line_id, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
            "0) AS BIGINT) AS line_id, line FROM upper_lines",
        ),
        "corpus_split": _sql(
            [*_UPPER_PARSED, "split"], "SELECT w1, w2, w3, part, occurrences FROM split"
        ),
        "trigram_counts": _sql(_COUNTS, "SELECT w1, w2, w3, r1, r2 FROM counts"),
        "corpus_total": _sql([*_COUNTS, "total"], "SELECT n FROM total"),
        "counts_unpivot": _sql([*_COUNTS, "unpivoted"], "SELECT r, part, other FROM unpivoted"),
        "nr_tr": _sql(_NR_TR, "SELECT r, part, nr, tr FROM nr_tr"),
        "nr_tr_wide": _sql(
            _NR_TR,
            "SELECT r, CAST(coalesce(sum(nr) FILTER (WHERE part = 1), 0) AS BIGINT) AS nr1, "
            "CAST(coalesce(sum(tr) FILTER (WHERE part = 1), 0) AS BIGINT) AS tr1, "
            "CAST(coalesce(sum(nr) FILTER (WHERE part = 2), 0) AS BIGINT) AS nr2, "
            "CAST(coalesce(sum(tr) FILTER (WHERE part = 2), 0) AS BIGINT) AS tr2 "
            "FROM nr_tr GROUP BY r",
        ),
        "step_union": _sql(
            _NR_TR,
            "SELECT 'counts' AS src, w1, w2, w3, r1, r2, CAST(NULL AS BIGINT) AS r, "
            "CAST(NULL AS INTEGER) AS part, CAST(NULL AS BIGINT) AS nr, "
            "CAST(NULL AS BIGINT) AS tr FROM counts "
            "UNION ALL SELECT 'nr_tr', NULL, NULL, NULL, NULL, NULL, r, part, nr, tr FROM nr_tr",
        ),
        "trigram_nrtr": _sql([*_NR_TR, "nrtr"], "SELECT w1, w2, w3, part, nr, tr FROM nrtr"),
        "trigram_nrtr_wide": _sql(
            _WIDE, "SELECT w1, w2, w3, r1, r2, nr1, tr1, nr2, tr2 FROM wide"
        ),
        "trigram_probability": _sql(_PROB, "SELECT w1, w2, w3, p FROM prob"),
        "trigram_probability_long": _sql(
            [*_NR_TR, "nrtr", "total"],
            "SELECT w1, w2, w3, CAST(sum(tr) AS DOUBLE) / (CAST((SELECT n FROM total) AS DOUBLE) "
            "* CAST(sum(nr) AS DOUBLE)) AS p FROM nrtr GROUP BY w1, w2, w3",
        ),
        "trigram_nrtr_shuffled": _sql(
            [*_NR_TR, "nrtr"], "SELECT w1, w2, w3, part, nr, tr FROM nrtr"
        ),
        "kb_sorted": _sql([*_PROB, "kb"], "SELECT w1, w2, w3, p, pos FROM kb"),
        "kb_sorted_sliced": _sql([*_PROB, "kb"], "SELECT w1, w2, w3, p, pos FROM kb"),
        "kb_table_sorted": _sql(_PROB, "SELECT w1, w2, w3, p FROM prob"),
        "kb_from_lines": _sql(line_kb, "SELECT w1, w2, w3, p, pos FROM kb"),
        "next_word_topk": _sql(
            [*_PROB, "kb"], f"SELECT w1, w2, w3, p, pos FROM kb WHERE pos <= {TOP_K}"
        ),
        "next_word_many": _sql(
            [*_PROB, "kb"], f"SELECT w1, w2, w3, p, pos FROM kb WHERE pos <= {MANY}"
        ),
        "next_word_lookup": _sql(
            [*_PROB, "kb"],
            "SELECT w1, w2, w3, p, pos FROM kb "
            f"WHERE pos <= {TOP_K} AND (w1, w2) IN (SELECT (upper(t[-2]), upper(t[-1])) FROM tok WHERE len(t) > 1)",
        ),
        "trigrams_without_stopwords": without_stop,
        "trigrams_without_stopwords_long": without_stop,
        "kb_import": _sql(_PROB, "SELECT w1, w2, w3, p FROM prob"),
        "kb_export_lines": _sql(
            [*_PROB, "printed"], "SELECT w1 || ' ' || w2 || ' ' || w3 || chr(9) || t AS line FROM printed"
        ),
        "text_arity": _sql(
            _PROB,
            "SELECT 'counts' AS kind, w1, w2, w3, r1, r2, CAST(NULL AS DOUBLE) AS p, "
            "CAST(NULL AS VARCHAR) AS line FROM counts "
            "UNION ALL SELECT 'table', w1, w2, w3, NULL, NULL, p, NULL FROM prob "
            "UNION ALL SELECT 'other', NULL, NULL, NULL, NULL, NULL, NULL, "
            "w1 || ' ' || w2 || ' ' || w3 FROM counts "
            "UNION ALL SELECT 'other', NULL, NULL, NULL, NULL, NULL, NULL, w1 || ' ' || w2 || ' ' "
            "|| w3 || ' ' || r1 || chr(9) || r2 || ' ' || r1 FROM counts",
        ),
    }
