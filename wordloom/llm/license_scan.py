"""License scans by diagonal voting, with DataFrame operations only.

Texts are words (runs of letters and digits after lower-casing A-Z; every character beyond ASCII
counts as a letter). Templates are short phrases and longer notices, cut into words by the same
columns. Every run of ``k`` words of a text is hashed and joined with the runs of the templates;
a template of fewer than ``WORDS`` words is one run of its own length, so the lengths rolled are
those that templates have. Hits of equal hashes are compared word by word.

A hit at word ``at`` of the text and word ``t`` of the template votes for the diagonal ``at - t``.
Votes are bits by template position, 64 to a row, so they merge in every map task and a repeated
row votes once. Neighbouring diagonals (up to ``GAP`` words apart: a few words put in or left
out) are merged. A span is verified by its length, at most ``1 + SLACK`` times the template's, and
by the share of the template's runs that it holds: ``LEAST``, or all of them if the notice has
fewer than ``LONG`` words, as one word (a version) tells such notices apart. A single diagonal
within a span may do better alone. Phrases of the base list are not merged: a place counts where one diagonal has them all.

Only hits and one row per document leave the task that reads the text. They are staged, so a text
is cut once. The templates are parameters; they are broadcast if they have at most ``MAX_RUNS``
runs, else joined as they are.

Defined results: a null text is empty; a text without words, and an empty table, have no hits; a
repeated row (same id and text) is returned as often as it occurs; a null id stays null; columns
other than ``doc_id`` and ``text`` are not used; overlapping places all count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm.common import documents, prepare, stage

WORDS = 4
GAP = 3
SLACK = 0.5
LEAST = 0.6
LONG = 14
MAX_RUNS = 1_000_000
BITS = 64
KEY = ["doc_id", "h1", "h2"]

# Phrases of the base list, and opening notices of common licenses.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license": "apache-2.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu "
    "lesser general public license as published by the free software foundation": "lgpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction": "mit",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all "
    "copies": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


@dataclass(frozen=True)
class Template:
    text: str
    label: str
    base: bool = False


TEMPLATES = [
    *[Template(text, label, True) for text, label in PHRASES.items()],
    *[Template(text, label) for text, label in NOTICES.items()],
]


def words_of(text: str = "text") -> Column:
    """The words of a text column; none for null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def run_hash(k: int) -> Column:
    """Hash of the ``k`` words from ``at`` on; null where there are fewer."""
    run = [F.get("words", F.col("at") + i) for i in range(k)]
    return F.when(F.col("at") + k <= F.size("words"), F.xxhash64(F.lit(k), *run))


def template_table(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """``template, label, base, n_words, k, runs, words``: one row per template."""
    rows = [
        F.struct(F.lit(i).alias("template"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(t.text).alias("text"))
        for i, t in enumerate(templates)
    ]
    table = spark.range(1).select(F.inline(F.array(*rows))).withColumn("words", words_of()).drop("text")
    size = F.size("words")
    k = F.least(size, F.lit(WORDS))
    return table.where(size > 0).select(
        "*", size.alias("n_words"), k.alias("k"), (size - k + 1).alias("runs")
    )


def template_runs(table: DataFrame, lengths: list[int]) -> DataFrame:
    """``run, template, t, run_words``: all runs of the templates, and the mark of a text's end."""
    each = table.select("*", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("at"))
    run = F.coalesce(*[F.when(F.col("k") == k, run_hash(k)) for k in lengths])
    runs = each.select(
        run.alias("run"), "template", F.col("at").alias("t"), F.slice("words", F.col("at") + 1, F.col("k")).alias("run_words")
    )
    end = table.sparkSession.range(1).select(
        end_mark().alias("run"), F.lit(-1).alias("template"), F.lit(0).alias("t"), F.array().cast("array<string>").alias("run_words")
    )
    return runs.unionByName(end)


def end_mark() -> Column:
    return F.xxhash64(F.lit(0))


def hits(docs: DataFrame, runs: DataFrame, lengths: list[int]) -> DataFrame:
    """``doc_id, h1, h2, template, at, t, k``; a text's end is a hit of template -1 at its length.

    ``h1, h2`` stand for the text, so that texts under one id stay apart.
    """
    texts = documents(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), words_of().alias("words")
    )
    each = texts.select("*", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("at"))
    first, *others = [run_hash(k) for k in lengths]
    first = F.when(F.col("at") == F.size("words"), end_mark()).otherwise(first)
    each = each.select("*", F.explode(F.array(first, *others)).alias("run")).where("run is not null")
    same = F.slice("words", F.col("at") + 1, F.size("run_words")) == F.col("run_words")
    found = each.join(runs, "run").where(same)
    return found.select(*KEY, "template", "at", "t", F.size("run_words").alias("k"))


def spans(found: DataFrame, table: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, label, base, lo, share, enough``: merged diagonals with the share of the
    template's runs that each holds, and if that is enough to name it."""
    own = [*KEY, "template"]
    bit = F.expr(f"shiftleft(1L, t % {BITS})")
    cells = found.where("template >= 0").groupBy(
        *own, (F.col("at") - F.col("t")).alias("diagonal"), F.floor(F.col("t") / BITS).alias("block")
    ).agg(F.bit_or(bit).alias("bits"), F.min("at").alias("lo"), F.max(F.col("at") + F.col("k")).alias("hi"))
    facts = table.select("template", "label", "base", "n_words", "runs")
    cells = cells.join(F.broadcast(facts), "template")
    order = Window.partitionBy(*own).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order)
    gap = F.when(F.col("base") | (F.col("runs") == 1), 0).otherwise(GAP)
    cells = cells.withColumn("new", F.when(apart > gap, 1).otherwise(0))
    cells = cells.withColumn("island", F.sum("new").over(order))
    kept = ["label", "base", "n_words", "runs"]
    alone = F.sum(F.bit_count("bits")).over(Window.partitionBy(*own, "island", "diagonal"))
    blocks = cells.withColumn("alone", alone).groupBy(*own, *kept, "island", "block").agg(
        F.bit_or("bits").alias("bits"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("alone").alias("alone")
    )
    islands = blocks.groupBy(*own, *kept, "island").agg(
        F.sum(F.bit_count("bits")).alias("together"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("alone").alias("alone")
    )
    fits = F.col("hi") - F.col("lo") <= (1 + SLACK) * F.col("n_words")
    votes = F.greatest("alone", F.when(fits, F.col("together")).otherwise(0))
    share = votes / F.col("runs")
    enough = F.when(F.col("base") | (F.col("n_words") < LONG), share == 1).otherwise(share >= LEAST)
    return islands.select(*KEY, "label", "base", "lo", share.alias("share"), enough.alias("enough"))


def scan_licenses(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``. ``n_base`` counts the places of base phrases; ``score`` is the largest share."""
    spark = docs.sparkSession
    prepare(spark)
    table = template_table(spark, templates)
    lengths = [row["k"] for row in table.select("k").distinct().orderBy("k").collect()]
    runs = template_runs(table, lengths or [1])
    if sum(len(t.text) for t in templates) <= MAX_RUNS:  # a run has a character at least
        runs = F.broadcast(runs)
    found = stage(hits(docs, runs, lengths or [1]), "license_hits")
    place = F.col("base") & F.col("enough")

    def joined(label: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    per_text = spans(found, table).groupBy(*KEY).agg(
        F.count_if(place).alias("n_base"),
        F.min(F.when(place, F.col("lo"))).alias("first_word"),
        F.max(F.when(place, F.col("lo"))).alias("last_word"),
        joined(F.when(place, F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("enough"), F.col("label"))).alias("labels"),
        F.max("share").alias("score"),
    )
    ends = found.where("template = -1").select(*KEY, F.col("at").cast("long").alias("n_words"))
    same = [ends[c].eqNullSafe(per_text[c]) for c in KEY]
    return ends.join(per_text, same, "left").select(
        ends["doc_id"],
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op12_license_scan(spark, sf_dir) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
