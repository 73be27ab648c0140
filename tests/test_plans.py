"""What Spark is asked to do: shuffles, pruning, broadcast, map-side limits."""

import re

import pytest

import __spark_entry__ as contract
from wordloom.plans.knowledge_base import KnowledgeBase, counts_of_documents
from wordloom.sources.documents import read_documents

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark):
    return read_documents(spark, f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def kb(docs):
    return KnowledgeBase(counts_of_documents(docs))


def test_scan_reads_two_columns(docs):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(counts_of_documents(docs))


def test_counting_sums_before_its_only_shuffle_by_key(docs):
    text = plan(counts_of_documents(docs))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text
    assert "Python" not in text


def test_table_moves_no_trigram(kb):
    text = plan(kb.table)
    assert text.count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_small_bounds_take_the_plans_for_large_tables(docs):
    source = counts_of_documents(docs)
    shuffled = KnowledgeBase(source, max_broadcast_rows=contract.FEW_BROADCAST_ROWS)
    text = plan(shuffled.stats_rows)
    assert "hashpartitioning" in text and shuffled.sizes[0] > contract.FEW_BROADCAST_ROWS
    sliced = KnowledgeBase(source, min_slice_rows=contract.SMALL_SLICE)
    assert "cuts" in sliced.ranked._jdf.queryExecution().analyzed().toString()
    many = KnowledgeBase(source)
    assert "WindowGroupLimit" not in plan(many.next_words(contract.MANY))
    assert "WindowGroupLimit" in plan(many.next_words(contract.TOP_K))


def test_lines_lose_no_trigram(spark):
    lines = contract.queries()["kb_from_lines"](spark, SF)
    table = contract.queries()["kb_sorted"](spark, SF)
    assert lines.count() == table.count()
    assert lines.exceptAll(table).isEmpty()


def test_ranking_takes_one_shuffle(kb):
    text = plan(kb.ranked)
    assert len(re.findall(r"Exchange rangepartitioning\(w1#\d+ ASC NULLS FIRST, w2#\d+ ASC NULLS FIRST, ", text)) == 1
    assert "hashpartitioning" not in text


def test_slicing_copies_no_array_and_keeps_one_shuffle(kb):
    from wordloom.operators.ranking import number_rows_sliced, slice_cuts

    cuts = slice_cuts(kb.table, 50, 50).cache()
    text = plan(number_rows_sliced(kb.table, cuts, 20))
    window = text.index("row_number()")
    assert "Exchange rangepartitioning" in text[window:]
    assert text.count("rangepartitioning") == 1
    assert "lambda" not in text[: text.index("Exchange rangepartitioning")]


def test_next_words_limits_before_the_shuffle(kb):
    text = plan(kb.next_words(3))
    shuffle = text.index("Exchange hashpartitioning(w1")
    assert "WindowGroupLimit" in text[shuffle:]


def test_many_next_words_use_the_sliced_numbering(kb):
    assert "WindowGroupLimit" in plan(kb.next_words(1000))
    many = kb.next_words(1001)
    assert "rangepartitioning" in plan(many) and "WindowGroupLimit" not in plan(many)
    assert many.count() == kb.table.count()


def test_every_query_has_columns_and_sql(spark):
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries)
    optional = set(contract._optional_queries())
    assert set(queries) - set(sql) <= optional


def test_trigrams_are_cut_without_a_regular_expression(docs):
    text = counts_of_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "substring_index(" in text and "split(" not in text
