"""From n-gram occurrences to the smoothed, ranked next-word table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.ngrams import WORD
from wordloom.operators.counts import count_trigrams
from wordloom.operators.frequency import (
    frequency_cells,
    frequency_stats_wide,
    total_from_stats,
)
from wordloom.operators.lookup import lookup_broadcast, lookup_shuffled, stats_rows
from wordloom.operators.parse import parse_lines, split_corpus
from wordloom.operators.probability import probability, probability_from_rows
from wordloom.operators.ranking import (
    next_words,
    number_rows,
    number_rows_sliced,
    slice_cuts,
    sort_table,
)
from wordloom.plans.staging import MAX_BROADCAST_ROWS, free, new_path, stage
from wordloom.sources.documents import document_occurrences

# A pair with fewer than two slices of rows is numbered in one task.
MIN_SLICE_ROWS = 2_000_000
# Slices aimed at per table; twice as many cuts are the most that is broadcast.
MAX_SLICES = 32_768
# Rows looked at per slice when placing the cuts.
POINTS_PER_SLICE = 64


def counts_of_lines(lines: DataFrame, word: str = WORD) -> DataFrame:
    """``w1, w2, w3, r1, r2`` from n-gram lines; lazy."""
    return count_trigrams(split_corpus(parse_lines(lines, word)))


def counts_of_documents(docs: DataFrame) -> DataFrame:
    """``w1, w2, w3, r1, r2`` from running text; lazy."""
    return count_trigrams(split_corpus(document_occurrences(docs)))


@dataclass
class KnowledgeBase:
    """The table for one set of trigram counts (``w1, w2, w3, r1, r2``).

    The counts are the only large intermediate result and are read several times, so they
    are staged; so are the statistics, which are small as a rule but have their rows
    counted before anything is broadcast. :meth:`build` writes both; whatever needs them
    calls it, so asking for a table of this class counts the corpus once, before anything
    is shown of it. :meth:`free` deletes what was written, once the results are written too.
    """

    source: DataFrame
    max_broadcast_rows: int = MAX_BROADCAST_ROWS
    min_slice_rows: int = MIN_SLICE_ROWS
    max_slices: int = MAX_SLICES

    @cached_property
    def folder(self) -> str:
        return new_path(self.source.sparkSession, "knowledge_base")

    @cached_property
    def counts(self) -> DataFrame:
        return stage(self.source, "trigram_counts", below=self.folder)

    @cached_property
    def cells(self) -> DataFrame:
        """``r1, r2, trigrams``: what the statistics are made of, and the shuffled lookup."""
        return stage(frequency_cells(self.counts), "frequency_cells", below=self.folder)

    @cached_property
    def stats(self) -> DataFrame:
        return stage(frequency_stats_wide(self.cells), "nr_tr", below=self.folder)

    def build(self) -> KnowledgeBase:
        """Count the corpus and write counts and statistics, unless that is done."""
        self.sizes  # reads the statistics, which need the counts
        return self

    def free(self) -> None:
        free(self.source.sparkSession, self.folder)

    @cached_property
    def sizes(self) -> tuple[int, int]:
        """Rows of the statistics, number of trigrams: two numbers from the small table."""
        row = self.stats.agg(
            F.count("*").alias("rows"), F.coalesce(F.sum("nr1"), F.lit(0)).alias("trigrams")
        ).first()
        return row["rows"], row["trigrams"]

    @property
    def total(self) -> DataFrame:
        return total_from_stats(self.stats)

    @property
    def with_stats(self) -> DataFrame:
        """``w1, w2, w3, r1, r2, nr1, tr1, nr2, tr2``."""
        rows, trigrams = self.sizes
        if rows <= self.max_broadcast_rows:
            return lookup_broadcast(self.counts, self.stats)
        return lookup_shuffled(
            self.counts,
            self.cells,
            self.stats,
            trigrams,
            max(1, self.max_broadcast_rows),
        )

    @property
    def stats_rows(self) -> DataFrame:
        """``w1, w2, w3, part, nr, tr``."""
        return stats_rows(self.with_stats)

    @property
    def table(self) -> DataFrame:
        """``w1, w2, w3, p``, unordered."""
        return probability(self.with_stats, self.total)

    @cached_property
    def staged_table(self) -> DataFrame:
        return stage(self.table, "table", below=self.folder)

    @cached_property
    def staged_cuts(self) -> dict[int, DataFrame]:
        return {}

    def _cuts(self, table: DataFrame, slice_rows: int) -> DataFrame:
        if slice_rows not in self.staged_cuts:
            cuts = slice_cuts(table, slice_rows, POINTS_PER_SLICE)
            self.staged_cuts[slice_rows] = stage(cuts, f"slice_cuts_{slice_rows}", below=self.folder)
        return self.staged_cuts[slice_rows]

    @property
    def table_from_rows(self) -> DataFrame:
        """``w1, w2, w3, p`` by way of :attr:`stats_rows`."""
        return probability_from_rows(self.stats_rows, self.total)

    @property
    def sorted(self) -> DataFrame:
        return sort_table(self.table)

    @property
    def ranked(self) -> DataFrame:
        """``w1, w2, w3, p, pos`` in global order; see :meth:`ranked_by`."""
        return self.ranked_by()

    def ranked_by(self, **lead: Column) -> DataFrame:
        """``w1, w2, w3, p, pos`` in the order of ``lead``, then as the table is.

        ``lead`` are columns that depend on the pair only; they are kept before ``pos``. A pair holding many rows is cut into slices of at least ``min_slice_rows``, which
        tasks number independently. The number of cuts is checked before they are
        broadcast; should there be too many, the slices are made larger.
        """
        rows, trigrams = self.sizes
        slice_rows = max(self.min_slice_rows, -(-trigrams // self.max_slices))
        # Cuts, slice totals and the result read the table. With broadcast statistics that is a
        # scan of the counts; only what takes a shuffled join is written first.
        table = self.staged_table if rows > self.max_broadcast_rows else self.table
        placed = table.withColumns(lead) if lead else table
        while trigrams >= 2 * slice_rows:
            cuts = self._cuts(table, slice_rows)
            size = F.size("cuts")
            total, longest = cuts.agg(F.sum(size), F.max(size)).first()
            if total is None:
                break
            if total <= 2 * self.max_slices:
                return number_rows_sliced(placed, cuts, longest, tuple(lead))
            slice_rows *= 2
        return number_rows(placed, tuple(lead))

    def next_words(self, k: int) -> DataFrame:
        """The ``k`` most probable third words of every pair, in no particular order.

        Spark limits pairs before the shuffle only up to a threshold of its own; for more
        followers than that, the sliced numbering keeps large pairs out of one task.
        """
        threshold = self.source.sparkSession.conf.get(
            "spark.sql.optimizer.windowGroupLimitThreshold"
        )
        if k <= int(threshold):
            return next_words(self.table, k)
        return self.ranked.where(F.col("pos") <= k)
