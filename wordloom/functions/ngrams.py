"""Expressions on n-gram lines, running text and frequency statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The n-gram line format.
# A line is  W1 W2 W3 <tab> year <tab> occurrences <tab> pages <tab> books
WORD = "[A-Z]+"
YEAR = r"\d{4}"
OCCURRENCES = r"\d+"


def line_pattern(word: str = WORD) -> str:
    """Regular expression that a whole n-gram line has to match.

    Group 1 is the three words, the last group the count; ``word`` may be any expression that
    matches no blank, without named groups and back references, since it stands there three
    times. ``\\A`` and ``\\z`` are used because ``$`` would let a trailing line break
    pass.
    """
    own = f"(?:{word})"
    return rf"\A({own} {own} {own})\t{YEAR}\t({OCCURRENCES}).*\z"


def capture_groups(pattern: str) -> int:
    """Number of groups of a pattern that capture."""
    groups, in_class, at = 0, False, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            if pattern[at + 1 : at + 2] == "Q":  # quoted up to \E
                end = pattern.find("\\E", at)
                at = len(pattern) if end < 0 else end
            at += 1
        elif c == "[":
            in_class = True
        elif c == "]":
            in_class = False
        elif c == "(" and not in_class:
            named = pattern.startswith("(?<", at) and pattern[at + 3 : at + 4] not in ("=", "!")
            groups += named or pattern[at + 1 : at + 2] != "?"
        at += 1
    return groups


def is_ngram_line(line: Column, word: str = WORD) -> Column:
    return F.coalesce(line.rlike(line_pattern(word)), F.lit(False))


def line_fields(line: Column, word: str = WORD) -> Column:
    """``count <tab> W1 W2 W3`` of a matching line, any other line as it is.

    One match finds and takes out the fields. A line that matches is longer than its fields
    (it has a year besides), so the two cases can be told apart by comparing with the line.
    """
    count = 2 + 3 * capture_groups(word)
    return F.regexp_replace(line, F.lit(line_pattern(word)), F.lit(f"${count}\t$1"))


def fields_trigram(fields: Column) -> Column:
    return F.substr(fields, F.position(F.lit("\t"), fields) + 1)


def fields_occurrences(fields: Column) -> Column:
    """The count; one above BIGINT raises under ANSI mode."""
    return F.substring_index(fields, "\t", 1).cast("bigint")


def words(trigram: Column) -> list[Column]:
    """``"A B C"`` as the columns w1, w2, w3; looks for blanks only, without a split per row."""
    first, last = F.substring_index(trigram, " ", 1), F.substring_index(trigram, " ", -1)
    second = F.substring_index(F.substring_index(trigram, " ", 2), " ", -1)
    return [word.alias(f"w{i + 1}") for i, word in enumerate([first, second, last])]


def corpus_part(line_id: Column) -> Column:
    """Part 1 for even line ids, part 2 for the others (negative ids included)."""
    return F.when(line_id % 2 == 0, F.lit(1)).otherwise(F.lit(2))


def text_letters(text: Column, *, keep_case: Column | None = None) -> Column:
    """The runs of ASCII letters of a text, in upper case, with single spaces between.

    Upper-casing happens after the reduction: doing it before would turn some non-ASCII
    letters into ASCII ones.
    """
    letters = F.regexp_replace(text, "[^A-Za-z]+", " ")
    upper = F.upper(letters)
    return F.trim(upper if keep_case is None else F.when(keep_case, letters).otherwise(upper))


def letter_trigrams(letters: Column) -> Column:
    """Array of all overlapping ``"W1 W2 W3"`` of :func:`text_letters`.

    A zero-width look-ahead at each word start captures that word and the two after it, so
    the array comes out of one pass without lambda functions. None spans anything but
    letters and single spaces.
    """
    return F.regexp_extract_all(
        letters, F.lit(r"\b(?=([A-Za-z]++ [A-Za-z]++ [A-Za-z]++))"), F.lit(1)
    )


def text_trigrams(text: Column, *, keep_case: Column | None = None) -> Column:
    """Array of all overlapping ``"W1 W2 W3"`` of a text, over its runs of ASCII letters."""
    return letter_trigrams(text_letters(text, keep_case=keep_case))


def deleted_estimation(tr1: Column, tr2: Column, nr1: Column, nr2: Column, n: Column) -> Column:
    """``(tr1 + tr2) / (n * (nr1 + nr2))`` in double arithmetic, NULL where it is 0/0."""
    return F.try_divide(
        (tr1 + tr2).cast("double"), n.cast("double") * (nr1 + nr2).cast("double")
    )
