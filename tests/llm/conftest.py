import pytest

DOCUMENTS = "doc_id long, text string"
NASTY = [
    None,
    "",
    " \n\t ",
    "a",
    "The cat sat, the cat's mat; don't we'll THEY'RE 1234 5.6",
    "naïve café Ünïcödé ßtraße ÉÈ Ñandú İstanbul ŉ",
    "áë combining, ΑΣ final sigma Σ ὈΔΥΣΣΕΎΣ",
    "日本語のテキスト 😀👩‍👩‍👧 ՘࢏ \U00010940",
    "x<|endoftext|>y <|startoftext|> <| endoftext |>",
    "\x00\x01\x1c\x1d \x85\xa0 　 z\r\n\x0b\x0c",
    "  leading   and  trailing   ",
    "w" * 5000,
    ("lorem ipsum dolor sit amet " * 3000).strip(),
    "!!!??? ... --- ### $$$ || ||",
]


@pytest.fixture
def documents(spark):
    """Small tables: (doc_id, text) rows, with columns that clash with the operators' own."""

    def make(rows, extra=True):
        df = spark.createDataFrame(list(rows), DOCUMENTS)
        if extra:
            for name in ("size", "row", "chunk", "key", "score", "fp", "length", "data", "lang"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture
def nasty(documents):
    rows = list(enumerate(NASTY))
    return documents([*rows, (4, NASTY[4]), (None, "a row without an id"), (None, None)])
