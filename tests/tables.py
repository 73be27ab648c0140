"""Rows and a helper of the tests; not in ``conftest.py``, which ``tests/llm`` has another one of."""

# The golden example of FIXTURES.md.
GOLDEN_LINES = [
    (0, "A B C\t1990\t3\t1\t1"),
    (1, "A B C\t1991\t1\t1\t1"),
    (2, "A B D\t1990\t1\t1\t1"),
    (3, "A B E\t1990\t1\t1\t1"),
    (4, "A B E\t1991\t3\t1\t1"),
    (5, "X Y Z\t1990\t1\t1\t1"),
    (6, "a b c\t1990\t9\t1\t1"),
    (7, "A B\t1990\t4\t1\t1"),
    (8, "X Y Z\t1991\t2\t1\t1"),
    (9, "A B D\t91\t5\t1\t1"),
]


def rows(df, *columns):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
