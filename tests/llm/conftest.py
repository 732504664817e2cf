import pytest


@pytest.fixture
def frame(spark):
    """Documents (doc_id, text, source), in several partitions, with columns whose names clash with the operators' own."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id long, text string, source string").repartition(3)
        if extra:
            for name in ("n_words", "Size", "hits", "key", "score", "bytes"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture
def odd(frame):
    """Nulls, empty, blank, very long, repeated and tied rows."""
    words = " ".join(f"w{i}" for i in range(60))
    return [
        (1, words, "a"),
        (2, words + " more", None),
        (2, words + " more", None),
        (3, None, "a"),
        (4, "", "b"),
        (5, " \t\n", "b"),
        (None, words, "a"),
        (None, None, None),
        (6, "Short text", "b"),
        (7, "short TEXT", "b"),
        (8, " ".join(f"x{i % 997}" for i in range(60_000)), "c"),
        (9, "y" * 300_000, "c"),
        (10, "é ß 漢字 " * 30, "é"),
        (11, "same id first text of eleven words in all for the test", "a"),
        (11, "same id other text of eleven words in all for the test", "a"),
    ]
