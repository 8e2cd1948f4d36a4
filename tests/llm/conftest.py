import pytest

#: Names that the operators use inside, as extra columns of the input.
CLASH = ["g", "key", "words", "n_words", "h", "n", "m", "fp", "band", "node", "u", "v", "size", "block", "blocks", "list",
         "unit", "base", "copies", "nth", "row", "rows", "text_u", "near", "spans", "score", "window", "tokens", "start", "end"]

LONG = " ".join(f"word{i % 977}x{i % 61}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    prose = "the quick brown fox jumps over the lazy dog while seven wizards box quietly near a frozen lake today and tomorrow"
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one two", "b"), (5, LONG, "b"), (5, LONG, "b"),
            (6, LONG + " tail", "c"), (None, "some words here", "c"), (7, prose, None), (8, prose, None), (8, prose, None),
            (9, prose + " " + prose, "é"), (10, "x " * 5000, "a"), (11, "ünïcödé 　 wörds " * 40, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
