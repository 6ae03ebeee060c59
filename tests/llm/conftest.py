import pytest
from pyspark.sql import functions as F

LONG = "alpha beta gamma delta epsilon " * 3000

# doc_id, text, lang, source: NULLs in every column, empty and blank texts, copies, ties, near copies, a very long text.
BASE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank at dawn"
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "b"), (3, BASE + " today", "en", "a"), (3, BASE + " today", "en", "a"),
    (4, None, "en", "a"), (5, "", None, "b"), (6, " \t\n ", "de", None), (None, BASE, None, None), (None, None, None, None),
    (7, "one two", "en", "c"), (8, "ONE two", "fr", "c"), (9, LONG, "en", "c"), (10, "1234 5678 !!! ###", "es", "c"),
    (11, "line one is here\nline one is here\nline one is here\nsomething else entirely now", "en", "a"),
    (7, "an entirely different text under a repeated id with enough words to matter here", "en", "c"),
]


def write_tables(spark, root, rows, labels, items):
    schema = "doc_id long, text string, lang string, source string"
    documents = spark.createDataFrame(rows, schema).withColumns({
        "n_chars": F.length("text").cast("long"), "row_id": F.lit("x"), "sig": F.lit(1), "pattern": F.lit("p"), "cell": F.lit(2.5),
        "words": F.array(F.lit("w")), "label": F.lit(None).cast("string"),
    })
    documents.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    turns = [(1, 0, "user", "Hello there."), (1, 1, "assistant", None), (None, None, None, None), (2, 0, "tool", "x"), (2, 0, "tool", "x")]
    spark.createDataFrame(turns if rows else [], "conv_id long, turn long, role string, text string").write.parquet(f"{root}/conversations.parquet")
    return root


@pytest.fixture(scope="session")
def odd_tables(spark, tmp_path_factory):
    labels = [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (4, 1, 0), (9, 0, 1), (9, 0, 1), (99, 1, 1)]
    items = [(1, BASE.upper()), (2, "one, two!"), (3, None), (4, ""), (None, "fox jumps"), (5, "seven wise owls")]
    return write_tables(spark, str(tmp_path_factory.mktemp("odd")), ROWS, labels, items)


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("empty")), [], [], [])
