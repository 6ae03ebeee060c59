"""Exact duplicate rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions.text import quoted

COPIES = "exact_copies"


def dedup_exact(df: DataFrame) -> DataFrame:
    """One row per distinct row, with `exact_copies`, the number of raw rows it stands for.

    Grouping by every column counts the copies in the same shuffle that removes them, so the
    audit needs no second pass over the raw data. Copies are combined in each task before the
    shuffle: a group of copies that holds a third of all rows sends one row per task. Rows that were dealt
    with their copies together before are counted where they are, without a shuffle. A column of the
    input that is itself called `exact_copies` becomes `exact_copies_raw`.
    """
    df = df.withColumnRenamed(COPIES, f"{COPIES}_raw")
    return df.groupBy(*map(quoted, df.columns)).agg(F.count(F.lit(1)).alias(COPIES))
