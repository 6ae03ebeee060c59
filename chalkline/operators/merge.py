"""One row per key out of several, each column from the first row that has it."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.functions.text import quoted


def tie_break(*columns: str) -> Column:
    """A text of fixed width that settles ties by the values of columns, wherever the rows lie."""
    # A NULL is written as a character that no value consists of alone.
    values = [F.coalesce(quoted(c).cast("string"), F.lit("\x1e")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *values).cast("binary"))


def first_non_null_per_key(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    head: Sequence[str],
    fill: Sequence[str],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per `key`, rows ranked by `order` from the highest down, NULL last.

    `fill` columns take their first non-null value in that ranking, each on its own, so a row
    of the result may mix several input rows. `head` columns, which are never null or whose
    NULL counts, all come from the top row. `extra` aggregates ride along.

    This is an aggregate, not a window: each task first reduces its rows to one per key, so a
    key that holds a third of all rows never has to fit into one task. Values of text make it a
    sort aggregate, whose buffer holds the rank once for the head and once for each filled
    column: keep `order` narrow, with `tie_break` for what only settles ties.
    """
    rank = F.col("__rank")
    merged = df.withColumn("__rank", F.struct(*order)).groupBy(key).agg(
        F.max_by(F.struct(*head), rank).alias("__head"),
        *[F.max_by(quoted(c), F.when(quoted(c).isNotNull(), rank)).alias(c) for c in fill],
        *extra,
    )
    heads = {c: F.col("__head")[c] for c in head}
    return merged.withColumns(heads).drop("__head")
