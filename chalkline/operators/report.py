"""Last steps of a report: ordering, shares, reshaping, headings, digests and trends."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.functions.text import quoted
from chalkline.vocabulary import FORMAL_LABELS


def ranked(df: DataFrame, by: str, descending: bool = True, ties: Sequence[str] = ()) -> DataFrame:
    """Rows ordered by one column, NULL last, equal values by the tie columns."""
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc_nulls_last() for c in ties])


def share_of_total(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Each row's percentage of the column's sum.

    The sum is a scalar subquery: one row from partial sums, which every task of `df` then knows,
    so the rows stay where they are however many there are.
    """
    total = df.agg(F.sum(value).alias("total")).scalar()
    return df.withColumn(name, F.try_divide(F.col(value) * 100.0, total))


def to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str
) -> DataFrame:
    """One row per id and measure."""
    return df.unpivot(list(ids), list(values), variable, value)


def formal_label(name: str) -> str:
    """The report heading of a column: from the list, else its name in title case."""
    return FORMAL_LABELS.get(name.strip().lower(), name.replace("_", " ").strip().title())


def with_formal_labels(df: DataFrame, labels: Mapping[str, str] | None = None) -> DataFrame:
    """Columns renamed to their report headings; `labels` overrides single ones."""
    labels = labels or {}
    return df.withColumnsRenamed({c: labels.get(c, formal_label(c)) for c in df.columns})


def digest_columns(df: DataFrame) -> tuple[str | None, str | None]:
    """The entity and the measure that a digest takes by itself: the first text and the first numeric column.

    Either is None where the result has no such column.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return (texts or [None])[0], (numbers or [None])[0]


def result_digest(df: DataFrame, entity: str | None = None, measure: str | None = None) -> DataFrame:
    """Row count, highest and lowest entity with their values, and the mean, in one row.

    Without names the columns are chosen by `digest_columns`; what a result has no column for is NULL. Of
    equal values the first entity in alphabetical order is named. An empty result has 0 rows and NULLs.
    """
    first_text, first_number = digest_columns(df)
    entity, measure = entity or first_text, measure or first_number
    name = F.lit(None).cast("string") if entity is None else quoted(entity)
    value = F.lit(None).cast("double") if measure is None else quoted(measure)
    known = value.isNotNull()
    highest = F.min(F.when(known, F.struct((-value).alias("v"), name.alias("e"))))
    lowest = F.min(F.when(known, F.struct(value.alias("v"), name.alias("e"))))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), highest.alias("__high"), lowest.alias("__low"),
        F.avg(value).alias("mean_value"),
    ).select(
        "n_rows",
        F.col("__high.e").alias("max_entity"), (-F.col("__high.v")).alias("max_value"),
        F.col("__low.e").alias("min_entity"), F.col("__low.v").alias("min_value"),
        "mean_value",
    )


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y over x: slope, intercept, R² and the number of points."""
    x_col, y_col = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.regr_count(y_col, x_col).alias("n_points"),
        F.regr_slope(y_col, x_col).alias("slope"),
        F.regr_intercept(y_col, x_col).alias("intercept"),
        F.regr_r2(y_col, x_col).alias("r2"),
    )
