"""Quality counters as rows (dataset, metric, key, value)."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.operators.dedup import COPIES


def row_counters(retained: str = "retained_rows") -> dict[str, Column]:
    """Raw, duplicate and retained row counts of a frame made by `dedup_exact`."""
    return {
        "raw_rows": F.sum(COPIES),
        "exact_duplicates": F.sum(F.col(COPIES) - 1),
        retained: F.count(F.lit(1)),
    }


def flag_counter(flag) -> Column:
    return F.count_if(F.col(flag) if isinstance(flag, str) else flag)


def counters(df: DataFrame, dataset: str, metrics: Mapping[str, Column]) -> DataFrame:
    """All counters of a dataset from one aggregate over it."""
    totals = df.agg(
        *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(name) for name, c in metrics.items()]
    )
    return totals.unpivot([], list(metrics), "metric", "value").select(
        F.lit(dataset).alias("dataset"), "metric", F.lit(None).cast("string").alias("key"), "value"
    )


def histogram(df: DataFrame, dataset: str, metric: str, name: str) -> DataFrame:
    """How often each value of a column occurs; the key is NULL for missing values."""
    return df.groupBy(F.col(name).alias("key")).agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(dataset).alias("dataset"), F.lit(metric).alias("metric"), "key", "value"
    )
