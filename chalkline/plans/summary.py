"""The stored summary: one row per school and month with additive measures of the three facts.

Sums, and the counts of what went into them, can be added up to any coarser grain and over parts of
the data, where means cannot. Reports by school, by district or by whole months read this table, of
at most a row per school and month however many facts there are, instead of reducing the facts again.
"""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.plans.cleaners import VALID

KEY = ["school_id", "month"]


def _known(prefix: str, value: Column | str) -> list[Column]:
    return [F.sum(value).alias(f"{prefix}_sum"), F.count(value).alias(f"{prefix}_count")]


def valid_rate() -> Column:
    return F.when(F.col("data_quality_status") == VALID, F.col("attendance_rate"))


def month_of(date: str = "date") -> Column:
    """The month of a date as text, NULL for undated rows."""
    return F.date_format(date, "yyyy-MM").alias("month")


def attendance_months(attendance: DataFrame) -> DataFrame:
    """Attendance by school and month; `dated` counts the records with a date."""
    return attendance.groupBy("school_id", month_of()).agg(
        F.count(F.lit(1)).alias("attendance_rows"),
        F.count("record_id").alias("records"),
        F.count("date").alias("dated"),
        *_known("rate", valid_rate()),
        F.count_if("is_proxy_attendance").alias("proxies"),
        F.count_if("is_impossible_attendance").alias("impossibles"),
    )


def score_months(scores: DataFrame) -> DataFrame:
    return scores.groupBy("school_id", month_of()).agg(
        F.count(F.lit(1)).alias("score_rows"), *_known("score", "score_percentage")
    )


def procurement_months(procurement: DataFrame) -> DataFrame:
    return procurement.groupBy("school_id", month_of()).agg(
        F.count(F.lit(1)).alias("procurement_rows"), *_known("kg", "quantity_kg"), *_known("cost", "total_cost")
    )


def merged(*summaries: DataFrame) -> DataFrame:
    """Summaries of disjoint parts of the data as one. Parts may lack measures.

    A sum is NULL where no part has a known value, a count is then 0.
    """
    whole = summaries[0]
    for other in summaries[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    sums = {c for c in whole.columns if c.endswith("_sum")}
    return whole.groupBy(*KEY).agg(*[
        F.sum(c).alias(c) if c in sums else F.coalesce(F.sum(c), F.lit(0)).alias(c)
        for c in whole.columns if c not in KEY
    ])


def summarise(attendance: DataFrame, procurement: DataFrame, scores: DataFrame) -> DataFrame:
    """The summary of cleaned facts. Each is reduced in its own tasks first, so a hot school sends a row a task and month."""
    return merged(attendance_months(attendance), score_months(scores), procurement_months(procurement))


def mean(prefix: str) -> Column:
    """The mean of a measure over summary rows, NULL without known values."""
    return F.try_divide(F.sum(f"{prefix}_sum"), F.sum(f"{prefix}_count"))


def school_measures(summary: DataFrame) -> DataFrame:
    """All measures of each school, from one aggregate; NULL where a school has no such facts."""
    return summary.groupBy("school_id").agg(
        mean("rate").alias("avg_attendance_rate"),
        F.try_divide(F.sum("proxies") * F.lit(100.0), F.sum("attendance_rows")).alias("proxy_anomaly_rate"),
        mean("score").alias("avg_fln_score"),
        F.sum("kg_sum").alias("total_quantity_kg"),
        F.sum("cost_sum").alias("total_cost"),
    )


def day(value: datetime.date | str | None) -> datetime.date | None:
    return datetime.date.fromisoformat(value) if isinstance(value, str) else value


def whole_months(since: datetime.date | None, until: datetime.date | None) -> bool:
    """Whether a range of days, both ends in it, consists of whole months."""
    starts = since is None or since.day == 1
    return starts and (until is None or (until + datetime.timedelta(days=1)).day == 1)
