"""Tables laid out by month: one directory per month of their date."""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "date_month"
UNDATED = "undated"


def month_column(date: Column | str = "date") -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(UNDATED))


def in_months(df: DataFrame, since: datetime.date | None, until: datetime.date | None) -> DataFrame:
    """The months of a table that a range of days touches; of one that is not laid out by month, all of it.

    The condition names the directory column only, so that other directories are not even listed as input.
    """
    if MONTH not in df.columns:
        return df
    df = df.where(F.col(MONTH) != UNDATED)
    if since is not None:
        df = df.where(F.col(MONTH) >= since.isoformat()[:7])
    return df if until is None else df.where(F.col(MONTH) <= until.isoformat()[:7])
