"""Governed tables: Parquet directories under one root, or bucketed tables of a catalog, and the views over them."""

import posixpath
import tempfile
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException, ParseException

from chalkline.plans import star as star_tables
from chalkline.plans.cleaners import current_infrastructure
from chalkline.plans.star import SUMMARY, Star
from chalkline.plans.summary import summarise
from chalkline.plans.views import VIEWS
from chalkline.session import shuffles_freed, side_by_side
from chalkline.sources import versions
from chalkline.sources.layout import MONTH, month_column

# Rows of a CSV file at most: some 30 MB when compressed, some seconds of one task.
CSV_ROWS = 1_000_000

# Of Parquet files: a quarter smaller than Spark's default, snappy, for about the same time.
CODEC = "zstd"

RISK_TABLE = "fact_welfare_risk"
RISK_VIEW = "vw_school_welfare_risk"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local session, where driver and executors are one process, may go without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="chalkline-")
    return posixpath.join(shared, f"{purpose}-{uuid.uuid4().hex}")


def _save(df: DataFrame, path: str) -> None:
    df.write.parquet(path, compression=CODEC)


def _save_in_order(df: DataFrame, path: str) -> None:
    df.withColumn(MONTH, F.col(star_tables.PLACE)).drop(star_tables.PLACE).write.partitionBy(MONTH).parquet(path, compression=CODEC)


def _save_by_month(df: DataFrame, path: str) -> None:
    by_month = df.withColumn(MONTH, month_column()).hint("rebalance", MONTH)
    by_month.write.partitionBy(MONTH).parquet(path, compression=CODEC)


def write_table(df: DataFrame, root: str, name: str, by_month: bool = False) -> str:
    """Replaces one table by a new version of it (`sources.versions`) as Parquet; returns the version's path.

    `by_month` lays the table out in one directory per month of its `date`, and `undated`. The rebalance
    before it gathers each month's rows into files of a good size and splits a month that
    holds much of the data over several tasks.
    """
    return versions.replace(df, posixpath.join(root, name), _save_by_month if by_month else _save)


def write_star_table(star: Star, root: str, name: str, by_month: bool = False) -> str:
    """`write_table` of a star's table. By month its rows are gathered and sorted before they are cleaned, where the star can do so."""
    if not by_month:
        return write_table(star.table(name), root, name)
    ordered = star.in_order(name, lambda _, date: month_column(date))
    return versions.replace(ordered, posixpath.join(root, name), _save_in_order)


def write_csv(df: DataFrame, path: str) -> str:
    """Overwrites a directory of CSV files with a header row; NULL is left empty, blanks are kept.

    The files are compressed by gzip, which takes a small part of the room. Such a file is read by one task, so each holds at
    most `CSV_ROWS` rows.
    """
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("compression", "gzip").option("maxRecordsPerFile", CSV_ROWS)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def write_audit(audit: DataFrame, path: str) -> str:
    """Overwrites the audit as JSON Lines. It has some ten rows per dataset, so one file."""
    audit.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of a table. One laid out by month keeps the column of its directories."""
    return spark.read.parquet(versions.current_path(spark, posixpath.join(root, name)))


def has_table(spark: SparkSession, root: str, name: str) -> bool:
    return bool(versions.commits(spark, posixpath.join(root, name)))


def open_star(spark: SparkSession, root: str) -> Star:
    """The star over written tables, with their summary if there is one."""
    def reader(name):
        return lambda _: read_table(spark, root, name)

    names = [*star_tables.TABLES, *([SUMMARY] if has_table(spark, root, SUMMARY) else [])]
    return Star({name: reader(name) for name in names})


def write_star(star: Star, root: str, by_month: bool = False) -> None:
    """Writes all six tables and the facts' summary by school and month.

    Tables that do not need each other are written side by side. The snapshot and the summary are built from written
    tables, not a second time from the raw data. What a write has shuffled is deleted when it ends.
    """
    spark = star.school.sparkSession

    def write(name):
        write_star_table(star, root, name, by_month and name != star_tables.SCHOOL)

    def write_infrastructure():
        write(star_tables.INFRA_HISTORY)
        history = read_table(spark, root, star_tables.INFRA_HISTORY)
        write_table(current_infrastructure(history.drop(MONTH)), root, star_tables.INFRA_CURRENT)

    def write_facts():
        side_by_side(spark, *[partial(write, name) for name in star_tables.FACTS])
        facts = (read_table(spark, root, name) for name in star_tables.FACTS)
        write_table(summarise(*facts), root, SUMMARY)

    with shuffles_freed(spark):
        side_by_side(spark, write_facts, write_infrastructure, partial(write, star_tables.SCHOOL))


def save_bucketed_star(star: Star, database: str, buckets: int) -> None:
    """Saves the six tables in a database of the catalog, bucketed and sorted by school; tables of those names go.

    Aggregates and joins by school of the tables need no shuffle. The rebalance before each write puts a bucket's rows into
    few files, several where a school has much of the data; a bucket is read by one task, however, so reports on
    data with such a school should use the summary. `buckets` should leave a bucket of the largest table
    at some hundred megabytes.
    """
    for name in star_tables.TABLES:
        dealt = star.gathered(name, lambda school, _: F.pmod(F.hash(school), F.lit(buckets)))
        writer = dealt.write.mode("overwrite").format("parquet").option("compression", CODEC)
        writer.bucketBy(buckets, "school_id").sortBy("school_id").saveAsTable(f"{database}.{name}")


def open_bucketed_star(spark: SparkSession, database: str) -> Star:
    """The star over the tables of a database."""
    def reader(name):
        return lambda _: spark.table(f"{database}.{name}")

    return Star({name: reader(name) for name in star_tables.TABLES})


def register_views(star: Star) -> list[str]:
    """Temporary views for the tables and the analytical views; returns their names."""
    frames = star.tables() | {name: build(star) for name, build in VIEWS.items()}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def register_risk(risk: DataFrame) -> None:
    """Temporary views for the risk table, under its table and its view name."""
    risk.createOrReplaceTempView(RISK_TABLE)
    risk.createOrReplaceTempView(RISK_VIEW)


def read_query(spark: SparkSession, text: str) -> DataFrame:
    """An ad-hoc query over the registered views; the text must be one query and nothing else.

    EXPLAIN parses the text on its own, without running it, so brackets in it are balanced;
    a statement that is no query does not parse as a subquery.
    """
    spark.sql(f"EXPLAIN {text.strip().rstrip(';')}")
    return spark.sql(f"SELECT * FROM (\n{text.strip().rstrip(';')}\n)")


def try_query(spark: SparkSession, text: str) -> tuple[DataFrame | None, str | None]:
    """(frame, None) of an ad-hoc query, or (None, message) when Spark cannot analyse it."""
    try:
        return read_query(spark, text), None
    except (AnalysisException, ParseException) as error:
        return None, str(error)
