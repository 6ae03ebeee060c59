"""The whole run: raw files to governed tables, audit, views and risk table."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from chalkline.plans import cleaners
from chalkline.plans.risk import DEFAULT_MODEL, RiskModel, welfare_risk
from chalkline.plans.star import Star, star_from_raw
from chalkline.session import prefer_compiled_methods
from chalkline.sources import tables
from chalkline.sources.raw import read_raw


def audit_all(star: Star, raw_school_master: DataFrame) -> DataFrame:
    """Counters of all five datasets, from the columns of the given tables that they need."""
    audits = [
        cleaners.audit_school_master(raw_school_master),
        cleaners.audit_attendance(star.attendance),
        cleaners.audit_procurement(star.procurement),
        cleaners.audit_infrastructure(star.infra_history),
        cleaners.audit_scores(star.scores),
    ]
    return reduce(DataFrame.unionByName, audits)


def rescue(
    spark: SparkSession, paths: dict[str, str], root: str, by_month: bool = False
) -> DataFrame:
    """Cleans the raw files into tables under `root`; returns the written audit.

    The audit reads the written tables, where a retried task cannot have counted a row twice.
    """
    raw = read_raw(prefer_compiled_methods(spark), paths)
    tables.write_star(star_from_raw(raw.__getitem__), root, by_month)
    audit = audit_all(tables.open_star(spark, root), raw["school_master"])
    path = tables.write_audit(audit, f"{root}/data_quality_report")
    return spark.read.schema(audit.schema).json(path)


def open_warehouse(spark: SparkSession, root: str) -> tuple[Star, int]:
    """Registers tables and views; returns the star and the district count, a check of the load."""
    star = tables.open_star(spark, root)
    tables.register_views(star)
    return star, spark.table("vw_district_summary").count()


def save_risk(star: Star, root: str, model: RiskModel = DEFAULT_MODEL) -> DataFrame:
    """Writes the risk table and registers it; returns the written table."""
    spark = star.school.sparkSession
    tables.write_table(welfare_risk(star, model), root, tables.RISK_TABLE)
    risk = tables.read_table(spark, root, tables.RISK_TABLE)
    tables.register_risk(risk)
    return risk
