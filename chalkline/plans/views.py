"""The analytical views, each a function from the star to a lazy frame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.operators.lookup import by_merge, left_lookup
from chalkline.plans.star import Star
from chalkline.plans.summary import (
    attendance_months, day, school_measures, valid_rate, whole_months,
)
from chalkline.sources.layout import in_months

_PLACE = ["school_name", "district", "block"]


def attendance_daily(star: Star) -> DataFrame:
    """Attendance records with their school."""
    fact = star.attendance.select(
        "record_id", "school_id", F.col("date").alias("attendance_date"), "grade",
        "total_students", "present_students", "attendance_rate", "teacher_present", "marked_by",
        "is_impossible_attendance", "is_proxy_attendance", "is_weekend", "data_quality_status",
    )
    joined = left_lookup(fact, star.school, "school_id", [*_PLACE, "school_type"], spread_by=["record_id"])
    return joined.select(
        "record_id", "school_id", *_PLACE, "school_type", *fact.columns[2:],
    )


def in_scope(fact: DataFrame, scope: DataFrame | None) -> DataFrame:
    """The rows of a fact whose school is among the schools in scope, all of them without a scope."""
    return fact if scope is None else fact.join(scope.select("school_id"), "school_id", "left_semi")


def in_range(fact: DataFrame, since=None, until=None) -> DataFrame:
    """The rows of a fact from one day to another, both included; a fact laid out by month is read in part.

    Days are dates or ISO texts; None leaves that side open. Undated rows are in no range, but in the
    whole that no range at all leaves.
    """
    since, until = day(since), day(until)
    if since is None and until is None:
        return fact
    rows = in_months(fact, since, until).where(F.col("date").isNotNull())
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since.isoformat()).cast("date"))
    return rows if until is None else rows.where(F.col("date") <= F.lit(until.isoformat()).cast("date"))


def _attendance_months(star: Star, scope: DataFrame | None, since, until) -> DataFrame:
    """Attendance by school and month, stored or, where a range cuts months, reduced from the facts."""
    if star.summary is None or not whole_months(day(since), day(until)):
        return attendance_months(in_scope(in_range(star.attendance, since, until), scope))
    rows = in_scope(star.summary, scope).where("attendance_rows > 0")
    if since is not None:
        rows = rows.where(F.col("month") >= day(since).isoformat()[:7])
    return rows if until is None else rows.where(F.col("month") <= day(until).isoformat()[:7])


def dated_months(star: Star, scope: DataFrame | None = None, since=None, until=None) -> DataFrame:
    """Attendance by district and month, with `dated`, the number of records that have a date.

    Records are first reduced to one row per school and month, so the school lookup joins
    those few rows instead of every record. Months that exist are those with `dated` above 0:
    unlike a filter on the month, one on that sum is not pushed below the aggregates, where the
    date would be worked out once more for it. `scope` are schools that alone count; `since` and
    `until` bound the days (`in_range`).
    """
    per_school = _attendance_months(star, scope, since, until)
    schools = star.school if scope is None else scope
    placed = per_school.join(by_merge(schools.select("school_id", "district")), "school_id", "left")
    by_district = placed.groupBy("district", "month").agg(
        F.sum("records").alias("total_records"),
        F.try_divide(F.sum("rate_sum"), F.sum("rate_count")).alias("avg_attendance_rate"),
        F.sum("proxies").alias("proxy_anomaly_records"),
        F.sum("impossibles").alias("impossible_records"),
        F.sum("dated").alias("dated"),
    )
    return by_district.withColumn(
        "proxy_anomaly_rate_pct",
        F.try_divide(F.col("proxy_anomaly_records") * F.lit(100.0), F.col("total_records")),
    )


def attendance_monthly(star: Star) -> DataFrame:
    """Attendance by district and month."""
    return dated_months(star).drop("dated")


def procurement_summary(star: Star) -> DataFrame:
    """Procurements with their school."""
    fact = star.procurement.select(
        "procurement_id", "school_id", F.col("date").alias("procurement_date"), "vendor_name",
        "grain_type", "quantity_kg", "total_cost", "cost_per_kg", "payment_status",
        "unit_inferred_flag",
    )
    joined = left_lookup(fact, star.school, "school_id", _PLACE, spread_by=["procurement_id"])
    return joined.select("procurement_id", "school_id", *_PLACE, *fact.columns[2:])


def infra_summary(star: Star) -> DataFrame:
    """Each school's current infrastructure. Both sides have one row per school."""
    current = star.infra_current
    joined = current.join(by_merge(star.school.select("school_id", *_PLACE)), "school_id", "left")
    return joined.select(
        "school_id", *_PLACE, F.col("date").alias("last_inspection_date"), "has_electricity",
        "has_drinking_water", "has_functional_toilet", "has_boundary_wall", "has_playground",
        "infrastructure_score", "infrastructure_deficit_pct", "inspector_name", "remarks",
    )


def test_summary(star: Star) -> DataFrame:
    """Assessments with their school."""
    fact = star.scores.select(
        "assessment_id", "school_id", F.col("date").alias("assessment_date"), "grade", "subject",
        "grading_scale_raw", "avg_score_raw", "score_percentage",
    )
    joined = left_lookup(fact, star.school, "school_id", _PLACE, spread_by=["assessment_id"])
    return joined.select("assessment_id", "school_id", *_PLACE, *fact.columns[2:])


def attendance_by_school(star: Star, scope: DataFrame | None = None) -> DataFrame:
    return in_scope(star.attendance, scope).groupBy("school_id").agg(
        F.avg(valid_rate()).alias("avg_attendance_rate"),
        (F.count_if("is_proxy_attendance") * 100.0 / F.count(F.lit(1))).alias("proxy_anomaly_rate"),
    )


def scores_by_school(star: Star, scope: DataFrame | None = None) -> DataFrame:
    return in_scope(star.scores, scope).groupBy("school_id").agg(
        F.avg("score_percentage").alias("avg_fln_score")
    )


def procurement_by_school(star: Star, scope: DataFrame | None = None) -> DataFrame:
    return in_scope(star.procurement, scope).groupBy("school_id").agg(
        F.sum("quantity_kg").alias("total_quantity_kg"), F.sum("total_cost").alias("total_cost")
    )


def infra_by_school(star: Star, scope: DataFrame | None = None) -> DataFrame:
    """Current score and deficit of each school.

    With a scope, Catalyst takes the semi join below the aggregate that makes the snapshot, so that
    inspections of other schools are not reduced.
    """
    return in_scope(star.infra_current, scope).select(
        "school_id", "infrastructure_score", "infrastructure_deficit_pct"
    )


def school_kpis(
    star: Star, procurement: bool = True, scope: DataFrame | None = None
) -> DataFrame:
    """One row per school with the measures of every fact.

    Each fact is reduced to one row per school before it is joined, so no join multiplies rows
    and all of them work on the partitioning the aggregates already have. With a `scope`, some
    rows of the school dimension, facts of other schools are left out before they are reduced. Where the
    star has a stored summary, the facts' measures come from one aggregate over it.
    """
    schools = star.school if scope is None else scope
    infra = by_merge(infra_by_school(star, scope))
    if star.summary is not None:
        measures = school_measures(in_scope(star.summary, scope))
        bought = [] if procurement else ["total_quantity_kg", "total_cost"]
        kpis = schools.join(by_merge(measures.drop(*bought)), "school_id", "left").join(infra, "school_id", "left")
        measured = ["avg_attendance_rate", "proxy_anomaly_rate", "infrastructure_score", "infrastructure_deficit_pct",
                    "avg_fln_score", *(["total_quantity_kg", "total_cost"] if procurement else [])]
        return kpis.select(*schools.columns, *measured)
    kpis = (
        schools.join(by_merge(attendance_by_school(star, scope)), "school_id", "left")
        .join(infra, "school_id", "left")
        .join(by_merge(scores_by_school(star, scope)), "school_id", "left")
    )
    if not procurement:
        return kpis
    return kpis.join(by_merge(procurement_by_school(star, scope)), "school_id", "left")


def district_summary(star: Star) -> DataFrame:
    """District averages of school measures, and totals.

    Schools are counted by rows: the dimension has one row per school.
    """
    return school_kpis(star).groupBy("district").agg(
        F.count("school_id").alias("total_schools"),
        F.sum("total_enrolled_students").alias("total_enrolled_students"),
        F.avg("avg_attendance_rate").alias("avg_attendance_rate"),
        F.avg("proxy_anomaly_rate").alias("proxy_anomaly_rate"),
        F.avg("infrastructure_score").alias("avg_infrastructure_score"),
        F.avg("infrastructure_deficit_pct").alias("avg_infrastructure_deficit"),
        F.avg("avg_fln_score").alias("avg_fln_score"),
        F.sum("total_quantity_kg").alias("total_mdm_quantity_kg"),
        F.sum("total_cost").alias("total_mdm_cost"),
    )


VIEWS = {
    "vw_school_attendance_daily": attendance_daily,
    "vw_school_attendance_monthly": attendance_monthly,
    "vw_school_mdm_summary": procurement_summary,
    "vw_school_infrastructure_summary": infra_summary,
    "vw_school_test_summary": test_summary,
    "vw_district_summary": district_summary,
}
