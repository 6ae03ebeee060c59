"""Reports over the star and the risk table. All are lazy; sorted ones end in their ordering."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.operators.report import ranked, share_of_total, to_long
from chalkline.plans import views
from chalkline.plans.star import Star
from chalkline.vocabulary import AMENITIES

_PROXY_COLUMNS = ["school_id", "school_name", "district", "attendance_date", "present_students",
                  "total_students", "marked_by"]
_PRIORITY_COLUMNS = ["school_id", "school_name", "district", "block", "welfare_risk_score",
                     "welfare_risk_category", "avg_attendance_rate", "avg_fln_score",
                     "infrastructure_deficit_pct"]


def scope_filter(district: str | None = None, school_type: str | None = None) -> Column:
    """The condition for a chosen district and school type; None leaves that side open."""
    condition = F.lit(True)
    if district is not None:
        condition = condition & (F.col("district") == district)
    if school_type is not None:
        condition = condition & (F.col("school_type") == school_type)
    return condition


# Executive -------------------------------------------------------------------------------


def kpi_scoped(star: Star, district: str | None = None, school_type: str | None = None) -> DataFrame:
    """Headline numbers of the schools in scope, as one row. Facts of other schools are not reduced."""
    chosen = None
    if district is not None or school_type is not None:
        chosen = star.school.where(scope_filter(district, school_type))
    return views.school_kpis(star, procurement=False, scope=chosen).agg(
        F.count("school_id").alias("total_schools"),
        F.sum("total_enrolled_students").alias("total_enrollment"),
        F.avg("avg_attendance_rate").alias("overall_attendance"),
        F.avg("proxy_anomaly_rate").alias("proxy_anomaly_rate"),
        F.avg("infrastructure_deficit_pct").alias("avg_infra_deficit"),
        F.avg("avg_fln_score").alias("avg_fln_score"),
    )


def district_compare(star: Star) -> DataFrame:
    """Attendance rate and score of each district, best attendance first."""
    by_district = views.district_summary(star).groupBy("district").agg(
        F.avg("avg_attendance_rate").alias("att_rate"), F.avg("avg_fln_score").alias("fln_score")
    )
    return ranked(by_district, "att_rate", ties=["district"])


def district_compare_long(star: Star) -> DataFrame:
    """The same, one row per district and indicator."""
    return to_long(district_compare(star), ["district"], ["att_rate", "fln_score"], "indicator", "value")


def risk_distribution(risk: DataFrame) -> DataFrame:
    """Schools per risk band and their share."""
    counts = risk.groupBy("welfare_risk_category").agg(F.count(F.lit(1)).alias("school_count"))
    return share_of_total(counts, "school_count")


def filter_values(star: Star) -> DataFrame:
    """The districts and school types there are to choose from, in one pass over the schools."""
    values = to_long(
        star.school.select("district", "school_type"), [], ["district", "school_type"], "filter", "value"
    )
    return values.where(F.col("value").isNotNull()).distinct().orderBy("filter", "value")


# Attendance ------------------------------------------------------------------------------


def attendance_totals(star: Star, since=None, until=None) -> DataFrame:
    """Records, impossible and proxy ones, of all days or of a range of days (`views.in_range`)."""
    return views.in_range(star.attendance, since, until).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_impossible_attendance").alias("imp"),
        F.count_if("is_proxy_attendance").alias("proxy"),
    )


def monthly_trend(star: Star, since=None, until=None) -> DataFrame:
    """State-wide months, all or in a range of days: unweighted means of the district values."""
    return views.dated_months(star, None, since, until).where("dated > 0").groupBy("month").agg(
        F.avg("avg_attendance_rate").alias("avg_attendance_rate"),
        F.avg("proxy_anomaly_rate_pct").alias("proxy_anomaly_rate_pct"),
    ).orderBy("month")


def trend_by_district(star: Star, district: str | None = None, since=None, until=None) -> DataFrame:
    """Monthly attendance of one district, or of the state. A district keeps undated records, unless a range of
    days is given."""
    if district is None:
        monthly = views.dated_months(star, None, since, until).where("dated > 0")
    else:
        schools = star.school.where(F.col("district") == district)
        monthly = views.dated_months(star, schools, since, until)
    return monthly.groupBy("month").agg(
        F.avg("avg_attendance_rate").alias("avg_attendance_rate")
    ).orderBy(F.col("month").asc_nulls_last())


def _latest_first(df: DataFrame, columns) -> list[Column]:
    return [F.col("attendance_date").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in columns if c != "attendance_date"
    ]


def latest_proxies(
    star: Star, limit: int = 20, district: str | None = None, since=None, until=None
) -> DataFrame:
    """The latest records with full attendance on a Sunday.

    Without a district the top rows are found before the school lookup, which then serves
    `limit` rows only; a left lookup of unique schools neither adds nor drops rows. With one, its
    schools are joined to the proxies alone.
    """
    proxies = views.in_range(star.attendance, since, until).where("is_proxy_attendance")
    proxies = proxies.withColumnRenamed("date", "attendance_date")
    if district is None:
        own = ["school_id", "attendance_date", "present_students", "total_students", "marked_by"]
        proxies = proxies.select(own)
        top = proxies.orderBy(*_latest_first(proxies, own)).limit(limit)
        named = top.join(star.school.select("school_id", "school_name", "district"), "school_id", "left")
        return named.select(_PROXY_COLUMNS).orderBy(*_latest_first(named, own))
    chosen = proxies.join(star.school.where(F.col("district") == district), "school_id").select(_PROXY_COLUMNS)
    return chosen.orderBy(*_latest_first(chosen, _PROXY_COLUMNS)).limit(limit)


# Procurement -----------------------------------------------------------------------------


def procurement_totals(star: Star) -> DataFrame:
    return star.procurement.agg(
        F.sum("quantity_kg").alias("tot_kg"),
        F.sum("total_cost").alias("tot_cost"),
        F.avg("cost_per_kg").alias("avg_cpk"),
    )


def vendor_ranking(star: Star) -> DataFrame:
    """Expenditure by vendor. Needs no school, so none is looked up."""
    spend = star.procurement.groupBy("vendor_name").agg(F.sum("total_cost").alias("total_cost"))
    return ranked(spend, "total_cost", ties=["vendor_name"])


def commodity_mix(star: Star) -> DataFrame:
    """Kilograms by grain and their share."""
    mix = star.procurement.groupBy("grain_type").agg(F.sum("quantity_kg").alias("total_kg"))
    return ranked(share_of_total(mix, "total_kg"), "total_kg", ties=["grain_type"])


def vendor_spend(star: Star, limit: int = 10) -> DataFrame:
    """The vendors with the highest expenditure, and their kilograms."""
    spend = star.procurement.where(F.col("vendor_name").isNotNull()).groupBy("vendor_name").agg(
        F.sum("total_cost").alias("total_cost_rs"), F.sum("quantity_kg").alias("total_quantity_kg")
    )
    return ranked(spend, "total_cost_rs", ties=["vendor_name"]).limit(limit)


# Infrastructure --------------------------------------------------------------------------


def amenity_share(star: Star) -> DataFrame:
    """Percentage of schools with each amenity; unknown counts as not available."""
    names = dict(zip(AMENITIES, ("elec", "water", "toilet", "wall", "play")))
    return star.infra_current.agg(
        *[(F.avg(F.when(F.col(c), 1.0).otherwise(0.0)) * 100.0).alias(n) for c, n in names.items()]
    )


def deficit_ranking(star: Star) -> DataFrame:
    by_district = views.infra_summary(star).groupBy("district").agg(
        F.avg("infrastructure_deficit_pct").alias("deficit")
    )
    return ranked(by_district, "deficit", ties=["district"])


# Learning --------------------------------------------------------------------------------


def score_totals(star: Star) -> DataFrame:
    return star.scores.agg(
        F.avg("score_percentage").alias("avg_score"), F.count(F.lit(1)).alias("total_tests")
    )


def score_by(star: Star, name: str) -> DataFrame:
    """Mean score by subject or grade, best first."""
    means = star.scores.groupBy(name).agg(F.avg("score_percentage").alias("avg_score"))
    return ranked(means, "avg_score", ties=[name])


def score_by_amenity(star: Star, amenity: str = "has_electricity", label: str = "Electricity") -> DataFrame:
    """Mean score of assessments in schools known to have or to lack an amenity.

    Scores are summed per school first; only those sums meet the school's inspection.
    """
    per_school = star.scores.groupBy("school_id").agg(
        F.sum("score_percentage").alias("score_sum"), F.count("score_percentage").alias("score_count")
    )
    inspected = star.infra_current.where(F.col(amenity).isNotNull()).select("school_id", amenity)
    status = F.when(F.col(amenity), F.lit(f"Functional {label}")).otherwise(
        F.lit(f"No Functional {label}")
    )
    return per_school.join(inspected, "school_id").groupBy(
        status.alias(f"{label.lower()}_status")
    ).agg(F.try_divide(F.sum("score_sum"), F.sum("score_count")).alias("avg_fln_score"))


def district_score_ranking(star: Star) -> DataFrame:
    """Districts by mean score, lowest first."""
    means = views.district_summary(star).where(F.col("district").isNotNull()).groupBy("district").agg(
        F.avg("avg_fln_score").alias("avg_fln_score")
    )
    return ranked(means, "avg_fln_score", descending=False, ties=["district"])


def district_overview(star: Star) -> DataFrame:
    means = views.district_summary(star).where(F.col("district").isNotNull()).groupBy("district").agg(
        F.avg("avg_attendance_rate").alias("avg_attendance_rate"),
        F.avg("avg_fln_score").alias("avg_fln_score"),
    )
    return ranked(means, "avg_attendance_rate", ties=["district"])


# Risk ------------------------------------------------------------------------------------


def risk_priority(risk: DataFrame, limit: int | None = None) -> DataFrame:
    """Schools by risk, highest first; all of them, or the first `limit`."""
    table = ranked(risk.select(_PRIORITY_COLUMNS), "welfare_risk_score", ties=["school_id"])
    return table if limit is None else table.limit(limit)


def risk_bands(risk: DataFrame) -> DataFrame:
    """Schools in each band, as one row."""
    def schools(band):
        return F.count_if(F.col("welfare_risk_category") == band)

    return risk.agg(
        schools("High Risk").alias("high_risk"),
        schools("Moderate Risk").alias("moderate_risk"),
        schools("Low Risk").alias("low_risk"),
    )
