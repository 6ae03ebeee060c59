"""Cleaners, views, risk and reports on hand-made records, and the shape of their plans."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from chalkline import derived, schemas
from chalkline.functions.dates import date_value
from chalkline.plans import cleaners, reports, views
from chalkline.plans.risk import RiskModel, welfare_risk
from chalkline.plans.star import star_from_raw

SF = "/root/testdata/sf0.001"


def frame(spark, name, rows):
    schema = schemas.RAW_SCHEMAS[name]
    rows = [tuple(float(v) if isinstance(v := row.get(c), int) else v for c in schema.names) for row in rows]
    return spark.createDataFrame(rows, schema)


def attendance(spark, *rows):
    base = {"school_id": "1", "date": "2025-01-06", "grade": "1", "teacher_present": "yes"}
    return frame(spark, "student_attendance", [base | {"record_id": str(i)} | row for i, row in enumerate(rows)])


SUNDAY = "2025-01-05"


@pytest.mark.parametrize("row, status, rate, proxy", [
    ({"total_students": 10, "present_students": 12}, cleaners.IMPOSSIBLE, None, False),
    ({"total_students": 10, "present_students": 12, "date": SUNDAY}, cleaners.IMPOSSIBLE, None, False),
    ({"total_students": 10, "present_students": 10, "date": SUNDAY}, cleaners.PROXY, 100.0, True),
    ({"total_students": 10, "present_students": 10}, cleaners.VALID, 100.0, False),
    ({"total_students": 0, "present_students": 0}, cleaners.ZERO_TOTAL, None, False),
    ({"total_students": 0, "present_students": 0, "date": "n/k"}, cleaners.ZERO_TOTAL, None, False),
    ({"total_students": 10, "present_students": 5, "date": "n/k"}, cleaners.BAD_DATE, 50.0, False),
    ({"total_students": None, "present_students": 5}, cleaners.VALID, None, False),
    ({"total_students": 10, "present_students": None}, cleaners.VALID, None, False),
    ({"total_students": 10, "present_students": 9, "date": SUNDAY}, cleaners.VALID, 90.0, False),
])
def test_attendance_status(spark, row, status, rate, proxy):
    got = cleaners.clean_attendance(attendance(spark, row)).first()
    assert (got.data_quality_status, got.attendance_rate, got.is_proxy_attendance) == (status, rate, proxy)


def test_weekend_flags(spark):
    days = {"2025-01-03": (False, False), "2025-01-04": (True, False), SUNDAY: (True, True), "n/k": (False, False)}
    rows = [{"date": d, "total_students": 1, "present_students": 0} for d in days]
    got = {r.date_raw: (r.is_weekend, r.is_sunday) for r in cleaners.clean_attendance(attendance(spark, *rows)).collect()}
    assert got == days


def test_attendance_audit_partitions_the_rows(spark):
    clean = cleaners.clean_attendance(derived.student_attendance(spark, SF)).cache()
    audit = {r.metric: r.value for r in cleaners.audit_attendance(clean).collect()}
    raw = derived.student_attendance(spark, SF)
    assert audit["raw_rows"] == raw.count() and audit["retained_rows"] == raw.distinct().count()
    assert audit["exact_duplicates"] == audit["raw_rows"] - audit["retained_rows"]
    statuses = {r[0]: r[1] for r in clean.groupBy("data_quality_status").count().collect()}
    assert sum(statuses.values()) == audit["retained_rows"]
    assert audit["valid_records_count"] == statuses["VALID"]
    clean.unpersist()


def test_school_master_merges_after_normalisation(spark):
    raw = frame(spark, "school_master", [
        {"school_id": "SCH-0007", "school_name": None, "district": None, "block": " b one", "total_enrolled_students": 90},
        {"school_id": "7", "school_name": "Seven", "district": "moga", "total_enrolled_students": 50, "medium": "HINDI"},
        {"school_id": "7", "school_name": "Seven", "district": "moga", "total_enrolled_students": 50, "medium": "HINDI"},
        {"school_id": "8", "school_name": "Eight", "district": "st. john's", "total_enrolled_students": None},
        {"school_id": None, "school_name": "lost", "district": "x", "total_enrolled_students": 5},
    ])
    seven, eight = cleaners.clean_school_master(raw).orderBy("school_id").collect()
    assert (seven.school_id, seven.school_name, seven.district, seven.block) == ("SCH0007", "Seven", "Unknown District", "B One")
    assert (seven.total_enrolled_students, seven.district_raw, seven.school_id_raw) == (90, None, "SCH-0007")
    assert (eight.district, eight.total_enrolled_students, eight.medium) == ("St. John'S", None, "Unknown")
    audit = {r.metric: r.value for r in cleaners.audit_school_master(raw).collect()}
    assert audit == {"raw_rows": 5, "exact_duplicates": 1, "retained_unique_schools": 2, "missing_districts_imputed": 1}


def test_infrastructure_snapshot_mixes_rows(spark):
    raw = frame(spark, "school_infrastructure", [
        {"school_id": "1", "date": "2025-03-01", "has_electricity": "maybe", "has_playground": "no", "remarks": "new"},
        {"school_id": "S1", "date": "2025-01-01", "has_electricity": "yes", "has_playground": "yes", "inspector_name": "old"},
        {"school_id": "1", "date": "n/k", "has_boundary_wall": "hai", "has_playground": "yes"},
        {"school_id": "2", "date": "2025-01-01"},
    ])
    history = cleaners.clean_infrastructure(raw)
    one, two = cleaners.current_infrastructure(history).orderBy("school_id").collect()
    assert (one.date, one.has_electricity, one.has_playground, one.has_boundary_wall) == (
        datetime.date(2025, 3, 1), True, False, True)
    assert (one.has_electricity_raw, one.has_electricity_is_unknown_flag, one.inspector_name, one.remarks) == (
        "maybe", True, "old", "new")
    assert (one.infrastructure_score, one.infrastructure_deficit_pct) == (0.0, 20.0)
    assert two.infrastructure_score is None and two.has_electricity is None
    audit = {r.metric: r.value for r in cleaners.audit_infrastructure(history).collect()}
    assert audit["unique_schools_current"] == 2 and audit["normalized_booleans_count"] == 20


def test_procurement_cost_per_kg(spark):
    rows = [
        {"procurement_id": "a", "quantity": "2", "unit": "bags", "total_cost": "₹500"},
        {"procurement_id": "b", "quantity": "0", "unit": "kg", "total_cost": "₹500"},
        {"procurement_id": "c", "quantity": "2", "unit": "kg", "total_cost": "tbd"},
        {"procurement_id": "d", "quantity": None, "unit": None, "total_cost": None},
    ]
    clean = cleaners.clean_procurement(frame(spark, "mdm_procurement", rows))
    assert {r.procurement_id: r.cost_per_kg for r in clean.collect()} == {"a": 5.0, "b": None, "c": None, "d": None}
    audit = {r.metric: r.value for r in cleaners.audit_procurement(clean).collect()}
    assert (audit["missing_units_count"], audit["inferred_units_count"], audit["invalid_costs_count"]) == (1, 1, 2)


@pytest.fixture(scope="module")
def lone_school(spark):
    """One school without facts, and one whose facts are chosen to hit a cut-off."""
    raw = {
        "school_master": frame(spark, "school_master", [
            {"school_id": "1", "district": "moga", "school_type": "primary", "total_enrolled_students": 100},
            {"school_id": "2", "district": "moga", "school_type": "high", "total_enrolled_students": None},
        ]),
        "student_attendance": attendance(spark, {"total_students": 10, "present_students": 0}),
        "mdm_procurement": frame(spark, "mdm_procurement", [
            {"school_id": "1", "quantity": "60", "unit": "kg", "total_cost": "10", "date": "2025-01-01"}]),
        "school_infrastructure": frame(spark, "school_infrastructure", [
            {"school_id": "1", "date": "2025-01-01"} | {a: "no" for a in cleaners.AMENITIES}]),
        "test_scores": frame(spark, "test_scores", [
            {"school_id": "1", "avg_score": "60", "grading_scale": "%", "date": "2025-01-01", "subject": "math"}]),
    }
    return star_from_raw(raw.__getitem__)


def test_risk_defaults_and_bands(lone_school):
    risk = {r.school_id: r for r in welfare_risk(lone_school).collect()}
    assert (risk["SCH0001"].mdm_risk, risk["SCH0001"].welfare_risk_score) == (20.0, 63.0)
    assert risk["SCH0001"].welfare_risk_category == "Moderate Risk"
    empty = risk["SCH0002"]
    assert (empty.avg_attendance_rate, empty.avg_fln_score, empty.infrastructure_deficit_pct) == (75.0, 65.0, 40.0)
    assert (empty.mdm_risk, empty.welfare_risk_score, empty.welfare_risk_category) == (20.0, 27.25, "Low Risk")
    for cut, band in [(63.0, "High Risk"), (63.01, "Moderate Risk")]:
        rows = welfare_risk(lone_school, RiskModel(high_from=cut)).where("school_id = 'SCH0001'").collect()
        assert rows[0].welfare_risk_category == band
    rows = welfare_risk(lone_school, RiskModel(moderate_from=63.0)).where("school_id = 'SCH0001'").collect()
    assert rows[0].welfare_risk_category == "Moderate Risk"


def test_scoped_kpis(lone_school):
    assert reports.kpi_scoped(lone_school).first().total_schools == 2
    assert reports.kpi_scoped(lone_school, "Moga", "High").first().total_schools == 1
    assert reports.kpi_scoped(lone_school, "Elsewhere").first().total_schools == 0


def test_risk_stays_within_bounds(spark):
    risk = welfare_risk(derived.star(spark, SF))
    low, high, n = risk.agg(F.min("welfare_risk_score"), F.max("welfare_risk_score"), F.count("*")).first()
    assert 0 <= low <= high <= 100 and n == derived.star(spark, SF).school.count()
    assert sum(r.share_pct for r in reports.risk_distribution(risk).collect()) == pytest.approx(100)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm_and_join_by_key(spark):
    star = derived.star(spark, SF)
    frames = [*star.tables().values(), *[build(star) for build in views.VIEWS.values()], welfare_risk(star)]
    for df in frames:
        plan = plan_of(df)
        for unwanted in ("EvalPython", "InPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert unwanted not in plan


def test_star_joins_add_no_shuffle(spark):
    plan = plan_of(views.school_kpis(derived.star(spark, SF)))
    by_school = re.findall(r"Exchange hashpartitioning\(school_id#\d+, \d+\)", plan)
    by_row = re.findall(r"Exchange hashpartitioning\(\w+#\d+L?, \w+#", plan)
    # Each of the five tables is shuffled once to de-duplicate and once by school; the joins use the latter.
    assert (len(by_school), len(by_row)) == (5, 5)


def test_scans_read_only_the_needed_columns(spark):
    star = derived.star(spark, SF)
    plan = reports.attendance_totals(star)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_skewed_lookup_scans_each_side_once(spark):
    star = derived.skewed_star(spark, SF)
    hot, orphans, lost = star.attendance.agg(
        F.avg((F.col("school_id") == derived.HOT_SCHOOL).cast("int")), F.count_if(~F.col("school_id").startswith("SCH")),
        F.count_if(F.col("school_id").isNull()),
    ).first()
    assert hot > 0.3 and orphans > 0 and lost > 0
    daily = views.attendance_daily(star)
    plan = plan_of(daily)
    for table in ("lineitem", "orders", "customer", "nation", "region"):
        assert plan.count(f"{table}.parquet") == 1
    plain = star.attendance.select("record_id", "school_id").join(star.school.select("school_id", "district"), "school_id", "left")
    assert daily.select("school_id", "record_id", "district").exceptAll(plain).count() == 0
    assert daily.count() == star.attendance.count()


def test_looked_up_views_compute_only_what_is_asked(spark):
    daily = views.attendance_daily(derived.star(spark, SF)).groupBy("block").agg(F.avg("attendance_rate"))
    plan = daily._jdf.queryExecution().optimizedPlan().toString()
    asked = plan[:plan.index("Aggregate", plan.index("Join LeftOuter"))]
    assert "l_shipdate" not in asked and "regexp_replace" not in asked


def test_monthly_counts_add_up(spark):
    star = derived.star(spark, SF)
    total = views.attendance_monthly(star).agg(F.sum("total_records")).first()[0]
    assert total == star.attendance.count()


def test_scoped_reports_reduce_only_facts_in_scope(spark):
    star = derived.star(spark, SF)
    logical = reports.kpi_scoped(star, "Nation_3")._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Join LeftSemi") == 3
    # The inspections' semi join lies below the aggregate that makes the snapshot.
    below = logical[logical.index("max_by"):]
    assert "Join LeftSemi" in below
    trend = reports.trend_by_district(star, "Nation_3")._jdf.queryExecution().optimizedPlan().toString()
    assert trend.count("Join LeftSemi") == 1


def test_months_are_filtered_above_the_aggregates(spark):
    star = derived.star(spark, SF)
    patterns = [
        report(star)._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(lower(")
        for report in (views.attendance_monthly, reports.monthly_trend)
    ]
    assert patterns[0] == patterns[1] > 0


def test_filters_work_no_text_out_once_more(spark):
    """Joins by school ask the raw texts for ids, and a filter on the status stays above the duplicate removal."""
    star = derived.star(spark, SF)
    valid = views.attendance_daily(star).where("data_quality_status = 'VALID'")
    for df in (welfare_risk(star), valid.groupBy("block").agg(F.avg("attendance_rate"))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        below = re.split(r"Aggregate \[(?:record|procurement|assessment)_id#\d+, school_id#", plan)[1:]
        assert below and not any("regexp" in part.split("Relation", 1)[0] for part in below)
        assert not re.search(r"(?:Filter|Join Inner,) \(?isnotnull\(CASE WHEN \(regexp_extract", plan)


def test_ids_are_missing_where_their_texts_are(spark):
    df = spark.createDataFrame([(None,), ("",), (" sch-0",), ("007",), ("x 00012345 9",), ("unlisted",)], "school_id string")
    found = [r.school_id for r in cleaners.with_id_lineage(df).collect()]
    assert found == [None, "", "SCH0000", "SCH0007", "SCH12345", "UNLISTED"]


def test_merge_settles_ties_wherever_the_rows_lie(spark):
    rows = [("7", d, "yes" if d == "2025-01-07" else None, "no", None, None, None, who, None)
            for d in ("2025-01-06", "2025-01-07") for who in ("x", "y")]
    df = spark.createDataFrame(rows, schemas.SCHOOL_INFRASTRUCTURE)
    history = cleaners.clean_infrastructure(df)
    first = cleaners.current_infrastructure(history.repartition(3)).collect()
    assert first == cleaners.current_infrastructure(history.repartition(5, "inspector_name")).collect()


def test_status_filters_ask_full_records_alone_for_the_sunday(spark):
    """A filter on the status takes the date's text along; it comes to the weekday of the few full records only."""
    attendance = derived.star(spark, SF).attendance.where("data_quality_status = 'VALID'").select("record_id")
    plan = attendance._jdf.queryExecution().optimizedPlan().toString()
    condition = plan[plan.index("Filter CASE WHEN"):]
    assert condition.index(">= 99.9") < condition.index("weekday(")


def test_dates_in_numbers_skip_the_later_steps(spark):
    value = spark.range(1).select(date_value(F.col("id").cast("string")).alias("day"))._jdf.queryExecution().optimizedPlan().toString()
    told, others = value.index("RLIKE"), value.index("regexp_replace(lower(")
    assert told < value.index("regexp_replace(") < others and value[told + 1:others].count("RLIKE") == 1
