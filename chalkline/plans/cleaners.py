"""Raw dataset in, governed dataset out; each cleaner is one lazy plan and has an audit.

All start with exact duplicate removal on the raw texts, so rows that become equal only by
normalisation stay apart. Everything after that is projections on the rows of that one shuffle;
the two datasets that keep one row per school add one aggregate.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline import schemas
from chalkline.functions.categories import (
    grade_name, grain_name, payment_name, subject_name, vendor_name,
)
from chalkline.functions.quantities import (
    DEFAULT_UNITS, UnitRules, cost_text, quantity_amount, quantity_kg, quantity_method,
    quantity_outcome, quantity_unit,
)
from chalkline.functions.scores import (
    amount_text, letter_value, ratio_texts, scale_text, score_form, score_method, score_text,
    score_value,
)
from chalkline.functions.text import ascii_digits, plain_number, quoted, stripped, title_case
from chalkline.operators.audit import counters, flag_counter, histogram, row_counters
from chalkline.operators.dedup import COPIES, dedup_exact
from chalkline.operators.lineage import with_boolean_lineage, with_date_lineage, with_id_lineage
from chalkline.operators.merge import first_non_null_per_key, tie_break
from chalkline.vocabulary import AMENITIES

# Attendance record states (fixed values), in the order they are decided.
IMPOSSIBLE = "INVALID_IMPOSSIBLE_ATTENDANCE"
PROXY = "ANOMALY_PROXY_SUNDAY"
ZERO_TOTAL = "INVALID_ZERO_TOTAL"
BAD_DATE = "INVALID_DATE_FORMAT"
VALID = "VALID"

PROXY_RATE = 99.9


def _as_they_are(rows: DataFrame) -> DataFrame:
    """Distinct raw rows that no write needs gathered."""
    return rows


def _sure(condition: Column) -> Column:
    """A comparison with something missing counts as false."""
    return F.coalesce(condition, F.lit(False))


def _others(df: DataFrame, schema: T.StructType, produced: list[str]) -> list[str]:
    """Columns of the input that its dataset does not declare. They pass through as they are, but
    for those whose name a cleaned column has."""
    taken = {name.lower() for name in [*schema.names, *produced, COPIES]}
    return [c for c in df.columns if c.lower() not in taken]


# School master ---------------------------------------------------------------------------


def _with_others(df: DataFrame, raw: DataFrame, schema: T.StructType, columns: list) -> DataFrame:
    """The cleaned columns, then the undeclared ones of the raw data."""
    cleaned = df.select(*columns)
    return df.select(*columns, *map(quoted, _others(raw, schema, cleaned.columns)))


_MASTER_LINEAGE = ["school_id_raw", "school_id_clean", "school_id_changed_flag", "district_raw",
                   "district_clean", "block_raw", "block_clean"]


def _merged_schools(raw: DataFrame) -> DataFrame:
    """One row per school, the row without a school id included, with its raw row counts."""
    df = with_id_lineage(dedup_exact(raw))
    df = df.withColumns({"district_raw": F.col("district"), "block_raw": F.col("block")})
    defaults = {"district": "Unknown District", "block": "Unknown Block",
                "school_type": "Unknown", "medium": "Unknown"}
    df = df.withColumns({
        name: stripped(F.coalesce(F.col(name), F.lit(default))) for name, default in defaults.items()
    })
    df = df.withColumns({name: title_case(name) for name in defaults})
    head = ["school_id_raw", "school_id_changed_flag", "district", "district_raw", "block",
            "block_raw", "school_type", "medium"]
    ties = ["school_name", "school_id_raw", "district_raw", "block_raw", "school_type", "medium"]
    others = _others(raw, schemas.SCHOOL_MASTER, _MASTER_LINEAGE)
    return first_non_null_per_key(
        df, "school_id", [F.col("total_enrolled_students"), tie_break(*ties, *others)], head,
        ["school_name", *others],
        extra=[
            F.max("total_enrolled_students").alias("total_enrolled_students"),
            F.sum(COPIES).alias("__raw_rows"),
            F.count(F.lit(1)).alias("__rows"),
        ],
    )


def clean_school_master(raw: DataFrame) -> DataFrame:
    """One row per school: highest enrolment first, casing settled, gaps named."""
    return _merged_schools(raw).where(F.col("school_id").isNotNull()).select(
        "school_id", "school_name", "district", "block", "school_type", "medium",
        "total_enrolled_students", "school_id_raw", F.col("school_id").alias("school_id_clean"),
        "school_id_changed_flag", "district_raw", F.col("district").alias("district_clean"),
        "block_raw", F.col("block").alias("block_clean"),
        *map(quoted, _others(raw, schemas.SCHOOL_MASTER, _MASTER_LINEAGE)),
    )


def audit_school_master(raw: DataFrame) -> DataFrame:
    """Counters of the school master, taken from the raw rows (the merge drops their counts)."""
    known = F.col("school_id").isNotNull()
    return counters(_merged_schools(raw), "school_master", {
        "raw_rows": F.sum("__raw_rows"),
        "exact_duplicates": F.sum(F.col("__raw_rows") - F.col("__rows")),
        "retained_unique_schools": F.count("school_id"),
        "missing_districts_imputed": flag_counter(known & F.col("district_raw").isNull()),
    })


# Attendance ------------------------------------------------------------------------------


def clean_attendance(raw: DataFrame, gather=_as_they_are) -> DataFrame:
    """Attendance records with rate, weekend, impossible and proxy flags and a status."""
    df = gather(dedup_exact(raw))
    # True of every row, but known only after the copies are counted: a filter on the status or the date stays above
    # that, where the text is a column, instead of working both out from the texts of all copies.
    df = df.withColumn("date", F.when(F.col(COPIES) > 0, F.col("date")))
    df = with_date_lineage(with_id_lineage(df))
    df = with_boolean_lineage(df, "teacher_present")
    present, total = F.col("present_students"), F.col("total_students")
    df = df.withColumns({
        "grade_raw": F.col("grade"),
        "grade": grade_name("grade"),
        "is_impossible_attendance": _sure(present > total),
        "is_weekend": _sure(F.weekday("date") >= 5),
        "is_sunday": _sure(F.weekday("date") == 6),
    })
    countable = (total > 0) & ~F.col("is_impossible_attendance")
    df = df.withColumns({
        "grade_clean": F.col("grade"),
        "attendance_rate": F.when(countable, present / total * 100.0),
    })
    # The few full records are told first: a filter on the status, which takes the date's text along with it, then works
    # out the date of the others once, for its error, and not for the Sunday too.
    df = df.withColumn(
        "is_proxy_attendance",
        _sure((present > 0) & (F.col("attendance_rate") >= PROXY_RATE) & F.col("is_sunday")),
    )
    status = (
        F.when(F.col("is_impossible_attendance"), F.lit(IMPOSSIBLE))
        .when(F.col("is_proxy_attendance"), F.lit(PROXY))
        .when(total <= 0, F.lit(ZERO_TOTAL))
        .when(F.col("date_parse_error_flag"), F.lit(BAD_DATE))
        .otherwise(F.lit(VALID))
    )
    return _with_others(df.withColumn("data_quality_status", status), raw, schemas.STUDENT_ATTENDANCE, [
        "record_id", "school_id", "date", "grade", "total_students", "present_students",
        "teacher_present", "marked_by", "school_id_raw", "school_id_clean",
        "school_id_changed_flag", "date_raw", "date_clean", "date_parse_method",
        "date_ambiguous_flag", "date_parse_error_flag", "grade_raw", "grade_clean",
        "teacher_present_raw", "teacher_present_clean", "teacher_present_is_unknown_flag",
        "is_impossible_attendance", "attendance_rate", "is_weekend", "is_sunday",
        "is_proxy_attendance", "data_quality_status", COPIES,
    ])


def audit_attendance(clean: DataFrame) -> DataFrame:
    return counters(clean, "student_attendance", row_counters() | {
        "impossible_attendance_count": flag_counter("is_impossible_attendance"),
        "proxy_attendance_count": flag_counter("is_proxy_attendance"),
        "valid_records_count": flag_counter(F.col("data_quality_status") == VALID),
    })


# Meal procurement ------------------------------------------------------------------------


def clean_procurement(raw: DataFrame, units: UnitRules = DEFAULT_UNITS, gather=_as_they_are) -> DataFrame:
    """Procurements in kilograms and rupees, with cost per kilogram and settled categories."""
    df = with_date_lineage(with_id_lineage(gather(dedup_exact(raw))))
    df = df.withColumns({
        "grain_raw": F.col("grain_type"),
        "grain_type": grain_name("grain_type"),
        "vendor_raw": F.col("vendor_name"),
        "vendor_name": vendor_name("vendor_name"),
        "payment_status_raw": F.col("payment_status"),
        "payment_status": payment_name("payment_status"),
        "cost_raw": F.col("total_cost"),
        "total_cost": cost_text("total_cost"),
        "__quantity": ascii_digits("quantity"),
    })
    df = df.withColumns({
        "__amount": quantity_amount("__quantity"),
        "__unit": quantity_unit("__quantity", "unit"),
    })
    df = df.withColumns({
        "total_cost": plain_number("total_cost"),
        "conversion_method": quantity_method("__amount", "__unit", "quantity", "unit", units),
    })
    unit_clean, inferred = quantity_outcome("__amount", "conversion_method")
    df = df.withColumns({
        "quantity_kg": quantity_kg("__amount", "conversion_method", units),
        "unit_clean": unit_clean,
        "unit_inferred_flag": inferred,
    })
    cost, kg = F.col("total_cost"), F.col("quantity_kg")
    return _with_others(df, raw, schemas.MDM_PROCUREMENT, [
        "procurement_id", "school_id", "date", "vendor_name", "grain_type", "quantity", "unit",
        "total_cost", "payment_status", "school_id_raw", "school_id_clean",
        "school_id_changed_flag", "date_raw", "date_clean", "date_parse_method",
        "date_ambiguous_flag", "date_parse_error_flag", "grain_raw",
        F.col("grain_type").alias("grain_clean"), "vendor_raw",
        F.col("vendor_name").alias("vendor_clean"), F.col("quantity").alias("quantity_raw"),
        F.col("unit").alias("unit_raw"), "quantity_kg", "unit_clean", "conversion_method",
        "unit_inferred_flag", "cost_raw", F.col("total_cost").alias("total_cost_numeric"),
        F.when(kg > 0, cost / kg).alias("cost_per_kg"), "payment_status_raw",
        F.col("payment_status").alias("payment_status_clean"), COPIES,
    ])


def audit_procurement(clean: DataFrame) -> DataFrame:
    return counters(clean, "mdm_procurement", row_counters() | {
        "missing_units_count": flag_counter(F.col("unit_raw").isNull()),
        "inferred_units_count": flag_counter("unit_inferred_flag"),
        "invalid_costs_count": flag_counter(F.col("total_cost_numeric").isNull()),
    })


# Infrastructure --------------------------------------------------------------------------


def clean_infrastructure(raw: DataFrame, gather=_as_they_are) -> DataFrame:
    """Every inspection, with amenity counts, score and deficit (unknowns count in neither)."""
    df = with_date_lineage(with_id_lineage(gather(dedup_exact(raw))))
    df = with_boolean_lineage(df, *AMENITIES)

    def count_where(condition):
        return sum(F.when(condition(F.col(a)), 1.0).otherwise(0.0) for a in AMENITIES)

    df = df.withColumns({
        "amenities_functional_count": count_where(lambda c: c),
        "amenities_deficit_count": count_where(lambda c: ~c),
    })
    any_known = F.coalesce(*AMENITIES).isNotNull()
    of_all = float(len(AMENITIES))
    lineage = [f"{a}{suffix}" for a in AMENITIES for suffix in ("_raw", "_clean", "_is_unknown_flag")]
    return _with_others(df, raw, schemas.SCHOOL_INFRASTRUCTURE, [
        "school_id", "date", *AMENITIES, "inspector_name", "remarks", "school_id_raw",
        "school_id_clean", "school_id_changed_flag", "date_raw", "date_clean",
        "date_parse_method", "date_ambiguous_flag", "date_parse_error_flag", *lineage,
        "amenities_functional_count", "amenities_deficit_count",
        F.when(any_known, F.col("amenities_functional_count") / of_all * 100.0)
        .alias("infrastructure_score"),
        F.when(any_known, F.col("amenities_deficit_count") / of_all * 100.0)
        .alias("infrastructure_deficit_pct"),
        COPIES,
    ])


def current_infrastructure(history: DataFrame) -> DataFrame:
    """One row per school: each column's latest known value, flags and raw texts of the latest row."""
    flags = [f"{a}_is_unknown_flag" for a in AMENITIES]
    raw = [f"{a}_raw" for a in AMENITIES]
    head = ["school_id_raw", "school_id_changed_flag", "date_raw", "date_parse_method",
            "date_ambiguous_flag", "date_parse_error_flag", *raw, *flags,
            "amenities_functional_count", "amenities_deficit_count"]
    fill = [*AMENITIES, "inspector_name", "remarks", "infrastructure_score",
            "infrastructure_deficit_pct"]
    ties = ["school_id_raw", "date_raw", "inspector_name", "remarks", *raw]
    settled = [*head, *fill, "school_id_clean", "date_clean", *[f"{a}_clean" for a in AMENITIES]]
    others = _others(history, schemas.SCHOOL_INFRASTRUCTURE, settled)
    current = first_non_null_per_key(
        history.where(F.col("school_id").isNotNull()), "school_id",
        [F.col("date"), tie_break(*ties, *others)], head, [*fill, *others],
        extra=[F.max("date").alias("date")],
    )
    copies = {f"{a}_clean": F.col(a) for a in AMENITIES}
    copies |= {"school_id_clean": F.col("school_id"), "date_clean": F.col("date")}
    columns = [c for c in history.columns if c != COPIES]
    return current.withColumns(copies).select(*map(quoted, columns))


def audit_infrastructure(history: DataFrame) -> DataFrame:
    return counters(history, "school_infrastructure", row_counters("history_rows") | {
        "unique_schools_current": F.count_distinct("school_id"),
        "normalized_booleans_count": F.count(F.lit(1)) * len(AMENITIES),
    })


# Test scores -----------------------------------------------------------------------------


def clean_scores(raw: DataFrame, gather=_as_they_are) -> DataFrame:
    """Assessments with a percentage whatever their scale. The grade is left as written."""
    df = with_date_lineage(with_id_lineage(gather(dedup_exact(raw))))
    df = df.withColumns({
        "subject_raw": F.col("subject"),
        "subject": subject_name("subject"),
        "__text": score_text("avg_score"),
        "__scale": scale_text("grading_scale"),
        "__full": stripped("max_marks"),
    })
    above, below = ratio_texts("__text")
    df = df.withColumns({
        "__letter": letter_value("__text"), "__amount": amount_text("__text"),
        "__above": above, "__below": below,
    })
    df = df.withColumns({
        name: plain_number(name) for name in ("__amount", "__above", "__below", "__full")
    })
    df = df.withColumn(
        "__form",
        score_form("__text", "__scale", "max_marks", "__letter", "__above", "__below", "__full"),
    )
    df = df.withColumn(
        "score_percentage",
        score_value("__form", "__amount", "__letter", "__above", "__below", "__full"),
    )
    return _with_others(df, raw, schemas.TEST_SCORES, [
        "assessment_id", "school_id", "date", "grade", "subject", "grading_scale", "avg_score",
        "max_marks", "school_id_raw", "school_id_clean", "school_id_changed_flag", "date_raw",
        "date_clean", "date_parse_method", "date_ambiguous_flag", "date_parse_error_flag",
        "subject_raw", F.col("subject").alias("subject_clean"),
        F.col("grading_scale").alias("grading_scale_raw"), F.col("avg_score").alias("avg_score_raw"),
        "score_percentage", score_method("__form", "score_percentage").alias("score_conversion_method"),
        F.col("score_percentage").isNotNull().alias("score_valid_flag"), COPIES,
    ])


def audit_scores(clean: DataFrame) -> DataFrame:
    totals = counters(clean, "test_scores", row_counters() | {
        "valid_scores_count": flag_counter("score_valid_flag"),
        "invalid_scores_count": flag_counter(~F.col("score_valid_flag")),
    })
    return totals.unionByName(
        histogram(clean, "test_scores", "scale_breakdown", "grading_scale_raw")
    )
