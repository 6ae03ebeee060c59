"""Declared schemas of the five raw datasets: messy columns are text, counts are numbers."""

from pyspark.sql import types as T

from chalkline.vocabulary import AMENITIES


def _schema(text, counts=()):
    fields = [T.StructField(name, T.StringType()) for name in text]
    fields += [T.StructField(name, T.DoubleType()) for name in counts]
    return T.StructType(fields)


def _ordered(schema, names):
    return T.StructType([schema[name] for name in names])


SCHOOL_MASTER = _schema(
    ["school_id", "school_name", "district", "block", "school_type", "medium"],
    ["total_enrolled_students"],
)

STUDENT_ATTENDANCE = _ordered(
    _schema(
        ["record_id", "school_id", "date", "grade", "teacher_present", "marked_by"],
        ["total_students", "present_students"],
    ),
    ["record_id", "school_id", "date", "grade", "total_students", "present_students",
     "teacher_present", "marked_by"],
)

MDM_PROCUREMENT = _schema(
    ["procurement_id", "school_id", "date", "vendor_name", "grain_type", "quantity", "unit",
     "total_cost", "payment_status"],
)

SCHOOL_INFRASTRUCTURE = _schema(
    ["school_id", "date", *AMENITIES, "inspector_name", "remarks"],
)

TEST_SCORES = _schema(
    ["assessment_id", "school_id", "date", "grade", "subject", "grading_scale", "avg_score",
     "max_marks"],
)

RAW_SCHEMAS = {
    "school_master": SCHOOL_MASTER,
    "student_attendance": STUDENT_ATTENDANCE,
    "mdm_procurement": MDM_PROCUREMENT,
    "school_infrastructure": SCHOOL_INFRASTRUCTURE,
    "test_scores": TEST_SCORES,
}
