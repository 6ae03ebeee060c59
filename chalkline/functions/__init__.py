"""Column functions: each takes columns and returns a native Spark expression."""

from chalkline.functions.categories import grade_name, grain_name, payment_name, subject_name, vendor_name
from chalkline.functions.dates import parse_date
from chalkline.functions.flags import parse_boolean
from chalkline.functions.identifiers import school_id
from chalkline.functions.quantities import UnitRules, parse_cost, parse_quantity
from chalkline.functions.scores import parse_score
from chalkline.functions.text import number, stripped, title_case

__all__ = [
    "UnitRules", "grade_name", "grain_name", "number", "parse_boolean", "parse_cost",
    "parse_date", "parse_quantity", "parse_score", "payment_name", "school_id", "stripped",
    "subject_name", "title_case", "vendor_name",
]
