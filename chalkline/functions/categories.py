"""Names of grades, grains, vendors, subjects and payment states."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chalkline.functions.text import column, lookup, stripped, title_case
from chalkline.vocabulary import (
    GRAINS, OTHER_GRAIN, PAYMENTS, ROMAN_GRADES, SUBJECTS, UNKNOWN_PAYMENT, VENDORS,
)


def _key(c):
    return F.upper(stripped(c))


# `GRADE n` and Roman spellings of grades 1 to 12; a bare number needs no entry.
_GRADES = {
    spelling: f"Grade {n}"
    for n, roman in enumerate(ROMAN_GRADES, start=1) for spelling in (roman, f"GRADE {n}")
}


def grade_name(c) -> Column:
    """`Grade n` for n, a Roman n or `grade n` up to 12; other text is kept after `Grade `."""
    key = _key(c)
    return F.coalesce(lookup(key, _GRADES), F.concat(F.lit("Grade "), key), F.lit("Unknown"))


def grain_name(c) -> Column:
    return F.coalesce(lookup(_key(c), GRAINS), F.lit(OTHER_GRAIN))


def payment_name(c) -> Column:
    return F.coalesce(lookup(_key(c), PAYMENTS), F.lit(UNKNOWN_PAYMENT))


def vendor_name(c) -> Column:
    """The supplier group of a known vendor, else the title-cased text; NULL stays NULL."""
    return F.coalesce(lookup(_key(c), VENDORS), title_case(column(c)))


def subject_name(c) -> Column:
    """The subject of a known spelling, else the title-cased text; NULL stays NULL."""
    return F.coalesce(lookup(_key(c), SUBJECTS), title_case(column(c)))
