"""Test scores of mixed scales as percentages.

As with dates, the steps are separate expressions over named columns: the texts, the numbers
in them, the form that decides which rule applies, and the value under that rule.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chalkline.functions.text import ascii_digits, column, lookup, number, plain_number, stripped
from chalkline.vocabulary import CGPA_FACTOR, LETTER_GRADES, PERCENT_SCALES

# What a method is called when its text gives no number (fixed values).
_FAILED = {
    "PERCENTAGE_DIRECT": "INVALID_PERCENTAGE",
    "RAW_MARKS_RATIO": "INVALID_RAW_MARKS",
    "CGPA_MULTIPLY_9_5": "INVALID_CGPA",
    "RAW_MARKS_WITH_JSON_MAX": "UNPARSED_SCORE_ERROR",
    "DIRECT_FLOAT": "UNPARSED_SCORE_ERROR",
}


def score_text(score) -> Column:
    return stripped(ascii_digits(score))


def scale_text(scale) -> Column:
    return F.lower(stripped(scale))


def letter_value(text) -> Column:
    """The percentage of a letter grade, NULL for any other text."""
    return lookup(F.upper(column(text)), LETTER_GRADES)


def amount_text(text) -> Column:
    """The text of a score that is not a ratio; a percent sign does not count."""
    return stripped(F.replace(column(text), F.lit("%"), F.lit("")))


def ratio_texts(text):
    """The texts before and after the first slash, the second NULL without a slash."""
    text = column(text)
    parts = F.split(text, "/")
    return stripped(F.get(parts, F.lit(0))), stripped(F.get(parts, F.lit(1)))


def score_form(text, scale, max_marks, letter, above, below, full) -> Column:
    """Which rule reads the score. A ratio whose denominator is not positive is no ratio."""
    text, scale, max_marks = column(text), column(scale), column(max_marks)
    above, below, full = column(above), column(below), column(full)
    counted = F.replace(max_marks, F.lit(".0"), F.lit("")).rlike("^[0-9]+$")
    return (
        F.when(text.isNull(), F.lit("MISSING_SCORE"))
        .when(text.contains("%") | scale.isin(*PERCENT_SCALES), F.lit("PERCENTAGE_DIRECT"))
        .when(column(letter).isNotNull(), F.lit("LETTER_GRADE_MIDPOINT"))
        .when(
            text.contains("/") & (above.isNull() | below.isNull() | (below > 0)),
            F.lit("RAW_MARKS_RATIO"),
        )
        .when((scale == "cgpa") | (stripped(max_marks) == "10"), F.lit("CGPA_MULTIPLY_9_5"))
        .when(
            counted & (full.isNull() | ((full > 0) & (full != 100))),
            F.lit("RAW_MARKS_WITH_JSON_MAX"),
        )
        .otherwise(F.lit("DIRECT_FLOAT"))
    )


def score_value(form, amount, letter, above, below, full) -> Column:
    """The percentage under the given form, NULL when the text gives no number."""
    form, amount = column(form), column(amount)
    return (
        F.when(form.isin("PERCENTAGE_DIRECT", "DIRECT_FLOAT"), amount)
        .when(form == "LETTER_GRADE_MIDPOINT", column(letter))
        .when(form == "RAW_MARKS_RATIO", column(above) / column(below) * 100.0)
        .when(form == "CGPA_MULTIPLY_9_5", amount * CGPA_FACTOR)
        .when(form == "RAW_MARKS_WITH_JSON_MAX", amount / column(full) * 100.0)
    )


def score_method(form, value) -> Column:
    form, value = column(form), column(value)
    return F.when(value.isNull(), F.coalesce(lookup(form, _FAILED), form)).otherwise(form)


def parse_score(score, scale, max_marks) -> Column:
    """Struct (percentage, method, valid) of a score, as one expression."""
    text = score_text(score)
    above, below = (plain_number(part) for part in ratio_texts(text))
    full = number(max_marks)
    letter = letter_value(text)
    form = score_form(text, scale_text(scale), max_marks, letter, above, below, full)
    value = score_value(form, plain_number(amount_text(text)), letter, above, below, full)
    return F.struct(
        value.alias("percentage"), score_method(form, value).alias("method"),
        value.isNotNull().alias("valid"),
    )
