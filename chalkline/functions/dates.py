"""Dates written in many ways.

The *form* of a date text says how it is laid out, its *value* is the day that gives, and the
*method* names the outcome. The value tells three kinds of text apart and takes one of them through a chain in which
every step uses the one before it once: when a filter on a date is pushed below the projection that computes it, the
expression moves with it, and must not multiply.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chalkline.functions.text import ascii_digits, column, stripped

# Outcome names (fixed values).
MISSING = "MISSING"
ISO = "ISO_FORMAT"
TEXT_MONTH = "TEXT_MONTH"
FALLBACK = "PANDAS_FALLBACK"
UNPARSED = "UNPARSED_ERROR"

_MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
)
_SHORT = "|".join(m[:3] for m in _MONTHS)
_LONG = "|".join(_MONTHS)

_ISO_PATTERN = r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}$"
_NUMERIC_PATTERN = r"^(?:\d{1,2}[-/]\d{1,2}[-/]|\d{1,2}\.\d{1,2}\.)\d{4}$"
_TEXT_PATTERN = rf"(?i)^\d{{1,2}}-(?:(?:{_SHORT})-(?:\d{{4}}|\d{{2}})|(?:{_LONG})-\d{{4}})$"
_FIRST_ABOVE_12 = r"^(?:1[3-9]|[2-9]\d)\D"
_SECOND_ABOVE_12 = r"^\d+\D(?:1[3-9]|[2-9]\d)\D"

# A text outside the main layouts is taken apart into tokens: a clock, names of weekdays and other parts
# that say nothing about the day become a mark, wherever they stand (that of a clock keeps its colon); what is left are
# numbers and at most one name of a month, which get their roles by kind and place.
_MARK = "\ue001"
_HOUR = r"(?:(?:[01]?\d|2[0-3])(:)[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?: ?[ap]\.?m\b\.?)?|(?:0?[1-9]|1[0-2]) ?[ap]\.?m\b\.?)"
_ZONE = r"(?: ?(?:z|utc|gmt)\b| ?[+-]\d{2}:?\d{2})"
_ASIDE = (
    # A look at the next character first, which rules out most places at once.
    rf"(?=[\dt])(?:(?<=\d)t)?(?<![\d:.])(?=\d\d?[: ap]){_HOUR}{_ZONE}?(?![\d:])|,|"
    r"(?=[fmostw])\b(?:mon|tue|wed|thu|fri|sat|sun|(?:mon|tues|wednes|thurs|fri|satur|sun)day|of)\b|"
    r"(?=[nrst])(?<=\d)(?:st|nd|rd|th)\b"
)
_MARKED = f"$1{_MARK}$2"

_YEAR = r"(?!0000)(\d{4})"
_NAME = r"([a-z]{3})[a-z]*"
_WORD = rf"(?=(?:{_LONG}|{_SHORT}|sept)(?![a-z])){_NAME}"
_DAY = r"(\d{1,2})"
_ABOVE_12 = r"(1[3-9]|[2-9]\d)"
_SHORT_YEAR = r"(\d{2})"
_AROUND = f"[ :{_MARK}]*"
_GAP = f"(?:[ :{_MARK}]+[-/.]?{_AROUND}|[-/.]{_AROUND})"
_NEAR = f"{_GAP}?"
# One clock at most, and no colon that is not a clock's.
_CLOCKS = f"(?!.*:.*:)(?!.*(?<!{_MARK}):)"


# The main layouts as they are written, then orders of tokens; what fits first applies. Each comes with the
# order of year, month and day in it; of a month's name the first three letters are taken. A
# month or year alone means its first day.
_MAIN = (
    (rf"{_YEAR}[-/](\d{{1,2}})[-/](\d{{1,2}})", "ymd"),
    (rf"{_ABOVE_12}[-/](\d{{1,2}})[-/]{_YEAR}", "dmy"),
    (rf"(\d{{1,2}})[-/](\d{{1,2}})[-/]{_YEAR}", "mdy"),
    (rf"(0?\d|1[0-2])\.{_ABOVE_12}\.{_YEAR}", "mdy"),
    (rf"(\d{{1,2}})\.(\d{{1,2}})\.{_YEAR}", "dmy"),
    (rf"(\d{{1,2}})-({_SHORT})-((?!0000)\d{{4}}|\d{{2}})", "dmy"),
    (rf"(\d{{1,2}})-(?=(?:{_LONG})-){_NAME}-{_YEAR}", "dmy"),
)
_ORDERS = (
    (_YEAR + r"(\d{2})(\d{2})(?:t\d{4}(?:\d{2})?)?", "ymd"),
    # Numbers only: the year by its digits, the day where only it can be above 12, else the month first.
    (_YEAR + _GAP + _DAY + _GAP + _DAY, "ymd"),
    (_ABOVE_12 + _GAP + _DAY + _GAP + _YEAR, "dmy"),
    (_DAY + _GAP + _DAY + _GAP + _YEAR, "mdy"),
    (_ABOVE_12 + _GAP + _DAY + _GAP + _SHORT_YEAR, "dmy"),
    (r"(0?\d|1[0-2])" + _GAP + _DAY + _GAP + _SHORT_YEAR, "mdy"),
    # With a name of a month: every order of the three, and a short year where it comes last.
    (_WORD + _NEAR + _DAY + _GAP + _YEAR, "mdy"),
    (_DAY + _NEAR + _WORD + _NEAR + _YEAR, "dmy"),
    (_YEAR + _NEAR + _WORD + _NEAR + _DAY, "ymd"),
    (_WORD + _NEAR + _YEAR + _GAP + _DAY, "myd"),
    (_YEAR + _GAP + _DAY + _NEAR + _WORD, "ydm"),
    (_DAY + _GAP + _YEAR + _NEAR + _WORD, "dym"),
    (_DAY + _NEAR + _WORD + _NEAR + _SHORT_YEAR, "dmy"),
    (_WORD + _NEAR + _DAY + _GAP + _SHORT_YEAR, "mdy"),
    (_WORD + _NEAR + _YEAR, "my"),
    (_YEAR + _NEAR + _WORD, "ym"),
    (_YEAR + "[-/]" + _DAY, "ym"),
    (_YEAR, "y"),
)


def _any_of(layouts) -> str:
    return "|".join(pattern for pattern, _ in layouts)


def _in_order(layouts) -> str:
    """The replacement that puts year, month and day in that order: groups of layouts that did not match are empty."""
    fields = "".join(order for _, order in layouts)
    return "-".join(
        "".join(f"${at}" for at, name in enumerate(fields, start=1) if name == field)
        for field in "ymd"
    )


# A text in a main layout is settled at once, by a pattern that fits nothing else, and gets a letter in front that no text in
# lower case has; the later patterns see that first and leave it alone. The others fit any other text: all fields
# are empty if it has no layout.
_DONE = "X"
_MAIN_TEXT = f"^(?:{_any_of(_MAIN)})$"
# Most texts are in a main layout of numbers alone, and need none of the later steps.
_NUMBERS = _MAIN[:5]
_NUMBERS_TEXT = f"^(?:{_any_of(_NUMBERS)})$"
_ASIDES = rf"\G(?!{_DONE})((?s:.)*?)(?:{_ASIDE})"
_OTHER_TEXT = (
    f"(?s)^(?!{_DONE})(?:(?=\\D*\\d){_CLOCKS}{_AROUND}(?:{_any_of(_ORDERS)}){_AROUND}|.*)$"
)


def date_text(c) -> Column:
    """The text a date is read from: white space stripped, digits in ASCII."""
    return stripped(ascii_digits(c))


def date_form(text) -> Column:
    """How the text is laid out.

    With two numbers before the year, one above 12 must be the day. Where neither is, dots
    are read day first and dashes or slashes month first.
    """
    text = column(text)
    dot = text.contains(".")
    order = (
        F.when(text.rlike(_FIRST_ABOVE_12), F.lit("DD_MM_YYYY"))
        .when(text.rlike(_SECOND_ABOVE_12), F.lit("MM_DD_YYYY"))
        .when(dot, F.lit("DD_MM_AMBIGUOUS"))
        .otherwise(F.lit("MM_DD_AMBIGUOUS"))
    )
    family = F.when(dot, F.lit("DOT_")).otherwise(F.lit("DASH_"))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", F.lit(MISSING))
        .when(text.rlike(_ISO_PATTERN), F.lit(ISO))
        .when(text.rlike(_NUMERIC_PATTERN), F.concat(family, order))
        .when(text.rlike(_TEXT_PATTERN), F.lit(TEXT_MONTH))
        .otherwise(F.lit(FALLBACK))
    )


def date_value(text) -> Column:
    """The calendar day the text gives, NULL where it gives none. Years start at 1.

    Numbers in a main layout are put in order at once, a text without a digit gives no day, and only the others go
    through all steps.
    """
    text = column(text)
    numbers = F.regexp_replace(text, _NUMBERS_TEXT, _in_order(_NUMBERS)).try_cast("date")
    return F.when(text.rlike(_NUMBERS_TEXT), numbers).when(text.rlike("[0-9]"), _any_day(text))


def _any_day(text) -> Column:
    day = F.regexp_replace(F.lower(text), _MAIN_TEXT, _DONE + _in_order(_MAIN))
    day = F.regexp_replace(day, _ASIDES, _MARKED)
    day = F.ltrim(F.regexp_replace(day, _OTHER_TEXT, _in_order(_ORDERS)), F.lit(_DONE))
    for number, month in enumerate(_MONTHS, start=1):
        day = F.replace(day, F.lit(month[:3]), F.lit(str(number)))
    # Two-digit years run from 1969 to 2068.
    day = F.regexp_replace(day, r"^(69|[7-9]\d)-", "19$1-")
    day = F.regexp_replace(day, r"^(\d\d)-", "20$1-")
    # A year or month alone leaves the fields after it empty.
    return F.rtrim(day, F.lit("-")).try_cast("date")


def date_outcome(form, value):
    """(method, ambiguous, error) of a form and the value it gave."""
    form, value = column(form), column(value)
    method = (
        F.when(value.isNotNull() | (form == MISSING), form)
        .when(form == ISO, F.lit("INVALID_ISO"))
        .when(form.startswith("DOT"), F.lit("INVALID_DOT"))
        .when(form.startswith("DASH"), F.lit("INVALID_DASH"))
        .otherwise(F.lit(UNPARSED))
    )
    doubtful = form.endswith("AMBIGUOUS") | (form == FALLBACK)
    return method, value.isNotNull() & doubtful, value.isNull()


def parse_date(c) -> Column:
    """Struct (value, method, ambiguous, error) of a date text, as one expression."""
    text = date_text(c)
    form = date_form(text)
    value = date_value(text)
    method, ambiguous, error = date_outcome(form, value)
    return F.struct(
        value.alias("value"), method.alias("method"), ambiguous.alias("ambiguous"),
        error.alias("error"),
    )
