"""Literal cases of every row function, each branch at least once."""

import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from chalkline.functions import (
    grade_name, grain_name, number, parse_boolean, parse_cost, parse_date, parse_quantity,
    parse_score, payment_name, school_id, stripped, subject_name, title_case, vendor_name,
)
from chalkline.functions.quantities import UnitRules
from chalkline.vocabulary import FALSE_WORDS, FORMAL_LABELS, GRAINS, SUBJECTS, TRUE_WORDS, VENDORS


def apply(spark, function, inputs):
    """The function over one-column rows, in input order."""
    rows = [(i, text) for i, text in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, c string")
    return [row[1] for row in sorted(df.select("i", function("c").alias("v")).collect())]


def check(spark, function, cases):
    assert dict(zip(cases, apply(spark, function, list(cases)))) == cases


def test_school_id(spark):
    check(spark, school_id, {
        "SCH1001": "SCH1001", "SCH-1001": "SCH1001", "sch_1001": "SCH1001", "S1001": "SCH1001",
        "1001": "SCH1001", "286": "SCH0286", "sch0050": "SCH0050", None: None, "12345": "SCH12345",
        "000": "SCH0000", "abc": "ABC", " 286 ": "SCH0286", "\t286\n": "SCH0286", "a12b34": "SCH0012",
        "12345678901234567890": "SCH12345678901234567890", "SCH००५०": "SCH0050", "007": "SCH0007",
        "0012345": "SCH12345", "": "",
    })


DATES = {
    "2025-08-10": ("2025-08-10", "ISO_FORMAT", False, False),
    "2025/8/1": ("2025-08-01", "ISO_FORMAT", False, False),
    "2025-02-31": (None, "INVALID_ISO", False, True),
    "0000-01-01": (None, "INVALID_ISO", False, True),
    "10-Apr-2025": ("2025-04-10", "TEXT_MONTH", False, False),
    "02-jun-25": ("2025-06-02", "TEXT_MONTH", False, False),
    "02-Jun-68": ("2068-06-02", "TEXT_MONTH", False, False),
    "02-Jun-69": ("1969-06-02", "TEXT_MONTH", False, False),
    "5-September-2025": ("2025-09-05", "TEXT_MONTH", False, False),
    "31-Feb-2025": (None, "UNPARSED_ERROR", False, True),
    "21-04-2025": ("2025-04-21", "DASH_DD_MM_YYYY", False, False),
    "07-26-2025": ("2025-07-26", "DASH_MM_DD_YYYY", False, False),
    "05-06-2025": ("2025-05-06", "DASH_MM_DD_AMBIGUOUS", True, False),
    "5/6/2025": ("2025-05-06", "DASH_MM_DD_AMBIGUOUS", True, False),
    "31-02-2025": (None, "INVALID_DASH", False, True),
    "00-05-2025": (None, "INVALID_DASH", False, True),
    "13-13-2025": (None, "INVALID_DASH", False, True),
    "16.08.2025": ("2025-08-16", "DOT_DD_MM_YYYY", False, False),
    "08.16.2025": ("2025-08-16", "DOT_MM_DD_YYYY", False, False),
    "05.06.2025": ("2025-06-05", "DOT_DD_MM_AMBIGUOUS", True, False),
    "32.01.2025": (None, "INVALID_DOT", False, True),
    "20250405": ("2025-04-05", "PANDAS_FALLBACK", True, False),
    "Apr 5, 2025": ("2025-04-05", "PANDAS_FALLBACK", True, False),
    "5 April 2025": ("2025-04-05", "PANDAS_FALLBACK", True, False),
    "2025-04-05T10:11:12Z": ("2025-04-05", "PANDAS_FALLBACK", True, False),
    "5/9/25": ("2025-05-09", "PANDAS_FALLBACK", True, False),
    "n/k": (None, "UNPARSED_ERROR", False, True),
    "2025-04-05 99:99": (None, "UNPARSED_ERROR", False, True),
    "": (None, "MISSING", False, True),
    "  ": (None, "MISSING", False, True),
    None: (None, "MISSING", False, True),
    " 10-Apr-2025 ": ("2025-04-10", "TEXT_MONTH", False, False),
}


def test_dates(spark):
    for text, row in zip(DATES, apply(spark, parse_date, list(DATES))):
        day, *outcome = DATES[text]
        expected = day and datetime.date.fromisoformat(day)
        assert tuple(row) == (expected, *outcome), text


@pytest.fixture
def fallback_dates():
    """Spellings outside the main layouts, and those of them that are still no day."""
    days = dict.fromkeys((
        "10/Apr/2025", "10.April.2025", "2025.04.10", "2025-Apr-10", "04.10.25", "10 April 2025 09:00",
        "Thursday, 10 April 2025", "Thu 10 Apr 2025", "10-APRIL-25", "10th April 2025", "April 10th, 2025", "20250410T083000", "04/10/2025 14:30",
        "04-10-2025 08:30:00", "04.10.2025 08:30", "4/10/2025 2:30 PM", "2025-04-10T08:30:00+05:30", "2025/04/10 08:30",
    ), "2025-04-10")
    return days | {
        "13/04/2025 14:30": "2025-04-13", "13.04.25": "2025-04-13", "Sept 5, 2025": "2025-09-05", "Apr 2025": "2025-04-01",
        "2025-04": "2025-04-01", "2025": "2025-01-01", "2025-13": None, "31 April 2025": None, "Aprilis 2025": None,
        "04/10/2025 25:00": None, "2025-": None, "-": None, "next Monday": None,
    }


def test_fallback_dates(spark, fallback_dates):
    for (text, day), row in zip(fallback_dates.items(), apply(spark, parse_date, list(fallback_dates))):
        expected = day and datetime.date.fromisoformat(day)
        method = "UNPARSED_ERROR" if day is None else "PANDAS_FALLBACK"
        assert tuple(row) == (expected, method, day is not None, day is None), text


def token_orders():
    """A day, a month's name, a year, a clock and a weekday in all sorts of orders."""
    for day, name, year in itertools.permutations(range(3)):
        tokens = [None] * 3
        tokens[day], tokens[name], tokens[year] = "10", "April", "2025"
        for at, (clock, gap) in enumerate([("08:30", " "), ("2:30 PM", "-"), ("23:59:59.25", ", "), ("11 am", " ")]):
            spelt = list(tokens)
            if gap == "-":
                spelt = ["-".join(spelt)]
            spelt.insert(at % (len(spelt) + 1), clock)
            yield (", " if gap == ", " else " ").join(spelt)
    yield from (
        "Thu Apr 10 08:30:00 2025", "Thu Apr 10 08:30:00 UTC 2025", "08:30 10/04/2025 Thursday".replace("10/04", "04/10"), "14:30 2025-04-10",
        "08:30 Thursday, 10th of April 2025", "Thursday the 10 April 2025".replace("the ", ""), "10Apr2025", "Apr. 10, 2025", "8:30am 04.10.2025",
        "Apr 10 25", "Thu 04.10.2025", "04 10 2025", "2025 04 10", "2025-04-10 08:30:00.123456 +0530", "08:30Z 10-Apr-2025",
    )


def test_clocks_and_words_may_stand_anywhere(spark):
    texts = list(token_orders())
    assert len(set(texts)) >= 35
    for text, row in zip(texts, apply(spark, parse_date, texts)):
        assert tuple(row) == (datetime.date(2025, 4, 10), "PANDAS_FALLBACK", True, False), text


NO_DATES = (
    "08:30", "Thursday", "10 April", "April", "24:00 10 April 2025", "10:60 10 April 2025", "08:30 09:30 10 April 2025", "10 April 2025 5", "10 10 April 2025",
    "April May 2025", "2025--04--10 x", "13 pm 10 April 2025", "10 Apr 2025 at", "0000 April 10", "31 April 2025 08:30", "10:30:2025", "of", ",", "1 2 3 4",
)


def test_tokens_that_make_no_day(spark):
    for text, row in zip(NO_DATES, apply(spark, parse_date, list(NO_DATES))):
        assert tuple(row) == (None, "UNPARSED_ERROR", False, True), text


def test_booleans(spark):
    spelt = {word.title(): True for word in TRUE_WORDS} | {word.lower(): False for word in FALSE_WORDS}
    check(spark, parse_boolean, spelt | {
        None: None, "random_text": None, "1.0": None, "Not available": False, " hai ": True, "": None,
    })


def test_grades(spark):
    check(spark, grade_name, {
        "I": "Grade 1", "iv": "Grade 4", "XII": "Grade 12", "9": "Grade 9", "grade 12": "Grade 12",
        " vi ": "Grade 6", "13": "Grade 13", "GRADE 13": "Grade GRADE 13", "Class IX": "Grade CLASS IX",
        "Nursery": "Grade NURSERY", None: "Unknown",
    })


def test_categories(spark):
    check(spark, grain_name, {k.title(): v for k, v in GRAINS.items()} | {"Kanak": "Other", None: "Other"})
    check(spark, vendor_name, {f" {k.lower()} ": v for k, v in VENDORS.items()} | {
        " verma stores": " Verma Stores", "d'souza & co": "D'Souza & Co", None: None})
    check(spark, subject_name, {k.lower(): v for k, v in SUBJECTS.items()} | {"art craft": "Art Craft", None: None})
    check(spark, payment_name, {"paid": "Paid", "Cleared": "Paid", "PENDING": "Pending", " due": "Pending",
                                "part": "Unknown", None: "Unknown"})


QUANTITIES = {
    ("2", "bags"): (100.0, "KG", "BAGS_50KG_TO_KG", False),
    ("16100", "Grams"): (16.1, "KG", "GRAMS_TO_KG", False),
    ("14.9 kg", None): (14.9, "KG", "DIRECT", False),
    ("14.9 kg", "  "): (14.9, "KG", "DIRECT", False),
    ("3bori", None): (150.0, "KG", "BAGS_50KG_TO_KG", False),
    (None, None): (None, "Unknown", "MISSING_QUANTITY_AND_UNIT", True),
    (None, "kg"): (None, "Unknown", "UNPARSED_QUANTITY", True),
    ("x", "kg"): (None, "Unknown", "UNPARSED_QUANTITY", True),
    ("5", None): (250.0, "KG", "INFERRED_BAGS_TO_KG", True),
    ("10", None): (500.0, "KG", "INFERRED_BAGS_TO_KG", True),
    ("11", None): (11.0, "KG", "INFERRED_ASSUMED_KG", True),
    ("500", None): (500.0, "KG", "INFERRED_ASSUMED_KG", True),
    ("501", None): (0.501, "KG", "INFERRED_GRAMS_TO_KG", True),
    ("3", "quintal"): (150.0, "KG", "INFERRED_BAGS_TO_KG", True),
    ("2,500", "kg"): (2.0, "KG", "DIRECT", False),
    ("5.", "50KG Bags"): (250.0, "KG", "BAGS_50KG_TO_KG", False),
}


def test_quantities(spark):
    rows = [(i, *key) for i, key in enumerate(QUANTITIES)]
    df = spark.createDataFrame(rows, "i int, q string, u string")
    got = [tuple(r.p) for r in sorted(df.select("i", parse_quantity("q", "u").alias("p")).collect())]
    assert dict(zip(QUANTITIES, got)) == QUANTITIES
    custom = df.select(parse_quantity("q", "u", UnitRules(kg_per_bag=25.0)).alias("p")).first()
    assert custom.p.kg == 50.0


def test_costs(spark):
    check(spark, parse_cost, {
        "₹644": 644.0, "Rs. 1,600": 1600.0, "336/-": 336.0, "1,710/-": 1710.0, "Rs500": 500.0,
        "tbd": None, None: None, "12d": None, "nan": None, "": None, " ₹ 5 ": 5.0, "-3": -3.0,
    })
    check(spark, number, {"1e3": 1000.0, ".5": 0.5, "5.": 5.0, "+2": 2.0, "Infinity": None, "0x1": None})


SCORES = {
    ("63.4%", "pct", None): (63.4, "PERCENTAGE_DIRECT", True),
    (" 80 % ", None, None): (80.0, "PERCENTAGE_DIRECT", True),
    ("55", "Percentage", None): (55.0, "PERCENTAGE_DIRECT", True),
    ("a%", None, None): (None, "INVALID_PERCENTAGE", False),
    ("A+", "Letter Grade", None): (95.0, "LETTER_GRADE_MIDPOINT", True),
    ("c", "Letter Grade", None): (65.0, "LETTER_GRADE_MIDPOINT", True),
    ("A+", "pct", None): (None, "INVALID_PERCENTAGE", False),
    ("45/50", "Raw Marks", None): (90.0, "RAW_MARKS_RATIO", True),
    ("x/5", "Raw Marks", None): (None, "INVALID_RAW_MARKS", False),
    ("7/0", "Raw Marks", None): (None, "UNPARSED_SCORE_ERROR", False),
    ("7/0", "CGPA", None): (None, "INVALID_CGPA", False),
    ("8", "cgpa", None): (76.0, "CGPA_MULTIPLY_9_5", True),
    ("8", None, "10"): (76.0, "CGPA_MULTIPLY_9_5", True),
    ("8", None, "10.0"): (80.0, "RAW_MARKS_WITH_JSON_MAX", True),
    ("30", None, "40"): (75.0, "RAW_MARKS_WITH_JSON_MAX", True),
    ("30", None, "0"): (30.0, "DIRECT_FLOAT", True),
    ("50", None, "100"): (50.0, "DIRECT_FLOAT", True),
    ("50", None, "forty"): (50.0, "DIRECT_FLOAT", True),
    ("50", None, "5.0.0"): (None, "UNPARSED_SCORE_ERROR", False),
    ("absent", None, None): (None, "UNPARSED_SCORE_ERROR", False),
    ("", None, None): (None, "UNPARSED_SCORE_ERROR", False),
    (None, "pct", None): (None, "MISSING_SCORE", False),
}


def test_scores(spark):
    rows = [(i, *key) for i, key in enumerate(SCORES)]
    df = spark.createDataFrame(rows, "i int, s string, c string, m string")
    got = [tuple(r.p) for r in sorted(df.select("i", parse_score("s", "c", "m").alias("p")).collect())]
    assert dict(zip(SCORES, got)) == SCORES


@pytest.mark.parametrize("text, percent", [("21.6/50", 43.2), ("7.7", 73.15)])
def test_score_arithmetic(spark, text, percent):
    df = spark.createDataFrame([(text,)], "s string")
    scale = F.lit("CGPA")
    assert df.select(parse_score("s", scale, F.lit(None).cast("string")).alias("p")).first().p.percentage == pytest.approx(percent)


def test_title_case_matches_python(spark):
    texts = ["st. mary's upper-primary (x)y 3RD", "NATION_0", "  a  b", "éCOLE à b", "", "ludhiana", "a1b2c", "o'neil"]
    check(spark, title_case, {t: t.title() for t in texts} | {None: None})


def test_stripped_matches_python(spark):
    texts = ["  a b ", "\t\na\x0b", "a", "a　", "", "   "]
    check(spark, stripped, {t: t.strip() for t in texts} | {None: None})


def test_normalisers_leave_clean_values_alone(spark):
    check(spark, school_id, {"SCH0001": "SCH0001", "SCH12345": "SCH12345"})
    check(spark, lambda c: parse_date(c).value.cast("string"), {"2025-08-10": "2025-08-10"})
    check(spark, title_case, {"Nation_3": "Nation_3"})


def test_formal_labels_are_complete():
    assert len(FORMAL_LABELS) == 56
