"""Quantities in kilograms and costs in rupees."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from chalkline.functions.text import ascii_digits, column, lookup, plain_number, stripped
from chalkline.vocabulary import BAG_UNITS, CURRENCY_MARKS, GRAM_UNITS, KILOGRAM_UNITS

_QUANTITY = r"([0-9]+\.?[0-9]*)\s*([a-zA-Z]+)?"


@dataclass(frozen=True)
class UnitRules:
    """Conversion factors and the ranges that decide the unit when none is written."""

    kg_per_bag: float = 50.0
    kg_per_gram: float = 0.001
    grams_above: float = 500.0
    bags_up_to: float = 10.0


DEFAULT_UNITS = UnitRules()


def quantity_amount(text) -> Column:
    """The first unsigned number in the text (digits in ASCII), NULL when it holds none."""
    return F.nullif(F.regexp_extract(column(text), _QUANTITY, 1), F.lit("")).cast("double")


def quantity_unit(text, unit) -> Column:
    """The written unit in small letters, else the word after the number; '' when there is none."""
    written = F.nullif(F.lower(stripped(unit)), F.lit(""))
    return F.coalesce(written, F.lower(F.regexp_extract(column(text), _QUANTITY, 2)), F.lit(""))


_UNIT_METHODS = (
    dict.fromkeys(KILOGRAM_UNITS, "DIRECT")
    | dict.fromkeys(GRAM_UNITS, "GRAMS_TO_KG")
    | dict.fromkeys(BAG_UNITS, "BAGS_50KG_TO_KG")
)


def quantity_method(amount, unit, quantity_raw, unit_raw, rules: UnitRules = DEFAULT_UNITS) -> Column:
    """How the amount becomes kilograms: by its unit, or by its size when the unit is unknown."""
    amount = column(amount)
    nothing = column(quantity_raw).isNull() & column(unit_raw).isNull()
    by_size = (
        F.when(amount > rules.grams_above, F.lit("INFERRED_GRAMS_TO_KG"))
        .when(amount <= rules.bags_up_to, F.lit("INFERRED_BAGS_TO_KG"))
        .otherwise(F.lit("INFERRED_ASSUMED_KG"))
    )
    return (
        F.when(nothing, F.lit("MISSING_QUANTITY_AND_UNIT"))
        .when(amount.isNull(), F.lit("UNPARSED_QUANTITY"))
        .otherwise(F.coalesce(lookup(unit, _UNIT_METHODS), by_size))
    )


def quantity_kg(amount, method, rules: UnitRules = DEFAULT_UNITS) -> Column:
    factors = {
        "DIRECT": 1.0, "INFERRED_ASSUMED_KG": 1.0,
        "GRAMS_TO_KG": rules.kg_per_gram, "INFERRED_GRAMS_TO_KG": rules.kg_per_gram,
        "BAGS_50KG_TO_KG": rules.kg_per_bag, "INFERRED_BAGS_TO_KG": rules.kg_per_bag,
    }
    return column(amount) * lookup(method, factors)


def quantity_outcome(amount, method):
    """(unit_clean, inferred) of a parsed quantity."""
    amount, method = column(amount), column(method)
    unit = F.when(amount.isNull(), F.lit("Unknown")).otherwise(F.lit("KG"))
    return unit, amount.isNull() | method.startswith("INFERRED")


def parse_quantity(quantity, unit, rules: UnitRules = DEFAULT_UNITS) -> Column:
    """Struct (kg, unit, method, inferred) of a quantity and its unit, as one expression."""
    text = ascii_digits(quantity)
    amount = quantity_amount(text)
    method = quantity_method(amount, quantity_unit(text, unit), quantity, unit, rules)
    unit_clean, inferred = quantity_outcome(amount, method)
    return F.struct(
        quantity_kg(amount, method, rules).alias("kg"), unit_clean.alias("unit"),
        method.alias("method"), inferred.alias("inferred"),
    )


def cost_text(c) -> Column:
    """The text without currency marks and white space at its ends."""
    text = ascii_digits(c)
    for mark in CURRENCY_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return stripped(text)


def parse_cost(c) -> Column:
    """The amount in a currency text, NULL when what is left is no number."""
    return plain_number(cost_text(c))
