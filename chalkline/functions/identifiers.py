"""School identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chalkline.functions.text import ascii_digits, column, stripped


def id_text(c) -> Column:
    """The text an id is read from: white space stripped, upper case, digits in ASCII."""
    return F.upper(stripped(ascii_digits(c)))


def id_digits(text) -> Column:
    """The first run of digits, '' when there is none."""
    return F.regexp_extract(column(text), "([0-9]+)", 1)


def id_value(text, digits) -> Column:
    """`SCH` and the digits without leading zeros, padded to four; the text when it has none.

    The digits stay text, so identifiers longer than a BIGINT neither overflow nor lose digits.
    """
    digits = column(digits)
    bare = F.ltrim(digits, F.lit("0"))
    padded = F.lpad(bare, F.greatest(F.length(bare), F.lit(4)), F.lit("0"))
    return F.when(digits == "", column(text)).otherwise(F.concat(F.lit("SCH"), padded))


def school_id(c) -> Column:
    """The canonical form of a school id, as one expression."""
    text = id_text(c)
    return id_value(text, id_digits(text))
