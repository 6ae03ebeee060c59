"""Text primitives shared by the normalisers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a field.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Digits of Devanagari, Gurmukhi and eastern Arabic script, read as 0-9.
_ZEROS = (0x0966, 0x0A66, 0x06F0)
FOREIGN_DIGITS = "".join(chr(zero + n) for zero in _ZEROS for n in range(10))
ASCII_DIGITS = "0123456789" * len(_ZEROS)

NUMBER_PATTERN = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"

# A private-use character and a blank, put where a word starts inside a blank-separated word.
_WORD_MARK = "\ue000 "


def column(c):
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def stripped(c) -> Column:
    """Text without white space (tabs, line ends and non-breaking blanks too) at either end."""
    return F.btrim(column(c), F.lit(WHITESPACE))


def ascii_digits(c) -> Column:
    """Digits of Indian scripts as 0-9; plain ASCII text is passed through untouched."""
    c = column(c)
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(
        F.translate(c, FOREIGN_DIGITS, ASCII_DIGITS)
    )


def plain_number(text) -> Column:
    """Stripped text to double: NULL, never NaN or an error, when the text is no number."""
    text = column(text)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def number(c) -> Column:
    """Tolerant text to double; white space around the number does not matter."""
    return plain_number(stripped(c))


def title_case(c) -> Column:
    """Capital after every non-letter, small letters elsewhere (`mary's` gives `Mary'S`).

    `initcap` starts words at blanks only, so a marker with a blank is put before each
    letter that follows a non-letter and taken out again afterwards.
    """
    cased = r"[\p{Lu}\p{Ll}\p{Lt}]"
    marked = F.regexp_replace(column(c), rf"(?<!{cased})(?={cased})", _WORD_MARK)
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def _literal(value):
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def lookup(c, mapping) -> Column:
    """The value a constant mapping gives for the text, NULL when it lists no such key.

    The mapping is written as one SQL literal: building it from single columns takes a call to
    the JVM for each entry.
    """
    entries = ", ".join(_literal(item) for pair in mapping.items() for item in pair)
    return F.try_element_at(F.expr(f"map({entries})"), column(c))
