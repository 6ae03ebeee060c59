"""Three-valued booleans."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chalkline.functions.text import lookup, stripped
from chalkline.vocabulary import FALSE_WORDS, TRUE_WORDS

_WORDS = dict.fromkeys(TRUE_WORDS, True) | dict.fromkeys(FALSE_WORDS, False)


def parse_boolean(c) -> Column:
    """TRUE or FALSE for a known spelling, NULL for anything else."""
    return lookup(F.upper(stripped(c)), _WORDS)
