"""Raw and clean columns side by side, with the flags that tell what happened between them.

Intermediate results that several columns use are kept as columns of their own for one
projection, so Spark computes each of them once per row; their names start with two underscores.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions.dates import date_form, date_outcome, date_text, date_value
from chalkline.functions.flags import parse_boolean
from chalkline.functions.identifiers import id_digits, id_text, id_value


def with_id_lineage(df: DataFrame, name: str = "school_id") -> DataFrame:
    """`<name>` normalised, `_raw`, `_clean` and `_changed_flag` (true for a missing id).

    An id is missing exactly where its raw text is, and says so: joins by school filter for known ids, and a filter
    pushed below the projections then asks for the raw text, instead of working every id out once more.
    """
    raw, text, digits = f"{name}_raw", f"__{name}_text", f"__{name}_digits"
    df = df.withColumns({raw: F.col(name), text: id_text(name)})
    df = df.withColumn(digits, id_digits(text))
    value = F.coalesce(id_value(text, digits), F.lit(""))
    df = df.withColumn(name, F.when(F.col(raw).isNotNull(), value))
    return df.withColumns({
        f"{name}_clean": F.col(name),
        f"{name}_changed_flag": F.col(raw).isNull() | ~F.col(raw).eqNullSafe(F.col(name)),
    }).drop(text, digits)


def date_kept(name: str = "date") -> str:
    """The column that may hold the value of a date's raw text, where that was worked out before."""
    return f"__{name}_value"


def with_date_lineage(df: DataFrame, name: str = "date") -> DataFrame:
    """`<name>` as a DATE, `_raw`, `_clean`, `_parse_method`, `_ambiguous_flag`, `_parse_error_flag`.

    A value of the text that the frame has already (`date_kept`) is taken as it is.
    """
    text, form, kept = f"__{name}_text", f"__{name}_form", date_kept(name)
    df = df.withColumns({f"{name}_raw": F.col(name), text: date_text(name)})
    df = df.withColumns({form: date_form(text), name: F.col(kept) if kept in df.columns else date_value(text)})
    method, ambiguous, error = date_outcome(form, name)
    return df.withColumns({
        f"{name}_clean": F.col(name),
        f"{name}_parse_method": method,
        f"{name}_ambiguous_flag": ambiguous,
        f"{name}_parse_error_flag": error,
    }).drop(text, form)


def with_boolean_lineage(df: DataFrame, *names: str) -> DataFrame:
    """Each column as TRUE, FALSE or NULL, with `_raw`, `_clean` and `_is_unknown_flag`."""
    df = df.withColumns(
        {f"{name}_raw": F.col(name) for name in names}
        | {name: parse_boolean(name) for name in names}
    )
    clean = {}
    for name in names:
        clean[f"{name}_clean"] = F.col(name)
        clean[f"{name}_is_unknown_flag"] = F.col(name).isNull()
    return df.withColumns(clean)
