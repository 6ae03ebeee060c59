"""Statistics of a text as Spark columns, without user functions.

Texts are whole; NULL counts as the empty text. Work columns start with `_ts_`; the operators select
what they need under names of their own first, so a table may bring columns of any name.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 5

# Frequent function words of the languages the rules know.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "was", "on", "with", "it", "are", "by", "this"),
    "de": ("der", "die", "das", "und", "zu", "den", "mit", "von", "für", "ist", "auf", "nicht", "ein", "des"),
    "fr": ("le", "la", "les", "de", "des", "et", "un", "une", "est", "que", "qui", "pour", "dans", "sur", "au"),
    "es": ("el", "la", "los", "las", "de", "que", "en", "y", "un", "una", "del", "se", "con", "por", "no"),
}


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds `_ts_text`, `_ts_words` and `_ts_lines` (lines that hold a word)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.withColumn("_ts_text", body).withColumns({
        "_ts_words": F.filter(F.split("_ts_text", f"{SPACES}+"), lambda w: w != ""),
        "_ts_lines": F.filter(F.split("_ts_text", "\n"), lambda line: line.rlike(WORD)),
    })


def settled(df: DataFrame) -> DataFrame:
    """The same rows and columns behind a generator, through which no filter is pushed.

    A filter on a statistic would otherwise be rewritten over the text, with every step's expression copied.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.inline(F.array(row)))


def n_words() -> Column:
    return F.size("_ts_words").cast("long")


def word_chars() -> Column:
    """Code points inside words."""
    return F.length(F.array_join("_ts_words", "")).cast("long")


def characters_of(kept: str) -> Column:
    """How many characters of the class `kept` the text holds."""
    return F.length(F.regexp_replace("_ts_text", f"[^{kept}]+", "")).cast("long")


def n_dup_lines() -> Column:
    """Lines with a word that equal an earlier line."""
    return (F.size("_ts_lines") - F.size(F.array_distinct("_ts_lines"))).cast("long")


def n_stop_words() -> Column:
    """Words that, lowered, are a stop word of any known language."""
    known = sorted({w for words in STOP_WORDS.values() for w in words})
    return F.size(F.filter("_ts_words", lambda w: F.lower(w).isin(*known))).cast("long")


def with_repeat_words(df: DataFrame, name: str = "n_repeat_words") -> DataFrame:
    """Adds how many words lie in a run of `WINDOW` words that the text holds twice or more.

    Runs are compared by 64-bit hash within one text. Only a text with equal runs sorts them; its
    run starts then cover words from left to right.
    """
    size = F.size("_ts_words")
    hashed = df.withColumn("_ts_hashes", F.transform("_ts_words", lambda w: F.xxhash64(w)))
    runs = F.transform(
        F.sequence(F.lit(0), size - WINDOW),
        lambda i: F.xxhash64(*[F.get("_ts_hashes", i + k) for k in range(WINDOW)]),
    )
    marked = hashed.withColumn("_ts_runs", F.when(size >= WINDOW, runs))
    repeated = F.size(F.array_distinct("_ts_runs")) < F.size("_ts_runs")
    pairs = F.transform("_ts_runs", lambda run, i: F.struct(run.alias("run"), i.alias("at")))
    ordered = marked.withColumn("_ts_sorted", F.when(repeated, F.sort_array(pairs)))
    equal = F.filter(
        F.transform("_ts_sorted", lambda x, j: F.when(
            (x["run"] == F.get("_ts_sorted", j - 1)["run"]) | (x["run"] == F.get("_ts_sorted", j + 1)["run"]), x["at"]
        )),
        lambda at: at.isNotNull(),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        F.sort_array(equal), start,
        lambda acc, at: F.struct(
            (acc["n"] + at + WINDOW - F.greatest(at, acc["end"])).alias("n"), (at + WINDOW).alias("end")
        ),
        lambda acc: acc["n"],
    )
    return ordered.withColumn(name, F.coalesce(covered, F.lit(0)).cast("long")).drop("_ts_hashes", "_ts_runs", "_ts_sorted")
