"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.llm import text_stats as S

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# One row per rule: (ratio, numerator, denominator, least, most, words from which it applies). None: no bound.
THRESHOLDS = (
    ("length", "n_words", None, MIN_WORDS, 1_000_000, 0),
    ("mean_word_length", "word_chars", "n_words", 2.5, 12.0, 0),
    ("symbol_ratio", "n_symbols", "n_words", None, 0.1, 0),
    ("exclamation_ratio", "n_exclamations", "n_words", None, 0.3, 0),
    ("dup_line_ratio", "n_dup_lines", "n_lines", None, 0.5, 0),
    ("stop_word_ratio", "n_stop_words", "n_words", 0.02, None, 100),
)


def compile_rule(rule: tuple) -> Column:
    """One row of the table as a condition that is true, never NULL, when the text passes."""
    _, numerator, denominator, least, most, from_words = rule
    value, per = F.col(numerator), F.col(denominator) if denominator else F.lit(1)
    passes = F.lit(True)
    if least is not None:
        passes &= value >= per * F.lit(least)
    if most is not None:
        passes &= value <= per * F.lit(most)
    return (F.col("n_words") < from_words) | passes if from_words else passes


def measured(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts the rules need, one row per row of `documents`.

    NULL and empty texts count nothing. Ids may be NULL or repeat; other columns are not read.
    """
    own = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return S.settled(S.with_repeat_words(S.with_words(own)).select(
        "doc_id", S.n_words().alias("n_words"), S.word_chars().alias("word_chars"),
        S.characters_of(SYMBOLS).alias("n_symbols"), S.characters_of("!").alias("n_exclamations"),
        F.size("_ts_lines").cast("long").alias("n_lines"), S.n_dup_lines().alias("n_dup_lines"),
        "n_repeat_words", S.n_stop_words().alias("n_stop_words"),
    ))


def apply_rules(counts: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Adds `base_failed`, `failed_rules` (names, in the table's order) and `kept`.

    A text without words fails the base and the length rule.
    """
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    failed = F.array_compact(F.array(*[F.when(~compile_rule(r), F.lit(r[0])) for r in thresholds]))
    verdict = ~base_failed
    for rule in thresholds:
        verdict &= compile_rule(rule)
    return counts.withColumns({"base_failed": base_failed, "failed_rules": failed, "kept": verdict})


def quality_verdicts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return apply_rules(measured(documents, doc_id, text))
