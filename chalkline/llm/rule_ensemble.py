"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark columns.

Statistics are Spark columns (`text_stats`). On a bounded sample of labelled documents, numpy on the driver grows
small boosted trees, takes every path from a root as a rule (a conjunction of thresholds), and fits lasso
logistic weights, which leave few rules. The fitted rules become one Spark expression; scoring uses no user
function.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.llm import text_stats as S
from chalkline.llm.sampling import held_out, labelled_ids, labelled_texts

FOLDS = 5
SAMPLE = 16_000
TREES = 24
DEPTH = 3
PENALTY = 2e-3
STATISTICS = (
    "n_words", "n_lines", "mean_word_length", "symbol_ratio", "exclamation_ratio", "punctuation_ratio", "upper_ratio",
    "digit_ratio", "distinct_ratio", "stop_word_ratio", "dup_line_ratio",
)


def statistics(texts: DataFrame) -> DataFrame:
    """The statistics of `text`, in place of it, never NULL. A text without words has zero ratios."""
    words, size = F.greatest(S.n_words(), F.lit(1)), F.greatest(F.length("_ts_text"), F.lit(1))
    lines = F.greatest(F.size("_ts_lines"), F.lit(1))
    values = {
        "n_words": S.n_words(), "n_lines": F.size("_ts_lines"), "mean_word_length": S.word_chars() / words,
        "symbol_ratio": S.characters_of("#*$%&|<>") / words, "exclamation_ratio": S.characters_of("!?") / words,
        "punctuation_ratio": S.characters_of(".,;:") / words, "upper_ratio": S.characters_of(r"\p{Lu}") / size,
        "digit_ratio": S.characters_of("0-9") / size,
        "distinct_ratio": F.size(F.array_distinct("_ts_words")) / words,
        "stop_word_ratio": S.n_stop_words() / words, "dup_line_ratio": S.n_dup_lines() / lines,
    }
    others = [F.col(c) for c in texts.columns if c != "text"]
    return S.settled(S.with_words(texts).select(*others, *[values[name].cast("double").alias(name) for name in STATISTICS]))


def grow_tree(x, bins, residual, weight, depth=DEPTH, least=20):
    """Paths of one regression tree, each a tuple of (feature, sign, threshold), and its fitted values."""
    fitted, paths = np.zeros(len(x)), []

    def split(rows, path):
        if path:
            paths.append(path)
        best = None
        if len(path) < depth and len(rows) >= 2 * least:
            total, mass = residual[rows].sum(), weight[rows].sum()
            for feature, cuts in enumerate(bins):
                if not len(cuts):
                    continue
                place = np.searchsorted(cuts, x[rows, feature], side="left")
                sums = np.cumsum(np.bincount(place, weights=residual[rows], minlength=len(cuts) + 1))[:-1]
                masses = np.cumsum(np.bincount(place, weights=weight[rows], minlength=len(cuts) + 1))[:-1]
                counts = np.cumsum(np.bincount(place, minlength=len(cuts) + 1))[:-1]
                gain = sums ** 2 / (masses + 1) + (total - sums) ** 2 / (mass - masses + 1) - total ** 2 / (mass + 1)
                gain[(counts < least) | (counts > len(rows) - least)] = -1
                at = int(np.argmax(gain))
                if gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
                    best = (gain[at], feature, float(cuts[at]))
        if best is None:
            fitted[rows] = residual[rows].sum() / (weight[rows].sum() + 1)
            return
        _, feature, cut = best
        low = x[rows, feature] <= cut
        split(rows[low], path + ((feature, "<=", cut),))
        split(rows[~low], path + ((feature, ">", cut),))

    split(np.arange(len(x)), ())
    return paths, fitted


def simplified(path):
    """One bound a side and feature, in a fixed order, so that equal rules compare equal."""
    bounds = {}
    for feature, sign, cut in path:
        known = bounds.get((feature, sign))
        tighter = cut if known is None else (min if sign == "<=" else max)(cut, known)
        bounds[feature, sign] = tighter
    return tuple((f, s, c) for (f, s), c in sorted(bounds.items()))


def holds(rule, x) -> np.ndarray:
    found = np.ones(len(x), dtype=bool)
    for feature, sign, cut in rule:
        found &= x[:, feature] <= cut if sign == "<=" else x[:, feature] > cut
    return found


def tree_rules(x, y, trees=TREES, rate=0.3):
    """Distinct rules of boosted trees on the logistic loss."""
    bins = [np.unique(np.quantile(column, np.linspace(0.01, 0.99, 64))) for column in x.T]
    margin, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        paths, fitted = grow_tree(x, bins, y - p, p * (1 - p))
        margin += rate * fitted
        rules.update(dict.fromkeys(map(simplified, paths)))
    return list(rules)


def lasso_logistic(z, y, penalty=PENALTY, steps=400):
    """(bias, weights) by accelerated proximal gradient steps; the bias is not penalised."""
    n, k = z.shape
    design = np.hstack([np.ones((n, 1)), z])
    step = 4 * n / max(np.linalg.norm(design, 2) ** 2, 1e-9)
    current, ahead, t = np.zeros(k + 1), np.zeros(k + 1), 1.0
    current[0] = ahead[0] = np.log(y.mean() / (1 - y.mean()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ ahead, -30, 30)))
        following = ahead - step * (design.T @ (p - y)) / n
        following[1:] = np.sign(following[1:]) * np.maximum(np.abs(following[1:]) - step * penalty, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = following + (t - 1) / t_next * (following - current)
        current, t = following, t_next
    return current[0], current[1:]


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[tuple, float]]]:
    """(bias, [(rule, weight)]). Without labels, or with one class, no rules and the class's log-odds."""
    prior = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    if not len(y) or y.min() == y.max():
        return float(np.log(prior / (1 - prior))), []
    rules = tree_rules(x, y)
    if not rules:
        return float(np.log(prior / (1 - prior))), []
    bias, weights = lasso_logistic(np.stack([holds(r, x) for r in rules], axis=1).astype(float), y)
    return float(bias), [(rule, float(w)) for rule, w in zip(rules, weights) if abs(w) > 1e-6]


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE):
    """Fits on at most `sample` labelled documents outside the held-out fold, taken by hash of their id."""
    texts = labelled_texts(documents, labelled_ids(labels, label, FOLDS, sample))
    measured = statistics(texts.select("doc_id", "label", "text"))
    # An id on several rows counts once, with its least statistics.
    once = measured.groupBy("doc_id").agg(F.max("label").alias("label"), F.min(F.array(*STATISTICS)).alias("x"))
    rows = sorted(once.collect(), key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([float(r["label"] > 0) for r in rows]))


def compile_rule(rule) -> Column:
    """A rule as a Spark condition over the statistics' columns."""
    found = F.lit(True)
    for feature, sign, cut in rule:
        value = F.col(STATISTICS[feature])
        found &= value <= F.lit(cut) if sign == "<=" else value > F.lit(cut)
    return found


def compile_score(model) -> Column:
    bias, weighted = model
    margin = F.lit(bias)
    for rule, weight in weighted:
        margin += F.when(compile_rule(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-margin))


def score(documents: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score): one row per row of `documents`, over whole texts.

    NULL and empty texts have the statistics of no words and are scored by them. Ids may be NULL or repeat;
    other columns are not read.
    """
    own = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return statistics(own).select("doc_id", compile_score(model).alias("score"))


def judged(scores: DataFrame, threshold: float = 0.3) -> DataFrame:
    return scores.select(
        "doc_id", held_out("doc_id", FOLDS).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
