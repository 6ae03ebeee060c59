"""Toxicity: a factorization machine over hashed terms.

A text's terms are its distinct words (punctuation separates, A-Z lowered) and their leading 4, 5 and 6 bytes,
hashed to 31 bits. On a bounded sample of labelled documents a factorization machine is fitted: a weight per term
and a vector per term whose products weigh pairs, so that two terms that are harmless alone can be toxic
together. Its terms are screened twice: those that tell the classes apart alone, and then those of the pairs that
tell apart what the first ones leave unexplained, whatever each says alone (all pairs among the sample's
`PAIR_CANDIDATES` most frequent terms are counted). Fitting runs in numpy on the driver, on the sample; scoring
runs over whole texts in tasks, with the fitted arrays broadcast (at most `TERMS` + `PAIR_TERMS` terms, whatever
the corpus).
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm.packed import small_batches
from chalkline.llm.sampling import held_out, labelled_ids, labelled_texts
from chalkline.llm.words import PUNCTUATED, Hasher, slices, word_bounds

FOLDS = 5
SAMPLE = 8_000
TERMS = 2048
RANK = 4
MIN_DOCUMENTS = 5
MIN_DEVIATION = 3.0
PAIR_CANDIDATES = 8192
PAIR_TERMS = 256
PAIR_DEVIATION = 7.0
PAIR_BLOCK = 512
PREFIXES = (4, 5, 6)
TERM_BITS = 31
STEPS = 120
SEED = 7


def slice_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed term) of every word and word beginning in one slice, repeats included."""
    starts, ends = word_bounds(data, offsets, PUNCTUATED)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    hasher = Hasher(data)
    found_rows, found = [rows], [hasher(starts, ends)]
    for n in PREFIXES:
        long = ends - starts > n
        found_rows.append(rows[long])
        found.append(hasher(starts[long], starts[long] + n) + np.uint64(n))
    return np.concatenate(found_rows), np.concatenate(found) >> np.uint64(64 - TERM_BITS)


def _sample_terms(batches):
    for batch in batches:
        blobs = []
        for _, data, offsets in slices(batch.column(2)):
            rows, terms = slice_terms(data, offsets)
            pairs = np.unique(rows.astype(np.uint64) << np.uint64(32) | terms)
            cuts = np.searchsorted(pairs, np.arange(len(offsets), dtype=np.uint64) << np.uint64(32))
            terms = pairs.astype(np.uint32)
            blobs += [terms[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], names=["doc_id", "label", "terms"]
        )


class Model:
    """Screened terms in order, their weights and vectors, and the bias."""

    def __init__(self, terms, bias, weights, vectors):
        self.terms, self.bias, self.weights, self.vectors = terms, bias, weights, vectors

    def arrays(self) -> tuple:
        return self.terms, self.bias, self.weights, self.vectors

    def margins(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """The log-odds of n rows from distinct (row, index of term) pairs."""
        linear = np.bincount(rows, weights=self.weights[terms], minlength=n)
        pairs = np.zeros(n)
        for f in range(self.vectors.shape[1]):
            v = self.vectors[terms, f]
            pairs += np.bincount(rows, weights=v, minlength=n) ** 2 - np.bincount(rows, weights=v * v, minlength=n)
        return self.bias + linear + pairs / 2


def _by_term(rows, terms):
    """The distinct terms in order, where their rows start, how many they are, and the rows."""
    order = np.argsort(terms, kind="stable")
    owner, ordered = rows[order].astype(np.int32), terms[order]
    del order
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    return ordered[starts], starts, np.diff(np.append(starts, len(ordered))), owner


def screen(rows, terms, labels, most=TERMS, least=MIN_DOCUMENTS):
    """The terms, at most `most`, whose document counts differ most between the classes."""
    known, starts, counts, owner = _by_term(rows, terms)
    positive = np.add.reduceat(labels.astype(np.float32)[owner], starts, dtype=np.float64) if len(starts) else np.zeros(0)
    del owner
    base = labels.mean()
    deviation = np.abs(positive - counts * base) / np.sqrt(counts * base * (1 - base) + 1)
    deviation[(counts < least) | (deviation < MIN_DEVIATION)] = 0
    order = np.lexsort((known, -deviation))[:most]
    return np.sort(known[order[deviation[order] > 0]])


def _at_least(deviation, least, first, second, best, most):
    """The `most` greatest of the pairs kept so far and those of one block that deviate enough."""
    i, j = np.nonzero(deviation >= least)
    found = np.concatenate([best, np.stack([deviation[i, j], first + i, second + j], axis=1)])
    return found[np.lexsort((found[:, 2], found[:, 1], -found[:, 0]))[:most]]


def screen_pairs(rows, terms, left, spread, most=PAIR_TERMS, candidates=PAIR_CANDIDATES, least=PAIR_DEVIATION):
    """At most `most` terms, those of the pairs whose documents deviate most from what a model says of them.

    left: label less probability by document; spread: the probability's variance. The pairs are those among the
    `candidates` most frequent terms, counted in blocks of dense products.
    """
    known, starts, counts, owner = _by_term(rows, terms)
    order = np.lexsort((known, -counts))[:candidates]
    chosen = order[counts[order] >= MIN_DOCUMENTS]
    left, spread = (np.asarray(x, np.float32)[:, None] for x in (left, spread))

    def block(first):
        own = chosen[first:first + PAIR_BLOCK]
        dense = np.zeros((len(left), len(own)), np.float32)
        for column, term in enumerate(own):
            dense[owner[starts[term]:starts[term] + counts[term]], column] = 1
        return dense

    best = np.zeros((0, 3))
    for first in range(0, len(chosen), PAIR_BLOCK):
        one = block(first)
        pulled, spreads = (one * left).T, (one * spread).T
        for second in range(first, len(chosen), PAIR_BLOCK):
            other = block(second)
            deviation = np.abs(pulled @ other) / np.sqrt(spreads @ other + 1)
            if first == second:
                deviation = np.triu(deviation, 1)
            best = _at_least(deviation, least, first, second, best, most)
    kept = list(dict.fromkeys(best[:, 1:].astype(int).ravel().tolist()))[:most]
    return np.sort(known[chosen[kept]])


def _probabilities(margins):
    return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def _inside(kept, rows, terms):
    """(rows, places in `kept`) of the terms that are kept."""
    if not len(kept):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    at = np.minimum(np.searchsorted(kept, terms), len(kept) - 1)
    inside = kept[at] == terms
    return rows[inside].astype(np.int32), at[inside].astype(np.int32)


def fit(rows, terms, labels, rank=RANK, steps=STEPS, seed=SEED, most=TERMS) -> Model:
    """The machine of the terms that are screened alone, and once more with those of the pairs that it left unexplained.

    rows, terms: distinct pairs of the sample, rows in order. Without documents, or with one class alone, the model is the bias.
    """
    prior = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-6, 1 - 1e-6))
    bias = np.log(prior / (1 - prior))
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(0, np.uint32), bias, np.zeros(0), np.zeros((0, rank)))
    alone = screen(rows, terms, labels, most)
    model = _fitted(alone, rows, terms, labels, bias, rank, steps, seed)
    said = _probabilities(model.margins(*_inside(alone, rows, terms), len(labels)))
    together = screen_pairs(rows, terms, labels - said, said * (1 - said))
    kept = np.union1d(alone, together)
    return model if len(kept) == len(alone) else _fitted(kept, rows, terms, labels, bias, rank, steps, seed)


def _fitted(kept, rows, terms, labels, bias, rank, steps, seed) -> Model:
    """Full-batch Adam on the logistic loss over the kept terms."""
    rows, at = _inside(kept, rows, terms)
    n, k = len(labels), len(kept)
    by_term = np.argsort(at, kind="stable")
    term_rows = rows[by_term]
    bounds = np.searchsorted(at[by_term], np.arange(k))
    vectors = np.random.default_rng(seed).normal(0, 0.05, (k, rank))
    state = {"bias": np.array([bias]), "weights": np.zeros(k), "vectors": vectors}
    first = {name: np.zeros_like(x) for name, x in state.items()}
    second = {name: np.zeros_like(x) for name, x in state.items()}
    for step in range(1, steps + 1):
        model = Model(kept, state["bias"][0], state["weights"], state["vectors"])
        error = (_probabilities(model.margins(rows, at, n)) - labels) / n
        pull = error[term_rows]
        own = np.add.reduceat(pull, bounds) if k else np.zeros(0)
        cross = np.empty((k, rank))
        for f in range(rank if k else 0):
            sums = np.bincount(rows, weights=state["vectors"][at, f], minlength=n)
            cross[:, f] = np.add.reduceat(pull * sums[term_rows], bounds)
        gradient = {
            "bias": np.array([error.sum()]), "weights": own + 1e-6 * state["weights"],
            "vectors": cross - own[:, None] * state["vectors"] + 1e-5 * state["vectors"],
        }
        for name, g in gradient.items():
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.999 * second[name] + 0.001 * g * g
            rate = 0.1 if name == "weights" else 0.03
            state[name] = state[name] - rate * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-9)
    return Model(kept, float(state["bias"][0]), state["weights"], state["vectors"])


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fits on at most `sample` labelled documents outside the held-out fold, taken by hash of their id."""
    small_batches(documents.sparkSession)
    texts = labelled_texts(documents, labelled_ids(labels, label, FOLDS, sample)).select("doc_id", "label", "text")
    found = texts.mapInArrow(_sample_terms, "doc_id long, label int, terms binary")
    # An id on several rows counts once.
    rows = found.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("terms").alias("terms")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    labels_of = np.array([float(r["label"] > 0) for r in rows])
    lengths = [len(r["terms"]) // 4 for r in rows]
    terms = np.frombuffer(b"".join(r["terms"] for r in rows), dtype=np.uint32)
    # The sample is held once while it is fitted.
    del rows
    return fit(np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), terms, labels_of)


def text_scorer(model: Model):
    """A function from an Arrow text column to the probabilities of its rows."""
    flags = np.zeros(1 << 20, dtype=bool)
    flags[model.terms >> 11] = True

    def scores(column):
        margins = []
        for _, data, offsets in slices(column):
            rows, terms = slice_terms(data, offsets)
            near = flags[terms >> np.uint64(11)]
            rows, terms = rows[near], terms[near].astype(np.uint32)
            rows, at = _inside(model.terms, rows, terms)
            pairs = np.unique(rows.astype(np.int64) << 32 | at)
            margins.append(model.margins(pairs >> 32, pairs & 0xFFFFFFFF, len(offsets) - 1))
        return _probabilities(np.concatenate(margins or [np.zeros(0)]))

    return scores


def score(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score): one row per row of `documents`, over whole texts.

    NULL and empty texts score as a text without terms. Ids may be NULL or repeat; other columns are not read.
    """
    source = small_batches(documents.sparkSession).sparkContext.broadcast(model.arrays())

    def run(batches):
        scores = text_scorer(Model(*source.value))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1)), pa.float64())], names=["doc_id", "score"])

    own = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return own.mapInArrow(run, "doc_id long, score double")


def judged(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    return scores.select(
        "doc_id", held_out("doc_id", FOLDS).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(documents: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of `documents`, with all their columns, that score below the threshold. Nothing is shuffled.

    A NULL or empty text scores by the bias alone; equal texts share one verdict; an empty table stays empty.
    """
    source = small_batches(documents.sparkSession).sparkContext.broadcast(model.arrays())
    at = documents.columns.index(text)

    def run(batches):
        scores = text_scorer(Model(*source.value))
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(at)) < threshold, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
