"""LM scoring: a Katz backoff model of word pairs, with Good-Turing discounts and exactly normalised backoff weights.

The probability of a token is found by recursion over what is known of it:

- a pair (history, word) seen in training has its discounted share of the history's count;
- else the history's backoff weight times the word's share of all tokens;
- words below the share `FREQUENT` of all tokens form one class in the pair model; the class is followed
  by the word's Good-Turing discounted share of the class, or, for a word never seen, by the mass that is left.

Weights are such that the probabilities after every history add up to 1. Pairs, not longer histories: the class
keeps every array that is broadcast below 1 / FREQUENT entries whatever the corpus, while longer
histories would need weights as numerous as the pairs.

Counts lie in tables of packed arrays, partitioned by ranges of the hash: `words` and `pairs`. Every text is counted
and scored whole. Scoring sends a text's rare words and rare pairs to the bucket that knows their counts; what
comes back are sums per document. Pairs above the share `FREQUENT`, which would fill a bucket, are scored
where they are met, from a broadcast of at most 1 / FREQUENT pairs.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm.packed import bucket_cuts, by_key, grouped, small_batches, summed
from chalkline.llm.sampling import held_out
from chalkline.llm.words import hashed_words, mixed, slices, unmixed
from chalkline.sources.tables import scratch_path

FOLDS = 10
FREQUENT = 1e-5
DISCOUNTED = 5
BASE_ADDED = 0.1
FLUSH_TOKENS = 1_000_000
FLUSH_DOCUMENTS = 60_000
BUCKET_TOKENS = 4_000_000
PARTS = 256

COUNTS = "bucket long, x binary, y binary"
SENT = "bucket long, kind int, flush long, x binary, y binary"
_PAIR_COUNTS, _WORD_COUNTS, _PAIRS, _WORDS, _LOCAL, _PAIR_SUMS, _WORD_SUMS = range(7)


def good_turing(numbers) -> np.ndarray:
    """Katz's discount ratio by count, index 0 unused, from how many types occur 1, 2, ... DISCOUNTED + 1 times.

    Where the numbers do not fall as the formula needs (small corpora), half a count is taken from each type.
    """
    n = np.concatenate([[0], np.asarray(numbers, dtype=float)])
    k = DISCOUNTED
    plain = np.array([1.0] + [(r - 0.5) / r for r in range(1, k + 1)])
    if (n[1:k + 2] <= 0).any():
        return plain
    common = (k + 1) * n[k + 1] / n[1]
    ratios = np.array([1.0] + [((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if common < 1 else 0 for r in range(1, k + 1)])
    return ratios if ((ratios[1:] > 0) & (ratios[1:] < 1)).all() else plain


def discounted(counts: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= DISCOUNTED, ratios[np.minimum(counts, DISCOUNTED)], 1.0)


def numbers_of_types(counts: np.ndarray) -> list[int]:
    """How many counts equal 1, 2, ... DISCOUNTED + 1."""
    return np.bincount(np.minimum(counts, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1:DISCOUNTED + 2].tolist()


class Classes:
    """The pair model's vocabulary: frequent words by hash, then the rare class, the end and the beginning of a text."""

    def __init__(self, words, counts, tokens, types, texts):
        self.words, self.counts, self.tokens, self.types, self.texts = words, counts, tokens, types, texts
        self.rare, self.end, self.begin = len(words), len(words) + 1, len(words) + 2
        self.rare_tokens = tokens - texts - int(counts.sum())

    def arrays(self):
        return self.words, self.counts, self.tokens, self.types, self.texts

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), self.rare)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, self.rare)

    def occurrences(self) -> np.ndarray:
        """How often each class is a history: all its tokens, and the beginning once a text."""
        return np.concatenate([self.counts, [self.rare_tokens, 0, self.texts]]).astype(float)

    def shares(self) -> np.ndarray:
        """Each class's share of all tokens; one token each is kept in reserve for the rare class and the end."""
        tokens = np.concatenate([self.counts, [self.rare_tokens + 1, self.texts + 1, 0]]).astype(float)
        return tokens / (self.tokens + 2)

    def pairs(self, classes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, rows) of all pairs of texts, the beginning and the end included. at: word offsets by row."""
        rows, n = len(at) - 1, len(classes)
        followed = np.full(n + rows, self.end, dtype=np.uint64)
        word_rows = np.repeat(np.arange(rows), np.diff(at))
        places = np.arange(n) + word_rows
        followed[places] = classes
        history = np.full(n + rows, self.begin, dtype=np.uint64)
        history[places + 1] = classes
        return mixed(history << np.uint64(32) | followed), np.repeat(np.arange(rows), np.diff(at) + 1)


def _count_rows(keys, counts, buckets):
    cuts = bucket_cuts(keys, buckets)
    own = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
    return pa.RecordBatch.from_arrays([
        pa.array(own, pa.int64()), pa.array([keys[cuts[b]:cuts[b + 1]].tobytes() for b in own], pa.binary()),
        pa.array([counts[cuts[b]:cuts[b + 1]].astype(np.uint32).tobytes() for b in own], pa.binary()),
    ], names=["bucket", "x", "y"])


def _counted(keys_of, buckets):
    """Counts of the keys that `keys_of(hashes, offsets)` gives, added up over some millions of tokens at a time."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                keys = keys_of(*hashed_words(data, offsets))
                held.append(keys)
                size += len(keys)
                if size >= FLUSH_TOKENS:
                    yield _count_rows(*np.unique(np.concatenate(held), return_counts=True), buckets)
                    held, size = [], 0
        if size:
            yield _count_rows(*np.unique(np.concatenate(held), return_counts=True), buckets)

    return run


TABLE = "bucket long, part int, types long, tokens long, numbers array<long>, x binary, y binary"


def _table(buckets):
    """One row per bucket: its sorted keys, their counts, and the bucket's share of the totals."""
    def run(batches):
        for bucket, rows in by_key(batches):
            keys, counts = summed([np.frombuffer(r[1], np.uint64) for r in rows], [np.frombuffer(r[2], np.uint32) for r in rows])
            yield pa.RecordBatch.from_arrays([
                pa.array([bucket], pa.int64()), pa.array([bucket * PARTS // buckets if buckets > PARTS else bucket], pa.int32()),
                pa.array([len(keys)], pa.int64()), pa.array([int(counts.sum())], pa.int64()),
                pa.array([numbers_of_types(counts)], pa.list_(pa.int64())), pa.array([keys.tobytes()], pa.binary()),
                pa.array([counts.tobytes()], pa.binary()),
            ], names=["bucket", "part", "types", "tokens", "numbers", "x", "y"])

    return run


def _unpacked(row):
    return np.frombuffer(row["x"], np.uint64), np.frombuffer(row["y"], np.int64)


def _frequent(table: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The keys counted at least `least` times, sorted; at most tokens / least of them."""
    def run(batches):
        for batch in batches:
            xs, ys = [], []
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, counts = np.frombuffer(x, np.uint64), np.frombuffer(y, np.int64)
                keep = counts >= least
                xs.append(keys[keep].tobytes())
                ys.append(counts[keep].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], names=["x", "y"])

    parts = [_unpacked(r) for r in table.select("x", "y").mapInArrow(run, "x binary, y binary").collect()]
    keys = np.concatenate([k for k, _ in parts] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([c for _, c in parts] or [np.zeros(0, np.int64)])
    order = np.argsort(keys)
    return keys[order], counts[order]


def _numbers(table: DataFrame, below: float | None = None) -> np.ndarray:
    found = table.select([F.sum(F.col("numbers")[r]) for r in range(DISCOUNTED + 1)]).first()
    counts = np.array([x or 0 for x in found])
    if below is not None:
        counts[np.arange(1, DISCOUNTED + 2) >= below] = 0
    return counts


def _history_sums(classes_arrays, ratios, ranges):
    """For each history the discounted counts and the shares of the words seen after it, by range of histories."""
    def run(batches):
        classes = Classes(*classes_arrays.value)
        shares, size = classes.shares(), classes.begin + 1
        width = -(-size // ranges)
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, counts = unmixed(np.frombuffer(x, np.uint64)), np.frombuffer(y, np.int64)
                history, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
                kept = np.bincount(history, weights=discounted(counts, ratios), minlength=size)
                lower = np.bincount(history, weights=shares[word], minlength=size)
                own = np.flatnonzero(kept)
                cuts = np.searchsorted(own, np.arange(ranges + 1) * width)
                filled = [r for r in range(ranges) if cuts[r] < cuts[r + 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(filled, pa.int64()), pa.array([own[cuts[r]:cuts[r + 1]].tobytes() for r in filled], pa.binary()),
                    pa.array([np.stack([a[own[cuts[r]:cuts[r + 1]]] for a in (kept, lower)]).tobytes() for r in filled], pa.binary()),
                ], names=["bucket", "x", "y"])

    return run


def _added_histories(batches):
    for bucket, rows in by_key(batches):
        own, index = np.unique(np.concatenate([np.frombuffer(r[1], np.int64) for r in rows]), return_inverse=True)
        sums = np.concatenate([np.frombuffer(r[2], np.float64).reshape(2, -1) for r in rows], axis=1)
        added = np.stack([np.bincount(index, weights=s, minlength=len(own)) for s in sums])
        yield pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int64()), pa.array([own.tobytes()], pa.binary()), pa.array([added.tobytes()], pa.binary())],
            names=["bucket", "x", "y"],
        )


class Weights:
    """By history: its count, the factor of seen pairs and the weight of unseen ones. By class: its share."""

    def __init__(self, occurrences, kept, lower, shares, ratios):
        self.occurrences, self.shares, self.ratios = np.maximum(occurrences, 1.0), shares, ratios
        seen = kept / self.occurrences
        reserve = 1 / (self.occurrences + 1)
        whole = lower > 1 - 1e-9
        with np.errstate(divide="ignore", invalid="ignore"):
            self.factor = np.where(whole, 1 / seen, np.where(1 - seen < reserve, (1 - reserve) / seen, 1.0))
            self.factor[kept == 0] = 1.0
            self.unseen = np.where(whole, 0.0, (1 - self.factor * seen) / np.where(whole, 1.0, 1 - lower))

    def log_probability(self, history, word, counts) -> np.ndarray:
        """log10 P(word | history) of classes, from the pairs' training counts (0: not seen)."""
        seen = self.factor[history] * discounted(counts, self.ratios) / self.occurrences[history]
        return np.log10(np.where(counts > 0, seen, self.unseen[history] * self.shares[word]))


class Model:
    """`words` and `pairs` are tables, the rest is bounded by 1 / FREQUENT."""

    def __init__(self, words, pairs, classes, weights, rare_ratios, rare_numbers, hot, buckets):
        self.words, self.pairs, self.classes, self.weights, self.buckets = words, pairs, classes, weights, buckets
        self.rare_ratios, self.hot = rare_ratios, hot
        lost = sum((1 - rare_ratios[r]) * r * rare_numbers[r - 1] for r in range(1, DISCOUNTED + 1))
        self.rare_total = classes.rare_tokens + 1
        self.unknown = (1 + lost) / self.rare_total

    def plain(self):
        w = self.weights
        return (
            self.classes.arrays(), (w.occurrences, w.factor, w.unseen, w.shares, w.ratios), self.rare_ratios, self.rare_total,
            self.unknown, self.hot, self.buckets,
        )


def _weights_from(parts) -> Weights:
    weights = Weights.__new__(Weights)
    weights.occurrences, weights.factor, weights.unseen, weights.shares, weights.ratios = parts
    return weights


def train(texts: DataFrame, text: str = "text", frequent: float = FREQUENT) -> Model:
    """Counts words and pairs of all rows of `texts` into tables in the scratch folder, and finds the weights."""
    spark = small_batches(texts.sparkSession)
    root = scratch_path(spark, "katz")
    body = texts.select(F.col(f"`{text}`").alias("text"))

    def table(keys_of, name, buckets):
        counted = grouped(body.mapInArrow(_counted(keys_of, buckets), COUNTS), "bucket")
        counted.mapInArrow(_table(buckets), TABLE).write.partitionBy("part").parquet(f"{root}/{name}")
        return spark.read.schema(TABLE).parquet(f"{root}/{name}")

    size = body.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    # About six bytes a token; only the number of buckets depends on it.
    buckets, count = max(8, (size[0] or 0) // (6 * BUCKET_TOKENS)), size[1]
    words = table(lambda hashes, at: hashes, "words", buckets)
    types, tokens = words.agg(F.sum("types"), F.sum("tokens")).first()
    types, tokens = (types or 0) + (count > 0), (tokens or 0) + count
    least = max(2.0, frequent * tokens)
    classes = Classes(*_frequent(words, least), tokens, types, count)
    rare_numbers = _numbers(words, least)
    source = spark.sparkContext.broadcast(classes.arrays())

    def pair_keys(hashes, at):
        own = Classes(*source.value)
        return own.pairs(own.of(hashes), at)[0]

    pairs = table(pair_keys, "pairs", buckets)
    ratios = good_turing(_numbers(pairs))
    ranges = 16
    sums = pairs.select("x", "y").mapInArrow(_history_sums(source, ratios, ranges), COUNTS)
    histories = grouped(sums, "bucket").mapInArrow(_added_histories, COUNTS).collect()
    kept, lower = np.zeros(classes.begin + 1), np.zeros(classes.begin + 1)
    for row in histories:
        own = np.frombuffer(row["x"], np.int64)
        kept[own], lower[own] = np.frombuffer(row["y"], np.float64).reshape(2, -1)
    weights = Weights(classes.occurrences(), kept, lower, classes.shares(), ratios)
    hot_keys, hot_counts = _frequent(pairs, least)
    plain = unmixed(hot_keys)
    hot = hot_keys, weights.log_probability((plain >> np.uint64(32)).astype(np.int64), (plain & np.uint64(0xFFFFFFFF)).astype(np.int64), hot_counts)
    return Model(words, pairs, classes, weights, good_turing(rare_numbers), rare_numbers, hot, buckets)


def _postings(keys, rows, flush, kind, buckets):
    """Rows (bucket, kind, flush, distinct keys, occurrences by key and the rows they are in)."""
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order].astype(np.uint16)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    once, times = keys[starts], np.diff(np.append(starts, len(keys))).astype(np.uint32)
    cuts = bucket_cuts(once, buckets)
    ends = np.append(starts, len(keys))
    return [
        (b, kind, flush, once[cuts[b]:cuts[b + 1]].tobytes(), times[cuts[b]:cuts[b + 1]].tobytes() + rows[ends[cuts[b]]:ends[cuts[b + 1]]].tobytes())
        for b in range(buckets) if cuts[b] < cuts[b + 1]
    ]


def _sent_batch(rows):
    columns = list(zip(*rows))
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["bucket", "kind", "flush", "x", "y"])


def _scattered(source):
    """What each text can score alone, and postings of the words and pairs that need the tables."""
    def run(batches):
        arrays, _, _, _, _, (hot_keys, hot_scores), buckets = source.value
        classes = Classes(*arrays)
        base_total = np.log10(classes.tokens + BASE_ADDED * (classes.types + 1))
        base_of = np.append(np.log10(classes.counts + BASE_ADDED), 0.0) - base_total
        base_end = np.log10(classes.texts + BASE_ADDED) - base_total
        task, number = TaskContext.get().partitionId(), 0
        ids, held, rows, size = [], [], 0, 0

        def flush():
            name = task << 24 | number
            words, word_rows, keys, key_rows, local = ([np.concatenate(c) for c in zip(*held)])
            local = local.reshape(-1, 4)
            sent = _postings(words, word_rows, name, _WORDS, buckets) + _postings(keys, key_rows, name, _PAIRS, buckets)
            known = np.array([i is not None for i in ids], dtype=np.uint8).tobytes()
            plain = np.array([i or 0 for i in ids], dtype=np.int64).tobytes()
            return _sent_batch([*sent, (name % buckets, _LOCAL, name, plain + known, local.tobytes())])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, data, offsets in slices(batch.column(1)):
                hashes, at = hashed_words(data, offsets)
                n = len(offsets) - 1
                word_rows = np.repeat(np.arange(n), np.diff(at))
                own = classes.of(hashes)
                rare = own == classes.rare
                keys, key_rows = classes.pairs(own.astype(np.uint64), at)
                place = np.minimum(np.searchsorted(hot_keys, keys), max(len(hot_keys) - 1, 0))
                hot = hot_keys[place] == keys if len(hot_keys) else np.zeros(len(keys), bool)
                local = np.zeros((n, 4))
                local[:, 0] = np.diff(at) + 1
                local[:, 1] = np.bincount(word_rows, weights=~rare, minlength=n) + (classes.texts > 0)
                local[:, 2] = np.bincount(word_rows, weights=np.where(rare, 0.0, base_of[own]), minlength=n) + base_end
                if len(hot_keys):
                    local[:, 3] = np.bincount(key_rows[hot], weights=hot_scores[place[hot]], minlength=n)
                held.append((hashes[rare], word_rows[rare] + rows, keys[~hot], key_rows[~hot] + rows, local.reshape(-1)))
                ids += names[first:first + n]
                rows += n
                size += len(keys)
                if size >= FLUSH_TOKENS or rows >= FLUSH_DOCUMENTS - 20_000:
                    yield flush()
                    ids, held, rows, size = [], [], 0, 0
                    number += 1
        if rows:
            yield flush()

    return run


def _scored_buckets(source):
    """Sums per flush and row of the words and pairs of one bucket, from the bucket's counts."""
    def run(batches):
        arrays, parts, rare_ratios, rare_total, unknown, _, _ = source.value
        classes, weights = Classes(*arrays), _weights_from(parts)
        base_total = np.log10(classes.tokens + BASE_ADDED * (classes.types + 1))
        for bucket, rows in by_key(batches):
            tables = {r[1]: (np.frombuffer(r[3], np.uint64), np.frombuffer(r[4], np.int64)) for r in rows if r[1] in (_PAIR_COUNTS, _WORD_COUNTS)}
            out = [r for r in rows if r[1] == _LOCAL]
            for _, kind, flush, x, y in rows:
                if kind not in (_PAIRS, _WORDS):
                    continue
                keys = np.frombuffer(x, np.uint64)
                times = np.frombuffer(y, np.uint32, count=len(keys))
                owners = np.frombuffer(y, np.uint16, offset=4 * len(keys))
                counts = _looked_up(tables.get(_PAIR_COUNTS if kind == _PAIRS else _WORD_COUNTS), keys)
                own, index = np.unique(owners, return_inverse=True)

                def sums(values):
                    return np.bincount(index, weights=np.repeat(values, times), minlength=len(own))

                if kind == _PAIRS:
                    plain = unmixed(keys)
                    history, word = (plain >> np.uint64(32)).astype(np.int64), (plain & np.uint64(0xFFFFFFFF)).astype(np.int64)
                    found, name = sums(weights.log_probability(history, word, counts)), _PAIR_SUMS
                else:
                    share = np.where(counts > 0, discounted(counts, rare_ratios) / rare_total, unknown)
                    base = np.log10(counts + BASE_ADDED) - base_total
                    found, name = np.concatenate([sums((counts > 0).astype(float)), sums(base), sums(np.log10(share))]), _WORD_SUMS
                out.append((bucket, name, flush, own.astype(np.uint16).tobytes(), found.tobytes()))
            if out:
                yield _sent_batch(out)

    return run


def _looked_up(table, keys):
    if table is None or not len(table[0]):
        return np.zeros(len(keys), np.int64)
    known, counts = table
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, counts[at], 0)


def _gathered(batches):
    """(doc_id, n_tokens, n_known, base_score, score) of the rows of each flush."""
    for _, rows in by_key(batches, key=2):
        local = next(r for r in rows if r[1] == _LOCAL)
        total = np.frombuffer(local[4], np.float64).reshape(-1, 4).copy()
        n = len(total)
        for _, kind, _, x, y in rows:
            own = np.frombuffer(x, np.uint16) if kind != _LOCAL else None
            if kind == _PAIR_SUMS:
                total[own, 3] += np.frombuffer(y, np.float64)
            elif kind == _WORD_SUMS:
                total[own, 1:] += np.frombuffer(y, np.float64).reshape(3, -1).T
        ids = np.frombuffer(local[3], np.int64, count=n)
        known = np.frombuffer(local[3], np.uint8, offset=8 * n).astype(bool)
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64(), mask=~known), pa.array(total[:, 0].astype(np.int64)), pa.array(np.rint(total[:, 1]).astype(np.int64)),
            pa.array(total[:, 2]), pa.array(total[:, 3]),
        ], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def score(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score), one row per row of `documents`, over whole texts.

    Scores are log10 probabilities of all words and the end of the text. NULL and empty texts are the end
    alone. Ids may be NULL or repeat; other columns are not read. A model of no texts gives every token the
    mass in reserve.
    """
    source = small_batches(documents.sparkSession).sparkContext.broadcast(model.plain())
    own = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    sent = own.mapInArrow(_scattered(source), SENT)

    def counts(table, kind):
        return table.select("bucket", F.lit(kind).alias("kind"), F.lit(0).cast("long").alias("flush"), "x", "y")

    met = grouped(sent.unionByName(counts(model.pairs, _PAIR_COUNTS)).unionByName(counts(model.words, _WORD_COUNTS)), "bucket")
    sums = met.mapInArrow(_scored_buckets(source), SENT)
    return grouped(sums, "flush").mapInArrow(_gathered, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def held_out_scores(documents: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Learns from all documents outside the held-out fold and scores all documents."""
    model = train(documents.where(~held_out("doc_id", folds)))
    return score(documents, model).select(
        "doc_id", held_out("doc_id", folds).alias("held_out"), "n_tokens", "n_known",
        F.lit(int(model.classes.tokens)).cast("long").alias("train_tokens"), "base_score", "score",
    )
