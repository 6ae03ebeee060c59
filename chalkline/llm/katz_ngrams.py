"""LM scoring: a Katz backoff model of triples, pairs and words, every word told apart.

The probability of a token is found by recursion over what was seen in training:

- a triple (two words, word) has its discounted share of its history's count;
- else the history's backoff weight times the probability of the pair, found in the same way;
- else the word's backoff weight times the last word's Good-Turing share, or, for words never seen, the mass left.

The first word of a text has the beginning alone for its history. Weights are such that the probabilities after
every history add up to 1, words never seen being one class. No vocabulary is cut and nothing but
discount ratios is broadcast.

An n-gram is known by two hashes, that of its history and that of itself less its first word (`lower`), from which
its own key follows. No table of triples or pairs is kept: `train` counts words, and how many pairs and triples occur how
often. `score` then reads the texts in rounds, each for the n-grams of one range, whose shuffles are freed before the next:

- triples by range of their history. What the texts teach and ask meets in one place, so that all triples seen are settled
  there; what stays open (texts not learnt from) is written down as questions, as are the pairs that follow histories asked for;
- pairs by range of their first word, dealt by their own key. They answer those questions, and give the weights of single words.

What the triples and pairs cannot answer goes on to the range of a word. What comes back are sums per document.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.llm.katz import (
    BASE_ADDED, DISCOUNTED, FLUSH_DOCUMENTS, FOLDS, SENT, _looked_up, _numbers, _sent_batch, discounted, good_turing,
    numbers_of_types,
)
from chalkline.llm.packed import bucket_cuts, by_key, grouped, small_batches
from chalkline.llm.sampling import held_out
from chalkline.llm.words import hashed_words, mixed, slices
from chalkline.session import shuffles_freed
from chalkline.sources.tables import CODEC, scratch_path

FLUSH_TOKENS = 600_000
BUCKET_TOKENS = 1_500_000
SENT_BYTES = 4_000_000
# The first round of triples carries the words as well.
TRIPLE_SHARES, PAIR_ROUNDS = (0.46, 0.54), 3
END, BEGIN = np.uint64(1), np.uint64(2)
_OF_HISTORY, _OF_LOWER = mixed(np.array([11, 12], dtype=np.uint64)) | np.uint64(1)

TABLE = "bucket long, n int, types long, tokens long, numbers array<long>, x binary, y binary"
_COUNTS, _HISTORIES, _LOWER, _FIRST_SUMS, _WORTH, _LOCAL, _SUMS = range(7)
_LEARNT, _TRIPLE, _PAIR, _UNSEEN_3, _SEEN_2, _UNSEEN_2, _DIVIDE, _WORD, _BASE, _TAUGHT = range(10, 20)
# What a text is for: it asks only, asks and teaches, or teaches only.
_ASKS, _BOTH, _TEACHES = range(3)


def key_of(history: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return mixed(history * _OF_HISTORY + lower * _OF_LOWER)


def lines(hashes, at):
    """(histories, words, rows, firsts) of all tokens, the end of each text included. at: word offsets by row."""
    rows, n = len(at) - 1, len(hashes)
    places = np.arange(n) + np.repeat(np.arange(rows), np.diff(at))
    words, history = np.full(n + rows, END, dtype=np.uint64), np.full(n + rows, BEGIN, dtype=np.uint64)
    words[places] = hashes
    history[places + 1] = hashes
    first = np.zeros(n + rows, dtype=bool)
    first[at[:-1] + np.arange(rows)] = True
    return history, words, np.repeat(np.arange(rows), np.diff(at) + 1), first


def ngrams(order, hashes, at):
    """(history, lower) of all n-grams of an order; of words only themselves."""
    history, words, _, first = lines(hashes, at)
    if order == 1:
        return words[None]
    if order == 2:
        return np.stack([history, words])
    pairs, later = key_of(history, words), np.flatnonzero(~first)
    return np.stack([pairs[later - 1], pairs[later]])


def _keys(parts):
    return parts[0] if len(parts) == 1 else key_of(*parts)


def _places(keys, buckets):
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _pair_places(first, keys, each):
    """The round of a pair is that of its first word; in it, `each` buckets divide the pairs by their own keys."""
    return _places(first, PAIR_ROUNDS) * each + _places(keys, each)


def _added(parts, counts):
    """Distinct n-grams in order of their keys, with their counts added up."""
    _, first, index = np.unique(_keys(parts), return_index=True, return_inverse=True)
    return parts[:, first], np.bincount(index, weights=counts, minlength=len(first)).astype(np.int64)


def _sent(rows):
    """The rows in batches of about SENT_BYTES, at least one row each."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3]) + len(row[4])
        if size >= SENT_BYTES:
            yield _sent_batch(held)
            held, size = [], 0
    if held:
        yield _sent_batch(held)


def _counted(buckets):
    """The keys of words, pairs and triples with their counts, by flush."""
    def flushed(held):
        rows = []
        for order, keys in zip((1, 2, 3), (np.concatenate(k) for k in zip(*held))):
            keys, counts = np.unique(keys, return_counts=True)
            rows += _by_bucket(order, 0, keys, buckets, keys, counts.astype(np.uint32))
        return rows

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                hashed = hashed_words(data, offsets)
                held.append([_keys(ngrams(order, *hashed)) for order in (1, 2, 3)])
                size += len(held[-1][0])
                if size >= FLUSH_TOKENS:
                    yield from _sent(flushed(held))
                    held, size = [], 0
        if size:
            yield from _sent(flushed(held))

    return run


def _table(batches):
    """One row per bucket and order: its share of the totals, and of words the sorted keys and their counts."""
    for bucket, rows in by_key(batches):
        for order in (1, 2, 3):
            own = [r for r in rows if r[1] == order]
            if own:
                keys = np.concatenate([np.frombuffer(r[3], np.uint64) for r in own])
                parts, counts = _added(keys[None], np.concatenate([np.frombuffer(r[4], np.uint32) for r in own]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([bucket], pa.int64()), pa.array([order], pa.int32()), pa.array([len(counts)], pa.int64()),
                    pa.array([int(counts.sum())], pa.int64()), pa.array([numbers_of_types(counts)], pa.list_(pa.int64())),
                    pa.array([parts.tobytes() if order == 1 else b""], pa.binary()),
                    pa.array([counts.tobytes() if order == 1 else b""], pa.binary()),
                ], names=["bucket", "n", "types", "tokens", "numbers", "x", "y"])


def _by_bucket(kind, flush, keys, buckets, x, y):
    """Rows for the buckets of sorted keys; x and y have their last axis by key."""
    cuts = bucket_cuts(keys, buckets)
    return [
        (b, kind, flush, x[..., cuts[b]:cuts[b + 1]].tobytes(), y[..., cuts[b]:cuts[b + 1]].tobytes())
        for b in range(buckets) if cuts[b] < cuts[b + 1]
    ]


def _first_sums(share, ratios, buckets):
    """Adds up by first word what the pairs that it begins count, and what their last words are worth; all else passes."""
    def run(batches):
        for _, rows in by_key(batches):
            tables = [_table_arrays(r) for r in rows if r[1] == _COUNTS]
            asked = [r for r in rows if r[1] == _LOWER]
            out = [r for r in rows if r[1] not in (_COUNTS, _LOWER)]
            if asked:
                lower, first = (np.concatenate([np.frombuffer(r[3], np.uint64).reshape(2, -1)[k] for r in asked]) for k in (0, 1))
                counts = np.concatenate([np.frombuffer(r[4], np.uint32) for r in asked]).astype(np.int64)
                own, index = np.unique(first, return_inverse=True)
                worth = share(_looked_up(tables[0] if tables else None, lower))
                sums = np.stack([np.bincount(index, weights=v) for v in (counts, discounted(counts, ratios), worth)])
                out += _by_bucket(_FIRST_SUMS, 0, own, buckets, own, sums)
            if out:
                yield from _sent(out)

    return run


def _table_arrays(row):
    """(sorted keys, counts) of a table's row among messages."""
    return np.frombuffer(row[3], np.uint64), np.frombuffer(row[4], np.int64)


def _factors(count, kept):
    """Of histories: the factor of a seen n-gram's discounted count, and the mass left."""
    seen, reserve = kept / count, 1 / (count + 1)
    factor = np.where(1 - seen < reserve, (1 - reserve) / seen, 1.0)
    return factor / count, 1 - factor * seen


def _weights(batches):
    """By history: its factor, the mass left, and the sum over words seen. Worths are added up by history; all else passes."""
    for bucket, rows in by_key(batches):
        out = [r for r in rows if r[1] not in (_FIRST_SUMS, _WORTH)]
        for kind, width in ((_FIRST_SUMS, 3), (_WORTH, 1)):
            sums = [r for r in rows if r[1] == kind]
            if sums:
                own, index = np.unique(np.concatenate([np.frombuffer(r[3], np.uint64) for r in sums]), return_inverse=True)
                values = np.concatenate([np.frombuffer(r[4], np.float64).reshape(width, -1) for r in sums], axis=1)
                values = np.stack([np.bincount(index, weights=v) for v in values])
                if kind == _FIRST_SUMS:
                    kind, values = _HISTORIES, np.stack([*_factors(*values[:2]), values[2]])
                out.append((bucket, kind, 0, own.tobytes(), values.tobytes()))
        if out:
            yield from _sent(out)


class Model:
    """The texts learnt from, a table of their words' counts, discount ratios by order, and the totals."""

    def __init__(self, texts, words, ratios, tokens, types, unknown, buckets):
        self.texts, self.words, self.ratios, self.buckets = texts, words, ratios, buckets
        self.tokens, self.types, self.unknown = tokens, types, unknown

    def word_share(self):
        ratios, tokens, unknown = self.ratios[1], self.tokens, self.unknown
        return lambda counts: np.where(counts > 0, discounted(counts, ratios) / (tokens + 1), unknown)


def train(texts: DataFrame, text: str = "text") -> Model:
    """Counts the words of all rows of `texts` into a table in the scratch folder, and how often pairs and triples occur.

    Scoring reads the texts again.
    """
    spark = small_batches(texts.sparkSession)
    path = f"{scratch_path(spark, 'katz-ngrams')}/counts"
    body = texts.select(F.col(f"`{text}`").alias("text"))
    size = body.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About six bytes a token; only the number of buckets depends on it.
    buckets = max(8, size // (6 * BUCKET_TOKENS))
    with shuffles_freed(spark):
        grouped(body.mapInArrow(_counted(buckets), SENT), "bucket").mapInArrow(_table, TABLE).write.parquet(path)
    counts = spark.read.schema(TABLE).parquet(path)
    words = counts.where("n = 1")
    numbers = {order: _numbers(counts.where(F.col("n") == order)) for order in (1, 2, 3)}
    ratios = {order: good_turing(numbers[order]) for order in numbers}
    types, tokens = (int(x or 0) for x in words.agg(F.sum("types"), F.sum("tokens")).first())
    lost = sum((1 - ratios[1][r]) * r * numbers[1][r - 1] for r in range(1, DISCOUNTED + 1))
    return Model(body, words, ratios, tokens, types, (1 + lost) / (tokens + 1), buckets)


def _messages(table, kind):
    return table.select("bucket", F.lit(kind).alias("kind"), F.lit(0).cast("long").alias("flush"), "x", "y")


class _Asked:
    """Keys (with what is needed further on) and the rows of a flush that ask: owner i asks times[i] for key index[i]."""

    def __init__(self, parts, index, rows, times):
        self.parts, self.index, self.rows, self.times = parts, index, rows, times

    @classmethod
    def of(cls, keys, parts, rows):
        """From occurrences in order of their rows: those with equal parts, side by side in the order of `keys`, are one."""
        order = np.argsort(keys, kind="stable")
        parts, rows = parts[:, order], rows[order]
        new_key = np.concatenate([[True], (parts[:, 1:] != parts[:, :-1]).any(axis=0)]) if len(keys) else np.zeros(0, bool)
        new = new_key.copy()
        new[1:] |= rows[1:] != rows[:-1]
        starts = np.flatnonzero(new)
        return cls(parts[:, new_key], np.cumsum(new_key)[starts] - 1, rows[starts], np.diff(np.append(starts, len(keys))))

    @classmethod
    def read(cls, row):
        n = int(np.frombuffer(row[4], np.int64, count=1)[0])
        parts = np.frombuffer(row[3], np.uint64).reshape(-1, n)
        owners = (len(row[4]) - 8 - 4 * n) // 6
        many = np.frombuffer(row[4], np.uint32, count=n, offset=8)
        times = np.frombuffer(row[4], np.uint32, count=owners, offset=8 + 4 * n)
        rows = np.frombuffer(row[4], np.uint16, count=owners, offset=8 + 4 * n + 4 * owners)
        return cls(parts, np.repeat(np.arange(n), many), rows, times)

    @classmethod
    def joined(cls, asked):
        """All questions as one; a key may repeat."""
        starts = np.cumsum([0] + [a.parts.shape[1] for a in asked[:-1]])
        return cls(
            np.concatenate([a.parts for a in asked], axis=1), np.concatenate([a.index + k for a, k in zip(asked, starts)]),
            np.concatenate([a.rows for a in asked]), np.concatenate([a.times for a in asked]),
        )

    def where(self, wanted, parts):
        """The keys for which `wanted` holds, with other parts."""
        place, held = np.cumsum(wanted) - 1, wanted[self.index]
        return _Asked(parts[:, wanted], place[self.index[held]], self.rows[held], self.times[held])

    def sums(self, flush, bucket, values, kind=_SUMS):
        """A row of sums by row of the flush; values: one or more by key."""
        own, at = np.unique(self.rows, return_inverse=True)
        found = np.stack([np.bincount(at, weights=v[self.index] * self.times, minlength=len(own)) for v in np.atleast_2d(values)])
        return bucket, kind, flush, own.astype(np.uint16).tobytes(), found.tobytes()

    def kept(self, kind, flush, bucket):
        """The same as one row for a bucket, none without a key."""
        return self.sent(kind, flush, np.full(self.parts.shape[1], bucket), bucket + 1)

    def sent(self, kind, flush, places, buckets):
        """Rows for the buckets in which the keys have their places."""
        index, rows, times, order = self.index, self.rows.astype(np.uint16), self.times.astype(np.uint32), np.arange(len(places))
        if (places[1:] < places[:-1]).any():
            order = np.argsort(places.astype(np.uint16) if buckets <= 1 << 16 else places, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            index = place[index]
        if (index[1:] < index[:-1]).any():
            by_key_ = np.argsort(index, kind="stable")
            index, rows, times = index[by_key_], rows[by_key_], times[by_key_]
        many = np.bincount(index, minlength=len(order)).astype(np.uint32)
        cuts, parts, out = np.searchsorted(places[order], np.arange(buckets + 1)), self.parts[:, order], []
        ends = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            c, d = cuts[b], cuts[b + 1]
            own = slice(ends[c], ends[d])
            y = np.array([d - c], np.int64).tobytes() + many[c:d].tobytes() + times[own].tobytes() + rows[own].tobytes()
            out.append((b, kind, flush, parts[:, c:d].tobytes(), y))
        return out


class _Held:
    """Texts of one use that wait for their flush."""

    def __init__(self):
        self.ids, self.lines, self.rows, self.size = [], [], 0, 0


def _flushes(batches):
    """(name, use, ids, lines) of the rows (doc_id, text, use), some 600,000 tokens of one use at a time.

    Rounds that read the same rows in the same order get the same names; a name tells other tokens or another order by its hash.
    """
    task, number, waiting = TaskContext.get().partitionId(), 0, {use: _Held() for use in (_ASKS, _BOTH, _TEACHES)}

    def flush(use):
        nonlocal number
        held, waiting[use] = waiting[use], _Held()
        history, words, owner, first = (np.concatenate(c) for c in zip(*held.lines))
        held.lines.clear()
        seal = np.dot(words, np.arange(1, 2 * len(words), 2, dtype=np.uint64))
        name = int(mixed(np.array([seal ^ np.uint64(task << 24 | number)]))[0] >> np.uint64(1))
        number += 1
        return name, use, held.ids, (history, words, owner, first)

    for batch in batches:
        for use in (_ASKS, _BOTH, _TEACHES):
            own = batch.filter(pc.equal(batch.column(2), use))
            names = own.column(0).to_pylist()
            for start, data, offsets in slices(own.column(1)):
                held = waiting[use]
                history, words, owner, first = lines(*hashed_words(data, offsets))
                n = len(offsets) - 1
                held.lines.append((history, words, (owner + held.rows).astype(np.uint16), first))
                held.ids += names[start:start + n]
                held.rows += n
                held.size += len(words)
                if held.size >= FLUSH_TOKENS or held.rows >= FLUSH_DOCUMENTS - 20_000:
                    del history, words, owner, first
                    yield flush(use)
    for use, held in waiting.items():
        if held.rows:
            yield flush(use)


def _regrouped(places, buckets):
    """The questions of each flush, which come from many buckets, dealt to the places of their keys. One row for each place, not for each pair of buckets."""
    def run(batches):
        for flush, rows in by_key(batches, key=2):
            out = []
            for kind in sorted({r[1] for r in rows}):
                asked = _Asked.joined([_Asked.read(r) for r in rows if r[1] == kind])
                out += asked.sent(kind, flush, places(asked.parts), buckets)
            yield from _sent(out)

    return run


def _first_asked(name, ids, history, words, owner, first, buckets):
    """What the texts ask apart from triples: their words and first pairs; and their ids."""
    asked = _Asked.of(words, words[None], owner)
    known = np.array([i is not None for i in ids], dtype=np.uint8).tobytes()
    plain = np.array([i or 0 for i in ids], dtype=np.int64).tobytes()
    sent = asked.sent(_BASE, name, _places(asked.parts[0], buckets), buckets)
    sent.append((name % buckets, _LOCAL, name, plain + known, np.bincount(owner, minlength=len(ids)).tobytes()))
    asked = _Asked.of(words[first], np.stack([history[first], words[first]]), owner[first])
    return sent + asked.kept(_PAIR, name, name % buckets)


def _triples(start, end, buckets):
    """The triples of the texts whose histories lie in the buckets from start to end; in the first round, all else they ask."""
    def triples(name, use, history, words, owner, first):
        pairs, later = key_of(history, words), np.flatnonzero(~first)
        place = _places(pairs[later - 1], buckets)
        own = (start <= place) & (place < end)
        later = later[own]
        before, lower = pairs[later - 1], pairs[later]
        del pairs, place, own
        # Sorted by history first, so by place too; equal histories side by side are compressed.
        half = np.uint64(32)
        keys = before >> half << half | key_of(before, lower) >> half
        parts = np.stack([before, lower, history[later], words[later]] if use == _ASKS else [before, lower])
        del before, lower
        asked = _Asked.of(keys, parts, owner[later] if use != _TEACHES else np.zeros(len(later), np.uint16))
        del keys, parts, later
        kind = {_ASKS: _TRIPLE, _BOTH: _LEARNT, _TEACHES: _TAUGHT}[use]
        return asked.sent(kind, name, _places(asked.parts[0], buckets), buckets)

    def run(batches):
        for name, use, ids, found in _flushes(batches):
            if start == 0 and use != _TEACHES:
                yield from _sent(_first_asked(name, ids, *found, buckets))
            sent = triples(name, use, *found)
            del found
            if sent:
                yield from _sent(sent)
                del sent

    return run


def _settled(ratios, base, each):
    """Settles the triples seen; asks for the pairs of the others, and for what follows their histories. Words are answered by `base`."""
    def run(batches):
        for bucket, rows in by_key(batches):
            counts = next((_table_arrays(r) for r in rows if r[1] == _COUNTS), None)
            out = [r for r in rows if r[1] in (_PAIR, _LOCAL)]
            out += [base(bucket, r, counts) for r in rows if r[1] == _BASE]
            rows = [r for r in rows if r[1] in (_TRIPLE, _LEARNT, _TAUGHT)]
            if rows:
                out += settled(bucket, rows)
            if out:
                yield from _sent(out)

    def settled(bucket, rows):
        asked = [_Asked.read(r) for r in rows]
        before, lower = (np.concatenate([a.parts[k] for a in asked]) for k in (0, 1))
        learnt = np.concatenate([
            np.bincount(a.index, weights=a.times, minlength=a.parts.shape[1]) if r[1] != _TRIPLE else np.zeros(a.parts.shape[1])
            for r, a in zip(rows, asked)
        ])
        order = np.lexsort((lower, before))
        before, lower = before[order], lower[order]
        new_history = np.concatenate([[True], before[1:] != before[:-1]])
        new = new_history.copy()
        new[1:] |= lower[1:] != lower[:-1]
        triple = np.empty(len(order), np.int64)
        triple[order] = np.cumsum(new) - 1
        counts = np.bincount(triple, weights=learnt).astype(np.int64)
        before, lower, history = before[new], lower[new], np.cumsum(new_history)[new] - 1
        del order, learnt, new, new_history
        occurrences, kept = (np.bincount(history, weights=w) for w in (counts, discounted(counts, ratios)))
        known = occurrences > 0
        factor, left = np.ones(len(known)), np.ones(len(known))
        factor[known], left[known] = _factors(occurrences[known], kept[known])
        seen = counts > 0
        values = np.log10(np.where(seen, discounted(counts, ratios) * factor[history], left[history]))
        # The last word of each history asked for in vain; its round is that of the pairs that follow.
        wanted, last_word, start, out = np.zeros(len(known), bool), np.zeros(len(known), np.uint64), 0, []
        for row, a in zip(rows, asked):
            own = triple[start:start + a.parts.shape[1]]
            start += a.parts.shape[1]
            if row[1] == _TAUGHT:
                continue
            out.append(a.sums(row[2], bucket, values[own]))
            if row[1] == _TRIPLE:
                unseen = ~seen[own]
                out += a.where(unseen, a.parts[2:]).kept(_PAIR, row[2], bucket)
                open_ = unseen & known[history[own]]
                out += a.where(open_, a.parts[[0, 2]]).kept(_UNSEEN_3, row[2], bucket)
                wanted[history[own[open_]]] = True
                last_word[history[own[open_]]] = a.parts[2][open_]
        follow = np.flatnonzero(seen & wanted[history])
        places = _pair_places(last_word[history[follow]], lower[follow], each)
        order = np.argsort(places, kind="stable")
        follow, cuts = follow[order], np.searchsorted(places[order], np.arange(each * PAIR_ROUNDS + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            own = follow[cuts[b]:cuts[b + 1]]
            out.append((b, _LOWER, 0, lower[own].tobytes(), before[own].tobytes()))
        return out

    return run


def _pairs(turn, each):
    """The pairs that the texts teach whose first words belong to the round."""
    def flushed(held):
        parts = np.concatenate(held, axis=1)
        parts, counts = _added(parts, np.ones(parts.shape[1]))
        rows = _by_bucket(_COUNTS, 0, _keys(parts), each, parts, counts.astype(np.uint32))
        return [(turn * each + r[0], *r[1:]) for r in rows]

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                parts = ngrams(2, *hashed_words(data, offsets))
                held.append(parts[:, _places(parts[0], PAIR_ROUNDS) == turn])
                size += held[-1].shape[1]
                if size >= FLUSH_TOKENS:
                    yield from _sent(flushed(held))
                    held, size = [], 0
        if size:
            yield from _sent(flushed(held))

    return run


def _paired(ratios, buckets):
    """Answers what is asked of pairs, and sends what makes the weights of their first words."""
    def run(batches):
        for bucket, rows in by_key(batches):
            out, table = [], None
            counted = [r for r in rows if r[1] == _COUNTS]
            if counted:
                parts = np.concatenate([np.frombuffer(r[3], np.uint64).reshape(2, -1) for r in counted], axis=1)
                (history, lower), counts = _added(parts, np.concatenate([np.frombuffer(r[4], np.uint32) for r in counted]))
                table = key_of(history, lower), counts
                order = np.argsort(lower)
                pairs = np.stack([lower[order], history[order]])
                out += _by_bucket(_LOWER, 0, pairs[0], buckets, pairs, counts[order].astype(np.uint32))
            followed = [r for r in rows if r[1] == _LOWER]
            if followed:
                keys, history = (np.concatenate([np.frombuffer(r[k], np.uint64) for r in followed]) for k in (3, 4))
                own, index = np.unique(history, return_inverse=True)
                worth = np.bincount(index, weights=discounted(_looked_up(table, keys), ratios))
                out += _by_bucket(_WORTH, 0, own, buckets, own, worth)
            for row in rows:
                if row[1] == _PAIR:
                    asked, flush = _Asked.read(row), row[2]
                    last, word = asked.parts
                    found = _looked_up(table, key_of(last, word))
                    seen = found > 0
                    out.append(asked.sums(flush, bucket, np.log10(np.where(seen, discounted(found, ratios), 1.0))))
                    for kind, held, keys in ((_SEEN_2, seen, last), (_UNSEEN_2, ~seen, last), (_WORD, ~seen, word)):
                        out += asked.where(held, keys[None]).kept(kind, flush, bucket)
            if out:
                yield from _sent(out)

    return run


def _divided(batches):
    """What the pairs seen after a history are worth, for those who ask for it; their last word's factor is asked for next."""
    for bucket, rows in by_key(batches):
        keys, worth = _joined([r for r in rows if r[1] == _WORTH], 1)
        out = []
        for row in rows:
            if row[1] == _UNSEEN_3:
                asked = _Asked.read(row)
                before, last = asked.parts
                asked.parts = np.stack([last, worth[0, np.searchsorted(keys, before)].view(np.uint64)])
                out += asked.kept(_DIVIDE, row[2], bucket)
        if out:
            yield from _sent(out)


def _joined(rows, width):
    """Sorted keys and their values from rows that share no key."""
    if not rows:
        return np.zeros(0, np.uint64), np.zeros((width, 0))
    keys = np.concatenate([np.frombuffer(r[3], np.uint64) for r in rows])
    order = np.argsort(keys)
    return keys[order], np.concatenate([np.frombuffer(r[4], np.float64).reshape(width, -1) for r in rows], axis=1)[:, order]


def _base_sums(tokens, types):
    base_total = np.log10(tokens + BASE_ADDED * (types + 1))

    def answer(bucket, row, counts):
        asked = _Asked.read(row)
        found = _looked_up(counts, asked.parts[0])
        return asked.sums(row[2], bucket, np.stack([(found > 0).astype(float), np.log10(found + BASE_ADDED) - base_total]), _BASE)

    return answer


def _answered(share):
    """Answers what is left from the tables of words and of the weights of words as histories."""
    def run(batches):
        for bucket, rows in by_key(batches):
            counts = next((_table_arrays(r) for r in rows if r[1] == _COUNTS), None)
            keys, values = _joined([r for r in rows if r[1] == _HISTORIES], 3)

            def histories(wanted):
                """(factor, mass left, sum over shorter n-grams) of each; an unknown history leaves everything."""
                found = np.stack([np.ones(len(wanted)), np.ones(len(wanted)), np.zeros(len(wanted))])
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    found = np.where(keys[at] == wanted, values[:, at], found)
                return found

            out = []
            for row in rows:
                if row[1] in (_COUNTS, _HISTORIES):
                    continue
                asked = _Asked.read(row)
                own = asked.parts[0]
                if row[1] == _WORD:
                    value = share(_looked_up(counts, own))
                else:
                    factor, left, lower = histories(own)
                    if row[1] == _SEEN_2:
                        value = factor
                    elif row[1] == _UNSEEN_2:
                        value = left / (1 - lower)
                    else:
                        # What the pairs seen after the longer history are worth; each history keeps some mass, so it is below 1.
                        value = 1 / (1 - factor * asked.parts[1].view(np.float64))
                out.append(asked.sums(row[2], bucket, np.log10(value)))
            if out:
                yield from _sent(out)

    return run


def _gathered(batches):
    """(doc_id, n_tokens, n_known, base_score, score) of the rows of each flush."""
    for _, rows in by_key(batches, key=2):
        local = next((r for r in rows if r[1] == _LOCAL), None)
        if local is None:
            raise ValueError("the documents gave other rows, or another order of rows, when they were read again")
        tokens = np.frombuffer(local[4], np.int64)
        n, total = len(tokens), np.zeros((3, len(tokens)))
        for _, kind, _, x, y in rows:
            if kind != _LOCAL:
                own = np.frombuffer(x, np.uint16)
                total[slice(2, 3) if kind == _SUMS else slice(0, 2), own] += np.frombuffer(y, np.float64).reshape(-1, len(own))
        ids = np.frombuffer(local[3], np.int64, count=n)
        known = np.frombuffer(local[3], np.uint8, offset=8 * n).astype(bool)
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64(), mask=~known), pa.array(tokens), pa.array(np.rint(total[0]).astype(np.int64)),
            pa.array(total[1]), pa.array(total[2]),
        ], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def score(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score), one row per row of `documents`, over whole texts.

    Scores are log10 probabilities of all words and the end of the text. NULL and empty texts are the end
    alone. Ids may be NULL or repeat; other columns are not read. A model of no texts gives every token the
    mass in reserve. Both tables are read several times and must give their rows in the same order.
    """
    taught = model.texts.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(_TEACHES).alias("use"))
    return _scores(_rows(documents, F.lit(_ASKS), doc_id, text).unionByName(taught), model)


def _rows(documents: DataFrame, use: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), use.alias("use"))


def _scores(rows: DataFrame, model: Model) -> DataFrame:
    """Scores of the texts that ask; those that teach are the model's."""
    spark = small_batches(rows.sparkSession)
    root, buckets = scratch_path(spark, "katz-scores"), model.buckets
    each = max(buckets // PAIR_ROUNDS, 8)
    words, share, base = _messages(model.words, _COUNTS), model.word_share(), _base_sums(model.tokens, model.types)

    def pair_places(parts):
        return _pair_places(parts[0], key_of(*parts), each)

    def word_places(parts):
        return _places(parts[0], buckets)

    def written(df, name):
        df.write.parquet(f"{root}/{name}", compression=CODEC)
        return spark.read.schema(SENT).parquet(f"{root}/{name}")

    def together(frames):
        whole = frames[0]
        for other in frames[1:]:
            whole = whole.unionByName(other)
        return whole

    with shuffles_freed(spark):
        found = []
        ends = [round(buckets * sum(TRIPLE_SHARES[:turn])) for turn in range(len(TRIPLE_SHARES))] + [buckets]
        for turn, (start, end) in enumerate(zip(ends, ends[1:])):
            met = rows.mapInArrow(_triples(start, end, buckets), SENT)
            met = grouped(met.unionByName(words) if turn == 0 else met, "bucket")
            found.append(written(met.mapInArrow(_settled(model.ratios[3], base, each), SENT), f"triples-{turn}"))
        triples, found = together(found), []
        asked = grouped(triples.where(F.col("kind") == _PAIR), "flush").mapInArrow(_regrouped(pair_places, each * PAIR_ROUNDS), SENT)
        asked = triples.where(F.col("kind") == _LOWER).unionByName(written(asked, "asked"))
        for turn in range(PAIR_ROUNDS):
            own = (F.col("bucket") >= turn * each) & (F.col("bucket") < (turn + 1) * each)
            taught = rows.where(F.col("use") != _ASKS).select("text").mapInArrow(_pairs(turn, each), SENT)
            met = grouped(taught.unionByName(asked.where(own)), "bucket")
            met = met.mapInArrow(_paired(model.ratios[2], buckets), SENT)
            met = grouped(met.unionByName(words), "bucket").mapInArrow(_first_sums(share, model.ratios[2], buckets), SENT)
            found.append(written(grouped(met, "bucket").mapInArrow(_weights, SENT), f"pairs-{turn}"))
        pairs = together(found)

    def of(table, *kinds):
        return table.where(F.col("kind").isin(*kinds))

    divided = grouped(of(triples, _UNSEEN_3).unionByName(of(pairs, _WORTH)), "bucket").mapInArrow(_divided, SENT)
    left = grouped(of(pairs, _SEEN_2, _UNSEEN_2, _WORD).unionByName(divided), "flush").mapInArrow(_regrouped(word_places, buckets), SENT)
    met = grouped(together([left, words, of(pairs, _HISTORIES)]), "bucket").mapInArrow(_answered(share), SENT)
    whole = grouped(together([of(triples, _LOCAL, _BASE, _SUMS), of(pairs, _SUMS), met]), "flush")
    return whole.mapInArrow(_gathered, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def held_out_scores(documents: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Learns from all documents outside the held-out fold and scores all documents, which are read several times (see `score`)."""
    learnt = ~held_out("doc_id", folds)
    model = train(documents.where(learnt))
    return _scores(_rows(documents, F.when(learnt, _BOTH).otherwise(_ASKS)), model).select(
        "doc_id", held_out("doc_id", folds).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
