"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes (A-Z lowered) in segments of `SEGMENT` bytes, forwards and backwards, gives every
position a probability per language, and a document the mean over all its positions. It is trained in numpy on
the driver, by backpropagation through time, on pieces of a bounded sample of documents whose language is known;
whole texts are labelled in tasks, with the few thousand weights broadcast.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chalkline.llm.packed import small_batches
from chalkline.llm.sampling import held_out
from chalkline.llm.words import slices

FOLDS = 5
PER_LANGUAGE = 1000
SAMPLE = 16_000
PIECES = 6
PIECE = 40
SEGMENT = 64
HIDDEN = 8
STEPS = 260
BATCH = 384
SEED = 11
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Network:
    """Weights by name: for each direction d input terms by byte (x) and recurrent weights (u), then output weights.

    The units are gated (reset r, update z, candidate n): n = tanh(x_n + r * u_n h), h' = z * h + (1 - z) * n, with
    piecewise linear gates clip(x / 4 + 1 / 2, 0, 1). Arrays run over (time, unit, row).
    """

    def __init__(self, languages, weights):
        self.languages, self.weights = languages, weights
        self._buffers = {}

    def _buffer(self, name, shape):
        if self._buffers.get(name) is None or self._buffers[name].shape != shape:
            self._buffers[name] = np.empty(shape, np.float32)
        return self._buffers[name]

    def states(self, codes, valid, direction, keep=None):
        """Hidden states of one direction. codes, valid: (time, row). keep: collects what backward needs."""
        x, u = self.weights[f"x{direction}"].copy(), self.weights[f"u{direction}"].copy()
        time, rows = codes.shape
        h = u.shape[1]
        x[:2 * h], u[:2 * h] = x[:2 * h] / 4 + 0.5, u[:2 * h] / 4
        out = self._buffer(direction, (time, h, rows))
        a, g = self._buffer("a", (3 * h, rows)), self._buffer("g", (3 * h, rows))
        r, z, n, gates = a[:h], a[h:2 * h], a[2 * h:], a[:2 * h]
        state = np.zeros((h, rows), np.float32)
        masked = not valid.all()
        for t in range(time) if direction == "f" else range(time - 1, -1, -1):
            np.take(x, codes[t], axis=1, out=a, mode="clip")
            np.matmul(u, state, out=g)
            gates += g[:2 * h]
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            if keep is not None:
                recurrent = g[2 * h:].copy()
            g[2 * h:] *= r
            n += g[2 * h:]
            np.tanh(n, out=n)
            if keep is not None:
                keep[t] = (state.copy(), r.copy(), z.copy(), n.copy(), recurrent)
            following = out[t]
            np.subtract(state, n, out=following)
            following *= z
            following += n
            if masked:
                following *= valid[t]
            state = following
        return out

    def position_probabilities(self, codes, valid):
        """(time, language, row): what the network says at every position."""
        w = self.weights
        h = w["uf"].shape[1]
        p = np.matmul(w["out"][:, :h], self.states(codes, valid, "f"), out=self._buffer("p", (codes.shape[0], len(w["bias"]), codes.shape[1])))
        p += np.matmul(w["out"][:, h:], self.states(codes, valid, "b"), out=self._buffer("q", p.shape))
        p += w["bias"][:, None]
        np.clip(p, -40, 40, out=p)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p


def gradients(network, codes, valid, targets):
    """Mean cross-entropy over valid positions, and its gradients by backpropagation through time."""
    w, grads, kept = network.weights, {}, {"f": {}, "b": {}}
    h, time, rows = w["uf"].shape[1], *codes.shape
    both = np.concatenate([network.states(codes, valid, d, kept[d]) for d in "fb"], axis=1)
    logits = np.matmul(w["out"], both) + w["bias"][:, None]
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    total = max(float(valid.sum()), 1.0)
    loss = float(-(np.log(p[:, targets, np.arange(rows)] + 1e-9) * valid).sum() / total)
    p[:, targets, np.arange(rows)] -= 1
    p *= (valid / total)[:, None, :]
    grads["out"] = np.einsum("tkb,thb->kh", p, both, optimize=True)
    grads["bias"] = p.sum(axis=(0, 2))
    d_both = np.matmul(w["out"].T, p)
    for d, part in (("f", d_both[:, :h]), ("b", d_both[:, h:])):
        u = w[f"u{d}"]
        du, d_state = np.zeros_like(u), np.zeros((h, rows), np.float32)
        d_inputs = np.empty((3 * h, time, rows), np.float32)
        for t in range(time - 1, -1, -1) if d == "f" else range(time):
            state, r, z, n, recurrent = kept[d][t]
            d_out = (part[t] + d_state) * valid[t]
            d_n = d_out * (1 - z) * (1 - n * n)
            d_z = d_out * (state - n) * ((z > 0) & (z < 1)) / 4
            d_r = d_n * recurrent * ((r > 0) & (r < 1)) / 4
            d_rec = np.concatenate([d_r, d_z, d_n * r])
            d_inputs[:2 * h, t], d_inputs[2 * h:, t] = d_rec[:2 * h], d_n
            du += d_rec @ state.T
            d_state = d_out * z + u.T @ d_rec
        seen = codes.reshape(-1)
        grads[f"x{d}"] = np.stack(
            [np.bincount(seen, weights=own.reshape(-1), minlength=256) for own in d_inputs]
        ).astype(np.float32)
        grads[f"u{d}"] = du
    return loss, grads


def fit(pieces, targets, languages, hidden=HIDDEN, steps=STEPS, batch=BATCH, seed=SEED) -> Network:
    """Adam over random batches of pieces (bytes); every language weighs the same."""
    rng = np.random.default_rng(seed)
    weights = {"out": rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32), "bias": np.zeros(len(languages), np.float32)}
    for d in "fb":
        weights[f"x{d}"] = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
        weights[f"u{d}"] = rng.normal(0, hidden ** -0.5, (3 * hidden, hidden)).astype(np.float32)
    network = Network(list(languages), weights)
    if not len(pieces) or len(languages) < 2:
        return network
    codes = np.zeros((len(pieces), PIECE), np.uint8)
    valid = np.zeros((len(pieces), PIECE), np.float32)
    for i, piece in enumerate(pieces):
        own = np.frombuffer(piece[:PIECE], dtype=np.uint8)
        codes[i, :len(own)], valid[i, :len(own)] = _LOWER[own], 1
    by_class = [np.flatnonzero(targets == k) for k in range(len(languages))]
    share = -(-batch // len(languages))
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, steps + 1):
        rows = np.concatenate([rng.choice(own, share) for own in by_class if len(own)])
        _, grads = gradients(network, codes[rows].T.astype(np.intp), np.ascontiguousarray(valid[rows].T), targets[rows])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.03 * min(1.0, 2.0 * (1 - step / (steps + 1))) / max(1.0, norm)
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            weights[k] -= (rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return network


def train(documents: DataFrame, lang: str = "lang", text: str = "text", per_language: int = PER_LANGUAGE) -> Network:
    """Fits on `PIECES` pieces each of at most `per_language` documents of a language and `SAMPLE` in all.

    Documents are taken by hash of their id, outside the held-out fold, where language and text are known and the
    text has a letter. An id on several rows counts once.
    """
    own = documents.select("doc_id", F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    known = own.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}")).where(~held_out("doc_id", FOLDS))
    # Only about twice the wanted share of a language, by hash, is ranked: one task never orders a language.
    shares = known.groupBy("lang").agg((F.lit(2.0 * per_language + 50) / F.count("*")).alias("share"))
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = known.select("doc_id", "lang", lot.alias("lot")).join(F.broadcast(shares), "lang").where("lot <= share")
    ranked = drawn.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("lot", "doc_id")))
    ranked = ranked.where(F.col("place") <= per_language)
    chosen = ranked.orderBy("place", "lang", "doc_id").limit(SAMPLE).select("doc_id").distinct()
    reach = F.greatest(F.length("text") - PIECE, F.lit(0)) + 1
    pieces = F.array(*[F.expr("text").substr((F.pmod(F.xxhash64("doc_id", F.lit(j)), reach) + 1).cast("int"), F.lit(PIECE)) for j in range(PIECES)])
    found = known.join(F.broadcast(chosen), "doc_id").select("doc_id", "lang", pieces.alias("pieces"))
    once = found.groupBy("doc_id").agg(F.min(F.struct("lang", "pieces")).alias("x"))
    rows = sorted(once.collect(), key=lambda r: r["doc_id"])
    languages = sorted({r["x"]["lang"] for r in rows})
    number = {name: k for k, name in enumerate(languages)}
    texts = [piece.encode() for r in rows for piece in r["x"]["pieces"]]
    return fit(texts, np.repeat([number[r["x"]["lang"]] for r in rows], PIECES).astype(np.int64), languages)


def segments(data: np.ndarray, offsets: np.ndarray):
    """(row of each segment, codes, valid): rows cut into runs of `SEGMENT` bytes, the last one filled up."""
    lengths = np.diff(offsets)
    counts = -(-lengths // SEGMENT)
    rows = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[rows] + nth * SEGMENT
    sizes = np.minimum(offsets[rows + 1] - starts, SEGMENT)
    order = np.argsort(-sizes, kind="stable")
    rows, starts, sizes = rows[order], starts[order], sizes[order]
    places = starts[:, None] + np.arange(SEGMENT)
    valid = np.arange(SEGMENT) < sizes[:, None]
    codes = _LOWER[data[np.minimum(places, len(data) - 1)]] if len(rows) else np.zeros((0, SEGMENT), np.uint8)
    return rows, np.where(valid, codes, 0).astype(np.uint8), valid.astype(np.float32)


def pooled(network: Network, column, block: int = 1024) -> np.ndarray:
    """(row, language): mean probabilities over all positions; NaN for texts without bytes."""
    found = []
    for _, data, offsets in slices(column, 1 << 19):
        sums = np.zeros((len(offsets) - 1, len(network.languages)))
        rows, codes, valid = segments(data, offsets)
        for at in range(0, len(rows), block):
            c, v = codes[at:at + block].T.astype(np.intp), np.ascontiguousarray(valid[at:at + block].T)
            p = network.position_probabilities(c, v)
            # Full segments come first, so only the last blocks have anything to mask.
            own = p.sum(axis=0) if v.all() else (p * v[:, None, :]).sum(axis=0)
            for k in range(sums.shape[1]):
                sums[:, k] += np.bincount(rows[at:at + block], weights=own[k], minlength=len(sums))
        with np.errstate(invalid="ignore", divide="ignore"):
            found.append(sums / np.diff(offsets)[:, None])
    return np.concatenate(found) if found else np.zeros((0, len(network.languages)))


def label_positions(network: Network, text: str) -> list[str]:
    """The language at every byte of one text."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    rows, codes, valid = segments(data, np.array([0, len(data)]))
    best = network.position_probabilities(codes.T.astype(np.intp), np.ascontiguousarray(valid.T)).argmax(axis=1).T
    return [network.languages[k] for k in best.reshape(-1)[:len(data)]]


def identify(documents: DataFrame, network: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): one row per row of `documents`, over whole texts.

    A NULL, empty or letterless text is `und` with score 0, and so is every text if no language was learned. Equal
    probabilities go to the first language by name. Ids may be NULL or repeat; other columns are not read.
    """
    source = small_batches(documents.sparkSession).sparkContext.broadcast((network.languages, network.weights))

    def run(batches):
        network = Network(*source.value)
        for batch in batches:
            p = pooled(network, batch.column(1))
            lettered = np.array(batch.column(2).to_pylist(), dtype=bool) & bool(network.languages)
            best = np.nan_to_num(p).argmax(axis=1) if network.languages else np.zeros(len(lettered), int)
            names = [network.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)]
            scores = [float(min(1.0, p[i, k])) if ok else 0.0 for i, (k, ok) in enumerate(zip(best, lettered))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    own = documents.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
        F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    return own.mapInArrow(run, "doc_id long, lang_pred string, score double")


def judged(found: DataFrame) -> DataFrame:
    return found.select("doc_id", held_out("doc_id", FOLDS).alias("held_out"), "lang_pred", "score")
