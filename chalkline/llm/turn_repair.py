"""Repair of damaged conversations at the least cost, by Four-Russians block tables.

A conversation's rows are a string of nine symbols: a row that must go, or one of four role initials, complete or
truncated. Edits turn its roles into nothing, or an optional system turn and then pairs of user and assistant.
Costs-to-go
from the four places in that pattern, less the one after an assistant turn, differ so little that only sixteen such vectors exist. For every vector and every block of `BLOCK` symbols the vector before the block
and the cost it adds are tabulated once (`Tables`); a conversation is worked off from its end by one lookup a block.
Then blocks are expanded: the vectors inside a block are worked out backward from the one kept at its end, and of all
edits that lie on a cheapest way the one with the least letter is taken, which makes the least of all cheapest audits.

A conversation of any length is spread over tasks. Rows are dealt by ranges of (conversation, turn, role, text) and packed
into pieces of at most `PIECE_ROWS` rows. A conversation inside one range is solved there; for pieces of others
a summary (for every vector at its end: the vector at its start, the cost, the place it leads to from each place) is
composed, a few hundred bytes a piece, and the pieces are expanded apart. Only the checksum of a
conversation's repaired text, which is sequential by its nature, passes through one task, as a stream of pieces.
"""

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm.packed import small_batches
from chalkline.sources.tables import scratch_path

BLOCK = 3
PIECE_ROWS = 4096
PIECE_CHARS = 1 << 22

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# Places in the pattern: nothing yet, after a system, user or assistant turn. An inserted or changed turn can only be the one
# that comes next there.
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_ENDS = (0, 2 * INSERT, INSERT, 0)
_KEPT = {(_EMPTY, 0): _SYSTEM, (_EMPTY, 1): _USER, (_SYSTEM, 1): _USER, (_USER, 2): _ASSISTANT, (_ASSISTANT, 1): _USER}
_INITIALS = {"s": 0, "u": 1, "a": 2}
_MUST_GO, SYMBOLS = 0, 9
_LEGAL = {"su", "ua", "au"}

SPACE = r"\x20\x09-\x0D"


def symbol(must_go: bool, truncated: bool, initial: str) -> int:
    return _MUST_GO if must_go else 1 + 2 * _INITIALS.get(initial, 3) + truncated


def _edits(sym, place):
    """(letter, cost, place after) of the edits that use up a row."""
    found = [("D", DELETE, place)]
    if sym != _MUST_GO:
        role, truncated = divmod(sym - 1, 2)
        if (place, role) in _KEPT:
            found.append(("K", TRUNCATED * truncated, _KEPT[place, role]))
        found.append(("R", REROLE + TRUNCATED * truncated, _NEXT[place]))
    return found


def _before(sym, after):
    """The costs-to-go before a row, from those after it."""
    costs = [min(cost + after[to] for _, cost, to in _edits(sym, place)) for place in range(4)]
    for _ in range(2):
        costs = [min(costs[p], INSERT + costs[_NEXT[p]]) for p in range(4)]
    return costs


class Tables:
    """All normalised cost vectors, and what a row and a block make of each of them."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors, self.ids, steps = [], {}, []

        def known(costs):
            vector = tuple(c - costs[_ASSISTANT] for c in costs)
            if vector not in self.ids:
                self.ids[vector] = len(self.vectors)
                self.vectors.append(vector)
            return self.ids[vector], costs[_ASSISTANT]

        self.end = known(list(_ENDS))[0]
        while len(steps) < len(self.vectors):
            steps.append([known(_before(sym, self.vectors[len(steps)])) for sym in range(SYMBOLS)])
        self.row_to = [[to for to, _ in step] for step in steps]
        self.row_cost = [[cost for _, cost in step] for step in steps]
        # Blocks of one more symbol in front, until they are long enough.
        to, cost = np.arange(len(steps))[:, None], np.zeros((len(steps), 1), dtype=np.int64)
        row_to, row_cost = np.array(self.row_to), np.array(self.row_cost)
        for _ in range(block):
            cost = np.concatenate([cost + row_cost[to, sym] for sym in range(SYMBOLS)], axis=1)
            to = np.concatenate([row_to[to, sym] for sym in range(SYMBOLS)], axis=1)
        self.block_to, self.block_cost = to.tolist(), cost.tolist()
        self.expanded = lru_cache(maxsize=1 << 16)(self._expanded)

    def spans(self, symbols: bytes) -> list[bytes]:
        return [symbols[k:k + self.block] for k in range(0, len(symbols), self.block)]

    def through(self, span: bytes, vector: int) -> tuple[int, int]:
        """(vector, cost added) before a span whose end has the given vector."""
        if len(span) == self.block:
            code = 0
            for sym in span:
                code = code * SYMBOLS + sym
            return self.block_to[vector][code], self.block_cost[vector][code]
        total = 0
        for sym in reversed(span):
            vector, total = self.row_to[vector][sym], total + self.row_cost[vector][sym]
        return vector, total

    def backward(self, spans: list[bytes], vector: int) -> tuple[list[int], int, int]:
        """(vector at the end of each span, vector at the start, cost added)."""
        ends, total = [0] * len(spans), 0
        for k in range(len(spans) - 1, -1, -1):
            ends[k] = vector
            vector, cost = self.through(spans[k], vector)
            total += cost
        return ends, vector, total

    def _expanded(self, span: bytes, vector: int, place: int) -> tuple[str, int]:
        """(edits, place after) of the least cheapest way through a span."""
        inner = [vector]
        for sym in reversed(span):
            inner.append(self.row_to[inner[-1]][sym])
        letters = []
        for k, sym in enumerate(span):
            after = self.vectors[inner[len(span) - 1 - k]]
            now = _before(sym, after)
            while True:
                tight = {letter: to for letter, cost, to in _edits(sym, place) if cost + after[to] == now[place]}
                if "D" not in tight and INSERT + now[_NEXT[place]] == now[place]:
                    letters.append("I")
                    place = _NEXT[place]
                    continue
                letter = min(tight)
                letters.append(letter)
                place = tight[letter]
                break
        return "".join(letters), place

    def finish(self, place: int) -> str:
        """The inserts after the last row."""
        return "I" * (_ENDS[place] // INSERT)

    def audit(self, symbols: bytes) -> tuple[int, str]:
        """(cost, edits) of a whole conversation."""
        spans = self.spans(symbols)
        ends, vector, total = self.backward(spans, self.end)
        place, letters = _EMPTY, []
        for span, end in zip(spans, ends):
            edits, place = self.expanded(span, end, place)
            letters.append(edits)
        return total + self.vectors[vector][_EMPTY], "".join(letters) + self.finish(place)

    def summary(self, symbols: bytes) -> tuple[list[int], list[int], list[int]]:
        """For every vector at the end: vector at the start, cost added, and the place after it from each of the four."""
        spans = self.spans(symbols)
        starts, costs, exits = [], [], []
        for vector in range(len(self.vectors)):
            ends, start, total = self.backward(spans, vector)
            starts.append(start)
            costs.append(total)
            for place in range(4):
                for span, end in zip(spans, ends):
                    place = self.expanded(span, end, place)[1]
                exits.append(place)
        return starts, costs, exits


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def repaired(edits: str, rows, place: int = _EMPTY):
    """The turns (`role:text`) that edits make of rows (symbol, role, text)."""
    rows = iter(rows)
    for letter in edits:
        if letter == "I":
            place = _NEXT[place]
            yield f"{_NAMES[place]}:"
            continue
        sym, role, text = next(rows)
        if letter == "K":
            place = _KEPT[place, (sym - 1) // 2]
            yield f"{role}:{text}"
        elif letter == "R":
            place = _NEXT[place]
            yield f"{_NAMES[place]}:{text}"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n): the rows after the damage of the contract; a dropped row stays as one with n = 0 and NULLs.

    NULL ids, turns, roles and texts count as one space, but rows stay under their NULL id and turn.
    """
    def known(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    own = conversations.select(*[F.col(f"`{c}`") for c in ("conv_id", "turn", "role", "text")])
    rows = own.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), known("role").alias("role"), known("text").alias("text"),
        F.pmod(F.crc32(F.concat_ws(":", known("conv_id"), known("turn"))), F.lit(20)).alias("draw"),
    )
    there = F.col("draw") != 0
    text = F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role"))
    n = F.when(~there, 0).when(F.col("draw") == 3, 2).otherwise(1).cast("long")
    return rows.select("conv", F.when(there, F.col("turn")).alias("turn"), F.when(there, role).alias("role"), F.when(there, text).alias("text"), n.alias("n"))


def in_order(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n, first, blank, cut) with equal rows as one, dealt and sorted by ranges of that order.

    Of rows with one role and text in a conversation the one in the first turn (NULL before all) is the first. Both steps are
    aggregates that tasks do in part, so neither many equal rows nor a long conversation meet in one task.
    """
    key = ["conv", "role", "text"]
    least = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    firsts = rows.where("n > 0").groupBy(*key).agg(least.alias("least")).select(
        "conv", F.col("least.turn").alias("turn"), "role", "text", F.lit(0).cast("long").alias("n"), F.lit(True).alias("first")
    )
    merged = rows.withColumn("first", F.lit(False)).unionByName(firsts).groupBy("conv", "turn", "role", "text").agg(
        F.sum("n").alias("n"), F.max("first").alias("first")
    )
    judged = merged.select(
        "conv", "turn", "role", "text", "n", "first", (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    return judged.repartitionByRange(*order).sortWithinPartitions(*order)


class _Piece:
    """Consecutive rows of one conversation, as they are packed."""

    def __init__(self, conv, seq):
        self.conv, self.seq, self.chars = conv, seq, 0
        self.symbols, self.roles, self.texts = bytearray(), [], []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.first = self.last = self.low = self.high = None

    def full(self):
        return len(self.symbols) >= PIECE_ROWS or self.chars >= PIECE_CHARS

    def add(self, turn, role, text, fault):
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in _LEGAL:
            self.counts["illegal"] += 1
        self.last = initial
        if turn is not None:
            self.counts["turns"] += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault:
            self.counts[fault] += 1
        sym = symbol(fault in ("blank", "duplicate"), fault == "truncated", initial)
        self.symbols.append(sym)
        if sym != _MUST_GO:
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


def _pieces(conv_type):
    schema = pa.schema([
        ("conv", conv_type), ("part", pa.int64()), ("seq", pa.int64()), ("whole", pa.bool_()), ("symbols", pa.binary()),
        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), *[(c, pa.int64()) for c in _COUNTS],
        ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()),
    ])

    def packed(part, pieces):
        columns = {
            "conv": [p.conv for p, _ in pieces], "part": [part] * len(pieces), "seq": [p.seq for p, _ in pieces], "whole": [w for _, w in pieces],
            "symbols": [bytes(p.symbols) for p, _ in pieces], "roles": [p.roles for p, _ in pieces], "texts": [p.texts for p, _ in pieces],
            **{c: [p.counts[c] for p, _ in pieces] for c in _COUNTS}, "first": [p.first for p, _ in pieces], "last": [p.last for p, _ in pieces],
            "low": [p.low for p, _ in pieces], "high": [p.high for p, _ in pieces],
        }
        return pa.RecordBatch.from_pydict(columns, schema=schema)

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        piece, opening, split, done, held = None, True, False, [], 0
        for batch in batches:
            for conv, turn, role, text, n, first, blank, cut in zip(*[c.to_pylist() for c in batch.columns]):
                if piece is None or conv != piece.conv:
                    if piece is not None:
                        # Rows of a range's first conversation may lie in the range before.
                        done.append((piece, not opening and not split))
                        held += piece.chars + 100
                        opening, split = False, False
                    piece, seq = _Piece(conv, seq), seq + 1
                for copy in range(n):
                    if piece.full():
                        done.append((piece, False))
                        held += piece.chars + PIECE_ROWS
                        piece, seq, split = _Piece(conv, seq), seq + 1, True
                    fault = "blank" if blank else "duplicate" if copy or not first else "truncated" if cut else None
                    piece.add(turn, role, text, fault)
                    if held >= PIECE_CHARS:
                        yield packed(part, done)
                        done, held = [], 0
        if piece is not None:
            done.append((piece, False))
        if done:
            yield packed(part, done)

    return run


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _rows_of(symbols, roles, texts):
    kept = iter(zip(roles, texts))
    for sym in symbols:
        yield (sym, *(next(kept) if sym != _MUST_GO else (None, None)))


def _gaps(low, high, turns):
    return 0 if low is None else high - low + 1 - turns


def _solved(conv_type):
    """Results of conversations that lie in one piece, which no other follows."""
    def run(batches):
        for batch in batches:
            rows = []
            for p in batch.to_pylist():
                cost, audit = tables().audit(p["symbols"])
                text = "\n".join(repaired(audit, _rows_of(p["symbols"], p["roles"], p["texts"])))
                rows.append((p["conv"], _gaps(p["low"], p["high"], p["turns"]), p["blank"], p["duplicate"], p["truncated"], p["illegal"], cost,
                             audit, hashlib.sha256(text.encode()).hexdigest()))
            yield _results(conv_type, rows)

    return run


def _results(conv_type, rows):
    schema = pa.schema([("conv_id", conv_type), *[(c, pa.int64()) for c in RESULT], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _summaries(batches):
    for batch in batches:
        found = [tables().summary(symbols) for symbols in batch.column("symbols").to_pylist()]
        names = [n for n in batch.schema.names if n != "symbols"]
        columns = [batch.column(n) for n in names]
        for at, (name, kind) in enumerate((("starts", pa.int32()), ("costs", pa.int64()), ("exits", pa.int32()))):
            columns.append(pa.array([f[at] for f in found], pa.list_(kind)))
            names.append(name)
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _conversations(batches):
    """Rows of each conversation, which come one after another, as an iterator apiece."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row["conv"] != current:
                yield rows
                rows = []
            current = row["conv"]
            rows.append(row)
    if rows:
        yield rows


def _composed(batches):
    """For each piece the vector at its end and the place it begins with; the last one knows the conversation's counts."""
    t = tables()
    for pieces in _conversations(batches):
        vector, total, ends = t.end, 0, []
        for p in reversed(pieces):
            ends.append(vector)
            vector, total = p["starts"][vector], total + p["costs"][vector]
        total += t.vectors[vector][_EMPTY]
        place, out = _EMPTY, []
        for p, end in zip(pieces, reversed(ends)):
            out.append((p["part"], p["seq"], end, place, None))
            place = p["exits"][4 * end + place]
        counts = {c: sum(p[c] for p in pieces) for c in _COUNTS}
        last = high = low = None
        for p in pieces:
            if p["first"] is not None:
                counts["illegal"] += last is not None and last + p["first"] not in _LEGAL
                last = p["last"]
            if p["low"] is not None:
                counts["turns"] -= p["low"] == high
                low, high = p["low"] if low is None else low, p["high"]
        gaps = _gaps(low, high, counts["turns"])
        out[-1] = (*out[-1][:4], [gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], total])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())))],
            names=["part", "seq", "end", "place", "counts"],
        )


def _expanded_pieces(conv_type):
    schema = pa.schema([("conv", conv_type), ("part", pa.int64()), ("seq", pa.int64()), ("counts", pa.list_(pa.int64())),
                        ("audit", pa.string()), ("turns", pa.list_(pa.string()))])

    def run(batches):
        t = tables()
        for batch in batches:
            for p in batch.to_pylist():
                spans = t.spans(p["symbols"])
                ends = t.backward(spans, p["end"])[0]
                place, letters = p["place"], []
                for span, end in zip(spans, ends):
                    edits, place = t.expanded(span, end, place)
                    letters.append(edits)
                if p["counts"] is not None:
                    letters.append(t.finish(place))
                audit = "".join(letters)
                turns = list(repaired(audit, _rows_of(p["symbols"], p["roles"], p["texts"]), p["place"]))
                yield pa.RecordBatch.from_pydict(
                    {"conv": [p["conv"]], "part": [p["part"]], "seq": [p["seq"]], "counts": [p["counts"]], "audit": [audit], "turns": [turns]}, schema=schema
                )

    return run


def _joined(conv_type):
    """Results of conversations from their expanded pieces, of which one at a time is held."""
    def run(batches):
        audit, digest, between = [], hashlib.sha256(), b""
        for batch in batches:
            for p in batch.to_pylist():
                audit.append(p["audit"])
                for turn in p["turns"]:
                    digest.update(between + turn.encode())
                    between = b"\n"
                if p["counts"] is not None:
                    yield _results(conv_type, [(p["conv"], *p["counts"], "".join(audit), digest.hexdigest())])
                    audit, digest, between = [], hashlib.sha256(), b""

    return run


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of `rows` (conv, turn, role, text, n): its faults, the cost, audit and checksum of its repair.

    A row's first fault counts: blank, duplicate (role and text seen earlier in its conversation), truncated. Rows go by turn, NULL
    first; rows of one turn by role and text. n is the number of equal rows; a conversation that has only rows with n = 0
    is reported with zeros, an empty audit and the checksum of the empty text. The rows of a NULL id are one conversation.
    A role other than by its initial s, u or a can only be changed or deleted. Empty tables give no rows.
    """
    spark = small_batches(rows.sparkSession)
    root = scratch_path(spark, "turn-repair")

    def written(df, name):
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    kind = rows.schema["conv"].dataType.simpleString()
    arrow = pa.string() if kind == "string" else pa.int64()
    ordered = in_order(rows if kind in ("string", "bigint") else rows.withColumn("conv", F.col("conv").cast("long")))
    kind = "string" if kind == "string" else "bigint"
    counted = ", ".join(f"{c} bigint" for c in _COUNTS)
    pieces = written(ordered.mapInArrow(
        _pieces(arrow), f"conv {kind}, part bigint, seq bigint, whole boolean, symbols binary, roles array<string>, texts array<string>, "
        f"{counted}, first string, last string, low bigint, high bigint"
    ), "pieces")
    result = f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in RESULT) + ", audit string, repaired_sha256 string"
    solved = pieces.where("whole").mapInArrow(_solved(arrow), result)

    parts = pieces.where("NOT whole")
    light = parts.drop("whole", "roles", "texts")
    summed = light.mapInArrow(
        _summaries, f"conv {kind}, part bigint, seq bigint, {counted}, first string, last string, low bigint, high bigint, "
        "starts array<int>, costs array<bigint>, exits array<int>"
    )
    steps = written(summed.repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(
        _composed, "part bigint, seq bigint, end int, place int, counts array<bigint>"
    ), "steps")
    expanded = parts.select("conv", "part", "seq", "symbols", "roles", "texts").join(steps, ["part", "seq"]).mapInArrow(
        _expanded_pieces(arrow), f"conv {kind}, part bigint, seq bigint, counts array<bigint>, audit string, turns array<string>"
    )
    long = expanded.repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(_joined(arrow), result)
    return solved.unionByName(long)

