"""Repairs of conversations against a plain search over all edits, and rows in every odd shape."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from chalkline.llm import turn_repair
from chalkline.llm.queries import QUERIES
from chalkline.llm.turn_repair import SYMBOLS, Tables, symbol, tables
from chalkline.llm.twins import TWINS
from compare import difference
from test_queries_llm import views

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def search(rows):
    """The least cheapest edits of rows (initial, must go, truncated), by best-first search over costs and audits."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, place = heapq.heappop(heap)
        if (at, place) in seen:
            continue
        seen.add((at, place))
        if at == len(rows) and place in ("", "a"):
            return cost, audit
        heapq.heappush(heap, (cost + 2, audit + "I", at, NEXT[place]))
        if at < len(rows):
            initial, gone, cut = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, place))
            if not gone:
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", at + 1, NEXT[place]))
                if initial == NEXT[place] or (initial == "s" and place == ""):
                    heapq.heappush(heap, (cost + cut, audit + "K", at + 1, initial))


def by_hand(rows):
    """The contract's result for rows (conv, turn, role, text), row by row."""
    talks = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        draw = zlib.crc32(key.encode()) % 20
        talk = talks[conv]
        if draw == 1:
            text = ""
        elif draw == 2:
            text = re.sub("[.!?]", "", text)
        elif draw == 4:
            role = "user"
        talk += [(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    found = set()
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, judged = set(), collections.Counter(), []
        for _, role, text in talk:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            judged.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit = search(judged)
        turns = [t for t, _, _ in talk if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        place, spoken, left = "", [], iter(talk)
        for letter in audit:
            role, text = (None, "") if letter == "I" else next(left)[1:]
            if letter != "D":
                place = role[:1] if letter == "K" else NEXT[place]
                spoken.append(f"{role if letter == 'K' else NAMES[place]}:{text}")
        checksum = hashlib.sha256("\n".join(spoken).encode()).hexdigest()
        found.add((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, checksum))
    return found


def random_talks(seed, conversations, turns):
    rng = random.Random(seed)
    texts = ["Fine.", "Fine!", "and then", "", " \t", None, "a. b", "no?\n", "x ", "Ünïcode.", "ends. "]
    roles = ["user", "assistant", "system", "tool", "", None, "human", "USER"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, turns)):
            rows.append((None if conv == 3 else conv, None if rng.random() < 0.05 else turn, rng.choice(roles[:3] * 4 + roles), rng.choice(texts)))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("block", [1, 2, 4])
def test_block_tables_find_the_least_cheapest_edits(block):
    t, rng = Tables(block), random.Random(block)
    plain = {0: ("u", True, False)} | {symbol(False, c, i): (i, False, c) for i in "suax" for c in (False, True)}
    assert len(plain) == SYMBOLS and len(t.vectors) < 100
    for _ in range(400):
        symbols = bytes(rng.choices(range(SYMBOLS), k=rng.randint(0, 14)))
        assert t.audit(symbols) == search([plain[s] for s in symbols])


def test_summaries_compose():
    t, rng = tables(), random.Random(5)
    for _ in range(100):
        front, back = (bytes(rng.choices(range(SYMBOLS), k=rng.randint(0, 20))) for _ in range(2))
        one, two = t.summary(front), t.summary(back)
        middle = two[0][t.end]
        cost = two[1][t.end] + one[1][middle] + t.vectors[one[0][middle]][0]
        whole, audit = t.audit(front + back)
        place = two[2][4 * t.end + one[2][4 * middle]]
        assert cost == whole and audit.endswith(t.finish(place))


SCHEMA = "conv_id long, turn long, role string, text string"


def repaired_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit("x"), "conv": F.lit(1), "first": F.lit(None).cast("string")})
    return {tuple(r) for r in turn_repair.repair(turn_repair.damaged(df)).collect()}


@pytest.mark.parametrize("piece", [4096, 3])
def test_repair_equals_plain_search(spark, monkeypatch, piece):
    """Also where conversations fall into many pieces."""
    monkeypatch.setattr(turn_repair, "PIECE_ROWS", piece)
    rows = random_talks(piece, 60, 12) + [(99, t, ("user", "assistant")[t % 2], f"Turn {t % 90}.") for t in range(300)]
    assert repaired_rows(spark, rows) == by_hand(rows)


def test_many_equal_rows_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "PIECE_ROWS", 16)
    rows = [(1, 5, "user", "Same.")] * 200 + [(2, None, None, None)] * 9 + [(4, 0, "user", "word " * 200_000 + "end."), (4, 1, "assistant", "Yes.")]
    rows += [(c, t, "user", "Hm.") for c in range(100, 140) for t in range(1)]
    assert repaired_rows(spark, rows) == by_hand(rows)


def test_query_equals_twin_on_odd_tables(spark, tmp_path):
    spark.createDataFrame(random_talks(7, 80, 9), SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    connection = views(str(tmp_path), ("conversations",))
    assert difference(QUERIES["op11_turn_repair"](spark, str(tmp_path)), connection, TWINS["op11_turn_repair"]) is None
