"""HyperMinHash sketches: registers, estimates, and near duplicates against plain comparison of all pairs."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chalkline.llm import hyperminhash
from chalkline.llm.hyperminhash import EMPTY_REGISTER, MANTISSA, REGISTERS, band_keys, estimates, packed_minima, sketches
from chalkline.llm.words import mixed

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(rows):
    """(doc_id, n_shingles, component_id, kept) of rows (doc_id, text), all pairs compared."""
    sets = []
    for _, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(words[k:k + 2]) for k in range(max(len(words) - 1, 1))} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in itertools.combinations(range(len(rows)), 2):
        if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
            parent[root(x)] = root(y)
    found = []
    for at, (doc, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if root(k) == root(at) and rows[k][0] is not None]
        least = min(ids, default=None)
        found.append((doc, len(sets[at]), least, doc == least))
    return sorted(found, key=str)


def result(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"sig": F.lit("x"), "band": F.lit(1), "label": F.lit(None).cast("long")})
    return sorted(map(tuple, hyperminhash.near_duplicates(df.repartition(5)).collect()), key=str)


def families(seed, groups, copies, edits):
    """Texts of random words, and copies of each with more and more words replaced."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(groups):
        text = rng.choices(words, k=rng.randint(2, 90))
        for copy in range(copies):
            own = list(text)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                text = own
            rows.append((1000 * group + rng.randint(0, 999), rng.choice([" ", "\n", "\t "]).join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, block):
    """Chains of copies, also where buckets fall into many blocks."""
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    rows = families(block, 25, 12, 4)
    assert result(spark, rows) == by_hand(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (5, "two"), (None, "one"), (None, None), (None, "lone words"), (None, "Lone  words"),
            (7, "a b"), (8, "b a"), (9, "a b a b a b"), (9, "a b a b a b"), (10, "x y " * 50_000), (11, "x y " * 50_000 + "x")]
    assert result(spark, rows) == by_hand(rows)


def test_registers_keep_zeros_and_mantissa():
    rest = np.array([1, 2, 3, (1 << 53) - 1, 1 << 52, 0b10110011101 << 20, (1 << 40) + 1], dtype=np.uint64)
    for value, packed in zip(rest.tolist(), packed_minima(rest).tolist()):
        bits = f"{value:053b}"
        zeros = bits.index("1")
        assert packed == (zeros << MANTISSA) | int((bits[zeros + 1:] + "0" * MANTISSA)[:MANTISSA], 2)
    hashes = np.unique(mixed(np.arange(5000, dtype=np.uint64)))
    own = sketches([hashes, hashes[:1], hashes[::7]])
    assert (own != EMPTY_REGISTER).all() and len(set(own[1])) == 1
    for register in range(REGISTERS):
        least = min(int(h) & ((1 << 56) - 1) for h in hashes if int(h) >> 56 == register)
        assert own[0][register] == packed_minima(np.array([least >> 3], dtype=np.uint64))[0]


@pytest.mark.parametrize("size", [5, 40, 300, 3000])
def test_estimates_and_bands(size):
    """Estimates follow similarity, and pairs at 0.8 agree in some band."""
    rng = np.random.default_rng(size)
    errors, missed = [], 0
    for _ in range(150):
        hashes = np.unique(rng.integers(0, 1 << 63, size * 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        hashes = rng.permutation(hashes)[:size]
        common = -(-8 * size // 10)
        a, b = np.sort(hashes[:common + (size - common) // 2]), np.sort(np.concatenate([hashes[:common], hashes[common + (size - common) // 2:]]))
        one, other = sketches([a, b])
        errors.append(estimates(np.array([(one == other).sum()]), np.array([len(a)]), np.array([len(b)]))[0] - common / size)
        missed += not (band_keys(one[None]) == band_keys(other[None])).any()
    assert missed == 0 and abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < hyperminhash.MARGIN


def test_chance_agreement_is_corrected():
    """Disjoint sets have an estimate of about nothing although some registers agree."""
    rng = np.random.default_rng(1)
    agreeing = chance = 0
    for _ in range(400):
        one, other = sketches([np.unique(rng.integers(0, 1 << 64, 4000, dtype=np.uint64)) for _ in range(2)])
        agreeing += (one == other).sum()
        chance += hyperminhash.chance_agreement(np.array([4000]), np.array([4000]))[0] * REGISTERS
    assert 0.5 * chance < agreeing < 2 * chance
