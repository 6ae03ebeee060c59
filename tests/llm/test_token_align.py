"""Token alignment against a plain version over lists and dicts."""

import collections
import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from chalkline.llm import token_align
from chalkline.llm.queries import QUERIES

FOLDER = token_align.FOLDER
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="vocabulary files are not installed")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    """Text -> (A ids, B ids), or two empty lists, by other code than the operator's."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(os.path.join(FOLDER, token_align.BYTE_LEVEL))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(FOLDER, token_align.PIECES))
    signs = token_align._byte_of_sign()

    def spans(text):
        whole = (" " + (text or "")).encode()
        found_a = [(i, bytes(signs[c] for c in a.id_to_token(i))) for i in a.encode(" " + (text or ""), add_special_tokens=False).ids]
        found_b = []
        for i in b.encode(text or ""):
            piece = b.id_to_piece(i)
            found_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        fits = text and all(b"".join(p for _, p in f) == whole for f in (found_a, found_b))
        result = []
        for f in (found_a, found_b) if fits else ((), ()):
            at, own = 0, []
            for i, part in f:
                own.append((i, at, at + len(part)))
                at += len(part)
            result.append(own)
        return result

    return spans


def by_hand(texts, plain):
    """Results in the order of the texts."""
    found, held = [], collections.Counter()
    for text in texts:
        a, b = plain(text)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [
            ",".join(str(i) for i, _, e in a if low < e <= high) + "|" + ",".join(str(i) for i, _, e in b if low < e <= high)
            for low, high in zip([0, *cuts], cuts)
        ]
        links = [(i, j) for i, s, e in a for j, x, y in b if s < y and x < e]
        held.update(set(links))
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    highest = collections.defaultdict(int)
    for (i, _), count in held.items():
        highest[i] = max(highest[i], count)
    return [
        (n_a, n_b, n_groups, len(links), sum(held[x] == highest[x[0]] for x in links), sum(held[x] for x in links), checksum)
        for n_a, n_b, n_groups, links, checksum in found
    ]


TEXTS = [
    "Hello world", "Hello  world\n\n\tagain", None, "", " ", "  ", "a▁b", "naïve café 你好 \U0001f642‍❤", "<|endoftext|> </s><s> <0x41>",
    "Hello world", "1234567890 '''ll we've", "\x00\x01", "́é", "ﬁne", "word " * 400, "வணக்கம்", "x" * 3000,
]


@pytest.mark.parametrize("entries", [token_align.BLOCK_ENTRIES, 40])
def test_alignment_equals_plain_version(spark, monkeypatch, plain, entries):
    """Also over many blocks."""
    monkeypatch.setattr(token_align, "BLOCK_ENTRIES", entries)
    rows = [(i if i % 5 else None, t, "x") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string").withColumn("bucket", F.lit(1)).repartition(3)
    got = collections.Counter(map(tuple, token_align.align(df).collect()))
    assert got == collections.Counter((r[0], *x) for r, x in zip(rows, by_hand(TEXTS, plain)))


def test_query_equals_plain_version(spark, plain):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.substring("text", 1, 400).alias("text")).collect()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, token_align.align(df).collect()))
    assert got == sorted((r["doc_id"], *x) for r, x in zip(rows, by_hand([r["text"] for r in rows], plain)))


def test_whole_query(spark):
    rows = QUERIES["op12_token_align"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] and r["n_best"] <= r["n_links"] <= r["count_sum"] for r in rows)


def test_groups_are_components_of_overlaps():
    rng = np.random.default_rng(3)
    for _ in range(200):
        size = int(rng.integers(1, 60))
        ends = [np.append(np.sort(rng.choice(np.arange(1, size), int(rng.integers(0, size)), replace=False)) if size > 1 else [], size).astype(np.int64) for _ in range(2)]
        common = np.intersect1d(*ends)
        for own, group in zip(ends, token_align.group_tokens(*ends)):
            assert np.array_equal(group, np.searchsorted(common, own))
