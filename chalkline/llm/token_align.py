"""Alignment of two tokenizers' tokens over the same text, and how the corpus pairs them.

A text's byte-level BPE tokens (A) and word-piece BPE tokens (B) cover the same bytes. Tokens that overlap, directly or
through others, form a group. Groups are found by pointer jumping: every token points to its farthest-right overlapping
token, the last of a group to itself, and successors are doubled, for all tokens of a slice of texts at
once, until they stand still: log2 of the longest group's chain rounds. A pair of overlapping tokens is a link; links
are the pieces between neighbouring token ends, so there are as many as tokens less groups.

Over the corpus an id pair counts the documents that hold it linked. Texts are tokenized once, in blocks of about
`BLOCK_ENTRIES` pairs of document and id pair. A block sends its distinct id pairs, with the number of its documents
that hold each, to buckets of A ids; buckets add up what comes and answer every block with the counts of its own pairs, and
whether they are their A id's highest. So a frequent token costs one row a block, and nothing is broadcast. The
blocks' packed entries then meet their answers. Every step holds one block or one bucket (at most its A ids times all B ids).
"""

import hashlib
import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm.packed import small_batches
from chalkline.llm.words import slices
from chalkline.sources.tables import scratch_path

FOLDER = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_ENTRIES = 1 << 21
BLOCK_DOCUMENTS = 1 << 16
BUCKETS = 64
DOCUMENTS_PER_BUCKET = 4096
SUM_AT = 1 << 22

# How byte-level BPE splits text before it merges (fixed value).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteTable:
    """Byte strings by number, to be laid end to end."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all strings, end of each)."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        places += np.arange(len(places))
        return self.flat[places], ends


def _byte_of_sign() -> dict[str, int]:
    """The signs that byte-level vocabularies write for the 256 bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken

        with open(os.path.join(folder, BYTE_LEVEL), encoding="utf-8") as file:
            stored = json.load(file)
        signs, special = _byte_of_sign(), {t["content"] for t in stored["added_tokens"]}
        vocabulary = stored["model"]["vocab"]
        own = {token: bytes(signs[c] for c in token) for token in vocabulary if token not in special}
        # The engine merges by rank; ranks are the ids, so ids must follow the order of the merges.
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in stored["model"]["merges"]]
        if [vocabulary[m] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError(f"{BYTE_LEVEL}: ids do not follow the merges")
        self.a = tiktoken.Encoding("byte-level", pat_str=_SPLIT, mergeable_ranks={b: vocabulary[t] for t, b in own.items()}, special_tokens={})
        in_order = [b""] * (max(vocabulary.values()) + 1)
        for token, content in own.items():
            in_order[vocabulary[token]] = content
        self.a_bytes = ByteTable(in_order)
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECES))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = ByteTable([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ])
        self.a_size, self.b_size = len(in_order), len(pieces)
        # A ids are dealt to buckets in a mixed order, so that frequent ones, which have low ids, lie apart.
        self.mixed_a = np.random.RandomState(0).permutation(self.a_size).astype(np.int64)
        self.digits = ByteTable([b"%d," % i for i in range(max(self.a_size, self.b_size))])

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of " " + text by A, and of the texts, before which it puts a space itself, by B."""
        return [self.a.encode_ordinary(" " + t) for t in texts], self.b.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def tokenizers(folder: str) -> Tokenizers:
    return Tokenizers(folder)


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, number in each list)."""
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64), np.array([len(x) for x in lists], dtype=np.int64)


def _before(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def group_tokens(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number of every A and B token, from the ends of two partitions of the same bytes."""
    n_a, n_b = len(a_ends), len(b_ends)
    a_at = np.repeat(np.arange(n_a), np.diff(a_ends, prepend=0))
    b_at = np.repeat(np.arange(n_b), np.diff(b_ends, prepend=0))
    over_a, over_b = b_at[a_ends - 1], a_at[b_ends - 1]
    # Of tokens that end together the A token is the farthest.
    successor = np.concatenate([np.where(b_ends[over_a] > a_ends, n_a + over_a, np.arange(n_a)), over_b])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            break
        successor = further
    number = np.cumsum(successor[:n_a] == np.arange(n_a)) - 1
    return number[successor[:n_a]], number[successor[n_a:]]


class Aligned:
    """The alignment of a slice of texts; arrays by document unless said otherwise."""

    def __init__(self, t: Tokenizers, data: np.ndarray, offsets: np.ndarray):
        sizes = np.diff(offsets)
        texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
        a_lists, b_lists = t.encode(texts)
        some = sizes > 0
        # " " + text of every document.
        spaced = np.insert(data, offsets[:-1], 32) if len(sizes) else data
        for table, lists in ((t.a_bytes, a_lists), (t.b_bytes, b_lists)):
            some &= self._covers(table, lists, spaced, sizes + 1)
        self.valid = some
        kept = np.flatnonzero(some)
        a, a_counts = _flat([a_lists[k] for k in kept])
        b, b_counts = _flat([b_lists[k] for k in kept])
        n = len(sizes)
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n, dtype=np.int64) for _ in range(4))
        self.n_a[kept], self.n_b[kept] = a_counts, b_counts
        self.checksums = [""] * n
        self.entry_documents, self.entry_pairs, self.entry_times = (np.zeros(0, dtype=np.int64) for _ in range(3))
        if not len(kept):
            return
        a_ends, b_ends = np.cumsum(t.a_bytes.lengths[a]), np.cumsum(t.b_bytes.lengths[b])
        a_group, b_group = group_tokens(a_ends, b_ends)
        a_lasts = np.cumsum(a_counts) - 1
        self.n_groups[kept] = np.diff(a_group[a_lasts] + 1, prepend=0)
        for k, text in zip(kept, self._written(t, a, b, a_group, b_group, a_counts + b_counts)):
            self.checksums[k] = hashlib.sha256(text).hexdigest()
        # A link for each piece between neighbouring ends.
        total = int(a_ends[-1])
        ends = np.zeros(total + 1, dtype=bool)
        ends[a_ends] = ends[b_ends] = True
        self.n_links[kept] = np.diff(np.cumsum(ends)[a_ends[a_lasts]], prepend=0)
        at = np.flatnonzero(ends) - 1
        own_a = a[np.repeat(np.arange(len(a)), t.a_bytes.lengths[a])[at]]
        own_b = b[np.repeat(np.arange(len(b)), t.b_bytes.lengths[b])[at]]
        pairs = t.mixed_a[own_a] * t.b_size + own_b
        room = t.a_size * t.b_size
        entries, self.entry_times = np.unique(np.repeat(kept, self.n_links[kept]) * room + pairs, return_counts=True)
        self.entry_documents, self.entry_pairs = np.divmod(entries, room)

    @staticmethod
    def _covers(table, lists, spaced, sizes):
        """Whether a document's joined token bytes are its text after a space."""
        ids, counts = _flat(lists)
        document = np.repeat(np.arange(len(sizes)), counts)
        lengths = np.bincount(document, weights=table.lengths[ids], minlength=len(sizes)).astype(np.int64)
        fits = lengths == sizes
        joined, _ = table.joined(ids[fits[document]])
        wanted = spaced[np.repeat(fits, sizes)]
        wrong = np.repeat(np.flatnonzero(fits), sizes[fits])[joined != wanted]
        fits[wrong] = False
        return fits

    @staticmethod
    def _written(t, a, b, a_group, b_group, counts):
        """`a1,a2|b1;a3|b2,b3` of every document."""
        groups = a_group[-1] + 1
        of_a, of_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        first = _before(of_a + of_b)
        a_place = first[a_group] + np.arange(len(a)) - _before(of_a)[a_group]
        b_place = (first + of_a)[b_group] + np.arange(len(b)) - _before(of_b)[b_group]
        ids, signs = np.empty(len(a) + len(b), dtype=np.int64), np.full(len(a) + len(b), ord(","), dtype=np.uint8)
        ids[a_place], ids[b_place] = a, b
        signs[first + of_a - 1], signs[first + of_a + of_b - 1] = ord("|"), ord(";")
        text, ends = t.digits.joined(ids)
        text[ends - 1] = signs
        stops = ends[np.cumsum(counts) - 1]
        return [text[start:stop - 1].tobytes() for start, stop in zip(np.concatenate([[0], stops[:-1]]), stops)]


def _squeezed(values: np.ndarray, kind: str) -> bytes:
    raw = np.ascontiguousarray(values.astype(kind)).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def _loose(content: bytes, kind: str) -> np.ndarray:
    if not content:
        return np.zeros(0, dtype=kind)
    size = int.from_bytes(content[:8], "little")
    return np.frombuffer(pa.decompress(content[8:], decompressed_size=size, codec="zstd", asbytes=True), dtype=kind)


def _steps(sorted_keys: np.ndarray) -> bytes:
    return _squeezed(np.diff(sorted_keys, prepend=0), "<u8")


def _keys(content: bytes) -> np.ndarray:
    return np.cumsum(_loose(content, "<u8").astype(np.int64))


_PAIRS, _BLOCK = 0, 1
TOKENIZED = (
    "kind int, bucket long, block long, keys binary, counts binary, doc_ids array<long>, numbers binary, checksums array<string>, "
    "sizes binary, places binary, times binary"
)
_TOKENIZED = pa.schema([
    ("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
    ("numbers", pa.binary()), ("checksums", pa.list_(pa.string())), ("sizes", pa.binary()), ("places", pa.binary()), ("times", pa.binary()),
])


class _Block:
    def __init__(self):
        self.ids, self.parts, self.entries = [], [], 0

    def add(self, ids, aligned):
        self.ids += ids
        self.parts.append(aligned)
        self.entries += len(aligned.entry_pairs)

    def rows(self, t, buckets, number):
        pairs = np.concatenate([p.entry_pairs for p in self.parts])
        keys, places, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        cuts = np.searchsorted(keys // t.b_size * buckets // t.a_size, np.arange(buckets + 1))
        rows = [
            {"kind": _PAIRS, "bucket": bucket, "block": number, "keys": _steps(keys[x:y]), "counts": _squeezed(counts[x:y], "<u4")}
            for bucket, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if x < y
        ]
        sizes = np.concatenate([np.bincount(p.entry_documents, minlength=len(p.valid)) for p in self.parts])
        # Places of a document's entries rise; the step to the first is from 0.
        steps = np.diff(places, prepend=0)
        firsts = _before(sizes)[sizes > 0]
        steps[firsts] = places[firsts]
        numbers = np.concatenate([np.stack([p.n_a, p.n_b, p.n_groups, p.n_links]) for p in self.parts], axis=1)
        rows.append({
            "kind": _BLOCK, "block": number, "doc_ids": self.ids, "numbers": _squeezed(numbers, "<u8"),
            "checksums": [c for p in self.parts for c in p.checksums], "sizes": _squeezed(sizes, "<u4"), "places": _squeezed(steps, "<u4"),
            "times": _squeezed(np.concatenate([p.entry_times for p in self.parts]), "<u4"),
        })
        return pa.RecordBatch.from_pylist(rows, schema=_TOKENIZED)


def _tokenized(folder, buckets):
    def run(batches):
        t, number, block = tokenizers(folder), TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, data, offsets in slices(batch.column(1)):
                block.add(ids[first:first + len(offsets) - 1], Aligned(t, data, offsets))
                if block.entries >= BLOCK_ENTRIES or len(block.ids) >= BLOCK_DOCUMENTS:
                    yield block.rows(t, buckets, number)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.rows(t, buckets, number)

    return run


def _added(parts):
    keys, index = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(index, weights=np.concatenate([c for _, c in parts]), minlength=len(keys)).astype(np.int64)


def _bucket_totals(b_size):
    """(bucket, keys, counts, best) of every bucket, from the blocks' rows that stand together."""
    def total(bucket, parts):
        keys, counts = _added(parts)
        a = keys // b_size
        starts = np.flatnonzero(np.diff(a, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.append(starts, len(a))))
        return pa.RecordBatch.from_pydict({
            "bucket": [bucket], "keys": [_steps(keys)], "counts": [_squeezed(counts, "<u8")], "best": [_squeezed(counts == highest, "u1")],
        })

    def run(batches):
        current, parts, held = None, [], 0
        for batch in batches:
            for bucket, keys, counts in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != current and parts:
                    yield total(current, parts)
                    parts, held = [], 0
                current = bucket
                parts.append((_keys(keys), _loose(counts, "<u4").astype(np.int64)))
                held += len(parts[-1][0])
                if held >= SUM_AT + 2 * len(parts[0][0]):
                    parts, held = [_added(parts)], 0
        if parts:
            yield total(current, parts)

    return run


def _answers(batches):
    """What a bucket knows about the pairs of each block. Its totals come before the blocks."""
    known = counts = best = None
    for batch in batches:
        for _, kind, block, bucket, keys, total, highest in zip(*[c.to_pylist() for c in batch.columns]):
            if kind == 0:
                known, counts, best = _keys(keys), _loose(total, "<u8"), _loose(highest, "u1")
                continue
            at = np.searchsorted(known, _keys(keys))
            yield pa.RecordBatch.from_pydict({
                "block": [block], "bucket": [bucket], "counts": [_squeezed(counts[at], "<u8")], "best": [_squeezed(best[at], "u1")],
            })


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _documents(batches):
    """The result of every document of a block, after the answers for it, which come by bucket."""
    counts, best = [], []
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                counts.append(_loose(row["counts"], "<u8"))
                best.append(_loose(row["best"], "u1"))
                continue
            sizes, times = _loose(row["sizes"], "<u4").astype(np.int64), _loose(row["times"], "<u4").astype(np.int64)
            n_best = count_sum = np.zeros(len(sizes), dtype=np.int64)
            if len(times):
                firsts = _before(sizes)[sizes > 0]
                places = np.cumsum(_loose(row["places"], "<u4").astype(np.int64))
                places -= np.repeat(places[firsts] - _loose(row["places"], "<u4")[firsts].astype(np.int64), sizes[sizes > 0])
                own_counts, own_best = np.concatenate(counts)[places].astype(np.int64), np.concatenate(best)[places].astype(np.int64)
                n_best, count_sum = n_best.copy(), count_sum.copy()
                n_best[sizes > 0] = np.add.reduceat(own_best * times, firsts)
                count_sum[sizes > 0] = np.add.reduceat(own_counts * times, firsts)
            numbers = _loose(row["numbers"], "<u8").astype(np.int64).reshape(4, -1)
            columns = [pa.array(row["doc_ids"], pa.int64()), *map(pa.array, numbers), pa.array(n_best), pa.array(count_sum), pa.array(row["checksums"], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
            counts, best = [], []


def align(documents: DataFrame, folder: str = FOLDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `documents`: its tokens, groups and links, and how the corpus counts its links' id pairs.

    `folder` holds the vocabulary files on every machine. NULL and empty texts, and those whose tokens do not give back a space and
    the text byte by byte, have no tokens: zeros and the empty checksum; they count for no pair. Every row is a document of its
    own, whatever its id (a long, NULL allowed). Other columns are not read. An empty table gives no rows.
    """
    spark = small_batches(documents.sparkSession)
    root = scratch_path(spark, "token-align")
    own = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    buckets = int(min(max(own.count() // DOCUMENTS_PER_BUCKET, BUCKETS), 8192))
    own.mapInArrow(_tokenized(folder, buckets), TOKENIZED).write.partitionBy("kind").parquet(f"{root}/tokenized")
    tokenized = spark.read.schema(TOKENIZED).parquet(f"{root}/tokenized")
    pairs = tokenized.where(f"kind = {_PAIRS}").select("bucket", "block", "keys", "counts")

    def together(df, *order):
        return df.repartition(F.col(order[0])).sortWithinPartitions(*order)

    b_size = tokenizers(folder).b_size
    totals = together(pairs.select("bucket", "keys", "counts"), "bucket").mapInArrow(
        _bucket_totals(b_size), "bucket long, keys binary, counts binary, best binary"
    )
    empty = F.lit(None)
    asked = totals.select("bucket", F.lit(0).alias("kind"), empty.cast("long").alias("block"), "keys", "counts", "best").unionByName(
        pairs.select("bucket", F.lit(1).alias("kind"), "block", "keys", empty.cast("binary").alias("counts"), empty.cast("binary").alias("best"))
    )
    answers = together(asked, "bucket", "kind").select("bucket", "kind", "block", F.col("bucket").alias("from"), "keys", "counts", "best").mapInArrow(
        _answers, "block long, bucket long, counts binary, best binary"
    )
    blocks = tokenized.where(f"kind = {_BLOCK}").select(
        F.lit(1).alias("kind"), "block", F.lit(0).cast("long").alias("bucket"), empty.cast("binary").alias("counts"), empty.cast("binary").alias("best"),
        "doc_ids", "numbers", "checksums", "sizes", "places", "times",
    )
    met = blocks.unionByName(answers.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return together(met, "block", "kind", "bucket").mapInArrow(_documents, RESULT)
