"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items, texts scanned once.

Words are runs of digits, letters and non-ASCII characters with A-Z lowered; everything else separates.
An item's windows are its runs of `WINDOW` consecutive words (a shorter item is one window). Every
distinct window, spelt as ` word word ... `, is a pattern of the automaton. A document is rewritten
in the same way, scanned once whatever the number of patterns, and the places of the matches are
mapped back to words and to byte spans of the original text.

The automaton is broadcast, and the benchmark may grow: patterns are dealt by hash into as many automata
of at most `PATTERN_BYTES` as they need (one, at any usual size), each scanned in a pass of its own.
"""

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.llm.packed import small_batches

WINDOW = 10
PATTERN_BYTES = 32 << 20

_KEEP = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TABLE = bytearray(b" " * 256)
for _b in range(256):
    if _KEEP.fullmatch(bytes([_b]).lower()):
        _TABLE[_b] = ord(bytes([_b]).lower())
_TABLE = bytes(_TABLE)

HITS = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_words", T.ArrayType(T.LongType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def normalised_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(pattern, items): the distinct windows and the sorted ids of the items that hold them.

    Items without words have no window; an item on several rows has the windows of all of them. Windows of
    a row without an id are patterns like others, but bring no id.
    """
    def split(batches):
        for batch in batches:
            ids, patterns = [], []
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = normalised_words(body)
                for k in range(max(len(words) - window, 0) + 1) if words else ():
                    ids.append(item)
                    patterns.append(" " + b" ".join(words[k:k + window]).decode("latin-1") + " ")
            yield pa.RecordBatch.from_pydict({"item": pa.array(ids, pa.string()), "pattern": pa.array(patterns, pa.string())})

    pairs = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("body"))
    windows = pairs.mapInArrow(split, "item string, pattern string")
    return windows.groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _scanner(automaton_source):
    def scan(batches):
        automaton = _automaton(automaton_source.value)
        for batch in batches:
            rows = batch.column(0).to_pylist()
            counts, hits, spans, items = [], [], [], []
            for body in batch.column(1).to_pylist():
                words = normalised_words(body)
                counts.append(len(words))
                positions, found = _matches(automaton, words)
                hits.append(positions)
                spans.append(_original_spans(body, positions) if positions else [])
                items.append(found)
            yield pa.RecordBatch.from_arrays([
                pa.array(rows, pa.int64()), pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int64())),
                pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string())),
            ], names=["row_id", "n_words", "hit_words", "spans", "items"])

    return scan


def _automaton(patterns):
    automaton = ahocorasick.Automaton()
    for pattern, items in patterns:
        automaton.add_word(pattern, (pattern.count(" ") - 1, len(pattern), tuple(items)))
    if patterns:
        automaton.make_automaton()
    return automaton


def _matches(automaton, words):
    """(sorted positions of the words inside matches, sorted ids of the matched items)."""
    if not words or not len(automaton):
        return [], []
    line = " " + b" ".join(words).decode("latin-1") + " "
    found = list(automaton.iter(line))
    if not found:
        return [], []
    gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)
    covered = np.zeros(len(words), dtype=bool)
    items = set()
    for end, (n, length, ids) in found:
        start = int(np.searchsorted(gaps, end - length + 1))
        covered[start:start + n] = True
        items.update(ids)
    return np.flatnonzero(covered).tolist(), sorted(items)


def _original_spans(text, positions):
    """Byte spans [start, end) of runs of consecutive hit words in the text as it was written."""
    words = [m.span() for m in re.finditer(rb"[^ ]+", text.encode().translate(_TABLE))]
    runs = np.split(np.array(positions), np.flatnonzero(np.diff(positions) > 1) + 1)
    return [[words[run[0]][0], words[run[-1]][1]] for run in runs]


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    window: int = WINDOW, pattern_bytes: int = PATTERN_BYTES,
) -> DataFrame:
    """(doc_id, n_words, hit_words, spans, items) for every row of `documents`, in any order.

    `hit_words` are the positions of words inside a window's occurrence, `spans` the byte spans of
    their runs in the original text, `items` the matched item ids. NULL and empty texts have no words and
    no hits; repeated rows and NULL ids give a row each; other columns are not read, whatever their names.
    An empty benchmark leaves every document clean. An automaton per `pattern_bytes` of patterns
    is scanned; where there are several, their results are joined by a row number that the texts'
    own hash and id make reproducible.
    """
    spark = small_batches(documents.sparkSession)
    windows = item_windows(benchmark, window=window)
    total = windows.select(F.sum(F.octet_length("pattern") + 64)).first()[0] or 0
    blocks = -(-total // pattern_bytes) or 1
    base = documents.select(F.col(doc_id).cast("long").alias("row_id"), F.col(text).alias("body"))

    def scanned(block):
        own = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block)
        patterns = [(r["pattern"], r["items"]) for r in own.collect()]
        return base.mapInArrow(_scanner(spark.sparkContext.broadcast(patterns)), HITS)

    if blocks == 1:
        return scanned(0).withColumnRenamed("row_id", "doc_id")
    # Rows with the same id merge: their hits are joined by id and text, so that repeated rows stay apart from others.
    base = documents.select(F.xxhash64(doc_id, text).alias("row_id"), F.col(text).alias("body"))
    parts = scanned(0)
    for block in range(1, blocks):
        parts = parts.unionByName(scanned(block))
    merged = parts.groupBy("row_id").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    ids = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(doc_id, text).alias("row_id"), F.col(text).alias("body"))
    found = ids.join(merged, "row_id").select("doc_id", "n_words", "hit_words", "items", "body")

    def spans(batches):
        for batch in batches:
            own = [_original_spans(b, h) if h else [] for h, b in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(own, pa.list_(pa.list_(pa.int64()))), batch.column(3)],
                names=["doc_id", "n_words", "hit_words", "spans", "items"],
            )

    return found.mapInArrow(spans, T.StructType([T.StructField("doc_id", T.LongType()), *HITS.fields[1:]]))


def report(hits: DataFrame) -> DataFrame:
    """The digest of `find_contamination`: counts, the item ids hashed, and the verdict."""
    return hits.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `documents`, with all their columns, whose text holds no benchmark window.

    The verdict is a scan beside each row, so nothing is shuffled and repeated ids or odd column names
    do not matter.
    """
    return _clean_rows(documents, benchmark, text)


def _clean_rows(documents, benchmark, text):
    spark = small_batches(documents.sparkSession)
    windows = item_windows(benchmark)
    total = windows.select(F.sum(F.octet_length("pattern") + 64)).first()[0] or 0
    blocks = -(-total // PATTERN_BYTES) or 1
    at = documents.columns.index(text)
    for block in range(blocks):
        own = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block)
        source = spark.sparkContext.broadcast([(r["pattern"], r["items"]) for r in own.collect()])

        def clean(batches, source=source):
            automaton = _automaton(source.value)
            for batch in batches:
                keep = [not _matches(automaton, normalised_words(body))[0] for body in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        documents = documents.mapInArrow(clean, documents.schema)
    return documents
