"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles, as 64-bit hashes. Two documents link when
100 * |A and B| >= percent * |A or B|. The join is exact and gives all links between different sets:

1. Documents with equal sets are one class; its signature (the sum of its hashes) stands for it.
2. In one order of all shingles, a pair that links shares at least l shingles among the first
   n - ceil(percent * n / 100) + l of both, for every l (the multi-match prefix). With the hash itself as the
   order and l a tenth of the set, a class stays only if enough of its prefix occurs in other classes.
3. The classes that stay are ordered by document frequency, rarest first. Each takes the l, up to `MOST_MATCHES`,
   whose prefix has the least estimated cost: postings to scan plus candidates to verify, where
   candidates need l common shingles. Pairs use the smaller l of the two.
4. Every class is first verified against the most central class it shares a posting with, which joins groups of
   near copies at linear cost; pairs still in different components are then enumerated, filtered by
   their matches and sizes, and verified. Components need no more than these links (`spanning`).
5. Pairs within one component are verified too: block against block of its classes, or, where fewer pairs
   meet in its postings than it has, those that share enough of their prefixes.

Posting lists travel as packed arrays by ranges of the hash; a shingle that many documents of a task hold is sent once
per task. Nothing is capped. The links of a group of near copies, and so the work of step 5, grow with the square of its
classes; so does step 4's on a frequent prefix shingle of documents that do not link, in the task that owns it.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm.components import connected_components
from chalkline.llm.packed import bucket_cuts, by_key, grouped, small_batches
from chalkline.llm.words import hashed_words, mixed, slices
from chalkline.sources.tables import scratch_path

WORDS = 5
PERCENT = 80
MOST_MATCHES = 8
BITMAP_WORDS = 32
BLOCK_SETS = 64
BLOCK_SHINGLES = 16_384
BUCKET_SHINGLES = 700_000
FLUSH_SHINGLES = 600_000
FLUSH_DOCUMENTS = 60_000

_SALTS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of one document's word hashes."""
    if not len(words):
        return words
    if len(words) < n:
        return mixed(np.array([(words * _SALTS[n:n + len(words)]).sum() + np.uint64(len(words))], dtype=np.uint64))
    total = words[:len(words) - n + 1] * _SALTS[0]
    for k in range(1, n):
        total = total + words[k:len(words) - n + 1 + k] * _SALTS[k]
    return np.unique(mixed(total))


def column_sets(column, n: int = WORDS):
    """The shingle set of every row of an Arrow text column, in order."""
    for _, data, offsets in slices(column):
        words, at = hashed_words(data, offsets)
        for start, end in zip(at[:-1], at[1:]):
            yield shingles(words[start:end], n)


def signature(own: np.ndarray) -> int:
    return int(mixed(own.sum(dtype=np.uint64, keepdims=True)).astype(np.int64)[0]) if len(own) else 0


def least_overlap(n, percent):
    """What a linked partner of any size shares with a set of n."""
    return -(-percent * n // 100)


def first_prefix(n, percent):
    """(prefix length, matches of one's own, matches that any partner's prefix guarantees)."""
    least = least_overlap(n, percent)
    matches = 1 + n // 10
    return np.minimum(n, n - least + matches), matches, 1 + least // 10


def _signed_rows(n_words):
    def run(batches):
        for batch in batches:
            sets = list(column_sets(batch.column(1), n_words))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([signature(s) for s in sets], pa.int64()),
            ], names=["doc_id", "text_hash", "n_shingles", "sig"])

    return run


def _packed(*arrays):
    """Record batch of (bucket, kind, x, y) from (bucket, kind, x bytes, y bytes) tuples."""
    bucket, kind, x, y = zip(*arrays) if arrays else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int64()), pa.array(kind, pa.int32()), pa.array(x, pa.binary()), pa.array(y, pa.binary())],
        names=["bucket", "kind", "x", "y"],
    )


PACKED = "bucket long, kind int, x binary, y binary"
_POSTINGS, _CREDITS = 0, 1


def _prefix_postings(n_words, percent, buckets):
    """Postings of the prefixes in hash order, and credits for shingles met twice in the same task."""
    def flush(sets, signatures):
        hashes = np.concatenate(sets)
        order = np.argsort(hashes, kind="stable")
        hashes, owners = hashes[order], np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])[order]
        same = np.zeros(len(hashes) + 1, dtype=bool)
        same[1:-1] = hashes[1:] == hashes[:-1]
        many = same[:-1] | same[1:]
        signatures = np.array(signatures, dtype=np.int64)
        credit = np.bincount(owners[many], minlength=len(sets))
        rows = [(int(signatures[0] % buckets), _CREDITS, signatures[credit > 0].tobytes(), credit[credit > 0].astype(np.int32).tobytes())]
        # Of a shingle met in several sets one row goes out, without an owner.
        sent = ~same[:-1]
        hashes, owners = hashes[sent], np.where(many, len(sets), owners)[sent].astype(np.uint16)
        cuts = bucket_cuts(hashes, buckets)
        known = np.append(signatures, 0)
        for bucket in range(buckets):
            a, b = cuts[bucket], cuts[bucket + 1]
            if a < b:
                own, index = np.unique(owners[a:b], return_inverse=True)
                header = np.array([len(own)], dtype=np.int64).tobytes()
                rows.append((bucket, _POSTINGS, hashes[a:b].tobytes(), header + known[own].tobytes() + index.astype(np.uint16).tobytes()))
        return _packed(*rows)

    def run(batches):
        sets, signatures, seen, held = [], [], set(), 0
        for batch in batches:
            for own in column_sets(batch.column(0), n_words):
                sig = signature(own)
                if not len(own) or sig in seen:
                    continue
                seen.add(sig)
                own = own[:first_prefix(len(own), percent)[0]]
                sets.append(own)
                signatures.append(sig)
                held += len(own)
                if held >= FLUSH_SHINGLES or len(sets) >= FLUSH_DOCUMENTS:
                    yield flush(sets, signatures)
                    sets, signatures, seen, held = [], [], set(), 0
        if sets:
            yield flush(sets, signatures)

    return run


def _shared_counts(batches):
    """(sig, shared): how many of a set's sent shingles another set has, by bucket."""
    for _, rows in by_key(batches):
        found_sigs, found_counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        hashes, owners = [], []
        for _, kind, x, y in rows:
            if kind == _CREDITS:
                found_sigs.append(np.frombuffer(x, dtype=np.int64))
                found_counts.append(np.frombuffer(y, dtype=np.int32).astype(np.int64))
            else:
                known = int(np.frombuffer(y, dtype=np.int64, count=1)[0])
                names = np.frombuffer(y, dtype=np.int64, count=known, offset=8)
                hashes.append(np.frombuffer(x, dtype=np.uint64))
                owners.append(names[np.frombuffer(y, dtype=np.uint16, offset=8 + 8 * known)])
        if hashes:
            hashes, owners = np.concatenate(hashes), np.concatenate(owners)
            order = np.argsort(hashes, kind="stable")
            hashes, owners = hashes[order], owners[order]
            starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            sizes = np.diff(np.append(starts, len(hashes)))
            shared = (np.minimum.reduceat(owners, starts) != np.maximum.reduceat(owners, starts)) | (np.minimum.reduceat(np.abs(owners), starts) == 0)
            credited = owners[np.repeat(shared, sizes)]
            sigs, counts = np.unique(credited[credited != 0], return_counts=True)
            found_sigs.append(sigs)
            found_counts.append(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_sigs)), pa.array(np.concatenate(found_counts))], names=["sig", "shared"])


def _set_rows(n_words, chunks):
    def run(batches):
        for batch in batches:
            sets = [s for s in column_sets(batch.column(0), n_words) if len(s)]
            sigs = [signature(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                pa.array([s % chunks for s in sigs], pa.int64()), pa.array(sigs, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()),
            ], names=["chunk", "sig", "n", "shingles"])

    return run


def _chunk_frequencies(buckets):
    """The distinct shingles of each chunk of sets with their counts, by bucket."""
    def run(batches):
        for chunk, rows in by_key(batches):
            once = {row[1]: row[2] for row in rows}
            hashes, counts = np.unique(np.concatenate([np.frombuffer(s, dtype=np.uint64) for s in once.values()]), return_counts=True)
            cuts = bucket_cuts(hashes, buckets)
            sent = []
            for bucket in range(buckets):
                a, b = cuts[bucket], cuts[bucket + 1]
                if a < b:
                    sent.append((bucket, chunk, hashes[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes()))
            yield _packed(*sent)

    return run


def _total_frequencies(batches):
    """For each chunk the shingles that more than one set holds, with their document frequency."""
    for _, rows in by_key(batches):
        parts = [np.frombuffer(row[2], dtype=np.uint64) for row in rows]
        hashes, index = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(index, weights=np.concatenate([np.frombuffer(row[3], dtype=np.uint32) for row in rows]).astype(float))
        sent, at = [], 0
        for row, part in zip(rows, parts):
            own = totals[index[at:at + len(part)]].astype(np.int64)
            at += len(part)
            more = own > 1
            sent.append((row[1], 0, part[more].tobytes(), own[more].tobytes()))
        yield _packed(*sent)


POSTING = "shingle long, sig long, n int, alone int, place int, matches int, weight long"


def choose_matches(frequencies: np.ndarray, n: int, percent: int, most: int = MOST_MATCHES) -> int:
    """The l with the least estimated cost, from the document frequencies of a set, rarest first."""
    least = least_overlap(n, percent)
    scanned = np.concatenate([[0], np.cumsum(frequencies - 1)])
    options = np.arange(1, min(most, least) + 1)
    scans = scanned[np.minimum(n - least + options, n)]
    return int(options[np.argmin(scans + scans / options * (n / 8))])


def _adaptive_postings(percent):
    """Prefix postings of every set: rows of kind 0 bring a chunk's frequencies, rows of kind 1 its sets."""
    def run(batches):
        for _, rows in by_key(batches):
            known = [(np.frombuffer(r[3], dtype=np.uint64), np.frombuffer(r[4], dtype=np.int64)) for r in rows if r[1] == 0]
            hashes = np.concatenate([h for h, _ in known] or [np.zeros(0, np.uint64)])
            totals = np.concatenate([d for _, d in known] or [np.zeros(0, np.int64)])
            order = np.argsort(hashes, kind="stable")
            hashes, totals = hashes[order], totals[order]
            columns = [[] for _ in range(7)]
            done = set()
            for _, kind, sig, x, _ in rows:
                if kind == 0 or sig in done:
                    continue
                done.add(sig)
                own = np.frombuffer(x, dtype=np.uint64)
                df = np.ones(len(own), np.int64)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                    df = np.where(hashes[at] == own, totals[at], 1)
                ranked = np.lexsort((own, df))
                own, df = own[ranked], df[ranked]
                n = len(own)
                matches = choose_matches(df, n, percent)
                end = min(n, n - least_overlap(n, percent) + matches)
                first = int(np.searchsorted(df, 2))
                if first < end:
                    size = end - first
                    for column, values in zip(columns, (
                        own[first:end].view(np.int64), np.full(size, sig), np.full(size, n, np.int32), np.full(size, first, np.int32),
                        np.arange(first + 1, end + 1, dtype=np.int32), np.full(size, matches, np.int32), np.full(size, df.sum()),
                    )):
                        column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in columns], names=["shingle", "sig", "n", "alone", "place", "matches", "weight"]
                )

    return run


def _overlap_needed(a, b, percent):
    """Columns: the least intersection of linked sets of sizes a and b."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent))


def _near_enough(percent):
    """A condition on columns of x and y: either set has enough shingles that any other set holds (not `alone`), and
    both entries lie in the prefixes that the two sizes leave."""
    need = _overlap_needed(F.col("x.n"), F.col("y.n"), percent)
    near = F.lit(True)
    for side in "xy":
        n, place, matches, alone = (F.col(f"{side}.{name}") for name in ("n", "place", "matches", "alone"))
        near &= (n - alone >= need) & (place <= n - need + matches)
    return near


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, common, either) of the pairs of signatures that link."""
    left = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(left.hint("merge"), "a").join(right.hint("merge"), "b")

    def overlaps(batches):
        for batch in batches:
            counts = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                counts.append((common, len(x) + len(y) - common))
            keep = pa.array([100 * common >= percent * either for common, either in counts], pa.bool_())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([c for c, _ in counts], pa.int64()), pa.array([e for _, e in counts], pa.int64()),
            ], names=["a", "b", "common", "either"]).filter(keep)

    return both.select("a", "b", "sa", "sb").mapInArrow(overlaps, "a long, b long, common long, either long")


class Join:
    """The tables of one join: `rows` (doc_id, text_hash, n_shingles, sig), `links` (a, b, common, either), `labels` (id, label)."""

    def __init__(self, rows, links, labels):
        self.rows, self.links, self.labels = rows, links, labels


def ngram_join(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", n_words: int = WORDS, percent: int = PERCENT, spanning: bool = False,
) -> Join:
    """Runs the join over whole texts and writes its tables to the scratch folder.

    `links` are all pairs of class signatures that link, or, if `spanning`, verified ones that span every
    component; classes are the rows of equal signature. NULL and empty texts have no shingles and no links. Ids may be NULL or repeat, also with different
    texts; other columns are not read. Empty tables give empty ones.
    """
    spark = small_batches(documents.sparkSession)
    root = scratch_path(spark, "ngram-join")

    def written(df, name):
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    own = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    hashed = own.withColumn("text_hash", F.xxhash64("text"))
    rows = written(hashed.mapInArrow(_signed_rows(n_words), "doc_id long, text_hash long, n_shingles long, sig long"), "rows")
    classes = rows.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"))
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(16, total // (3 * BUCKET_SHINGLES))

    postings = own.select("text").mapInArrow(_prefix_postings(n_words, percent, buckets), PACKED)
    shared = grouped(postings, "bucket").mapInArrow(_shared_counts, "sig long, shared long").groupBy("sig").agg(F.sum("shared").alias("shared"))
    least = F.ceil(F.lit(percent) * F.col("n") / 100)
    staying = written(classes.join(shared, "sig").where(F.col("shared") >= 1 + F.floor(least / 10)).select("sig", "doc_id", "n"), "staying")

    remaining = staying.agg(F.sum("n")).first()[0] or 0
    chunks = buckets = max(16, remaining // BUCKET_SHINGLES)
    ids = staying.select(F.col("doc_id").alias("kept_id")).distinct()
    texts = own.join(ids.hint("merge"), own.doc_id.eqNullSafe(ids.kept_id), "left_semi").select("text")
    sets = written(texts.mapInArrow(_set_rows(n_words, chunks), "chunk long, sig long, n long, shingles binary"), "sets")

    counts = grouped(sets.select("chunk", "sig", "shingles"), "chunk").mapInArrow(_chunk_frequencies(buckets), PACKED)
    totals = grouped(counts, "bucket").mapInArrow(_total_frequencies, PACKED)
    brought = totals.select(F.col("bucket").alias("chunk"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("sig"), "x", "y")
    packed = sets.select("chunk", F.lit(1).alias("kind"), "sig", F.col("shingles").alias("x"), F.lit(None).cast("binary").alias("y"))
    prefixes = written(grouped(brought.unionByName(packed), "chunk").mapInArrow(_adaptive_postings(percent), POSTING), "prefixes")

    first = written(verified(_hub_pairs(prefixes, percent), sets, percent), "links-hub")
    near = connected_components(first.select("a", "b"))
    across = written(verified(_cross_pairs(prefixes, near, sets, percent), sets, percent), "links-cross")
    links = first.unionByName(across)
    if not spanning:
        links = written(_inner_links(prefixes, near, sets, percent), "links-inner").unionByName(across)
    return Join(rows, links, near if across.isEmpty() else connected_components(links.select("a", "b")))


def _hub_pairs(prefixes, percent):
    """For each class the two central classes with which it has most postings in common."""
    hubs = prefixes.groupBy("shingle").agg(F.max(F.struct("weight", "sig", "n", "alone", "place", "matches")).alias("hub"))
    joined = prefixes.alias("x").join(hubs.selectExpr("shingle", "hub.*").alias("y"), "shingle")
    near = joined.where((F.col("x.sig") != F.col("y.sig")) & _near_enough(percent))
    counted = near.groupBy(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).agg(F.count("*").alias("common"), F.max("y.weight").alias("weight"))
    best = counted.groupBy("a").agg(
        F.max(F.struct("common", "weight", "b")).alias("most"), F.max(F.struct("weight", "common", "b")).alias("central")
    )
    return best.select(F.explode(F.array_distinct(F.array("most.b", "central.b"))).alias("b"), "a").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def _bitmaps(batches):
    """Each set's shingles as a bitmap of their first bits."""
    for batch in batches:
        maps = []
        for own in batch.column(1).to_pylist():
            places = np.frombuffer(own, dtype=np.uint64) >> np.uint64(64 - (BITMAP_WORDS * 64).bit_length() + 1)
            words = np.zeros(BITMAP_WORDS, dtype=np.uint64)
            np.bitwise_or.at(words, (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63)))
            maps.append(words.view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(maps, pa.list_(pa.int64()))], names=["sig", "bits"])


def _missing(one, other):
    """At least so many of one's shingles are not in the other: bits of its map that the other's lacks."""
    lacking = F.zip_with(one, other, lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b))))
    return F.aggregate(lacking, F.lit(0), lambda total, n: total + n)


def _cross_pairs(prefixes, labels, sets, percent):
    """Pairs of different components with enough common prefix shingles.

    Within a posting the main component (of the most central class) is never paired with itself: only rows outside
    it look for partners. Near copies that were not linked to the centre meet very many rows of the
    main component; most of these are ruled out when they meet, by bitmaps that show too many missing shingles.
    """
    own = prefixes.join(labels.select(F.col("id").alias("sig"), "label"), "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    mixed_lists = own.groupBy("shingle").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.struct("weight", "sig", "label")).alias("hub")
    ).where("low <> high").select("shingle", F.col("hub.label").alias("main"))
    rows = own.join(mixed_lists, "shingle")
    bits = sets.select("sig", "shingles").mapInArrow(_bitmaps, "sig long, bits array<long>").dropDuplicates(["sig"])
    rows = rows.join(bits, "sig")
    x, y = rows.where("label <> main").alias("x"), rows.alias("y")
    once = (F.col("y.label") == F.col("y.main")) | (F.col("x.sig") < F.col("y.sig"))
    need = _overlap_needed(F.col("x.n"), F.col("y.n"), percent)
    likely = (_missing(F.col("x.bits"), F.col("y.bits")) <= F.col("x.n") - need) & (_missing(F.col("y.bits"), F.col("x.bits")) <= F.col("y.n") - need)
    apart = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.label") != F.col("y.label"))
    met = x.join(y, apart & once & _near_enough(percent) & likely)
    low = F.col("x.sig") < F.col("y.sig")

    def side(wanted, name):
        return F.when(low if wanted == "low" else ~low, F.col(f"x.{name}")).otherwise(F.col(f"y.{name}"))

    oriented = met.select(
        side("low", "sig").alias("a"), side("high", "sig").alias("b"), F.least("x.matches", "y.matches").alias("matches")
    )
    counted = oriented.groupBy("a", "b", "matches").agg(F.count("*").alias("common"))
    return counted.where("common >= matches").select("a", "b")


def _inner_links(prefixes, labels, sets, percent):
    """(a, b, common, either) of all links within the components."""
    own = prefixes.join(labels.select(F.col("id").alias("sig"), "label"), "sig")
    held = own.groupBy("label", "shingle").agg(F.count("*").alias("m"))
    met = held.groupBy("label").agg(F.sum(F.col("m") * (F.col("m") - 1)).alias("met"))
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    way = sizes.join(met, "label", "left").select(
        "label", "size", ((F.col("size") <= BLOCK_SETS) | (F.col("size") * (F.col("size") - 1) <= F.coalesce("met", F.lit(0)))).alias("whole")
    )
    ways = labels.join(way, "label").select(F.col("id").alias("sig"), "label", "size", "whole")
    members = sets.dropDuplicates(["sig"]).join(ways.where("whole"), "sig")
    blocks = F.ceil(F.col("size") / BLOCK_SETS)
    placed = members.withColumn("block", F.pmod(F.xxhash64("sig"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    cell = F.concat_ws(" ", "label", F.least("block", "other"), F.greatest("block", "other")).alias("cell")
    blockwise = grouped(placed.select(cell, "block", "sig", "shingles"), "cell").mapInArrow(
        _block_links(percent), "a long, b long, common long, either long"
    )
    fewer = own.join(ways.where("NOT whole").select("sig", "size"), "sig")
    postings = fewer.join(held, ["label", "shingle"]).where("m > 1")
    # A hot posting is split: x lies in one of its parts, y in all.
    parts = F.ceil(F.col("m") / BLOCK_SETS)
    x = postings.withColumn("part", F.pmod(F.xxhash64("sig"), parts)).alias("x")
    y = postings.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).alias("y")
    same = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.label") == F.col("y.label")) & (F.col("x.part") == F.col("y.part"))
    pairs = x.join(y, same & (F.col("x.sig") < F.col("y.sig")) & _near_enough(percent)).select(
        F.col("x.sig").alias("a"), F.col("y.sig").alias("b"), F.least("x.matches", "y.matches").alias("matches")
    ).groupBy("a", "b", "matches").agg(F.count("*").alias("common")).where("common >= matches")
    return blockwise.unionByName(verified(pairs, sets, percent))


def _block_links(percent):
    """The links between two blocks of sets, or within one."""
    def run(batches):
        for _, rows in by_key(batches):
            sets = [np.frombuffer(r[3], dtype=np.uint64) for r in rows]
            sizes = np.array([len(s) for s in sets])
            hashes, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            known, index, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            shared = counts > 1
            place, often = (np.cumsum(shared) - 1)[index], shared[index]
            order = np.argsort(place[often], kind="stable")
            place, owners = place[often][order], owners[often][order]
            common = np.zeros((len(sets), len(sets)))
            for first in range(0, int(shared.sum()), BLOCK_SHINGLES):
                a, b = np.searchsorted(place, (first, first + BLOCK_SHINGLES))
                holds = np.zeros((len(sets), BLOCK_SHINGLES), dtype=np.float32)
                holds[owners[a:b], place[a:b] - first] = 1
                common += holds @ holds.T
            common = common.astype(np.int64)
            either = sizes[:, None] + sizes - common
            blocks, sigs = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
            # Of a cell of two blocks only pairs across them are its own.
            own = (blocks[:, None] != blocks) if rows[0][0].split()[1] != rows[0][0].split()[2] else True
            x, y = np.nonzero((100 * common >= percent * either) & (sigs[:, None] < sigs) & own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs[x]), pa.array(sigs[y]), pa.array(common[x, y]), pa.array(either[x, y])], names=["a", "b", "common", "either"]
            )

    return run


def links_by_document(join: Join) -> DataFrame:
    """`components_by_document` and n_links, the number of other rows that link with a row; equal sets link.

    The join must not be a `spanning` one.
    """
    copies = join.rows.where("n_shingles > 0").groupBy("sig").agg(F.count("*").alias("copies"))
    ends = join.links.select("a", "b").unionByName(join.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(copies.withColumnRenamed("sig", "b"), "b").groupBy(F.col("a").alias("sig")).agg(F.sum("copies").alias("others"))
    counted = copies.join(others, "sig", "left").select("sig", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    own = components_by_document(join).join(counted, "sig", "left")
    return own.withColumn("n_links", F.when(F.col("n_shingles") > 0, F.col("n_links")).otherwise(F.lit(0).cast("long")))


def components_by_document(join: Join) -> DataFrame:
    """(doc_id, n_shingles, sig, component, component_id), one row per row of the documents.

    `component_id` is the smallest doc_id reachable by links, `component` its signature label. A row without
    shingles is a component of its own.
    """
    labelled = _labelled(join)
    smallest = labelled.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least_id"))
    return labelled.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", "sig", "component",
        F.when(F.col("n_shingles") > 0, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _labelled(join: Join) -> DataFrame:
    rows = join.rows.join(join.labels.select(F.col("id").alias("sig"), "label"), "sig", "left")
    return rows.withColumn("component", F.coalesce("label", "sig")).drop("label")


def drop_copies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of `documents`, with their columns, less all but one of each component.

    The row with the smallest id stays (NULL ids come last; of several texts under that id, the one with the
    smallest hash). Rows without shingles all stay. A row that repeats another in id and text counts as its copy.
    """
    join = ngram_join(documents, doc_id, text, percent=percent, spanning=True)
    rows = _labelled(join).where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = rows.groupBy("component").agg(F.min(order).alias("kept")).select("component", "kept.doc_id", "kept.text_hash")
    kept = first.select(F.col("component").alias("k_component"), F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("text_hash") == F.col("k_hash"))
    gone = rows.join(kept, (F.col("component") == F.col("k_component")) & same, "left_anti")
    gone = gone.select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    hashed = documents.select(F.col(f"`{doc_id}`").cast("long").alias("own_id"), F.xxhash64(F.col(f"`{text}`")).alias("own_hash"), row)
    match = F.col("own_id").eqNullSafe(F.col("g_id")) & (F.col("own_hash") == F.col("g_hash"))
    left = hashed.join(gone.hint("merge"), match, "left_anti")
    repeats = rows.groupBy("doc_id", "text_hash").count().where("count > 1")
    if repeats.isEmpty():
        return left.select("row.*")
    wordless = ~F.coalesce(F.col(f"row.`{text}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    once = left.where(~wordless).dropDuplicates(["own_id", "own_hash"])
    return left.where(wordless).unionByName(once).select("row.*")
