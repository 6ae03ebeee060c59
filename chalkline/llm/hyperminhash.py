"""Near duplicates by HyperMinHash sketches, confirmed on full sets.

A document is the set of its distinct two-word shingles, as 64-bit hashes. The first eight bits of a hash choose one of 256
registers, which keeps the least of the rest in 16 bits: its leading zeros and `MANTISSA` bits after them. Registers that a
small set leaves empty borrow from others along one pseudo-random path for all sets, so that any register agrees
in two sets with the probability of their similarity, if by chance not, with 2**-`MANTISSA` or less.

1. Documents with equal sets are one class; its signature (the sum of its hashes) stands for it.
2. `BAND` registers make a band; classes that agree in one of the 51 bands are candidates. At a similarity of 0.8 a pair
   agrees in none with a probability of about 1e-8, above it far less often.
3. Of each band's bucket, every class is compared with the one of the least signature first. Pairs whose similarity, estimated from
   all registers less the agreements expected of different minima, may be enough are verified on the full
   sets. That joins groups of near copies at linear cost. Sizes, and bitmaps that show too many missing shingles, rule out most
   others of the pairs before, never one that links.
4. Where a bucket still holds several components, the classes outside the first one's component are compared with all others, block by
   block (`BLOCK` classes), and pairs of different components that pass the estimate are verified.

Links inside a component need no more pairs. Nothing is capped: a bucket of any size is dealt to blocks.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.llm.components import connected_components
from chalkline.llm.ngram_join import column_sets, signature, verified
from chalkline.llm.packed import by_key, grouped, small_batches
from chalkline.llm.words import mixed
from chalkline.sources.tables import scratch_path

WORDS = 2
PERCENT = 80
REGISTERS = 256
MANTISSA = 10
BAND = 5
BLOCK = 512
# The estimate's standard deviation is about 0.03; pairs this far below the wanted similarity are verified all the same.
MARGIN = 0.2
PATHS = 1024
SEEN = 100_000
FILTER_BITS = 1 << 26

EMPTY_REGISTER = np.uint16(65535)
_BITS = 53
_MAP_WORDS = 32
_BANDS = REGISTERS // BAND
_SALTS = mixed(np.arange(1, BAND + 1, dtype=np.uint64)) | np.uint64(1)
_STEPS = (mixed(np.arange(PATHS * REGISTERS, dtype=np.uint64)) >> np.uint64(56)).astype(np.int64).reshape(PATHS, REGISTERS)


def packed_minima(rest: np.ndarray) -> np.ndarray:
    """Leading zeros and the bits after the first one, of 53-bit numbers, in 16 bits. Greater numbers give no greater zeros."""
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    shift = length - 1 - MANTISSA
    after = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64))
    return (((_BITS - length) << MANTISSA) | (after.astype(np.int64) & ((1 << MANTISSA) - 1))).astype(np.uint16)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of each set of sorted distinct hashes, none of them empty."""
    registers = np.full((len(sets), REGISTERS), EMPTY_REGISTER, dtype=np.uint16)
    if not sets:
        return registers
    hashes = np.concatenate(sets)
    cells = np.repeat(np.arange(len(sets)) * REGISTERS, [len(s) for s in sets]) + (hashes >> np.uint64(56)).astype(np.int64)
    # Hashes are sorted: the first of a register is its least.
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    rest = (hashes[first] & np.uint64((1 << 56) - 1)) >> np.uint64(56 - _BITS)
    registers.reshape(-1)[cells[first]] = packed_minima(rest)
    filled = registers.copy()
    row, column = np.nonzero(registers == EMPTY_REGISTER)
    for step in _STEPS:
        if not len(row):
            return filled
        found = registers[row, step[column]]
        hit = found != EMPTY_REGISTER
        filled[row[hit], column[hit]] = found[hit]
        row, column = row[~hit], column[~hit]
    # After so many steps the next register to the right that is not empty.
    for at in np.unique(row):
        known = np.flatnonzero(registers[at] != EMPTY_REGISTER)
        own = column[row == at]
        filled[at, own] = registers[at, known[np.searchsorted(known, own) % len(known)]]
    return filled


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """The shingles of each set as a bitmap, by bits of their hashes that the registers are not chosen by."""
    maps = np.zeros((len(sets), _MAP_WORDS * 64), dtype=np.uint8)
    if sets:
        at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        maps[at, (np.concatenate(sets) & np.uint64(_MAP_WORDS * 64 - 1)).astype(np.int64)] = 1
    return np.packbits(maps, axis=1).view(np.uint64)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for every band of every row of registers."""
    banded = registers[:, :_BANDS * BAND].reshape(len(registers), _BANDS, BAND).astype(np.uint64)
    return mixed((banded * _SALTS).sum(axis=2, dtype=np.uint64) + mixed(np.arange(_BANDS, dtype=np.uint64)))


def chance_agreement(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How often registers of sets of n and m hashes agree although their minima differ."""
    zeros = np.arange(_BITS)
    upper, lower = 1 - 0.5 ** (zeros + 1), 1 - 0.5 ** zeros
    share = [
        upper ** load[..., None] - lower ** load[..., None]
        for load in (np.maximum(np.asarray(size, dtype=float) / REGISTERS, 1) for size in (n, m))
    ]
    return (share[0] * share[1]).sum(axis=-1) / (1 << MANTISSA)


def estimates(agreeing: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal registers, corrected for chance."""
    chance = chance_agreement(n, m)
    return (agreeing / REGISTERS - chance) / (1 - chance)


def possible(n, m, one, other, percent):
    """Whether sets of sizes n and m may link for all that their bitmaps (rows of words) tell; exact where they say no."""
    need = -(-percent * (n + m) // (100 + percent))
    lacking = np.bitwise_count(one & ~other).sum(axis=-1, dtype=np.int64), np.bitwise_count(other & ~one).sum(axis=-1, dtype=np.int64)
    return (np.minimum(n, m) >= need) & (n - lacking[0] >= need) & (m - lacking[1] >= need)


def _rows(n_words):
    """(doc_id, text_hash, n_shingles, sig, sketch); a set that the task has seen lately brings no sketch again.

    A sketch is the registers and then the bitmap."""
    def run(batches):
        seen = set()
        for batch in batches:
            sets = list(column_sets(batch.column(1), n_words))
            sigs = [signature(s) for s in sets]
            new = []
            for at, sig in enumerate(sigs):
                if len(sets[at]) and sig not in seen:
                    seen.add(sig)
                    new.append(at)
            if len(seen) > SEEN:
                seen = set()
            sketch = [None] * len(sets)
            chosen = [sets[k] for k in new]
            for at, registers, bits in zip(new, sketches(chosen), bitmaps(chosen)):
                sketch[at] = registers.tobytes() + bits.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.int64()), pa.array(sketch, pa.binary()),
            ], names=["doc_id", "text_hash", "n_shingles", "sig", "sketch"])

    return run


def _loaded(column) -> tuple[np.ndarray, np.ndarray]:
    """(registers, bitmaps) of a list of sketches."""
    raw = np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), -1)
    return np.ascontiguousarray(raw[:, :2 * REGISTERS]).view(np.uint16), np.ascontiguousarray(raw[:, 2 * REGISTERS:]).view(np.uint64)


def _banded(batches):
    for batch in batches:
        keys = band_keys(_loaded(batch.column(1).to_pylist())[0]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))], names=["band", "sig"])


def _likely(percent):
    """Of pairs (a, b, n, m, one, other) with sketches those that may link, with a similarity estimated as `percent` less the margin or more."""
    def run(batches):
        for batch in batches:
            (one, one_bits), (other, other_bits) = (_loaded(batch.column(k).to_pylist()) for k in (4, 5))
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            keep = estimates((one == other).sum(axis=1), n, m) >= percent / 100 - MARGIN
            keep &= possible(n, m, one_bits, other_bits, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def _block_pairs(percent):
    """The same of a cell's rows (cell, seeking, sig, label, outside, n, sketch): pairs of a row that seeks and one that is sought.

    The two are of different components. Of the bands in which a pair agrees only the first reports it, and of two rows that both
    seek (sought ones that do are `outside`) the one with the lesser signature.
    """
    def run(batches):
        for cell, rows in by_key(batches):
            _, seeking, sigs, labels, outside, n, sketch = zip(*rows)
            (registers, bits), seeking, sigs, labels, outside, n = _loaded(sketch), *map(np.array, (seeking, sigs, labels, outside, n))
            band, y = np.int64(cell.split()[0]).astype(np.uint64), np.flatnonzero(~seeking)
            found = []
            for at in np.flatnonzero(seeking):
                other = y[(labels[y] != labels[at]) & (~outside[y] | (sigs[at] < sigs[y]))]
                other = other[possible(n[at], n[other], bits[at], bits[other], percent)]
                agreeing = (registers[other] == registers[at]).sum(axis=1)
                other = other[estimates(agreeing, n[at], n[other]) >= percent / 100 - MARGIN]
                if len(other):
                    own = band_keys(registers[at][None])[0]
                    first = (band_keys(registers[other]) == own).argmax(axis=1)
                    other = other[own[first] == band]
                    found.append((np.minimum(sigs[at], sigs[other]), np.maximum(sigs[at], sigs[other])))
            if found:
                a, b = (np.concatenate(side) for side in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def hash_filter(hashes: DataFrame) -> bytes:
    """A compressed bitmap of `FILTER_BITS` bits of a column of 64-bit hashes, of a fixed size however many there are.

    The bits are put together in 64-bit words by an aggregate, at most one row for each word.
    """
    place = F.pmod(F.col(hashes.columns[0]), F.lit(FILTER_BITS))
    words = hashes.select(F.shiftright(place, 6).alias("word"), F.pmod(place, F.lit(64)).alias("bit")).groupBy("word").agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits")
    ).toArrow()
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    return zlib.compress(bits.tobytes(), 1)


def _set_rows(n_words, wanted):
    """(sig, shingles) of the texts (text, text_hash) whose hash may be in the filter, once for copies that a task has seen lately."""
    def run(batches):
        bits, seen = np.frombuffer(zlib.decompress(wanted), dtype=np.uint8), set()
        for batch in batches:
            places = batch.column(1).to_numpy() % FILTER_BITS
            hit = (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1
            chosen = []
            for at in np.flatnonzero(hit):
                own = batch.column(1)[int(at)].as_py()
                if own not in seen:
                    seen.add(own)
                    chosen.append(int(at))
            if len(seen) > SEEN:
                seen = set()
            sets = [s for s in column_sets(batch.column(0).take(pa.array(chosen, pa.int64())), n_words) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([signature(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["sig", "shingles"]
            )

    return run


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", n_words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of the documents.

    `component_id` is the smallest doc_id that links reach, and a row is kept if that is its own id (rows that repeat a kept id stay too).
    A NULL or empty text has no shingles and no links, and is kept. A NULL id is never the smallest unless no row of
    its component has one. Other columns are not read. An empty table gives no rows.
    """
    spark = small_batches(documents.sparkSession)
    root = scratch_path(spark, "hyperminhash")

    def written(df, name):
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    own = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    rows = written(own.mapInArrow(_rows(n_words), "doc_id long, text_hash long, n_shingles long, sig long, sketch binary"), "rows")
    classes = rows.where("n_shingles > 0")
    bands = classes.where("sketch IS NOT NULL").select("sig", "sketch").mapInArrow(_banded, "band long, sig long")
    shared = bands.groupBy("band").agg(F.min("sig").alias("hub"), F.max("sig").alias("last")).where("hub <> last").select("band", "hub")
    postings = written(bands.join(written(shared, "shared"), "band").distinct(), "postings")
    met = postings.select("sig").distinct()
    known = written(
        classes.where("sketch IS NOT NULL").join(met, "sig").groupBy("sig").agg(F.max("sketch").alias("sketch"), F.max("n_shingles").alias("n")), "sketches"
    )
    examples = written(classes.join(met, "sig").groupBy("sig").agg(F.min("text_hash").alias("text_hash")), "examples")

    def sets_of(pairs, name):
        """The full sets of the pairs' classes, from one text of each, which a filter finds where the texts lie."""
        classes_met = written(pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct(), f"{name}-classes")
        wanted = hash_filter(examples.join(classes_met, "sig").select("text_hash"))
        found = written(own.select("text", "text_hash").mapInArrow(_set_rows(n_words, wanted), "sig long, shingles binary"), f"{name}-sets")
        return found.join(classes_met, "sig", "left_semi").dropDuplicates(["sig"])

    def links(pairs, name):
        pairs = written(pairs, f"{name}-pairs")
        return written(verified(pairs, sets_of(pairs, name), percent).select("a", "b"), f"{name}-links")

    starred = postings.where("sig <> hub").select(F.col("hub").alias("a"), F.col("sig").alias("b")).distinct()
    for side, size, sketch in (("a", "n", "one"), ("b", "m", "other")):
        starred = starred.join(known.select(F.col("sig").alias(side), F.col("n").alias(size), F.col("sketch").alias(sketch)), side)
    first = links(starred.select("a", "b", "n", "m", "one", "other").mapInArrow(_likely(percent), "a long, b long"), "hub")
    near = connected_components(first)

    labels = near.select(F.col("id").alias("sig"), "label")
    hubs = labels.select(F.col("sig").alias("hub"), F.col("label").alias("main"))
    labelled = postings.join(labels, "sig", "left").join(hubs, "hub", "left")
    labelled = written(labelled.select("band", "sig", F.coalesce("label", "sig").alias("label"), F.coalesce("main", "hub").alias("main")), "labelled")
    outside = F.count_if(F.col("label") != F.col("main"))
    split = labelled.groupBy("band").agg(F.ceil(outside / BLOCK).alias("x_blocks"), F.ceil(F.count("*") / BLOCK).alias("y_blocks"))
    across = labelled.join(written(split.where("x_blocks > 0"), "split"), "band")

    def block(side):
        return F.pmod(F.xxhash64("sig"), F.col(f"{side}_blocks")).alias(side)

    def every(side):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{side}_blocks") - 1)).alias(side)

    cell = F.concat_ws(" ", "band", "x", "y").alias("cell")
    seeking = across.where("label <> main").select("band", "sig", "label", block("x"), every("y")).select(cell, F.lit(True).alias("seeking"), "sig", "label", F.lit(True).alias("outside"))
    outer = (F.col("label") != F.col("main")).alias("outside")
    sought = across.select("band", "sig", "label", outer, block("y"), every("x")).select(cell, F.lit(False).alias("seeking"), "sig", "label", "outside")
    cells = seeking.unionByName(sought).join(known, "sig").select("cell", "seeking", "sig", "label", "outside", "n", "sketch")
    second = links(grouped(cells, "cell").mapInArrow(_block_pairs(percent), "a long, b long"), "cross")

    whole = near if second.isEmpty() else connected_components(first.unionByName(second))
    smallest = classes.groupBy("sig").agg(F.min("doc_id").alias("least"))
    grown = whole.select(F.col("id").alias("sig"), "label").join(smallest, "sig")
    reached = grown.groupBy("label").agg(F.min("least").alias("least"))
    components = grown.select("sig", "label").join(reached, "label").select("sig", "least")
    components = written(smallest.join(whole.select(F.col("id").alias("sig")), "sig", "left_anti").unionByName(components), "components")
    found = rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("sig")).alias("sig")).join(components, "sig", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
