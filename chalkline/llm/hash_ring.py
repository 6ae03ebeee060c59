"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `VIRTUAL_NODES` points of a ring of 2**62 places, every row one place given by its id and its
text's checksum. A row belongs to the next point clockwise. Shards have a quota of rows; rows that
find their shard full continue clockwise to the next point of a shard with room. Quotas differ by at
most one and add up to the number of rows, so counts are at most one apart, whatever the ids are.

The ring is cut into `CELLS` equal cells, further cut at the points. A histogram of rows by cell is all that the
driver sees; its size does not depend on the data. Who goes where is settled on the histogram: a cell's
rows, in order of place, go to one or more shards in runs. Each row then needs its rank within its cell
only, so the largest group that one task orders is about rows / CELLS.
"""

import bisect
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VIRTUAL_NODES = 128
CELLS = 1 << 14
_PLACES = 1 << 62


def ring_points(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(place, shard) of all points, in order. A shard's points do not depend on how many others there are."""
    points = []
    for shard in range(shards):
        for node in range(virtual_nodes):
            name = f"{shard}:{node}".encode()
            place = (zlib.crc32(name) << 32 | zlib.crc32(name[::-1], 0x9E3779B9)) % _PLACES
            points.append((place, shard))
    return sorted(points)


def place_of(doc_id: Column, checksum: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, checksum), F.lit(_PLACES))


def cut_starts(points, cells: int = CELLS) -> list[int]:
    """Where the cells begin: the equal cuts and the places of the points."""
    return sorted({c * (_PLACES // cells) for c in range(cells)} | {place for place, _ in points})


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def settle(counts: dict[int, int], starts: list[int], points, shards: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (cell, first rank, end rank, shard, first slot) that cover every counted row once.

    Rows claim their own shard first, in ring order; those that overflow walk on together, one point at a
    time, so that a row moves no further than needed.
    """
    room = quotas(sum(counts.values()), shards)
    used = [0] * shards
    places = [p for p, _ in points]
    waiting = [(cell, 0, n, bisect.bisect_left(places, starts[cell]) % len(points)) for cell, n in sorted(counts.items())]
    runs = []
    while waiting:
        further = []
        for cell, first, end, point in waiting:
            shard = points[point][1]
            taken = min(room[shard] - used[shard], end - first)
            if taken:
                runs.append((cell, first, first + taken, shard, used[shard]))
                used[shard] += taken
            if first + taken < end:
                further.append((cell, first + taken, end, (point + 1) % len(points)))
        waiting = further
    return runs


def assign_shards(
    documents: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text",
    virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of `documents`.

    `size` is the text's UTF-8 bytes plus 16, `slot` numbers a shard's rows from 0 without gaps. NULL texts
    count as empty; NULL ids have a place like any other; rows that repeat an id and a text share their
    place and take neighbouring ranks, so the result has the same rows in any order of arrival.
    Other columns are not read. An empty table gives an empty result.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    ).withColumn("place", place_of(F.col("doc_id"), F.col("text_crc32")))
    return shard_rows(rows, shards, virtual_nodes, cells)


def shard_rows(rows: DataFrame, shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> DataFrame:
    """Adds shard and slot to (doc_id, size, text_crc32, place, ...); place is dropped."""
    spark = rows.sparkSession
    points = ring_points(shards, virtual_nodes)
    starts = cut_starts(points, cells)
    celled = _with_cell(rows, starts, cells)
    counts = {r["cell"]: r["count"] for r in celled.groupBy("cell").count().collect()}
    runs = settle(counts, starts, points, shards)
    table = spark.createDataFrame(runs or [(0, 0, 0, 0, 0)], "cell int, first long, until long, shard int, slot0 long")
    by_cell = table.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("first", "until", "shard", "slot0"))).alias("runs"))
    order = Window.partitionBy("cell").orderBy("place", "doc_id", "text_crc32")
    ranked = celled.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    run = F.filter("runs", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["until"]))
    # At most one run per cell, point and shard: bounded by the parameters, not by the data.
    placed = ranked.join(F.broadcast(by_cell), "cell").withColumn("run", F.get(run, F.lit(0)))
    return placed.withColumns({
        "shard": F.col("run.shard"), "slot": F.col("run.slot0") + F.col("rank") - F.col("run.first"),
    }).drop("cell", "runs", "rank", "run", "place")


def _with_cell(rows, starts, cells):
    """The index in `starts` of the cell of each place: the equal cell gives a short list to search."""
    width = _PLACES // cells
    inner = {}
    for index, start in enumerate(starts):
        inner.setdefault(min(start // width, cells - 1), []).append((start, index))
    first = rows.sparkSession.createDataFrame(
        [(block, [s for s, _ in cuts], cuts[0][1]) for block, cuts in inner.items()],
        "block long, cuts array<long>, base int",
    )
    block = F.expr(f"least(place div {width}L, {cells - 1}L)")
    return rows.withColumn("block", block).join(F.broadcast(first), "block").withColumn(
        "cell", F.col("base") + F.size(F.filter("cuts", lambda c: c <= F.col("place"))) - 1
    ).drop("block", "cuts", "base")


def moved_share(before: DataFrame, after: DataFrame) -> float:
    """The share of rows whose shard differs between two assignments of the same ids."""
    both = before.select("doc_id", F.col("shard").alias("old")).join(after.select("doc_id", "shard"), "doc_id")
    return both.agg(F.avg((F.col("old") != F.col("shard")).cast("double"))).first()[0] or 0.0
