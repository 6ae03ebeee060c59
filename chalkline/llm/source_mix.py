"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns.

Documents that belong to the same set of sources are alike for the mix, so they are aggregated: a pattern
offers its words once, twice, up to `MAX_COPIES` times at rising cost, and each of its sources may use them
towards its target. The cheapest flow says how many words of every pattern the mix takes. The
documents that supply them come in a seeded order: all documents as often as the flow covers the whole pattern,
then one more copy of the first ones in that order until the rest is met to within half a document.

The driver sees one row per pattern, never documents. The seeded order is cut into `CELLS` cells per pattern, and
only the cell in which a pattern's last copy ends has its rows ranked, about 1 / CELLS of the pattern. Rows equal
in id and text share a place in the order; where the last copy ends among them, as many of them as are
wanted are taken, numbered in `SUBCELLS` parts that are counted first.
"""

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.sources.tables import scratch_path

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
COPY_COSTS = (0, 1, 3)
CELLS = 2048
SUBCELLS = 256
REPEAT_BLOCK = 4096
SEED = 20240607
WORD = r"[^\x20\x09-\x0D]+"


def code_point_order(names) -> list:
    """Distinct names by code point, NULL last."""
    distinct = set(names)
    return sorted(n for n in distinct if n is not None) + ([None] if None in distinct else [])


def target_words(sizes: dict, weights=WEIGHTS, most: int = MAX_COPIES) -> dict:
    """Each source's words in the mix: shares of all words by weight, none above `most` times its own words.

    What a source cannot take is shared by weight among the others, until none is above its bound. With
    `most` at least 1 all words find a place.
    """
    names = code_point_order(sizes)
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    total, targets, open_names = Fraction(sum(sizes.values())), {}, list(names)
    while open_names:
        unit = total / sum(weight[n] for n in open_names)
        above = [n for n in open_names if unit * weight[n] > most * sizes[n]]
        for name in above or open_names:
            targets[name] = Fraction(most * sizes[name]) if above else unit * weight[name]
        if not above:
            break
        total -= sum(targets[n] for n in above)
        open_names = [n for n in open_names if n not in targets]
    return {name: float(targets[name]) for name in names}


def min_cost_flow(arcs: list[list], source: str, sink: str) -> int:
    """Augments along cheapest paths until the sink can take no more. arcs: [from, to, capacity, cost, flow]."""
    leaving = {}
    for index, (tail, head, _, _, _) in enumerate(arcs):
        leaving.setdefault(tail, []).append((index, 1))
        leaving.setdefault(head, []).append((index, -1))
    total = 0
    while True:
        cost, via, queue = {source: 0}, {}, [source]
        while queue:
            node, following = queue.pop(0), None
            for index, sign in leaving.get(node, ()):
                tail, head, capacity, price, flow = arcs[index]
                following = head if sign > 0 else tail
                left = capacity - flow if sign > 0 else flow
                if left > 0 and cost[node] + sign * price < cost.get(following, float("inf")):
                    cost[following], via[following] = cost[node] + sign * price, (index, sign, node)
                    if following not in queue:
                        queue.append(following)
        if sink not in cost:
            return total
        path, node = [], sink
        while node != source:
            path.append(via[node])
            node = via[node][2]
        step = min(arcs[i][2] - arcs[i][4] if s > 0 else arcs[i][4] for i, s, _ in path)
        for index, sign, _ in path:
            arcs[index][4] += sign * step
        total += step


def route(pattern_words: dict, members: dict, targets: dict, costs=COPY_COSTS) -> dict:
    """{(pattern, source): words} of the cheapest flow that meets the targets as far as the copies go."""
    arcs = []
    for key, words in pattern_words.items():
        arcs += [["all", ("pattern", key), words, cost, 0] for cost in costs]
        arcs += [[("pattern", key), ("source", name), words * len(costs), 0, 0] for name in members[key]]
    arcs += [[("source", name), "mix", round(target), 0, 0] for name, target in targets.items()]
    min_cost_flow(arcs, "all", "mix")
    return {(tail[1], head[1]): flow for tail, head, _, _, flow in arcs if tail != "all" and head != "mix"}


def member_set(sources: Column) -> Column:
    """The sorted distinct sources of a row; none for a NULL array."""
    return F.array_sort(F.array_distinct(F.coalesce(sources.cast("array<string>"), F.array().cast("array<string>"))))


def sized_rows(documents: DataFrame, sources: Column, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, members, pattern, size, pick, cell): one row per row of `documents`. NULL texts have no words."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"), member_set(sources).alias("members"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.crc32(body.cast("binary"))).alias("pick"),
    )
    return rows.withColumns({"pattern": F.to_json("members"), "cell": F.pmod("pick", F.lit(CELLS)).cast("int")})


class Mix:
    """A decided mix: the sources' `sizes` and `targets`, the column `sources` it was decided by, and `plan`.

    The plan has one (pattern, whole, last_cell, last_pick, take, of) per pattern: a row takes part `whole` times, and
    once more when it comes before the place of the seeded order where the last copy ends; of the `of` rows at that place `take` do.
    """

    def __init__(self, rows, sizes, targets, plan, sources):
        self.rows, self.sizes, self.targets, self.plan, self.sources = rows, sizes, targets, plan, sources

    def with_copies(self, rows: DataFrame) -> DataFrame:
        """Adds `copies` to rows that have pattern, pick, cell and size; rows without words (size 0) have none.

        The plan has a row per combination of sources in use. Rows are shuffled only where some of several equal ones are taken.
        """
        schema = "pattern string, whole int, last_cell int, last_pick long, take long, of long"
        table = rows.sparkSession.createDataFrame(self.plan, schema)
        place, last = F.struct("cell", "pick"), F.struct("last_cell", "last_pick")
        known = rows.join(F.broadcast(table), "pattern")
        more = F.coalesce((F.col("cell") < F.col("last_cell")) | ((F.col("cell") == F.col("last_cell")) & (F.col("pick") <= F.col("last_pick"))), F.lit(False))
        copies = F.when(F.col("size") > 0, F.col("whole") + more.cast("int")).otherwise(0).cast("long")
        if all(r[4] == r[5] for r in self.plan):
            return known.withColumn("copies", copies).select(*rows.columns, "copies")
        parted = (place == last) & (F.col("take") < F.col("of")) & (F.col("size") > 0)
        parted = F.coalesce(parted, F.lit(False))
        return known.where(~parted).withColumn("copies", copies).select(*rows.columns, "copies").unionByName(
            _some_of_equal(known.where(parted), rows.columns)
        )


def _some_of_equal(known: DataFrame, columns: list[str]) -> DataFrame:
    """Rows at the place of their pattern where the last copy ends: `take` of them once more than the others.

    Rows that are the same in all columns are one with their number. The others are ordered by what they hold.
    """
    own = known.groupBy(*columns, "whole", "take").agg(F.count(F.lit(1)).alias("n")).withColumn("held", F.to_json(F.struct(*columns)))
    own = own.withColumn("sub", F.pmod(F.xxhash64("held"), F.lit(SUBCELLS)))
    ahead = Window.partitionBy("pattern").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    counts = own.groupBy("pattern", "sub").agg(F.sum("n").alias("in_sub"))
    counts = counts.select("pattern", "sub", F.coalesce(F.sum("in_sub").over(ahead), F.lit(0)).alias("before_sub"))
    within = Window.partitionBy("pattern", "sub").orderBy("held").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before_sub") + F.coalesce(F.sum("n").over(within), F.lit(0))
    taken = own.join(F.broadcast(counts), ["pattern", "sub"]).withColumn("before", before)
    taken = taken.withColumn("taken", F.greatest(F.lit(0), F.least("n", F.col("take") - F.col("before"))))
    parts = F.array(
        F.struct((F.col("whole") + 1).cast("long").alias("copies"), F.col("taken").alias("times")),
        F.struct(F.col("whole").cast("long").alias("copies"), (F.col("n") - F.col("taken")).alias("times")),
    )
    many = taken.select(*columns, F.explode(parts).alias("part")).where("part.times > 0").select(*columns, "part.*")
    return _repeated(many).select(*columns, "copies")


def _repeated(rows: DataFrame) -> DataFrame:
    """Each row `times` times, in blocks that are dealt to all tasks."""
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {REPEAT_BLOCK}"))).alias("block")
    blocks = rows.select("*", block).repartition("block", "pattern")
    return blocks.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(REPEAT_BLOCK), F.col("times") - F.col("block") * REPEAT_BLOCK))))


def plan_mix(
    documents: DataFrame, sources: Column | None = None, doc_id: str = "doc_id", text: str = "text",
    weights=WEIGHTS, seed: int = SEED,
) -> Mix:
    """Decides the mix of all rows.

    `sources` is an array column of the sources a row belongs to (default: its `source` alone; NULL is a source of
    its own, last in order). Rows that repeat are rows of their own: of rows equal in id and text as many are taken
    as the target wants, and reruns take the same. Rows without a source or without words are not taken, nor anything of an empty
    table. Extra columns are not read.
    """
    spark = documents.sparkSession
    members = F.array(F.col("source")) if sources is None else sources
    path = scratch_path(spark, "mix")
    sized_rows(documents, members, doc_id, text, seed).write.parquet(path)
    rows = spark.read.parquet(path)
    found = rows.groupBy("pattern", "members").agg(F.sum("size").alias("words")).collect()
    pattern_words = {r["pattern"]: r["words"] for r in found}
    members_of, sizes = {r["pattern"]: list(r["members"]) for r in found}, {}
    for key, words in pattern_words.items():
        for name in members_of[key]:
            sizes[name] = sizes.get(name, 0) + words
    targets = target_words(sizes, weights)
    taken = dict.fromkeys(pattern_words, 0)
    for (key, _), flow in route(pattern_words, members_of, targets).items():
        taken[key] += flow
    whole, rest = {}, []
    for key, words in pattern_words.items():
        whole[key], left = divmod(taken[key], words) if words else (0, 0)
        rest.append((key, left))
    last = _last_places(rows, rest)
    plan = [(key, whole[key], *last.get(key, (-1, None, 0, 0))) for key in pattern_words]
    return Mix(rows, sizes, targets, plan, members)


def _last_places(rows: DataFrame, rest: list[tuple]) -> dict:
    """{pattern: (cell, pick, take, of)}: where in the seeded order the words up to there are nearest to those wanted.

    At the last place `of` equal rows stand, of which `take` are wanted.
    """
    table = rows.sparkSession.createDataFrame(rest, "pattern string, rest long")
    ahead = Window.partitionBy("pattern").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.where("size > 0").groupBy("pattern", "cell").agg(F.sum("size").alias("words"))
    cells = cells.join(F.broadcast(table), "pattern").withColumn("before", F.coalesce(F.sum("words").over(ahead.orderBy("cell")), F.lit(0)))
    ends = cells.where("before <= rest AND rest < before + words").select("pattern", "cell", (F.col("rest") - F.col("before")).alias("wanted"))
    places = rows.where("size > 0").join(F.broadcast(ends), ["pattern", "cell"]).groupBy("pattern", "cell", "wanted", "pick", "size").agg(F.count(F.lit(1)).alias("of"))
    places = places.withColumn("before", F.coalesce(F.sum(F.col("of") * F.col("size")).over(ahead.orderBy("pick", "size")), F.lit(0)))
    # A row is wanted when at least half of its words are.
    reached = places.where("2 * before + size <= 2 * wanted").withColumn("take", F.expr("least(of, (2 * (wanted - before) + size) div (2 * size))"))
    last = reached.groupBy("pattern").agg(F.max(F.struct("cell", "pick", "size", "take", "of")).alias("p"))
    found = {r["pattern"]: (r["p"]["cell"], r["p"]["pick"], r["p"]["take"], r["p"]["of"]) for r in last.collect()}
    # Where the first row of the last cell is not wanted the copy ends with the cell before.
    for r in ends.select("pattern", "cell").collect():
        found.setdefault(r["pattern"], (r["cell"], None, 0, 0))
    return found


def mixed_rows(mix: Mix) -> DataFrame:
    """(doc_id, members, size, copies, taken) for every row that was mixed."""
    return mix.with_copies(mix.rows).select(
        "doc_id", "members", "size", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def apply_mix(
    documents: DataFrame, mix: Mix, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, sources: Column | None = None,
) -> DataFrame:
    """The rows of `documents`, with their columns, as often as the mix takes them.

    Nothing is shuffled but rows equal in id and text at the place where a pattern's last copy ends.
    `sources` is the array column that `plan_mix` was given (default: the very same).
    """
    members = mix.sources if sources is None else sources
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    picked = documents.select(
        row.alias("row"), F.to_json(member_set(members)).alias("pattern"),
        F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.crc32(body.cast("binary"))).alias("pick"),
        body.rlike(WORD).cast("long").alias("size"),
    ).withColumn("cell", F.pmod("pick", F.lit(CELLS)).cast("int"))
    counted = mix.with_copies(picked).where("copies > 0")
    return counted.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
