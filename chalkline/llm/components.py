"""Connected components of links that lie in a table, by contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.sources.tables import scratch_path


def connected_components(links: DataFrame) -> DataFrame:
    """(id, label) for every id that has a link (a, b); label is the smallest id of its component.

    In each round every vertex takes its smallest neighbour for parent, parents are followed a few steps, and the
    links are mapped to what was reached. Links within one vertex vanish, so the graph shrinks by half or more in a
    round. A vertex with very many links costs partial aggregates, one row a task. Rounds are cut by written
    tables.
    """
    spark = links.sparkSession
    root = scratch_path(spark, "components")

    def written(df, name):
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    current = written(links.where("a <> b").select(*ends).distinct(), "links-0")
    labels = current.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("label"))
    number = 0
    while not current.isEmpty():
        number += 1
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")).select("v", F.least("v", "p").alias("p"))
        parents = written(parents, f"parents-{number}")
        reached = parents
        for _ in range(2):
            step = reached.select(F.col("v").alias("p"), F.col("p").alias("further"))
            reached = reached.join(step, "p").select("v", F.col("further").alias("p"))
        reached = written(reached, f"reached-{number}")
        at_a, at_b = (reached.select(F.col("v").alias(c), F.col("p").alias(f"{c}_to")) for c in "ab")
        moved = current.join(at_a, "a").join(at_b, "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        current = written(moved.where("a <> b").select(*ends).distinct(), f"links-{number}")
        moves = reached.select(F.col("v").alias("label"), F.col("p").alias("to"))
        labels = written(
            labels.join(moves, "label", "left").select("id", F.coalesce("to", "label").alias("label")), f"labels-{number}"
        )
    return labels
