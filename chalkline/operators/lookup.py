"""Dimension attributes for fact rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Over how many join keys the facts of one key are spread; the dimension is repeated as often.
SALTS = 16


def by_merge(side: DataFrame) -> DataFrame:
    """One side of a join as a table that grows with the schools, so is sorted and merged, never broadcast."""
    return side.hint("merge")


def left_lookup(
    fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], salts: int = SALTS,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """`fact` LEFT JOIN `dim` on `key`, where `dim` has one row per key.

    One plan for every size and every distribution of keys, with one scan of each side. Each fact
    gets a salt from a hash of the columns `spread_by`, such as its own id (default: of the whole row, which then
    must be read whole), and each dimension row comes once per salt, so the
    facts of a key that holds much of the data meet it in `salts` places instead of one. Facts
    without a key match nothing and are spread over all tasks. The salted sides are plain shuffles, so AQE can
    split what is still too large (facts that are equal in `spread_by` share a salt). The dimension is never
    broadcast: a planner goes by the size of its compressed file, without the repetition, and would send rows by
    the million through the driver.
    """
    own = F.xxhash64(*(spread_by or fact.columns))
    # A fact without a key needs no partner, so its salt may be any number.
    salt = F.when(F.col(key).isNull(), own).otherwise(F.pmod(own, F.lit(salts)))
    places = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    spread = by_merge(dim.select(F.col(key).alias("__key"), *columns, places.alias("__place")))
    joined = fact.withColumn("__salt", salt).join(
        spread, (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__place")), "left"
    )
    return joined.select(*fact.columns, *columns)
