"""Arrays of 64-bit hashes that travel in rows: one row holds a task's hashes of one range (a bucket)."""

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARK_DEFAULT = "67108864b"


def small_batches(spark: SparkSession) -> SparkSession:
    """Lets Python workers read texts in batches of about 4 MB, so that memory does not follow the texts' length.

    It is a setting of the session; one that the session made itself is left alone.
    """
    if spark.conf.get(_BATCH_BYTES, _SPARK_DEFAULT) == _SPARK_DEFAULT:
        spark.conf.set(_BATCH_BYTES, "4m")
    return spark


def bucket_cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets of sorted hashes begin, and the end."""
    places = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(places, np.arange(buckets + 1, dtype=np.uint64))


def by_key(batches, key: int = 0):
    """(key, rows of all batches with that key) where rows come sorted by key."""
    current, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[key] != current and rows:
                yield current, rows
                rows = []
            current = row[key]
            rows.append(row)
    if rows:
        yield current, rows


def grouped(df: DataFrame, key: str) -> DataFrame:
    """The rows of a key in one partition, next to each other."""
    return df.repartition(F.col(key)).sortWithinPartitions(key)


def summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts added up."""
    keys, index = np.unique(np.concatenate(keys), return_inverse=True)
    return keys, np.bincount(index, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64)
