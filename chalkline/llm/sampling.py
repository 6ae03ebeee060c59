"""Held-out folds, and bounded samples of labelled documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str, folds: int) -> Column:
    """True for the fold that no model learns from. A NULL id counts as the empty text and is held out."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % folds == 0


def labelled_ids(labels: DataFrame, label: str, folds: int, most: int) -> DataFrame:
    """At most `most` (doc_id, label) outside the held-out fold, the same ones in every run.

    A document labelled twice counts once, with its higher label; rows without an id or a label are left out.
    """
    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    known = own.where(~held_out("doc_id", folds)).groupBy("doc_id").agg(F.max("label").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def labelled_texts(documents: DataFrame, sample: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, label, text) of the sampled documents; the sample is bounded, so it is broadcast."""
    own = documents.select("doc_id", F.col(f"`{text}`").alias("text"))
    return own.join(F.broadcast(sample), "doc_id")
