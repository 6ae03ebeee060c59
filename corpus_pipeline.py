"""Corpus preparation in stages, each written as Parquet and read again by the next one.

toxicity: documents that the factorization machine takes for toxic go.
ngram_join: of every group of near copies (five-word shingles, similarity 0.8 or more) one document stays.
decontaminate: documents that hold a benchmark window go.
mix: sources are brought to their target weights; documents come as often as the mix takes them, or not at all.
shard: the rest is put into shards by the ring.

All stages but the last return the columns of `documents`.
"""

from chalkline.llm import decontaminate, hash_ring, ngram_join, source_mix, toxicity_fm
from chalkline.sources.tables import scratch_path

SHARDS = 40


def drop_toxic(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity_fm.drop_toxic(docs, toxicity_fm.train(docs, labels))


def drop_copies(spark, docs, sf_dir):
    return ngram_join.drop_copies(docs)


def drop_contaminated(spark, docs, sf_dir):
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark, docs, sf_dir):
    return source_mix.apply_mix(docs, source_mix.plan_mix(docs))


def shard(spark, docs, sf_dir):
    return hash_ring.assign_shards(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("shard", shard),
]

# The first stage learns its weights, which SQL cannot express; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
