"""The registered queries of the operators, and the DuckDB twins of those that SQL can express."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.llm import byte_rnn, decontaminate, hash_ring, hyperminhash, katz_ngrams, ngram_join, quality_rules, rule_ensemble, source_mix, token_align, token_rollup, toxicity_fm, turn_repair
from chalkline.llm.twins import TWINS
from chalkline.sources.tables import scratch_path

SHARDS = 40


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_katz(spark, sf_dir):
    return katz_ngrams.held_out_scores(_table(spark, sf_dir, "documents"))


def op2_token_rollup(spark, sf_dir):
    """All documents are counted by one tokenizer; some are then deleted, others revised (digits removed), which is
    sent twice; the rest are counted by a second tokenizer version. The result is the rollup."""
    ledger = token_rollup.Ledger(spark, scratch_path(spark, "token-counts"))
    documents = _table(spark, sf_dir, "documents").withColumn("doc_key", token_rollup.document_key())
    digit = F.pmod("doc_id", F.lit(10))
    gone, revised = F.coalesce(digit == 3, F.lit(False)), F.coalesce(digit == 7, F.lit(False))
    first = token_rollup.word_counts(documents, "words-1")
    scrubbed = documents.where(revised).withColumn("text", F.regexp_replace("text", "[0-9]+", ""))
    second = token_rollup.word_counts(scrubbed, "words-1", "revise", F.col("doc_key")).unionByName(
        token_rollup.word_counts(documents.where(gone), "words-1", "delete")
    )
    third = token_rollup.word_counts(documents.where(~gone), "words-2")
    for batch, changes in (("1", first), ("2", second), ("2", second), ("3", third)):
        ledger.apply(batch, changes)
    return ledger.totals()


def op3_rule_ensemble(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    model = rule_ensemble.train(documents, _table(spark, sf_dir, "labels"))
    return rule_ensemble.judged(rule_ensemble.score(documents, model))


def op4_toxicity_fm(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    model = toxicity_fm.train(documents, _table(spark, sf_dir, "labels"))
    return toxicity_fm.judged(toxicity_fm.score(documents, model))


def op5_ngram_join(spark, sf_dir):
    join = ngram_join.ngram_join(_table(spark, sf_dir, "documents"), spanning=True)
    return ngram_join.components_by_document(join).select("doc_id", "n_shingles", "component_id")


def op5_ngram_links(spark, sf_dir):
    join = ngram_join.ngram_join(_table(spark, sf_dir, "documents"))
    return ngram_join.links_by_document(join).select("doc_id", "n_shingles", "component_id", "n_links")


def op6_hash_ring(spark, sf_dir):
    placed = hash_ring.assign_shards(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_source_mix(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    mix = source_mix.plan_mix(documents)
    schema = T.StructType([
        T.StructField("source", T.StringType()), T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
    ])
    known = spark.createDataFrame([(name, mix.sizes[name], mix.targets[name]) for name in mix.sizes], schema)
    rows = source_mix.mixed_rows(mix).withColumn("own", F.col("members")[0])
    return rows.join(F.broadcast(known), rows.own.eqNullSafe(known.source)).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


def op8_decontaminate(spark, sf_dir):
    return decontaminate.report(decontaminate.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    ))


def op9_byte_rnn(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return byte_rnn.judged(byte_rnn.identify(documents, byte_rnn.train(documents)))


def op10_quality_rules(spark, sf_dir):
    return quality_rules.quality_verdicts(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_stop_words", "n_lines", "n_exclamations",
    )


def op11_turn_repair(spark, sf_dir):
    return turn_repair.repair(turn_repair.damaged(_table(spark, sf_dir, "conversations")))


def op12_token_align(spark, sf_dir):
    return token_align.align(_table(spark, sf_dir, "documents"))


def op13_hyperminhash(spark, sf_dir):
    return hyperminhash.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_katz": op1_katz,
    "op2_token_rollup": op2_token_rollup,
    "op3_rule_ensemble": op3_rule_ensemble,
    "op4_toxicity_fm": op4_toxicity_fm,
    "op5_ngram_join": op5_ngram_join,
    "op5_ngram_links": op5_ngram_links,
    "op6_hash_ring": op6_hash_ring,
    "op7_source_mix": op7_source_mix,
    "op8_decontaminate": op8_decontaminate,
    "op9_byte_rnn": op9_byte_rnn,
    "op10_quality_rules": op10_quality_rules,
    "op11_turn_repair": op11_turn_repair,
    "op12_token_align": op12_token_align,
    "op13_hyperminhash": op13_hyperminhash,
}
