"""Every query over ordinary, odd and empty tables; those with a twin against DuckDB, the others against brute force."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline  # noqa: E402
from chalkline.llm.queries import QUERIES  # noqa: E402
from chalkline.llm.twins import TWINS  # noqa: E402
from compare import difference, open_duckdb  # noqa: E402

SF = "/root/testdata/sf0.001"


def views(root, names=("documents", "labels", "benchmark", "conversations")):
    connection = duckdb.connect()
    for name in names:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet/*.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin_on_given_tables(spark, name):
    assert difference(QUERIES[name](spark, SF), open_duckdb(SF), TWINS[name]) is None


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin_on_odd_tables(spark, odd_tables, name):
    assert difference(QUERIES[name](spark, odd_tables), views(odd_tables), TWINS[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_of_odd_tables(spark, odd_tables, name):
    rows = QUERIES[name](spark, odd_tables).collect()
    if name not in ("op2_token_rollup", "op11_turn_repair"):
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(
            str(r["doc_id"]) for r in spark.read.parquet(f"{odd_tables}/documents.parquet").collect()
        )
    for r in rows:
        if "score" in r.asDict() and name != "op1_katz":
            assert 0 <= r["score"] <= 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_tables, name):
    assert QUERIES[name](spark, empty_tables).collect() == []


def test_pipeline_on_odd_and_empty_tables(spark, odd_tables, empty_tables):
    docs = spark.read.parquet(f"{odd_tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, odd_tables)
        assert kept.columns == docs.columns
        kept.collect()
    deduplicated = corpus_pipeline.drop_copies(spark, docs, odd_tables).collect()
    wordy = sorted(str(r["doc_id"]) for r in deduplicated if (r["text"] or "").strip())
    assert wordy == sorted(["1", "7", "7", "9", "10", "11"])
    assert sum(not (r["text"] or "").strip() for r in deduplicated) == 4
    clean = corpus_pipeline.drop_contaminated(spark, docs, odd_tables).collect()
    assert not any("fox" in (r["text"] or "") or (r["text"] or "").lower() == "one two" for r in clean) and len(clean) == 8
    assert corpus_pipeline.run(spark, empty_tables).collect() == []


def test_pipeline_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r["doc_id"] for r in QUERIES["op4_toxicity_fm"](spark, SF).where("predicted = 1").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, SF).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - toxic
    groups = {r["component_id"] for r in QUERIES["op5_ngram_join"](spark, SF).collect()}
    assert {r["doc_id"] for r in corpus_pipeline.drop_copies(spark, docs, SF).collect()} == groups
    hit = {r["doc_id"] for r in QUERIES["op8_decontaminate"](spark, SF).where("contaminated").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.drop_contaminated(spark, docs, SF).collect()}.isdisjoint(hit)
    copies = {r["doc_id"]: r["copies"] for r in QUERIES["op7_source_mix"](spark, SF).collect() if r["copies"]}
    mixed = [r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, SF).collect()]
    assert {d: mixed.count(d) for d in set(mixed)} == copies
