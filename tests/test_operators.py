"""Operators against brute force on small frames."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from chalkline.operators import lookup
from chalkline.operators.audit import counters, histogram
from chalkline.operators.dedup import COPIES, dedup_exact
from chalkline.operators.lineage import with_boolean_lineage, with_date_lineage, with_id_lineage
from chalkline.operators.merge import first_non_null_per_key
from chalkline.operators.report import (
    digest_columns, formal_label, linear_trend, ranked, result_digest, share_of_total, to_long, with_formal_labels,
)


def test_dedup_counts_copies_and_nulls(spark):
    rows = [("a", 1), ("a", 1), ("b", None), ("b", None), ("b", None), (None, 2)]
    df = dedup_exact(spark.createDataFrame(rows, "k string, v int"))
    assert {tuple(r) for r in df.collect()} == {("a", 1, 2), ("b", None, 3), (None, 2, 1)}
    assert dedup_exact(df.drop(COPIES)).where(F.col(COPIES) > 1).count() == 0


def test_lineage_of_missing_values(spark):
    df = spark.createDataFrame([(None, None, None), ("SCH0001", "2025-01-02", "yes")],
                               "school_id string, date string, flag string")
    out = with_boolean_lineage(with_date_lineage(with_id_lineage(df)), "flag").orderBy("school_id").collect()
    missing, clean = out
    assert missing.school_id is None and missing.school_id_raw is None and missing.school_id_changed_flag
    assert missing.date_parse_method == "MISSING" and missing.date_parse_error_flag
    assert missing.flag is None and missing.flag_is_unknown_flag
    assert not clean.school_id_changed_flag and clean.flag is True and not clean.flag_is_unknown_flag
    assert not any(c.startswith("__") for c in with_date_lineage(df).columns)


def test_first_non_null_against_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(5)]), i,
         rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, o int, tie int, text string, num int").repartition(7)
    got = first_non_null_per_key(df, "k", [F.col("o"), F.col("tie")], ["tie"], ["text", "num"])
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    expected = set()
    for key, members in groups.items():
        members.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]), reverse=True)
        first = [next((m[i] for m in members if m[i] is not None), None) for i in (3, 4)]
        expected.add((key, members[0][2], *first))
    assert {(r.k, r.tie, r.text, r.num) for r in got.collect()} == expected


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    keys = ["hot"] * 400 + [None] * 300 + ["orphan"] * 100 + [f"k{rng.randrange(60)}" for _ in range(400)]
    fact = spark.createDataFrame(list(enumerate(keys)), "id int, k string").repartition(5)
    dim = spark.createDataFrame(
        [("hot", "H", None)] + [(f"k{i}", f"n{i}", i) for i in range(50)], "k string, name string, size int"
    )
    return fact, dim


@pytest.mark.parametrize("salts", [1, 3, 40])
def test_left_lookup_equals_left_join(skewed, salts):
    fact, dim = skewed
    expected = sorted(map(tuple, fact.join(dim, "k", "left").select("id", "k", "name", "size").collect()))
    found = lookup.left_lookup(fact, dim, "k", ["name", "size"], salts)
    assert found.columns == ["id", "k", "name", "size"]
    assert sorted(map(tuple, found.collect())) == expected


def test_left_lookup_spreads_hot_and_missing_keys(spark, skewed):
    fact, dim = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = lookup.left_lookup(fact, dim, "k", ["name"])
        parts = df.select(F.spark_partition_id().alias("part"), "k").groupBy("part").count().collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [r["count"] for r in parts]
    assert sum(sizes) == 1200 and max(sizes) < 500 and plan.count("Exchange hashpartitioning") == 2


def test_left_lookup_never_broadcasts_the_repeated_dimension(spark, skewed, tmp_path):
    """Neither by the size of its file, which the repetition does not show in, nor after it is measured."""
    for name, df in zip(("fact", "dim"), skewed):
        df.write.parquet(f"{tmp_path}/{name}")
    fact, dim = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("fact", "dim"))
    found = lookup.left_lookup(fact, dim, "k", ["name"])
    assert found.count() == 1200
    before, _ = found._jdf.queryExecution().executedPlan().toString(), found.collect()
    plans = before + found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plans and "SortMergeJoin" in plans


def test_counters_and_histogram(spark):
    df = spark.createDataFrame([("a", True), ("a", False), (None, True)], "s string, f boolean")
    rows = counters(df, "d", {"n": F.count(F.lit(1)), "f": F.count_if("f")}).collect()
    assert [tuple(r) for r in rows] == [("d", "n", None, 3), ("d", "f", None, 2)]
    empty = counters(df.limit(0), "d", {"n": F.sum(F.lit(1))}).collect()
    assert empty[0].value == 0
    assert {(r.key, r.value) for r in histogram(df, "d", "m", "s").collect()} == {("a", 2), (None, 1)}


def test_report_steps(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, None), ("c", 3.0, 4.0), ("d", None, 0.0)],
                               "k string, v double, w double")
    assert sum(r.share_pct or 0 for r in share_of_total(df, "v").collect()) == pytest.approx(100)
    assert [r.k for r in ranked(df, "v", ties=["k"]).collect()] == ["b", "c", "a", "d"]
    assert [r.k for r in ranked(df, "v", descending=False, ties=["k"]).collect()] == ["a", "b", "c", "d"]
    assert to_long(df, ["k"], ["v", "w"], "m", "x").count() == 8
    assert tuple(result_digest(df, "k", "v").first()) == (4, "b", 3.0, "a", 1.0, pytest.approx(7 / 3))
    line = linear_trend(spark.createDataFrame([(x, 2.0 * x + 1) for x in range(5)], "x int, y double"), "x", "y").first()
    assert (line.n_points, line.slope, line.intercept, line.r2) == (5, pytest.approx(2), pytest.approx(1), pytest.approx(1))


def test_digest_chooses_its_columns(spark):
    df = spark.createDataFrame([(True, "a", "x", 1, 9.0), (False, "b", "y", 5, 1.0)], "f boolean, k string, l string, `v w` int, w double")
    assert digest_columns(df) == ("k", "v w")
    assert tuple(result_digest(df).first()) == (2, "b", 5, "a", 1, 3.0)
    assert tuple(result_digest(df, measure="w").first()) == (2, "a", 9.0, "b", 1.0, 5.0)
    assert tuple(result_digest(df.select("k")).first()) == (2, None, None, None, None, None)
    assert tuple(result_digest(df.select("w")).first()) == (2, None, 9.0, None, 1.0, 5.0)
    assert tuple(result_digest(df.limit(0)).first()) == (0, None, None, None, None, None)


def test_formal_labels(spark):
    assert formal_label("district") == "District Name" and formal_label("avg_cost_x") == "Avg Cost X"
    df = spark.createDataFrame([(1, 2)], "district int, my_col int")
    assert with_formal_labels(df).columns == ["District Name", "My Col"]
    assert with_formal_labels(df, {"my_col": "Mine"}).columns == ["District Name", "Mine"]


def test_copies_survive_hot_groups(spark):
    rows = [("same",)] * 500 + [(str(i % 20),) for i in range(100)]
    df = dedup_exact(spark.createDataFrame(rows, "v string").repartition(6))
    assert {r.v: r[COPIES] for r in df.collect()} == Counter(v for v, in rows)
