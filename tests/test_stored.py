"""Stored tables: versions, months, the summary, buckets."""

import datetime
import os
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from chalkline import derived
from chalkline.operators.report import share_of_total
from chalkline.plans import reports, star as star_tables, summary, views
from chalkline.plans.risk import welfare_risk
from chalkline.session import side_by_side
from chalkline.sources import tables, versions

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def reads(df, table):
    return any(f"/{table}/" in path for path in df.inputFiles())


@pytest.fixture(scope="module")
def stored(spark):
    return derived.stored_star(spark, SF)


def values(df):
    return sorted(r.v for r in df.collect())


# Versions --------------------------------------------------------------------------------


def test_readers_keep_their_version_while_a_table_is_replaced(spark, tmp_path):
    root = str(tmp_path)
    tables.write_table(spark.range(3).toDF("v"), root, "t")
    before = tables.read_table(spark, root, "t")
    seen = []

    def save(df, path):
        df.write.parquet(path)
        # The new files are there, but nobody has been told.
        seen.append((values(before), values(tables.read_table(spark, root, "t"))))

    versions.replace(before.selectExpr("v + 10 AS v"), f"{root}/t", save)
    assert seen == [([0, 1, 2], [0, 1, 2])]
    assert values(tables.read_table(spark, root, "t")) == [10, 11, 12] and values(before) == [0, 1, 2]


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    root = str(tmp_path)
    tables.write_table(spark.range(3).toDF("v"), root, "t")
    broken = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("v"))
    with pytest.raises(Exception, match="no"):
        tables.write_table(broken, root, "t")
    assert values(tables.read_table(spark, root, "t")) == [0, 1, 2]
    tables.write_table(tables.read_table(spark, root, "t").where("v > 0"), root, "t")
    assert values(tables.read_table(spark, root, "t")) == [1, 2]
    assert [v for v, _ in versions.commits(spark, f"{root}/t")] == [2, 1]


def test_old_versions_expire(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        tables.write_table(spark.range(n).toDF("v"), root, "t")
    gone = versions.expire_versions(spark, f"{root}/t", keep=2)
    assert [name[:7] for name in gone] == ["v000001", "v000002"]
    left = {name[:7] for name in os.listdir(f"{root}/t") if name.startswith("v")}
    assert left == {"v000003", "v000004"} and values(tables.read_table(spark, root, "t")) == [0, 1, 2]
    assert versions.expire_versions(spark, f"{root}/missing") == []
    with pytest.raises(ValueError):
        versions.expire_versions(spark, f"{root}/t", keep=0)


def test_a_folder_without_commits_is_read_as_it_is(spark, tmp_path):
    spark.range(2).toDF("v").write.parquet(f"{tmp_path}/plain")
    assert values(tables.read_table(spark, str(tmp_path), "plain")) == [0, 1]
    assert not tables.has_table(spark, str(tmp_path), "plain")


# Months ----------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["fact_attendance", "fact_mdm_procurement", "fact_infrastructure_history", "fact_test_scores"])
def test_raw_rows_are_gathered_and_then_cleaned(spark, name):
    """No lineage is shuffled; the rows are those of the table."""
    star = derived.star(spark, SF)
    gathered = star.gathered(name, lambda _, date: F.date_format(date, "yyyy-MM"))
    plan = gathered._jdf.queryExecution().optimizedPlan().toString()
    shuffled = plan[plan.index("RebalancePartitions"):]
    assert plan.count("RebalancePartitions") == 1 and "school_id_raw" not in shuffled and "_parse_error_flag" not in shuffled
    whole = star.table(name)
    assert gathered.columns == whole.columns
    assert gathered.exceptAll(whole).count() == 0 and whole.exceptAll(gathered).count() == 0


@pytest.mark.parametrize("name", ["fact_attendance", "fact_mdm_procurement", "fact_infrastructure_history", "fact_test_scores"])
def test_a_write_by_month_moves_and_sorts_raw_rows_once(spark, tmp_path, monkeypatch, name):
    """The shuffle that brings copies together also gathers the months; cleaned rows are neither moved nor sorted."""
    written = []
    monkeypatch.setattr(versions, "replace", lambda df, path, save: written.append(df))
    tables.write_star_table(derived.star(spark, SF), str(tmp_path), name, by_month=True)
    plan = plan_of(written[0])
    assert len(re.findall(r"(?<!Broadcast)Exchange \w+", plan)) == 1 and len(re.findall(r"Sort \[", plan)) == 1
    moved = plan[plan.index("Sort ["):]
    assert "school_id_raw" not in moved and "_parse_error_flag" not in moved
    by_month = written[0].withColumn("date_month", F.col(star_tables.PLACE))
    assert "date_month" in by_month._jdf.queryExecution().optimizedPlan().outputOrdering().toString()


@pytest.fixture()
def many_ranges(spark):
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_copies_in_any_place_are_one_row_of_a_table_by_month(spark, tmp_path, many_ranges):
    """Most rows are copies of one, from many tasks, and half of the dates are one month's or missing."""
    n = F.col("id")
    date = F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, F.lit("never")).when(n % 4 == 2, F.lit("5-Mar-2024"))
    date = F.coalesce(date, F.when(n % 4 == 3, F.concat(F.lit("2023-0"), (1 + n % 9).cast("string"), F.lit("-17"))))
    rows = spark.range(0, 4000, 1, 20).select(F.when(n % 2 == 0, F.lit(6)).otherwise(n % 501).alias("id")).select(
        F.when(n % 7 > 0, F.concat(F.lit("A"), n.cast("string"))).alias("record_id"),
        F.when(n % 5 > 0, F.concat(F.lit("sch-"), n.cast("string"))).alias("school_id"), date.alias("date"), F.lit("iv").alias("grade"),
        F.lit(45.0).alias("total_students"), F.when(F.rand(3) < 0.5, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("present_students"),
        F.lit("Hai").alias("teacher_present"), F.lit(None).cast("string").alias("marked_by"),
        F.create_map(F.lit("row"), n).alias("notes"), F.lit("2001-01").alias("date_month"),
    )
    rows.write.parquet(f"{tmp_path}/raw")
    star = star_tables.star_from_raw(lambda _: spark.read.parquet(f"{tmp_path}/raw"))
    tables.write_star_table(star, str(tmp_path), star_tables.ATTENDANCE, by_month=True)
    read = tables.read_table(spark, str(tmp_path), star_tables.ATTENDANCE)
    assert set(read.columns) == set(star.attendance.columns)
    wanted, found = (df.drop("date_month").withColumn("notes", F.to_json("notes")) for df in (star.attendance, read))
    found = found.select(wanted.columns)
    assert found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0
    assert found.agg(F.max("exact_copies"), F.sum("exact_copies")).first()[:] == (2004, 4000)
    assert read.where(F.col("date_month") != F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("undated"))).count() == 0


def test_tables_that_were_opened_are_written_by_month_again(spark, stored, tmp_path):
    tables.write_star_table(stored, str(tmp_path), star_tables.SCORES, by_month=True)
    read = tables.read_table(spark, str(tmp_path), star_tables.SCORES)
    assert read.columns == stored.scores.columns
    assert read.exceptAll(stored.scores).count() == 0 and stored.scores.exceptAll(read).count() == 0


def test_what_a_write_shuffles_goes_when_it_ends(spark, tmp_path):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for folder in manager.localDirsString() for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    freed = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(freed)
    tables.write_star(derived.star(spark, SF), str(tmp_path), by_month=True)
    until = time.monotonic() + 10
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(freed) == setting


@pytest.mark.parametrize("by_month", [False, True])
def test_tables_are_written_small(spark, tmp_path, by_month):
    df = spark.range(3).selectExpr("id AS v", "make_date(1995, 1 + cast(id AS int), 1) AS date")
    path = tables.write_table(df, str(tmp_path), "t", by_month)
    files = [name for _, _, names in os.walk(path) for name in names if name.endswith(".parquet")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)
    assert values(tables.read_table(spark, str(tmp_path), "t")) == [0, 1, 2]


def test_tables_are_written_side_by_side(spark, tmp_path, monkeypatch):
    # Each of the five waits for the others to begin.
    begun = threading.Barrier(5, timeout=60)
    write = tables.write_star_table

    def together(*args):
        begun.wait()
        return write(*args)

    monkeypatch.setattr(tables, "write_star_table", together)
    tables.write_star(derived.star(spark, SF), str(tmp_path), by_month=True)
    written = tables.open_star(spark, str(tmp_path))
    for name, df in derived.star(spark, SF).tables().items():
        assert written.table(name).count() == df.count()
    assert written.summary.count() > 0


def test_steps_side_by_side_all_end_and_show_their_fault(spark):
    ended = []

    def fails():
        raise ValueError("of this step")

    with pytest.raises(ValueError, match="of this step"):
        side_by_side(spark, fails, lambda: ended.append(spark.range(5).count()))
    assert ended == [5]


def test_ranges_prune_months(stored):
    since, until = datetime.date(1995, 3, 10), "1995-06-20"
    trend = reports.monthly_trend(stored, since, until)
    plan = plan_of(trend)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan.replace("\n", " ")).group(1)
    assert "1995-03" in filters and "1995-06" in filters and "undated" in filters
    days = stored.attendance.where("date >= '1995-03-10' AND date <= '1995-06-20'")
    assert [r.month for r in trend.collect()] == ["1995-03", "1995-04", "1995-05", "1995-06"]
    assert reports.attendance_totals(stored, since, until).first().total == days.count()
    proxies = reports.latest_proxies(stored, 1000, None, since, until)
    assert proxies.count() == days.where("is_proxy_attendance").count()


def test_ranges_leave_undated_rows_out(spark, stored):
    raw = derived.star(spark, SF)
    everything = ("0001-01-01", "9999-11-30")
    for star in (raw, stored):
        assert reports.attendance_totals(star, *everything).first().total == star.attendance.where("date IS NOT NULL").count()
        trend = reports.trend_by_district(star, "Nation_3", *everything).collect()
        assert trend and all(r.month for r in trend)
        assert None in {r.month for r in reports.trend_by_district(star, "Nation_3").collect()}


@pytest.mark.parametrize("since, until", [("1995-03-01", "1995-06-30"), ("1996-02-01", "1996-02-29"), (None, "1996-12-31"), ("1995-05-17", None)])
def test_ranges_over_the_summary_equal_those_over_facts(spark, stored, since, until):
    one, other = (reports.monthly_trend(star, since, until) for star in (stored, derived.star(spark, SF)))
    assert one.count() > 0
    for a, b in zip(one.collect(), other.collect(), strict=True):
        assert a.month == b.month and a.avg_attendance_rate == pytest.approx(b.avg_attendance_rate, nan_ok=True)
    start, end = summary.day(since), summary.day(until)
    assert reads(one, star_tables.SUMMARY) == summary.whole_months(start, end) != reads(one, star_tables.ATTENDANCE)


# Summary ---------------------------------------------------------------------------------


def test_reports_read_the_summary_instead_of_facts(stored):
    for report in (views.attendance_monthly, views.district_summary, reports.kpi_scoped, reports.monthly_trend, reports.trend_by_district,
                   reports.district_score_ranking, reports.district_overview, welfare_risk):
        df = report(stored)
        assert reads(df, star_tables.SUMMARY) and not any(reads(df, name) for name in star_tables.FACTS), report


def test_summaries_of_parts_add_up(spark, stored):
    facts = [stored.table(name) for name in star_tables.FACTS]
    whole = summary.summarise(*facts)
    halves = [summary.summarise(*[f.where(F.pmod(F.hash(f.columns[0]), F.lit(2)) == half) for f in facts]) for half in (0, 1)]
    merged = summary.merged(*halves)
    counts = [c for c in whole.columns if not c.endswith("_sum")]
    assert whole.select(counts).exceptAll(merged.select(counts)).count() == 0 and merged.count() == whole.count()
    totals = [df.agg(F.sum("rate_sum"), F.sum("score_sum"), F.sum("kg_sum"), F.sum("cost_sum")).first() for df in (whole, merged)]
    assert list(totals[0]) == pytest.approx(list(totals[1]))
    assert whole.agg(F.sum("attendance_rows")).first()[0] == stored.attendance.count()


def test_measures_of_schools_equal_those_of_the_facts(spark, stored):
    names = ["avg_attendance_rate", "proxy_anomaly_rate", "avg_fln_score", "total_quantity_kg", "total_cost", "infrastructure_score"]
    by_id = [{r.school_id: [r[n] for n in names] for r in views.school_kpis(star).collect()} for star in (stored, derived.star(spark, SF))]
    assert by_id[0].keys() == by_id[1].keys()
    for school, row in by_id[0].items():
        assert [v is None for v in row] == [v is None for v in by_id[1][school]]
        assert [v or 0 for v in row] == pytest.approx([v or 0 for v in by_id[1][school]])


# Buckets ---------------------------------------------------------------------------------


def test_bucketed_tables_need_no_shuffle_by_school(spark):
    star = derived.bucketed_star(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(views.district_summary(star))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange (\w+)\((\w+)", plan)
    assert exchanges == [("hashpartitioning", "district")] and plan.count("SelectedBucketsCount") == 5


# Others ----------------------------------------------------------------------------------


def test_shares_need_no_window(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", None)], "k string, v double")
    shares = share_of_total(df, "v")
    assert {r.k: r.share_pct for r in shares.collect()} == {"a": 25.0, "b": 75.0, "c": None}
    assert "Window" not in plan_of(shares) and "SinglePartition" not in plan_of(shares).split("Subquery")[0]
    zero = share_of_total(spark.createDataFrame([("a", 0.0)], "k string, v double"), "v")
    assert zero.first().share_pct is None and share_of_total(df.limit(0), "v").collect() == []


def test_fixture_reaches_every_branch(spark):
    star = derived.star(spark, SF)
    raw = derived.school_master(spark, SF)
    assert raw.where("school_id IS NULL").count() and star.school.count() < raw.distinct().count()
    assert {"Unknown Block", "Unknown"} <= {v for r in star.school.select("block", "school_type").collect() for v in r}
    assert star.school.where("total_enrolled_students IS NULL").count()
    assert {r[0] for r in reports.risk_distribution(welfare_risk(star)).collect()} == {"Low Risk", "Moderate Risk", "High Risk"}
    for fact in (star.attendance, star.procurement, star.scores, star.infra_history):
        assert fact.where("school_id IS NULL").count() and fact.where("school_id = 'UNLISTED'").count()
    assert star.procurement.where("vendor_name IS NULL").count() and star.scores.where("subject IS NULL").count()
    assert star.procurement.where("conversion_method = 'UNPARSED_QUANTITY'").count()
    assert views.attendance_daily(star).where("district IS NULL").count()
