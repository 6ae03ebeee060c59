
from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from functools import partial, reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracles  # noqa: E402
from chalkline import derived, schemas  # noqa: E402
from chalkline.functions import (  # noqa: E402
    grade_name, grain_name, parse_cost, parse_quantity, parse_score, payment_name, school_id,
    subject_name, title_case, vendor_name,
)
from chalkline.operators.audit import histogram  # noqa: E402
from chalkline.operators.dedup import dedup_exact  # noqa: E402
from chalkline.operators.lineage import (  # noqa: E402
    with_boolean_lineage, with_date_lineage, with_id_lineage,
)
from chalkline.operators.merge import first_non_null_per_key  # noqa: E402
from chalkline.operators.report import linear_trend, result_digest, with_formal_labels  # noqa: E402
from chalkline.plans import reports, views  # noqa: E402
from chalkline.plans.rescue import audit_all, open_warehouse, rescue, save_risk  # noqa: E402
from chalkline.plans.risk import welfare_risk  # noqa: E402
from chalkline.session import side_by_side  # noqa: E402
from chalkline.sources import raw as raw_sources  # noqa: E402
from chalkline.sources import tables  # noqa: E402
from chalkline.sources.workbook import decode_workbooks  # noqa: E402
from chalkline.sources.workbook_source import register_workbooks  # noqa: E402

# The operators on training text may be left out of an installation; if they are there, faults in them show.
corpus_pipeline = text_queries = None
_text_package = importlib.util.find_spec("chalkline.llm")
if getattr(_text_package, "origin", None) and importlib.util.find_spec("corpus_pipeline"):
    import corpus_pipeline  # noqa: E402
    from chalkline.llm import queries as text_queries  # noqa: E402

DISTRICT = "Nation_3"
SCHOOL_TYPE = "Machinery"
DIGITS = 6
SINCE, UNTIL = "1995-03-10", "1996-08-20"


def rounded(df: DataFrame) -> DataFrame:
    """Aggregated doubles rounded: the order of summation differs between engines."""
    return df.select(*[
        F.round(f"`{f.name}`", DIGITS).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`")
        for f in df.schema
    ])


# Row functions over derived spellings ----------------------------------------------------


def normalize_id(spark, sf_dir):
    customer = derived.load(spark, sf_dir, "customer")
    spelt = customer.selectExpr(
        "c_custkey", f"{derived.id_text('c_custkey')} AS school_id", "c_name", "c_mktsegment"
    )
    return with_id_lineage(spelt).withColumns({
        "name_id": school_id("c_name"), "segment_id": school_id("c_mktsegment")
    }).drop("c_name", "c_mktsegment")


def normalize_date(spark, sf_dir):
    orders = derived.load(spark, sf_dir, "orders")
    return with_date_lineage(orders.selectExpr(
        "o_orderkey", f"{derived.rare_date_text('o_orderdate', 'o_orderkey')} AS date"
    ))


def normalize_date_fallback(spark, sf_dir):
    orders = derived.load(spark, sf_dir, "orders")
    return with_date_lineage(orders.selectExpr(
        "o_orderkey", f"{derived.fallback_date_text('o_orderdate', 'o_orderkey')} AS date"
    ))


def normalize_boolean(spark, sf_dir):
    events = derived.load(spark, sf_dir, "events")
    return with_boolean_lineage(events.selectExpr(
        "event_id", f"{derived.boolean_text('event_id + user_id')} AS working",
        "event_type AS kind",
    ), "working", "kind")


def normalize_grade(spark, sf_dir):
    raw = derived.student_attendance(spark, sf_dir)
    return raw.select("record_id", F.col("grade").alias("grade_raw"), grade_name("grade").alias("grade"))


def normalize_quantity(spark, sf_dir):
    raw = derived.mdm_procurement(spark, sf_dir)
    parsed = raw.select("procurement_id", parse_quantity("quantity", "unit").alias("p"))
    return parsed.select(
        "procurement_id", F.col("p.kg").alias("quantity_kg"), F.col("p.unit").alias("unit_clean"),
        F.col("p.method").alias("conversion_method"), F.col("p.inferred").alias("unit_inferred_flag"),
    )


def normalize_cost(spark, sf_dir):
    raw = derived.mdm_procurement(spark, sf_dir)
    return raw.select("procurement_id", "total_cost", parse_cost("total_cost").alias("cost"))


def normalize_score(spark, sf_dir):
    raw = derived.test_scores(spark, sf_dir)
    parsed = raw.select("assessment_id", parse_score("avg_score", "grading_scale", "max_marks").alias("p"))
    return parsed.select(
        "assessment_id", F.col("p.percentage").alias("score_percentage"),
        F.col("p.method").alias("score_conversion_method"), F.col("p.valid").alias("score_valid_flag"),
    )


def map_category(spark, sf_dir):
    raw = derived.mdm_procurement(spark, sf_dir)
    return raw.select(
        "procurement_id", grain_name("grain_type").alias("grain"), vendor_name("vendor_name").alias("vendor"),
        payment_name("payment_status").alias("payment"),
    )


def map_subject(spark, sf_dir):
    raw = derived.test_scores(spark, sf_dir)
    return raw.select("assessment_id", subject_name("subject").alias("subject"))


def title_case_names(spark, sf_dir):
    part = derived.load(spark, sf_dir, "part")
    name = F.concat_ws("'", F.concat_ws("-", "p_name", "p_brand"), "p_type")
    return part.select("p_partkey", title_case(name).alias("title"))


# Operators -------------------------------------------------------------------------------


def exact_duplicates(spark, sf_dir):
    return dedup_exact(derived.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


def first_non_null(spark, sf_dir):
    line = derived.load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
        f"{derived.boolean_text('l_suppkey')} AS word",
        "CASE WHEN l_partkey % 3 = 0 THEN l_partkey END AS part",
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_linenumber"]
    return first_non_null_per_key(
        line, "l_orderkey", [F.col(c) for c in order], ["l_linenumber", "l_suppkey"], ["word", "part"]
    )


def latest_snapshot(spark, sf_dir):
    events = derived.load(spark, sf_dir, "events").selectExpr(
        "user_id", "event_id", "ts", "event_type", f"{derived.boolean_text('event_id')} AS state"
    )
    return first_non_null_per_key(
        events, "user_id", [F.col("ts"), F.col("event_id")], ["event_id", "event_type"], ["state"]
    )


# Sources and sinks -----------------------------------------------------------------------


def csv_round_trip(spark, sf_dir):
    raw = derived.school_infrastructure(spark, sf_dir)
    path = tables.write_csv(raw, tables.scratch_path(spark, "csv"))
    return raw_sources.read_csv(spark, path, schemas.SCHOOL_INFRASTRUCTURE)


def csv_by_heading(spark, sf_dir):
    """Columns in another order and one undeclared, in which alone half of the rows differ."""
    raw = derived.student_attendance(spark, sf_dir)
    wide = raw.withColumn("shift", F.explode(F.array(F.lit("am"), F.lit("pm"))))
    path = tables.write_csv(wide.select(*sorted(wide.columns)), tables.scratch_path(spark, "headings"))
    return dedup_exact(raw_sources.read_csv(spark, path, schemas.STUDENT_ATTENDANCE))


def csv_counts(spark, sf_dir):
    raw = derived.school_master(spark, sf_dir)
    count = "total_enrolled_students"
    spelt = raw.withColumn(count, F.expr(f"""CASE {count} % 4 WHEN 0 THEN {count} || '.5' WHEN 1 THEN 'N/A'
        WHEN 2 THEN {count} || '.0' ELSE {count} || '' END"""))
    path = tables.write_csv(spelt, tables.scratch_path(spark, "counts"))
    return raw_sources.read_csv(spark, path, schemas.SCHOOL_MASTER)


def json_array(spark, sf_dir):
    """Files that hold one array of records each, at most 5,000 ids to a file."""
    raw = derived.test_scores(spark, sf_dir)
    block = F.floor(F.substring("assessment_id", 4, 18).cast("long") / 5000)
    arrays = raw.groupBy(block.alias("block")).agg(F.to_json(F.collect_list(F.struct(*raw.columns))).alias("value"))
    path = tables.scratch_path(spark, "arrays")
    arrays.repartition("block").write.partitionBy("block").text(path)
    return raw_sources.read_json(spark, f"{path}/block=*", schemas.TEST_SCORES)


def json_round_trip(spark, sf_dir):
    raw = derived.test_scores(spark, sf_dir)
    path = tables.scratch_path(spark, "json")
    raw.write.json(path)
    return raw_sources.read_json(spark, path, schemas.TEST_SCORES, lines=True)


def parquet_round_trip(spark, sf_dir):
    star = derived.star(spark, sf_dir)
    root = tables.scratch_path(spark, "tables")
    tables.write_star_table(star, root, "fact_attendance", by_month=True)
    return tables.read_table(spark, root, "fact_attendance").drop("date_month")


def workbook_scan(spark, sf_dir):
    books = derived.as_workbooks(derived.mdm_procurement(spark, sf_dir))
    return decode_workbooks(books, schemas.MDM_PROCUREMENT)


def workbook_files(spark, sf_dir):
    """Procurements with typed columns, written as workbooks of two kinds and read back by the data source."""
    number = F.substring("procurement_id", 4, 18).cast("long")
    typed = derived.mdm_procurement(spark, sf_dir).withColumns({
        "received": F.date_add(F.lit("1904-01-01").cast("date"), (1 + number % 30000).cast("int")),
        "weight": F.when(number % 9 == 0, F.lit(float("nan"))).otherwise(number / 8),
        "checked": number % 3 == 0, "lot": number,
    })
    root = tables.scratch_path(spark, "workbooks")
    register_workbooks(spark)
    typed.where(number % 2 == 0).write.format("workbook").options(strings="shared", date1904="true").mode("append").save(f"{root}/even")
    typed.where(number % 2 == 1).write.format("workbook").option("rowsPerFile", 5000).mode("append").save(f"{root}/odd")
    return spark.read.format("workbook").load(root)


def risk_table_write(spark, sf_dir):
    return rounded(save_risk(derived.star(spark, sf_dir), tables.scratch_path(spark, "risk")))


def risk_view(spark, sf_dir):
    save_risk(derived.star(spark, sf_dir), tables.scratch_path(spark, "risk-view"))
    return rounded(spark.table(tables.RISK_VIEW))


def rescue_run(spark, sf_dir):
    """The whole run over raw files in four formats; the result is the audit as it was written."""
    base = tables.scratch_path(register_workbooks(spark), "rescue")
    endings = {"test_scores": "jsonl", "student_attendance": "parquet", "mdm_procurement": "xlsx"}
    paths = {name: f"{base}/{name}.{endings.get(name, 'csv')}" for name in derived.RAW}

    def write(name):
        raw, path = derived.RAW[name](spark, sf_dir), paths[name]
        if name == "test_scores":
            raw.write.json(path)
        elif name == "student_attendance":
            raw.write.parquet(path)
        elif name == "mdm_procurement":
            raw.write.format("workbook").mode("append").save(path)
        else:
            tables.write_csv(raw, path)

    others = [name for name in paths if name != "mdm_procurement"]
    side_by_side(spark, *[partial(write, name) for name in ("mdm_procurement", *others)])
    return rescue(spark, paths, f"{base}/warehouse")


def warehouse_open(spark, sf_dir):
    """Tables written, opened and registered; the result is the number of rows of each view."""
    root = tables.scratch_path(spark, "warehouse")
    tables.write_star(derived.star(spark, sf_dir), root)
    open_warehouse(spark, root)
    counts = [
        spark.table(name).agg(F.lit(name).alias("relation"), F.count(F.lit(1)).alias("n_rows"))
        for name in views.VIEWS
    ]
    return reduce(DataFrame.unionByName, counts)


def adhoc_sql(spark, sf_dir):
    tables.register_views(derived.star(spark, sf_dir))
    return rounded(tables.read_query(spark, """
        SELECT block, count(*) AS records, avg(attendance_rate) AS avg_rate
        FROM vw_school_attendance_daily WHERE data_quality_status = 'VALID'
        GROUP BY block ORDER BY block
    """))


def audit_counts(spark, sf_dir):
    star = derived.star(spark, sf_dir)
    return audit_all(star, derived.school_master(spark, sf_dir))


# Registry --------------------------------------------------------------------------------


def _on_star(build):
    return lambda spark, sf_dir: build(derived.star(spark, sf_dir))


def _rounded_on_star(build):
    return lambda spark, sf_dir: rounded(build(derived.star(spark, sf_dir)))


def _on_risk(build):
    return lambda spark, sf_dir: rounded(build(welfare_risk(derived.star(spark, sf_dir))))


def _stored(build):
    """A report over written tables and their summary."""
    return lambda spark, sf_dir: rounded(build(derived.stored_star(spark, sf_dir)))


STORED = {
    "attendance_monthly": views.attendance_monthly,
    "district_summary": views.district_summary,
    "kpi_all": reports.kpi_scoped,
    "kpi_scoped": lambda s: reports.kpi_scoped(s, DISTRICT, SCHOOL_TYPE),
    "monthly_trend": reports.monthly_trend,
    "trend_by_district": lambda s: reports.trend_by_district(s, DISTRICT),
    "district_score_ranking": reports.district_score_ranking,
    "district_overview": reports.district_overview,
    "welfare_risk": welfare_risk,
}


def risk_table_replaced(spark, sf_dir):
    """A risk table written with other weights, then replaced by a job that reads it; the result is the second version."""
    root = tables.scratch_path(spark, "replaced")
    star = derived.stored_star(spark, sf_dir)
    tables.write_table(welfare_risk(star).withColumn("welfare_risk_category", F.lit("none yet")), root, tables.RISK_TABLE)
    former = tables.read_table(spark, root, tables.RISK_TABLE)
    bands = welfare_risk(star).select("school_id", F.col("welfare_risk_category").alias("band"))
    banded = former.join(bands, "school_id").withColumn("welfare_risk_category", F.col("band")).drop("band")
    tables.write_table(banded, root, tables.RISK_TABLE)
    return rounded(tables.read_table(spark, root, tables.RISK_TABLE))


def _text_queries():
    """The operators on training text and their pipeline, where that subpackage is installed."""
    if text_queries is None:
        return {}
    return text_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def _text_twins():
    if text_queries is None:
        return {}
    whole = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return text_queries.TWINS | whole


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or report; each runs over whole tables."""
    return {
        "normalize_id": normalize_id,
        "normalize_date": normalize_date,
        "normalize_date_fallback": normalize_date_fallback,
        "normalize_boolean": normalize_boolean,
        "normalize_grade": normalize_grade,
        "normalize_quantity": normalize_quantity,
        "normalize_cost": normalize_cost,
        "normalize_score": normalize_score,
        "map_category": map_category,
        "map_subject": map_subject,
        "title_case": title_case_names,
        "dedup_exact": exact_duplicates,
        "first_non_null_per_key": first_non_null,
        "latest_snapshot": latest_snapshot,
        "school_master_clean": _on_star(lambda s: s.school),
        "attendance_clean": _on_star(lambda s: s.attendance),
        "procurement_clean": _on_star(lambda s: s.procurement),
        "infra_history": _on_star(lambda s: s.infra_history),
        "infra_current": _on_star(lambda s: s.infra_current),
        "scores_clean": _on_star(lambda s: s.scores),
        "audit_counts": audit_counts,
        "scale_histogram": _on_star(
            lambda s: histogram(s.scores, "test_scores", "scale_breakdown", "grading_scale_raw")
        ),
        "attendance_daily": _on_star(views.attendance_daily),
        "attendance_daily_skewed": lambda spark, sf_dir: views.attendance_daily(derived.skewed_star(spark, sf_dir)),
        "attendance_monthly": _rounded_on_star(views.attendance_monthly),
        "procurement_summary": _on_star(views.procurement_summary),
        "infra_summary": _on_star(views.infra_summary),
        "test_summary": _on_star(views.test_summary),
        "school_kpis": _rounded_on_star(views.school_kpis),
        "district_summary": _rounded_on_star(views.district_summary),
        "kpi_all": _rounded_on_star(reports.kpi_scoped),
        "kpi_scoped": _rounded_on_star(lambda s: reports.kpi_scoped(s, DISTRICT, SCHOOL_TYPE)),
        "district_compare": _rounded_on_star(reports.district_compare),
        "district_compare_long": _rounded_on_star(reports.district_compare_long),
        "filter_values": _on_star(reports.filter_values),
        "attendance_totals": _on_star(reports.attendance_totals),
        "monthly_trend": _rounded_on_star(reports.monthly_trend),
        "trend_by_district": _rounded_on_star(lambda s: reports.trend_by_district(s, DISTRICT)),
        "proxy_top20": _on_star(reports.latest_proxies),
        "proxy_by_district": _on_star(lambda s: reports.latest_proxies(s, 10, DISTRICT)),
        "procurement_totals": _rounded_on_star(reports.procurement_totals),
        "vendor_ranking": _rounded_on_star(reports.vendor_ranking),
        "commodity_mix": _rounded_on_star(reports.commodity_mix),
        "vendor_spend_topn": _rounded_on_star(lambda s: reports.vendor_spend(s, 3)),
        "amenity_share": _rounded_on_star(reports.amenity_share),
        "deficit_ranking": _rounded_on_star(reports.deficit_ranking),
        "score_totals": _rounded_on_star(reports.score_totals),
        "score_by_subject": _rounded_on_star(lambda s: reports.score_by(s, "subject")),
        "score_by_grade": _rounded_on_star(lambda s: reports.score_by(s, "grade")),
        "score_by_amenity": _rounded_on_star(reports.score_by_amenity),
        "district_score_ranking": _rounded_on_star(reports.district_score_ranking),
        "district_overview": _rounded_on_star(reports.district_overview),
        "welfare_risk": _on_risk(lambda r: r),
        "risk_distribution": _on_risk(reports.risk_distribution),
        "risk_bands": _on_risk(reports.risk_bands),
        "risk_priority": _on_risk(reports.risk_priority),
        "risk_priority_labelled": _on_risk(lambda r: with_formal_labels(reports.risk_priority(r))),
        "risk_topn": _on_risk(lambda r: reports.risk_priority(r, 10)),
        "result_digest": _rounded_on_star(
            lambda s: result_digest(reports.district_overview(s), "district", "avg_attendance_rate")
        ),
        "score_trendline": _rounded_on_star(
            lambda s: linear_trend(views.school_kpis(s), "avg_attendance_rate", "avg_fln_score")
        ),
        "result_digest_chosen": _on_risk(lambda r: result_digest(reports.risk_priority(r))),
        "district_summary_bucketed": lambda spark, sf_dir: rounded(views.district_summary(derived.bucketed_star(spark, sf_dir))),
        "monthly_trend_ranged": _stored(lambda s: reports.monthly_trend(s, SINCE, UNTIL)),
        "trend_by_district_ranged": _stored(lambda s: reports.trend_by_district(s, DISTRICT, "1995-03-01", "1996-08-31")),
        "attendance_totals_ranged": _stored(lambda s: reports.attendance_totals(s, SINCE, UNTIL)),
        "proxy_ranged": _stored(lambda s: reports.latest_proxies(s, 20, None, SINCE, UNTIL)),
        **{f"{name}_stored": _stored(build) for name, build in STORED.items()},
        "risk_table_replaced": risk_table_replaced,
        "csv_round_trip": csv_round_trip,
        "csv_by_heading": csv_by_heading,
        "csv_counts": csv_counts,
        "json_array": json_array,
        "json_round_trip": json_round_trip,
        "parquet_round_trip": parquet_round_trip,
        "workbook_scan": workbook_scan,
        "workbook_files": workbook_files,
        "risk_table_write": risk_table_write,
        "risk_view": risk_view,
        "rescue_run": rescue_run,
        "warehouse_open": warehouse_open,
        "adhoc_sql": adhoc_sql,
        **_text_queries(),
    }


def oracle_sql() -> dict[str, str]:
    """The DuckDB twin of each registered query."""
    return oracles.all_twins(DISTRICT, SCHOOL_TYPE, DIGITS, SINCE, UNTIL, tuple(STORED)) | _text_twins()


def entry(spark: SparkSession) -> DataFrame:
    """District summary over the smallest tables: all five datasets cleaned, merged and joined."""
    return queries()["district_summary"](spark, "/root/testdata/sf0.001")
