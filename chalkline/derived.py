"""Messy school records derived from the benchmark tables by fixed spelling rules.

The benchmark ships clean order data; these frames spell it the way school records arrive
(ids, dates, booleans, units, currency, grading scales), with exact duplicates. Every row of
the source tables is used.
"""

import io
import posixpath
import zipfile
from functools import lru_cache, partial
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline.plans.star import Star, star_from_raw
from chalkline.session import prefer_compiled_methods
from chalkline.sources import tables
from chalkline.vocabulary import AMENITIES

# One row in this many is repeated exactly.
DUPLICATE_EVERY = 25

# The school that a third of the skewed attendance belongs to, by key and as its id.
HOT_KEY, HOT_SCHOOL = 7, "SCH0007"

# Multipliers of user_id that give the five amenity columns different patterns.
AMENITY_FACTORS = (1, 3, 5, 7, 11)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def _text(expression):
    return f"cast({expression} as string)"


def id_text(k: str) -> str:
    """An id in one of five spellings."""
    padded = f"lpad({_text(k)}, greatest(4, length({_text(k)})), '0')"
    return (
        f"CASE {k} % 5 WHEN 0 THEN 'SCH' || {padded} WHEN 1 THEN 'SCH-' || {padded} "
        f"WHEN 2 THEN ' sch_' || {padded} WHEN 3 THEN 'S' || {k} ELSE {_text(k)} END"
    )


def _day(d):
    iso = _text(f"cast({d} as date)")
    year, month, day = (f"substr({iso}, {at}, {n})" for at, n in ((1, 4), (6, 2), (9, 2)))
    name = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * month({d}) - 2, 3)"
    return iso, year, month, day, name


def date_text(d: str, k: str) -> str:
    """A date in one of six spellings, no date, or NULL."""
    iso, year, month, day, name = _day(d)
    return (
        f"CASE {k} % 8 WHEN 0 THEN {iso} WHEN 1 THEN replace({iso}, '-', '/') "
        f"WHEN 2 THEN {day} || '-' || {name} || '-' || {year} "
        f"WHEN 3 THEN {day} || '-' || {month} || '-' || {year} "
        f"WHEN 4 THEN {month} || '-' || {day} || '-' || {year} "
        f"WHEN 5 THEN {day} || '.' || {month} || '.' || {year} WHEN 6 THEN 'n/k' END"
    )


def rare_date_text(d: str, k: str) -> str:
    """A date in the spellings that `date_text` does not use, impossible days included."""
    iso, year, month, day, name = _day(d)
    return (
        f"CASE {k} % 12 WHEN 0 THEN {year} || '-02-31' WHEN 1 THEN '31-02-' || {year} "
        f"WHEN 2 THEN {day} || '-' || {name} || '-' || substr({year}, 3, 2) "
        f"WHEN 3 THEN {month} || '.' || {day} || '.' || {year} "
        f"WHEN 4 THEN {day} || '/' || {month} || '/' || {year} "
        f"WHEN 5 THEN replace({iso}, '-', '') WHEN 6 THEN {name} || ' ' || {day} || ', ' || {year} "
        f"WHEN 7 THEN {day} || ' ' || {name} || ' ' || {year} WHEN 8 THEN {iso} || ' 08:30:00' "
        f"WHEN 9 THEN {month} || '/' || {day} || '/' || substr({year}, 3, 2) "
        f"WHEN 10 THEN '30.02.' || {year} ELSE '  ' END"
    )


def fallback_date_text(d: str, k: str) -> str:
    """A date in spellings outside the main layouts."""
    layouts = (
        "MM-dd-yyyy 08:30:00", "MM/dd/yyyy 14:30", "dd/MMM/yyyy", "dd.MMMM.yyyy", "yyyy.MM.dd", "yyyy-MMM-dd",
        "MM.dd.yy", "dd-MMM-yyyy 08:30", "dd MMMM yyyy 09:00", "EEEE, dd MMMM yyyy", "dd-MMMM-yy", "MMM d, yyyy",
        "yyyyMMdd'T083000'", "MMM yyyy", "yyyy-MM", "yyyy",
    )
    whens = " ".join(
        f"WHEN {n} THEN date_format({d}, \"{layout}\")" for n, layout in enumerate(layouts)
    )
    text = f"CASE {k} % {len(layouts)} {whens} END"
    return f"CASE WHEN {k} % {len(layouts)} = 11 THEN replace({text}, 'Sep', 'Sept') ELSE {text} END"


def boolean_text(k: str) -> str:
    return (
        f"CASE ({k}) % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN 'Hai' WHEN 2 THEN '1' WHEN 3 THEN 'Working' "
        f"WHEN 4 THEN 'Nahi hai' WHEN 5 THEN 'Kharab' WHEN 6 THEN 'maybe' END"
    )


def known_id_text(k: str, key: str) -> str:
    """The same, but missing in some records and without a number, so of no school, in others."""
    return f"CASE WHEN {key} % 53 = 11 THEN NULL WHEN {key} % 59 = 13 THEN ' unlisted ' ELSE {id_text(k)} END"


def _poor(k):
    """Schools that have hardly any attendance, scores or amenities."""
    return f"{k} % 40 = 1"


def _with_duplicates(df: DataFrame, key: str) -> DataFrame:
    copies = F.when(F.col(key) % DUPLICATE_EVERY == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return df.withColumn("__copy", F.explode(copies)).drop("__copy")


def school_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some schools have three records, each with other gaps, and some records no id, block, type or enrolment."""
    customer = load(spark, sf_dir, "customer")
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    records = F.when(F.col("c_custkey") % 10 == 3, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    return _with_duplicates(joined, "c_custkey").withColumn("record", F.explode(records)).selectExpr(
        "CASE WHEN c_custkey % 97 = 5 THEN NULL WHEN record = 1 THEN cast(c_custkey as string) "
        f"WHEN record = 2 THEN 'sch-' || c_custkey ELSE {id_text('c_custkey')} END AS school_id",
        "CASE WHEN c_custkey % 10 = 3 AND record = 0 THEN NULL WHEN record = 2 THEN 'Old ' || c_name ELSE c_name END AS school_name",
        "CASE WHEN c_custkey % 50 = 7 OR record = 2 THEN NULL ELSE CASE c_custkey % 3 WHEN 0 THEN lower(n_name) "
        "WHEN 1 THEN upper(n_name) ELSE '  ' || n_name || ' ' END END AS district",
        "CASE WHEN c_custkey % 31 = 4 THEN NULL ELSE r_name END AS block",
        "CASE WHEN c_custkey % 29 = 6 THEN NULL WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS school_type",
        "CASE c_custkey % 4 WHEN 0 THEN 'punjabi' WHEN 1 THEN 'HINDI' WHEN 2 THEN 'English' END AS medium",
        "cast(CASE WHEN record = 2 OR c_custkey % 41 = 8 THEN NULL WHEN record = 1 THEN 50 + c_custkey % 40 "
        "ELSE 100 + c_custkey % 900 END AS int) AS total_enrolled_students",
    )


def student_attendance(spark: SparkSession, sf_dir: str, skewed: bool = False) -> DataFrame:
    """Attendance records; if `skewed`, every third order is one school's."""
    key = f"(CASE WHEN l_orderkey % 3 = 0 THEN {HOT_KEY} ELSE o_custkey END)" if skewed else "o_custkey"
    joined = load(spark, sf_dir, "lineitem").join(
        load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    zero = "l_suppkey % 97 = 0"
    return _with_duplicates(joined, "l_orderkey").selectExpr(
        "'ATT' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS record_id",
        f"{known_id_text(key, 'l_orderkey')} AS school_id",
        f"{date_text('l_shipdate', 'l_partkey')} AS date",
        "CASE l_partkey % 3 WHEN 0 THEN cast(l_linenumber AS string) "
        "WHEN 1 THEN CASE l_linenumber WHEN 1 THEN 'I' WHEN 2 THEN 'II' WHEN 3 THEN 'III' "
        "WHEN 4 THEN 'IV' WHEN 5 THEN 'V' WHEN 6 THEN 'VI' ELSE 'Nursery' END "
        "ELSE 'grade ' || l_linenumber END AS grade",
        f"CASE WHEN {zero} THEN 0 ELSE 45 END AS total_students",
        f"CASE WHEN {zero} THEN 0 WHEN {_poor('o_custkey')} THEN cast(floor(l_quantity / 25) AS int) "
        "ELSE cast(l_quantity AS int) END AS present_students",
        f"{boolean_text('l_suppkey')} AS teacher_present",
        "l_returnflag AS marked_by",
    )


def mdm_procurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _with_duplicates(load(spark, sf_dir, "orders"), "o_orderkey")
    price = _text("cast(floor(o_totalprice) as bigint)")
    tail = f"right({price}, 3)"
    return orders.selectExpr(
        "'MDM' || lpad(cast(o_orderkey as string), greatest(7, length(cast(o_orderkey as string))), '0') "
        "AS procurement_id",
        f"{known_id_text('o_custkey', 'o_orderkey')} AS school_id",
        f"{date_text('o_orderdate', 'o_orderkey')} AS date",
        "CASE WHEN o_orderkey % 37 = 5 THEN NULL ELSE CASE o_orderkey % 5 WHEN 0 THEN 'Kumar & Co.' WHEN 1 THEN 'SINGH AGRO' "
        "WHEN 2 THEN 'sharma & sons' WHEN 3 THEN 'Goyal Mill' ELSE 'verma stores' END END AS vendor_name",
        "CASE o_orderkey % 6 WHEN 0 THEN 'chawal' WHEN 1 THEN 'ATTA' WHEN 2 THEN 'Daal' "
        "WHEN 3 THEN 'Sarson Tel' WHEN 4 THEN 'Kanak' END AS grain_type",
        "CASE WHEN o_orderkey % 43 = 7 THEN 'some' ELSE CASE o_orderkey % 7 WHEN 0 THEN (1 + o_custkey % 90) || ' kg' WHEN 6 THEN NULL "
        "ELSE cast(1 + o_custkey % 900 AS string) END END AS quantity",
        "CASE o_orderkey % 7 WHEN 1 THEN 'KG' WHEN 2 THEN 'Grams' WHEN 3 THEN '50kg Bags' "
        "WHEN 4 THEN 'sacks' END AS unit",
        f"CASE o_orderkey % 5 WHEN 0 THEN '₹' || {price} WHEN 1 THEN 'Rs. ' || {price} "
        f"WHEN 2 THEN {price} || '/-' WHEN 3 THEN '1,' || lpad({tail}, 3, '0') ELSE 'tbd' END AS total_cost",
        "CASE o_orderstatus WHEN 'F' THEN 'cleared' WHEN 'O' THEN 'Due' ELSE 'part' END AS payment_status",
    )


def school_infrastructure(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _with_duplicates(load(spark, sf_dir, "events"), "event_id")
    return events.selectExpr(
        f"{known_id_text('user_id', 'event_id')} AS school_id",
        f"{date_text('ts', 'event_id')} AS date",
        *[
            f"CASE WHEN {_poor('user_id')} THEN 'Nahi hai' ELSE {boolean_text(f'event_id + {m} * user_id')} END AS {a}"
            for a, m in zip(AMENITIES, AMENITY_FACTORS)
        ],
        "event_type AS inspector_name",
        "props AS remarks",
    )


def test_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _with_duplicates(load(spark, sf_dir, "events"), "event_id")
    points = "(event_id * 13 + user_id)"
    return events.selectExpr(
        "'TST' || lpad(cast(event_id as string), greatest(7, length(cast(event_id as string))), '0') "
        "AS assessment_id",
        f"{known_id_text('user_id', 'event_id')} AS school_id",
        f"{date_text('ts', 'event_id')} AS date",
        "'Grade ' || (1 + event_id % 12) AS grade",
        "CASE WHEN event_id % 47 = 9 THEN NULL ELSE CASE event_id % 4 WHEN 0 THEN 'ganit' WHEN 1 THEN 'HINDI' WHEN 2 THEN 'evs' "
        "ELSE 'art craft' END END AS subject",
        f"CASE WHEN {_poor('user_id')} THEN '%' ELSE CASE event_id % 8 WHEN 0 THEN '%' WHEN 1 THEN 'pct' WHEN 2 THEN 'Letter Grade' "
        "WHEN 3 THEN 'Raw Marks' WHEN 4 THEN 'CGPA' WHEN 5 THEN 'Raw Marks' WHEN 6 THEN 'Raw Marks' END END "
        "AS grading_scale",
        f"CASE WHEN {_poor('user_id')} THEN {points} % 7 || '%' ELSE CASE event_id % 8 WHEN 0 THEN {points} % 101 || '%' WHEN 1 THEN cast({points} % 101 AS string) "
        "WHEN 2 THEN CASE user_id % 4 WHEN 0 THEN 'A+' WHEN 1 THEN 'b' WHEN 2 THEN 'F' ELSE 'absent' END "
        f"WHEN 3 THEN {points} % 51 || '/50' WHEN 4 THEN {points} % 10 || '.5' "
        f"WHEN 5 THEN cast({points} % 41 AS string) WHEN 6 THEN '7/0' END END AS avg_score",
        "CASE event_id % 8 WHEN 4 THEN '10' WHEN 5 THEN '40' END AS max_marks",
    )


RAW = {
    "school_master": school_master,
    "student_attendance": student_attendance,
    "mdm_procurement": mdm_procurement,
    "school_infrastructure": school_infrastructure,
    "test_scores": test_scores,
}


@lru_cache(maxsize=8)
def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star over the derived records; queries of a session share its plans, not its data."""
    prefer_compiled_methods(spark)
    return star_from_raw(lambda name: RAW[name](spark, sf_dir))


@lru_cache(maxsize=8)
def skewed_star(spark: SparkSession, sf_dir: str) -> Star:
    """The same with a third of all attendance in one school."""
    prefer_compiled_methods(spark)
    raw = RAW | {"student_attendance": partial(student_attendance, skewed=True)}
    return star_from_raw(lambda name: raw[name](spark, sf_dir))


@lru_cache(maxsize=8)
def stored_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star written once as tables, facts by month, with their summary, and opened again."""
    root = tables.scratch_path(spark, "stored")
    tables.write_star(star(spark, sf_dir), root, by_month=True)
    return tables.open_star(spark, root)


@lru_cache(maxsize=8)
def bucketed_star(spark: SparkSession, sf_dir: str, buckets: int = 8) -> Star:
    """The star saved as bucketed tables of a database of its own, and opened again."""
    path = tables.scratch_path(spark, "bucketed")
    database = posixpath.basename(path).replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    tables.save_bucketed_star(star(spark, sf_dir), database, buckets)
    return tables.open_bucketed_star(spark, database)


_BOOK = (
    '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
    '<sheets><sheet name="records" sheetId="1" r:id="rId1"/></sheets></workbook>'
)
_BOOK_PARTS = (
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>'
)


def workbook_bytes(records: pd.DataFrame) -> bytes:
    """A workbook with one sheet of text cells; missing values are left out."""
    lines = [list(records.columns), *records.itertuples(index=False)]
    rows = "".join(
        "<row>" + "".join(
            "<c/>" if value is None
            else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'
            for value in line
        ) + "</row>"
        for line in lines
    )
    sheet = (
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        f"<sheetData>{rows}</sheetData></worksheet>"
    )
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("xl/workbook.xml", _BOOK)
        archive.writestr("xl/_rels/workbook.xml.rels", _BOOK_PARTS)
        archive.writestr("xl/worksheets/sheet1.xml", sheet)
    return target.getvalue()


def as_workbooks(df: DataFrame) -> DataFrame:
    """The records as workbooks in a binary column, one for each Arrow batch of text records."""
    def encode(batches):
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"content": [workbook_bytes(batch)]})

    return df.mapInPandas(encode, "content binary")
