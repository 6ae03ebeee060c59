"""Files in, governed tables, views and audit out."""

import io
import json
import os
import subprocess
import sys
import threading
import zipfile
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import types as T

from __spark_entry__ import queries
from chalkline import derived, schemas
from chalkline.plans.cleaners import clean_attendance, clean_school_master, clean_scores
from chalkline.plans.rescue import open_warehouse, rescue, save_risk
from chalkline.sources import raw, tables
from chalkline.sources.workbook import sheet_rows
from chalkline.vocabulary import NA_TOKENS

SF = "/root/testdata/sf0.001"


def test_csv_missing_texts_and_counts(spark, tmp_path):
    lines = ["school_id,school_name,district,block,school_type,medium,total_enrolled_students"]
    lines += [f"{i},a,{token},b,c,d,{token}" for i, token in enumerate(NA_TOKENS)]
    lines += ['98,"with ""quotes"", and comma", moga ,b,c,d,40.0', "99,a,na,b,c,d,41"]
    (tmp_path / "m.csv").write_text("\n".join(lines))
    rows = {r.school_id: r for r in raw.read_csv(spark, str(tmp_path / "m.csv"), schemas.SCHOOL_MASTER).collect()}
    assert all(rows[str(i)].district is None and rows[str(i)].total_enrolled_students is None for i in range(len(NA_TOKENS)))
    assert rows["98"].school_name == 'with "quotes", and comma' and rows["98"].district == " moga "
    assert rows["98"].total_enrolled_students == 40 and rows["99"].district == "na"


@pytest.mark.parametrize("lines", [False, True])
def test_json_keeps_number_spelling(spark, tmp_path, lines):
    records = ['{"assessment_id": "a", "avg_score": 8, "max_marks": 10}',
               '{"assessment_id": "b", "avg_score": "NA", "max_marks": 10.0}', '{"assessment_id": "c"}']
    text = "\n".join(records) if lines else "[" + ",\n".join(records) + "]"
    (tmp_path / "s.json").write_text(text)
    got = raw.read_json(spark, str(tmp_path / "s.json"), schemas.TEST_SCORES, lines)
    assert {(r.assessment_id, r.avg_score, r.max_marks) for r in got.collect()} == {
        ("a", "8", "10"), ("b", "NA", "10.0"), ("c", None, None)}


def office_workbook():
    """A workbook as office programs write it: shared strings, references, gaps, typed cells."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    parts = {
        "xl/workbook.xml": f'<workbook {main} {rel}><sheets><sheet name="x" sheetId="1" r:id="rId7"/>'
                           '<sheet name="y" sheetId="2" r:id="rId8"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                                      '<Relationship Id="rId8" Target="worksheets/other.xml"/>'
                                      '<Relationship Id="rId7" Target="/xl/worksheets/first.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst {main}><si><t>procurement_id</t></si><si><t>unit</t></si>'
                                '<si><r><t>k</t></r><r><t>g</t></r></si></sst>',
        "xl/worksheets/first.xml": f'<worksheet {main}><sheetData>'
                                   '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c>'
                                   '<c r="AA1" t="inlineStr"><is><t>quantity</t></is></c></row>'
                                   '<row r="2"><c r="A2"><v>12</v></c><c r="C2" t="s"><v>2</v></c><c r="AA2"><v>2.5</v></c></row>'
                                   '<row r="3"/><row r="4"><c r="A4" t="b"><v>1</v></c><c r="C4" t="str"><v>N/A</v></c></row>'
                                   "</sheetData></worksheet>",
    }
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w") as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return target.getvalue()


PART = T.StructType([schemas.MDM_PROCUREMENT[name] for name in ("procurement_id", "unit")])


def test_workbooks(spark, tmp_path):
    content = office_workbook()
    assert next(sheet_rows(content))[0] == "procurement_id"
    (tmp_path / "one.xlsx").write_bytes(content)
    two = pd.DataFrame({"unit": ["bags", None], "procurement_id": ["<7>", "8"]}, dtype=object)
    (tmp_path / "two.xlsx").write_bytes(derived.workbook_bytes(two))
    (tmp_path / "notes.txt").write_text("no workbook")
    got = raw.read_excel(spark, str(tmp_path), PART)
    assert got.columns == ["procurement_id", "unit", "quantity"]
    assert {(r.procurement_id, r.unit, r.quantity) for r in got.collect()} == {
        ("12", "kg", "2.5"), ("TRUE", None, None), ("<7>", "bags", None), ("8", None, None)}
    with pytest.raises(Exception, match="not found by heading: quantity"):
        raw.read_excel(spark, str(tmp_path), T.StructType([*PART, schemas.MDM_PROCUREMENT["quantity"]])).collect()


def typed_sheet(cells, late=False):
    """A workbook with one row of cells; style 1 is a built-in date, style 2 an own one, style 3 an amount."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    source = io.BytesIO(derived.workbook_bytes(pd.DataFrame()))
    target = io.BytesIO()
    with zipfile.ZipFile(source) as old, zipfile.ZipFile(target, "w") as new:
        book = old.read("xl/workbook.xml").decode()
        new.writestr("xl/workbook.xml", book.replace("<sheets>", '<workbookPr date1904="1"/><sheets>') if late else book)
        new.writestr("xl/_rels/workbook.xml.rels", old.read("xl/_rels/workbook.xml.rels"))
        new.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="dd\\.mm\\.yyyy"/>'
                     '<numFmt numFmtId="171" formatCode="[Red]0.00&quot; days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/>'
                     '<xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        new.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData><row>{cells}</row></sheetData></worksheet>")
    return target.getvalue()


def test_workbook_cells_are_typed():
    cells = ('<c s="1"><v>45757</v></c><c s="2"><v>45757.354166666664</v></c><c s="3"><v>12</v></c><c t="e"><v>#DIV/0!</v></c>'
             '<c><v>1E-4</v></c><c><v>40.0</v></c><c t="d"><v>2025-04-10T08:30:00</v></c><c s="1"><v>59</v></c><c s="1"><v>0.5</v></c>')
    assert next(sheet_rows(typed_sheet(cells))) == [
        "2025-04-10 00:00:00", "2025-04-10 08:30:00", "12", None, "0.0001", "40", "2025-04-10T08:30:00", "1900-02-28 00:00:00", "12:00:00"]
    assert next(sheet_rows(typed_sheet('<c s="1"><v>44295</v></c>', late=True))) == ["2025-04-10 00:00:00"]


ATTENDANCE = "present_students,date,shift,record_id,total_students,school_id,grade,teacher_present,marked_by"


def test_csv_by_heading_keeps_other_columns(spark, tmp_path):
    lines = [ATTENDANCE, "40.9,2025-01-06,am,r1,40.5,SCH-7,I,yes,x", "40.9,2025-01-06,pm,r1,40.5,SCH-7,I,yes,x", "N/A,2025-01-06,am,r2,nan,S8,I,yes,x"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    got = raw.read_csv(spark, str(tmp_path / "a.csv"), schemas.STUDENT_ATTENDANCE)
    assert got.columns == [*schemas.STUDENT_ATTENDANCE.names, "shift"]
    rows = clean_attendance(got).collect()
    assert {(r.school_id, str(r.date), r.shift, r.present_students, r.is_impossible_attendance, r.exact_copies) for r in rows} == {
        ("SCH0007", "2025-01-06", "am", 40.9, True, 1), ("SCH0007", "2025-01-06", "pm", 40.9, True, 1), ("SCH0008", "2025-01-06", "am", None, False, 1)}


@pytest.mark.parametrize("lines", [
    [ATTENDANCE.replace("grade", "class"), "1,2025-01-06,am,r,1,7,I,y,x"],
    [ATTENDANCE, "1,2025-01-06,am,r,1,7,I,y,x,more"],
    [ATTENDANCE, "1,2025-01-06,am"],
])
def test_broken_csv_fails(spark, tmp_path, lines):
    (tmp_path / "a.csv").write_text("\n".join(lines))
    with pytest.raises(Exception, match="heading|MALFORMED"):
        raw.read_csv(spark, str(tmp_path / "a.csv"), schemas.STUDENT_ATTENDANCE).collect()


def test_csv_files_of_one_path_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text(ATTENDANCE + "\n1,2025-01-06,am,r,1,7,I,y,x")
    (tmp_path / "b.csv").write_text(ATTENDANCE.replace("shift,record_id", "record_id,shift") + "\n1,2025-01-06,r,am,1,7,I,y,x")
    with pytest.raises(Exception, match="header"):
        raw.read_csv(spark, str(tmp_path), schemas.STUDENT_ATTENDANCE).collect()


def test_json_keeps_other_keys_and_fails_on_broken_lines(spark, tmp_path):
    path = tmp_path / "s.jsonl"
    path.write_text('{"assessment_id": "a", "room": 1.50}\n{"assessment_id": "a", "room": 2}\n')
    got = raw.read_json(spark, str(path), schemas.TEST_SCORES, lines=True)
    assert {(r.assessment_id, r.room, r.exact_copies) for r in clean_scores(got).collect()} == {("a", "1.50", 1), ("a", "2", 1)}
    path.write_text('{"assessment_id": "a"}\n{"assessment_id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.read_json(spark, str(path), schemas.TEST_SCORES, lines=True).collect()


def test_undeclared_columns_follow_their_school(spark):
    rows = [("7", "n", "d", "b", "t", "m", 5.0, None, "x.y", 9), ("7", "n", "d", "b", "t", "m", 3.0, "late", None, 9)]
    df = spark.createDataFrame(rows, T.StructType(schemas.SCHOOL_MASTER.fields + [
        T.StructField("phone", T.StringType()), T.StructField("a.b", T.StringType()), T.StructField("exact_copies", T.IntegerType())]))
    row = clean_school_master(df).first()
    assert (row["total_enrolled_students"], row["phone"], row["a.b"]) == (5.0, "late", "x.y")


def session(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: conf.get(k, d)), sparkContext=SimpleNamespace(master=master))


def test_scratch_path_uses_the_shared_folder():
    shared = session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/dir"})
    first, second = tables.scratch_path(shared, "x"), tables.scratch_path(shared, "x")
    assert first.startswith("hdfs://shared/dir/x-") and first != second
    with pytest.raises(ValueError):
        tables.scratch_path(session("yarn"), "x")
    assert "chalkline-" in tables.scratch_path(session("local[4]"), "x")


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """The whole run from files in the formats the datasets come in."""
    base = tmp_path_factory.mktemp("files")
    paths = {}
    for name in ("school_master", "student_attendance", "school_infrastructure"):
        paths[name] = tables.write_csv(derived.RAW[name](spark, SF), str(base / f"{name}.csv"))
    scores = derived.test_scores(spark, SF).toPandas().astype(object)
    paths["test_scores"] = str(base / "scores.json")
    with open(paths["test_scores"], "w", encoding="utf-8") as file:
        json.dump(scores.where(scores.notna(), None).to_dict("records"), file)
    paths["mdm_procurement"] = str(base / "mdm.xlsx")
    (base / "mdm.xlsx").mkdir()
    for i, row in enumerate(derived.as_workbooks(derived.mdm_procurement(spark, SF)).collect()):
        (base / "mdm.xlsx" / f"{i}.xlsx").write_bytes(bytes(row.content))
    root = str(tmp_path_factory.mktemp("warehouse"))
    audit = rescue(spark, paths, root, by_month=True)
    star, districts = open_warehouse(spark, root)
    return star, districts, audit, root


def test_written_csv_is_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "CSV_ROWS", 40)
    rows = [(f"r{i}", f' x"{i % 7}" ', None if i % 5 else "v,w") for i in range(100)]
    df = spark.createDataFrame(rows, "a string, b string, c string").coalesce(1)
    path = tables.write_csv(df, f"{tmp_path}/out")
    assert [f for f in os.listdir(path) if f.endswith(".csv")] == [] and len([f for f in os.listdir(path) if f.endswith(".csv.gz")]) == 3
    text = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    assert sorted(map(str, raw.read_csv(spark, path, text).collect())) == sorted(map(str, df.collect()))


def test_tables_equal_the_plans_over_derived_records(spark, warehouse):
    star, districts, _, _ = warehouse
    direct = derived.star(spark, SF)
    assert districts == 26
    for name in direct.tables():
        ours, theirs = star.table(name).drop("date_month"), direct.table(name)
        assert sorted(ours.columns) == sorted(theirs.columns)
        ours = ours.select(theirs.columns)
        assert ours.exceptAll(theirs).count() == 0 and theirs.exceptAll(ours).count() == 0


def test_audit_matches_the_tables(warehouse):
    star, _, audit, _ = warehouse
    values = {(r.dataset, r.metric): r.value for r in audit.where("key IS NULL AND metric <> 'scale_breakdown'").collect()}
    assert values["student_attendance", "retained_rows"] == star.attendance.count()
    assert values["school_infrastructure", "unique_schools_current"] == star.infra_current.count()
    assert values["school_master", "retained_unique_schools"] == star.school.count()
    assert values["mdm_procurement", "raw_rows"] - values["mdm_procurement", "exact_duplicates"] == star.procurement.count()
    breakdown = {r.key: r.value for r in audit.where("metric = 'scale_breakdown'").collect()}
    assert sum(breakdown.values()) == star.scores.count() and None in breakdown


def test_workbooks_are_read_where_the_package_is_not_installed(tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(sheet_rows))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", "import pickle; pickle.load(open('f', 'rb'))"], cwd=tmp_path, env=env, check=True, timeout=60)


def test_raw_files_of_the_run_are_written_side_by_side(spark, monkeypatch):
    # Each of the five waits for the others to begin.
    begun = threading.Barrier(len(derived.RAW), timeout=60)

    def together(build):
        def waits(*args):
            begun.wait()
            return build(*args)
        return waits

    for name, build in derived.RAW.items():
        monkeypatch.setitem(derived.RAW, name, together(build))
    audit = {(r.dataset, r.metric): r.value for r in queries()["rescue_run"](spark, SF).where("key IS NULL").collect()}
    monkeypatch.undo()
    for name in derived.RAW:
        assert audit[name, "raw_rows"] == derived.RAW[name](spark, SF).count()


def test_months_prune_partitions(warehouse):
    star, _, _, _ = warehouse
    plan = star.attendance.where("date_month = '1998-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan


def test_risk_table_and_ad_hoc_queries(spark, warehouse):
    star, _, _, root = warehouse
    risk = save_risk(star, root)
    assert risk.count() == star.school.count()
    for name in ("vw_school_welfare_risk", "fact_welfare_risk", "vw_district_summary", "dim_school"):
        df, error = tables.try_query(spark, f"SELECT count(*) AS n FROM {name};")
        assert error is None and df.first().n > 0
    ordered = tables.read_query(spark, "SELECT school_id FROM fact_welfare_risk ORDER BY school_id DESC LIMIT 3").collect()
    assert [r.school_id for r in ordered] == sorted((r.school_id for r in ordered), reverse=True)


@pytest.mark.parametrize("text", [
    "SELECT nothing FROM nowhere", "SELEC 1", "DROP VIEW dim_school", "CREATE TABLE t AS SELECT 1",
    "INSERT INTO dim_school SELECT * FROM dim_school",
])
def test_ad_hoc_errors_and_commands_are_refused(spark, warehouse, text):
    df, error = tables.try_query(spark, text)
    assert df is None and error
    assert spark.table("dim_school").count() > 0


@pytest.mark.parametrize("text", ["select 1 as a) x join (select 2 as b", "DROP VIEW IF EXISTS v", "EXTENDED SELECT 1"])
def test_only_whole_queries_are_read(spark, text):
    assert tables.try_query(spark, text)[0] is None


def test_a_query_may_have_brackets_and_a_semicolon(spark):
    assert tables.read_query(spark, "SELECT (1 + 2) AS a;").first().a == 3
