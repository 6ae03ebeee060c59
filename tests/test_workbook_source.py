"""The data source of workbooks: round trips, cells, commits."""

import datetime
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from chalkline import schemas
from chalkline.sources import raw, workbook_source
from chalkline.sources.workbook import sheet_records, sheet_rows
from chalkline.sources.workbook_source import register_workbooks, serial_number, workbooks_below


@pytest.fixture(scope="module")
def books(spark):
    return register_workbooks(spark)


KINDS = [{}, {"strings": "shared"}, {"strings": "shared", "date1904": "true"}, {"date1904": "true", "rowsPerFile": "7"}]


@pytest.mark.parametrize("options", KINDS)
def test_typed_cells_come_back_as_texts(books, tmp_path, options):
    df = books.range(40).repartition(3).selectExpr(
        "id", "' a <b> & \"c\" _x0041_ ' || char(7) || char(10) || id AS t", "date_add(date'1904-01-02', cast(id * 500 AS int)) AS d",
        "CASE WHEN id % 5 = 0 THEN double('NaN') WHEN id % 5 = 1 THEN double('-Infinity') ELSE id / 8 END AS f", "id % 2 = 0 AS b",
        "timestamp_ntz'2024-05-06 07:08:09' AS m", "cast(NULL AS string) AS n", "cast(id AS decimal(20, 3)) AS x", "9007199254740993 + id AS long",
    )
    df.write.format("workbook").options(**options).mode("overwrite").save(f"{tmp_path}/out")
    back = books.read.format("workbook").load(f"{tmp_path}/out")
    assert back.columns == df.columns
    rows = sorted(back.collect(), key=lambda r: int(r.id))
    for k, r in enumerate(rows):
        day = datetime.date(1904, 1, 2) + datetime.timedelta(days=500 * k)
        number = None if k % 5 < 2 else f"{k / 8}".removesuffix(".0")
        assert tuple(r) == (
            str(k), f' a <b> & "c" _x0041_ \x07\n{k}', f"{day} 00:00:00", number, "TRUE" if k % 2 == 0 else "FALSE", "2024-05-06 07:08:09", None,
            f"{k}.000", str(9007199254740993 + k),
        )
    assert len(rows) == 40
    for name in workbooks_below(f"{tmp_path}/out"):
        with zipfile.ZipFile(name) as archive:
            assert ("xl/sharedStrings.xml" in archive.namelist()) == (options.get("strings") == "shared")
        assert sum(1 for _ in sheet_rows(open(name, "rb").read())) <= 1 + int(options.get("rowsPerFile", 100))


def test_days_before_the_first_are_texts(books, tmp_path):
    assert serial_number(datetime.date(1900, 1, 1), False) == 1 and serial_number(datetime.date(1900, 2, 28), False) == 59
    assert serial_number(datetime.date(1900, 3, 1), False) == 61 and serial_number(datetime.date(1899, 12, 31), False) is None
    assert serial_number(datetime.date(1903, 12, 31), True) is None and serial_number(datetime.datetime(1904, 1, 2, 12), True) == 1.5
    df = books.sql("SELECT explode(array(date'1850-06-01', date'1900-01-01', date'1900-03-01')) AS d")
    df.write.format("workbook").mode("append").save(f"{tmp_path}/out")
    assert {r.d for r in books.read.format("workbook").load(f"{tmp_path}/out").collect()} == {
        "1850-06-01", "1900-01-01 00:00:00", "1900-03-01 00:00:00"}


def test_a_write_is_seen_whole_or_not_at_all(books, tmp_path):
    path = f"{tmp_path}/out"
    books.range(4).write.format("workbook").mode("append").save(path)
    before = set(os.listdir(path))
    broken = books.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        broken.write.format("workbook").mode("overwrite").save(path)
    assert set(os.listdir(path)) == before
    books.range(2).write.format("workbook").mode("append").save(path)
    assert books.read.format("workbook").load(path).count() == 6
    books.range(3).write.format("workbook").mode("overwrite").save(path)
    assert books.read.format("workbook").load(path).count() == 3 and not [n for n in os.listdir(path) if n.startswith("_")]


def test_headings_and_schemas(books, tmp_path):
    books.sql("SELECT 'a' AS one, 'b' AS two").write.format("workbook").mode("append").save(f"{tmp_path}/x/1")
    books.sql("SELECT 'c' AS two, 'd' AS three").write.format("workbook").mode("append").save(f"{tmp_path}/x/2")
    df = books.read.format("workbook").load(f"{tmp_path}/x")
    assert sorted(df.columns) == ["one", "three", "two"]
    assert {(r.one, r.two, r.three) for r in df.collect()} == {("a", "b", None), (None, "c", "d")}
    assert {r.two for r in books.read.format("workbook").schema("two string").load(f"{tmp_path}/x").collect()} == {"b", "c"}
    with pytest.raises(Exception, match="columns not found by heading: one"):
        books.read.format("workbook").schema("one string").load(f"{tmp_path}/x").collect()
    with pytest.raises(Exception, match="read as texts"):
        books.read.format("workbook").schema("two int").load(f"{tmp_path}/x").collect()
    one = workbooks_below(f"{tmp_path}/x/1")[0]
    assert books.read.format("workbook").load(one).collect() == books.read.format("workbook").load(f"file://{one}").collect()
    os.makedirs(f"{tmp_path}/none")
    with pytest.raises(Exception, match="no workbook"):
        books.read.format("workbook").load(f"{tmp_path}/none")
    assert books.read.format("workbook").schema("a string").load(f"{tmp_path}/none").collect() == []
    books.range(0).write.format("workbook").mode("append").save(f"{tmp_path}/empty")
    assert workbooks_below(f"{tmp_path}/empty") == []


def test_written_workbooks_are_raw_files(books, tmp_path):
    names = schemas.MDM_PROCUREMENT.names
    books.createDataFrame([["N/A", *map(str, range(len(names) - 1))]], names).write.format("workbook").mode("append").save(f"{tmp_path}/p.xlsx")
    got = raw.read_raw(books, {"mdm_procurement": f"{tmp_path}/p.xlsx"})["mdm_procurement"]
    assert [tuple(r) for r in got.collect()] == [(None, *map(str, range(len(names) - 1)))]


def test_a_workbook_shares_a_bounded_number_of_texts(books, tmp_path, monkeypatch):
    """The texts held do not grow with the rows, and every text comes back."""
    monkeypatch.setattr(workbook_source, "MOST_SHARED", 5)
    stream = io.BytesIO()
    sheet = workbook_source._Sheet(stream, ["a", "b"], True, False)
    rows = [[f"t{i}", f"t{i % 3}"] for i in range(200)]
    for row in rows:
        sheet.add(row)
    assert len(sheet.shared) == 5
    sheet.close()
    stream.seek(0)
    assert list(sheet_records(stream, ["a", "b"], ["a"])) == rows == list(sheet_records(stream.getvalue(), ["a", "b"], ["a"]))
