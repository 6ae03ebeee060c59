"""Workbooks (.xlsx): many files in parallel, one file per row of a binary scan.

Spark has no workbook source. A workbook is a zip archive of XML that cannot be split, and a
sheet holds at most 1,048,576 rows, so a file is the natural unit of work: each is decoded in
the task that reads it, row by row, and leaves as Arrow batches.
"""

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from decimal import Decimal
from typing import BinaryIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH_ROWS = 10_000

# Numbers of the built-in formats that show dates and times (fixed values).
_BUILT_IN_DATES = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Names that are asked for at every cell.
_DATA, _ROW, _CELL, _VALUE, _INLINE = (f"{_MAIN}{name}" for name in ("sheetData", "row", "c", "v", "is"))
_TEXT, _RUN_TEXT = f"{_MAIN}t", f"{_MAIN}r/{_MAIN}t"


def _first_sheet(archive: zipfile.ZipFile) -> str:
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    wanted = book.find(f"{_MAIN}sheets/{_MAIN}sheet").get(f"{_REL}id")
    rels = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels if r.get("Id") == wanted)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _texts(element) -> str:
    """The text of a string item, without the phonetic readings beside it."""
    only = element[0] if len(element) == 1 else None
    if only is not None and only.tag == _TEXT:
        text = only.text or ""
    else:
        text = "".join(t.text or "" for t in (element.findall(_RUN_TEXT) or element.findall(_TEXT)))
    # Characters that XML has no place for are written by number.
    return text if "_x" not in text else re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m.group(1), 16)), text)


def _shared_strings(archive: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in archive.namelist():
        return []
    found, root = [], None
    with archive.open("xl/sharedStrings.xml") as items:
        for event, element in ElementTree.iterparse(items, ("start", "end")):
            if root is None:
                root = element
            if event == "end" and element.tag == f"{_MAIN}si":
                found.append(_texts(element))
                # Only the texts are kept.
                root.clear()
    return found


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _is_date_format(code: str) -> bool:
    """Whether a number format shows a date: letters of dates outside quotes, escapes and brackets."""
    bare = re.sub(r'"[^"]*"|\\.|_.|\[[^\]]*\]', "", code)
    return code.lower() != "general" and re.search("[dmyhs]", bare, re.IGNORECASE) is not None


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a serial number as a date."""
    if "xl/styles.xml" not in archive.namelist():
        return set()
    root = ElementTree.fromstring(archive.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
    styles = [int(x.get("numFmtId", "0")) for x in root.findall(f"{_MAIN}cellXfs/{_MAIN}xf")]
    return {
        at for at, style in enumerate(styles)
        if (_is_date_format(own[style]) if style in own else style in _BUILT_IN_DATES)
    }


def _day_zero(archive: zipfile.ZipFile) -> datetime:
    """The day of serial number 0: workbooks count from 1900 or, if they say so, from 1904."""
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    settings = book.find(f"{_MAIN}workbookPr")
    late = settings is not None and settings.get("date1904", "0") in ("1", "true")
    return datetime(1904, 1, 1) if late else datetime(1899, 12, 30)


def _date_text(serial: str, zero: datetime) -> str:
    """The text of a date cell; a time without a day, below 1, is written as a time."""
    days = float(serial)
    # Serial numbers from 1900 count a 29 February 1900 that never was.
    if zero.year < 1900 and 1 <= days < 60:
        days += 1
    moment = zero + timedelta(seconds=round(days * 86_400))
    return moment.strftime("%H:%M:%S" if 0 <= days < 1 else "%Y-%m-%d %H:%M:%S")


def _number_text(value: str) -> str:
    """A stored number written out, without an exponent and without a fraction of zero."""
    text = format(Decimal(repr(float(value))), "f")
    return text.removesuffix(".0")


def _cell_text(cell, shared, dates, zero):
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _texts(cell.find(_INLINE))
    value = cell.findtext(_VALUE)
    if value is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "TRUE" if value == "1" else "FALSE"
    if kind == "n":
        if int(cell.get("s", "0")) in dates:
            return _date_text(value, zero)
        return _number_text(value)
    return value


def sheet_rows(content: bytes | BinaryIO) -> Iterator[list]:
    """Rows of the first sheet, of a workbook's bytes or open file, as lists of texts; blank cells and error values are None."""
    with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as archive:
        shared = _shared_strings(archive)
        dates, zero = _date_styles(archive), _day_zero(archive)
        with archive.open(_first_sheet(archive)) as sheet:
            data, columns = None, {}
            for event, element in ElementTree.iterparse(sheet, ("start", "end")):
                if event == "start":
                    if data is None and element.tag == _DATA:
                        data = element
                    continue
                if element.tag != _ROW:
                    continue
                row = []
                for position, cell in enumerate(element.findall(_CELL)):
                    reference, at = cell.get("r"), position
                    if reference:
                        letters = reference.rstrip("0123456789")
                        if letters not in columns:
                            columns[letters] = _column_index(letters)
                        at = columns[letters]
                    row.extend([None] * (at + 1 - len(row)))
                    row[at] = _cell_text(cell, shared, dates, zero)
                # The row is detached, or a full sheet would leave a million empty ones behind.
                data.clear()
                yield row


def sheet_records(content: bytes | BinaryIO, names: list[str], required: list[str]) -> Iterator[list]:
    """The rows below the headings as lists of the named columns' texts, empty rows left out."""
    rows = sheet_rows(content)
    header = next(rows, [])
    absent = [name for name in required if name not in header]
    if absent:
        raise ValueError(f"columns not found by heading: {', '.join(absent)}")
    at = [header.index(name) if name in header else None for name in names]
    for row in rows:
        record = [row[i] if i is not None and i < len(row) else None for i in at]
        if any(value is not None for value in record):
            yield record


def decode_workbooks(files: DataFrame, schema: T.StructType, required: Sequence[str] | None = None) -> DataFrame:
    """Records of a frame of workbooks (binary column `content`); columns are found by heading.

    A workbook without a heading that is `required`, all of the schema by default, is an error.
    """
    names = schema.names
    needed = names if required is None else list(required)

    def decode(batches):
        for batch in batches:
            for content in batch["content"]:
                chunk = []
                for record in sheet_records(content, names, needed):
                    chunk.append(record)
                    if len(chunk) == BATCH_ROWS:
                        yield pd.DataFrame(chunk, columns=names, dtype=object)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=names, dtype=object)

    return files.select("content").mapInPandas(decode, schema)


def headings(files: DataFrame) -> list[str]:
    """The distinct headings of a frame of workbooks, of which only the first rows are decoded."""
    def first_rows(batches):
        for batch in batches:
            for content in batch["content"]:
                rows = sheet_rows(content)
                yield pd.DataFrame({"heading": [name for name in next(rows, []) if name]}, dtype=object)
                rows.close()

    found = files.select("content").mapInPandas(first_rows, "heading string").distinct()
    return sorted(row["heading"] for row in found.collect())


def read_workbooks(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """Records of every workbook under a path, all columns as text: the required ones, then all others."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx")
        .option("recursiveFileLookup", "true").load(path)
    )
    names = [*required, *[name for name in headings(files) if name not in required]]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return decode_workbooks(files, schema, required)
