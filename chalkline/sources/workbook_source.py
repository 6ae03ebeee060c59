"""The data source `workbook`: `.xlsx` files in and out, one file per partition.

    register_workbooks(spark)
    spark.read.format("workbook").load("raw/procurement")
    df.write.format("workbook").option("strings", "shared").mode("overwrite").save("out/procurement")

Paths are folders (or single files to read) that driver and executors share: plain or `file:` paths, or whatever URI
pyarrow's file systems open. `raw.read_excel` reads workbooks through Spark's own file systems instead.
"""

import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from chalkline.sources.workbook import BATCH_ROWS, sheet_rows, sheet_records

ENDING = ".xlsx"
# A sheet has room for 1,048,576 rows (fixed value), one of them the headings.
MOST_ROWS = 1_048_575
MOST_EXACT = 1 << 53
# Texts that a workbook shares at most: those that come first. The others are written in their cells.
MOST_SHARED = 50_000

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_FIRST_DAY = {False: datetime(1899, 12, 30), True: datetime(1904, 1, 1)}
_DAY, _MOMENT = 1, 2


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path) else (fs.LocalFileSystem(), path)


def workbooks_below(path: str) -> list[str]:
    """The workbooks in a folder and below it, or a single one, by name; hidden ones and unfinished writes are left out."""
    system, root = opened(path)
    if system.get_file_info(root).type == fs.FileType.File:
        return [root]
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    names = [f.path for f in found if f.type == fs.FileType.File and f.path.endswith(ENDING)]
    return sorted(n for n in names if not any(part[:1] in "_." for part in posixpath.relpath(n, root).split("/")))


# Reading ---------------------------------------------------------------------------------


@dataclass
class OneWorkbook(InputPartition):
    """A partition: the name of a workbook."""

    name: str

    def __post_init__(self):
        super().__init__(self.name)


class WorkbookReader(DataSourceReader):
    """A task per workbook; a sheet cannot be split, and has at most a million rows."""

    def __init__(self, path: str, schema: T.StructType, required: list[str]):
        self.path, self.names, self.required = path, schema.names, required

    def partitions(self):
        # Without workbooks there is one partition that reads none.
        return [OneWorkbook(name) for name in workbooks_below(self.path)] or [OneWorkbook("")]

    def read(self, partition: OneWorkbook) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        system, _ = opened(self.path)
        chunk = []
        with system.open_input_file(partition.name) as file:
            for record in sheet_records(file, self.names, self.required):
                chunk.append(record)
                if len(chunk) == BATCH_ROWS:
                    yield self._batch(chunk)
                    chunk = []
        if chunk:
            yield self._batch(chunk)

    def _batch(self, rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=self.names)


# Writing ---------------------------------------------------------------------------------


def _escaped(text: str) -> str:
    """Characters that XML has no place for are written by number, as office programs do."""
    text = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", text)
    return escape(re.sub("[\x00-\x08\x0b\x0c\x0d\x0e-\x1f￾￿]", lambda m: f"_x{ord(m.group()):04X}_", text))


def serial_number(value: date | datetime, late: bool) -> float | int | None:
    """The number of a day or moment, counted from 1904 if `late` and else from 1900; None before that."""
    moment = value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
    past = moment.replace(tzinfo=None) - _FIRST_DAY[late]
    days = past.days + past.seconds / 86_400 + past.microseconds / 86_400_000_000
    # From 1900 a 29 February 1900 is counted that never was.
    if not late and days < 61:
        days -= 1
    if days < (0 if late else 1):
        return None
    return days if isinstance(value, datetime) else int(days)


class _Sheet:
    """One workbook while it is written, row by row; only the texts that are shared are held."""

    def __init__(self, stream, names, shared, late):
        self.archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
        self.late, self.shared = late, {} if shared else None
        settings = '<workbookPr date1904="1"/>' if late else ""
        self._part("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="xml" ContentType="application/xml"/></Types>')
        self._part("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" '
                   'Target="xl/workbook.xml"/></Relationships>')
        self._part("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}">{settings}<sheets>'
                   '<sheet name="records" sheetId="1" r:id="rId1"/></sheets></workbook>')
        self._part("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">'
                   f'<Relationship Id="rId1" Type="{_OFFICE}/worksheet" Target="worksheets/sheet1.xml"/>'
                   f'<Relationship Id="rId2" Type="{_OFFICE}/styles" Target="styles.xml"/>'
                   + (f'<Relationship Id="rId3" Type="{_OFFICE}/sharedStrings" Target="sharedStrings.xml"/>' if shared else "") + "</Relationships>")
        self._part("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}"><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="22"/>'
                   "</cellXfs></styleSheet>")
        self.sheet = self.archive.open("xl/worksheets/sheet1.xml", "w")
        self.sheet.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self.rows = -1
        self.add(names)

    def _part(self, name, xml):
        self.archive.writestr(name, f'<?xml version="1.0" encoding="UTF-8"?>{xml}')

    def _cell(self, value):
        if value is None:
            return "<c/>"
        if isinstance(value, bool):
            return f'<c t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (date, datetime)):
            number = serial_number(value, self.late)
            if number is not None:
                return f'<c s="{_MOMENT if isinstance(value, datetime) else _DAY}"><v>{number!r}</v></c>'
        if isinstance(value, float) and (value != value or value in (float("inf"), float("-inf"))):
            return '<c t="e"><v>#NUM!</v></c>'
        if isinstance(value, float) or isinstance(value, int) and abs(value) <= MOST_EXACT:
            return f"<c><v>{value!r}</v></c>"
        text = str(value)
        if self.shared is not None and (text in self.shared or len(self.shared) < MOST_SHARED):
            return f'<c t="s"><v>{self.shared.setdefault(text, len(self.shared))}</v></c>'
        return f'<c t="inlineStr"><is><t xml:space="preserve">{_escaped(text)}</t></is></c>'

    def add(self, row):
        self.sheet.write(f"<row>{''.join(map(self._cell, row))}</row>".encode())
        self.rows += 1

    def close(self):
        self.sheet.write(b"</sheetData></worksheet>")
        self.sheet.close()
        if self.shared is not None:
            items = "".join(f'<si><t xml:space="preserve">{_escaped(text)}</t></si>' for text in self.shared)
            self._part("xl/sharedStrings.xml", f'<sst xmlns="{_MAIN}">{items}</sst>')
        self.archive.close()


@dataclass
class Written(WriterCommitMessage):
    """The names of the finished workbooks of a task, in the folder of the write."""

    names: list[str]


class WorkbookWriter(DataSourceArrowWriter):
    """Each task writes its rows to workbooks of at most `rowsPerFile` rows; none for no rows.

    They wait in a hidden folder below the path and are moved beside it when all tasks have ended; a
    write that fails leaves nothing. Former workbooks go only then, where they are to be overwritten.
    """

    def __init__(self, options, schema: T.StructType, overwrite: bool):
        self.path, self.names, self.overwrite = options["path"], schema.names, overwrite
        self.shared = options.get("strings", "inline") == "shared"
        self.late = options.get("date1904", "false").lower() == "true"
        self.most = int(options.get("rowsPerFile", MOST_ROWS))
        if not 0 < self.most <= MOST_ROWS:
            raise ValueError(f"rowsPerFile must be from 1 to {MOST_ROWS}")
        self.waiting = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator):
        system, root = opened(self.path)
        folder = posixpath.join(root, self.waiting)
        system.create_dir(folder, recursive=True)
        names, sheet, stream = [], None, None
        for batch in iterator:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if sheet is not None and sheet.rows == self.most:
                    sheet.close()
                    stream.close()
                    sheet = None
                if sheet is None:
                    names.append(f"part-{uuid.uuid4().hex}{ENDING}")
                    stream = system.open_output_stream(posixpath.join(folder, names[-1]))
                    sheet = _Sheet(stream, self.names, self.shared, self.late)
                sheet.add(row)
        if sheet is not None:
            sheet.close()
            stream.close()
        return Written(names)

    def commit(self, messages):
        system, root = opened(self.path)
        former = workbooks_below(self.path) if self.overwrite and system.get_file_info(root).type != fs.FileType.NotFound else []
        system.create_dir(root, recursive=True)
        for message in messages:
            for name in message.names if message is not None else ():
                system.move(posixpath.join(root, self.waiting, name), posixpath.join(root, name))
        for name in former:
            system.delete_file(name)
        self._tidy(system, root)

    def abort(self, messages):
        self._tidy(*opened(self.path))

    def _tidy(self, system, root):
        folder = posixpath.join(root, self.waiting)
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class WorkbookSource(DataSource):
    """Options: `strings` (inline or shared), `date1904` and `rowsPerFile` for writing.

    Read columns are texts, found by heading; cells are spelt as `sources.workbook` says. Without a schema the driver reads the
    headings of all workbooks, in the order in which they come; with one, a heading that a workbook lacks is
    an error. Written are texts, numbers, booleans, dates (as numbers, in texts before the first day that can be counted);
    NaN and infinite numbers become error cells, integers above 2**53 and decimals texts.
    """

    @classmethod
    def name(cls):
        return "workbook"

    def schema(self):
        system, _ = opened(self.options["path"])
        found: dict[str, None] = {}
        for name in workbooks_below(self.options["path"]):
            with system.open_input_file(name) as file:
                rows = sheet_rows(file)
                found |= dict.fromkeys(heading for heading in next(rows, []) if heading)
                rows.close()
        if not found:
            raise ValueError(f"no workbook with headings below {self.options['path']}")
        self.inferred = True
        return T.StructType([T.StructField(name, T.StringType()) for name in found])

    def reader(self, schema):
        others = [f.name for f in schema if not isinstance(f.dataType, T.StringType)]
        if others:
            raise ValueError(f"columns of workbooks are read as texts: {', '.join(others)}")
        required = [] if getattr(self, "inferred", False) else schema.names
        return WorkbookReader(self.options["path"], schema, required)

    def writer(self, schema, overwrite):
        return WorkbookWriter(self.options, schema, overwrite)


def register_workbooks(spark: SparkSession) -> SparkSession:
    """Makes the format `workbook` known to a session."""
    spark.dataSource.register(WorkbookSource)
    return spark
