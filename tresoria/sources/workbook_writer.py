"""Long cells -> spreadsheet workbooks (.xlsx), one workbook per task at a time.

The cells of a workbook meet in one task, sorted by Spark; they go through as a stream into the sheets' XML
parts, so a task holds one compressed workbook and its shared strings.  The result has the columns of
the binary file source (``path``, ``content``), so ``workbook.decode_files`` reads it back; where files are
wanted, ``content`` is what goes into them.

Dates (``yyyy-MM-dd``) are stored as serial numbers with a date style, numbers as numbers, all other
values as shared strings.  Repeated cells (same sheet, row and column) end the job, as do positions beyond
a sheet's limits and characters that XML does not allow.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILES_SCHEMA = "path string, length long, content binary"
MAX_ROWS, MAX_COLUMNS = 1_048_576, 16_384
_NUMBER = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
_NO_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
_EPOCH = _dt.date(1899, 12, 30)
_HEAD = '<?xml version="1.0" encoding="UTF-8"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def column_name(c: int) -> str:
    """0 -> A, 25 -> Z, 26 -> AA."""
    out = ""
    c += 1
    while c:
        c, rest = divmod(c - 1, 26)
        out = chr(65 + rest) + out
    return out


class _Workbook:
    """A workbook under construction; sheets are added one after the other, cells in row order."""

    def __init__(self):
        self.bytes = io.BytesIO()
        self.zip = zipfile.ZipFile(self.bytes, "w", zipfile.ZIP_DEFLATED)
        self.strings: dict[str, int] = {}
        self.sheets: list[str] = []
        self.part, self.at = None, None

    def _end_sheet(self):
        if self.part:
            self.part.write(("</row>" if self.at else "").encode() + b"</sheetData></worksheet>")
            self.part.close()

    def sheet(self, name: str):
        self._end_sheet()
        self.sheets.append(name)
        self.part, self.at = self.zip.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w"), None
        self.part.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())

    def cell(self, r: int, c: int, v: str):
        row = r + 2  # r = -1 is the first row of the sheet
        if not (1 <= row <= MAX_ROWS and 0 <= c < MAX_COLUMNS):
            raise ValueError(f"sheet {self.sheets[-1]}: no cell at row {row}, column {c}")
        if self.at and self.at >= (row, c):
            raise ValueError(f"sheet {self.sheets[-1]}: row {row}, column {c} occurs twice")
        start = "" if self.at and self.at[0] == row else ("</row>" if self.at else "") + f'<row r="{row}">'
        self.at = (row, c)
        ref = f"{column_name(c)}{row}"
        if _DATE.fullmatch(v):
            text = f'<c r="{ref}" s="1"><v>{(_dt.date.fromisoformat(v) - _EPOCH).days}</v></c>'
        elif _NUMBER.fullmatch(v):
            text = f'<c r="{ref}"><v>{v}</v></c>'
        else:
            if _NO_XML.search(v):
                raise ValueError(f"sheet {self.sheets[-1]}, {ref}: a character that XML does not allow")
            text = f'<c r="{ref}" t="s"><v>{self.strings.setdefault(v, len(self.strings))}</v></c>'
        self.part.write((start + text).encode())

    def close(self) -> bytes:
        self._end_sheet()
        numbers = range(1, len(self.sheets) + 1)
        put = lambda name, body: self.zip.writestr(name, _HEAD + body)
        put("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>' + "".join(
            f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in zip(numbers, self.sheets)) + "</sheets></workbook>")
        put("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">' + "".join(
            f'<Relationship Id="rId{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
            + f'<Relationship Id="rIdS" Type="{_OFFICE}/sharedStrings" Target="sharedStrings.xml"/>'
            f'<Relationship Id="rIdT" Type="{_OFFICE}/styles" Target="styles.xml"/></Relationships>')
        put("xl/sharedStrings.xml", f'<sst xmlns="{_MAIN}">' + "".join(
            f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in self.strings) + "</sst>")
        put("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        put("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" '
            'Target="xl/workbook.xml"/></Relationships>')
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml."
        put("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kind}sheet.main+xml"/>' + "".join(
                f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}worksheet+xml"/>' for i in numbers)
            + f'<Override PartName="/xl/sharedStrings.xml" ContentType="{kind}sharedStrings+xml"/>'
            f'<Override PartName="/xl/styles.xml" ContentType="{kind}styles+xml"/></Types>')
        self.zip.close()
        return self.bytes.getvalue()


def _encode(batches):
    book, file, sheet = None, None, None

    def done():
        content = book.close()
        return pd.DataFrame([(file, len(content), content)], columns=["path", "length", "content"])

    for pdf in batches:
        for f, no, s, r, c, v in zip(*(pdf[x] for x in ("file", "sheet_no", "sheet", "r", "c", "v"))):
            if f != file:
                if book:
                    yield done()
                book, file, sheet = _Workbook(), f, None
            if (no, s) != sheet:
                book.sheet(s)
                sheet = (no, s)
            book.cell(int(r), int(c), v)
    if book:
        yield done()


def encode_workbooks(cells: DataFrame) -> DataFrame:
    """Cells (file, sheet, r, c, v and, where there is one, sheet_no) -> ``(path, length, content)``, a row a workbook.

    Sheets stand in the order of ``sheet_no``, else of their names.  NULL and empty values are empty cells."""
    df = cells.toDF(*[c.lower() for c in cells.columns])
    no = F.col("sheet_no").cast("int") if "sheet_no" in df.columns else F.lit(0)
    df = df.select(F.col("file").cast("string"), no.alias("sheet_no"), F.col("sheet").cast("string"), F.col("r").cast("int"),
                   F.col("c").cast("int"), F.col("v").cast("string")).where("v is not null and v <> ''")
    return df.repartition("file").sortWithinPartitions("file", "sheet_no", "sheet", "r", "c").mapInPandas(_encode, FILES_SCHEMA)
