"""Spreadsheet workbooks (.xlsx) -> long cells, one workbook per task.

``spark.read.format("binaryFile")`` lists and reads the files; ``mapInPandas``
decodes each workbook (a zip of XML parts, standard library only) into rows
``(file, sheet, sheet_no, r, c, v)``: ``r = -1`` is the first sheet row
(the header), ``c = 0`` is column A, empty cells are not emitted.  A workbook
is the unit of work; cells leave the task as Arrow batches.
"""

from __future__ import annotations

import datetime as _dt
import io
import posixpath
import re
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

CELL_SCHEMA = "file string, sheet string, sheet_no int, r int, c int, v string"

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
# FIXED VALUES: built-in number formats that display dates (ECMA-376 18.8.30).
_DATE_FORMAT_IDS = set(range(14, 23)) | {45, 46, 47}
_REF = re.compile(r"([A-Z]+)([0-9]+)")
_EPOCH = _dt.datetime(1899, 12, 30)


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    """Text of a string item: its own ``<t>`` or its rich-text runs' ``<t>``;
    phonetic hints (``<rPh>``) are not part of the value."""
    m = _NS["m"]
    out = [t.text or "" for t in el.findall(f"{{{m}}}t")]
    for run in el.findall(f"{{{m}}}r"):
        out += [t.text or "" for t in run.findall(f"{{{m}}}t")]
    return "".join(out)


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles whose number format shows a date."""
    try:
        root = ET.fromstring(z.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {}
    for nf in root.iterfind("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
        custom[int(nf.get("numFmtId"))] = any(ch in code for ch in "dy") or ("m" in code and "h" not in code)
    out = set()
    for i, xf in enumerate(root.iterfind("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_FORMAT_IDS or custom.get(fid, False):
            out.add(i)
    return out


def _number_text(s: str, is_date: bool) -> str:
    x = float(s)
    if is_date:
        d = _EPOCH + _dt.timedelta(days=x)
        return d.strftime("%Y-%m-%d") if d.time() == _dt.time(0) else d.strftime("%Y-%m-%d %H:%M:%S")
    return repr(int(x)) if x.is_integer() and abs(x) < 1e15 else repr(x)


def decode_workbook(name: str, content: bytes):
    """Yield ``(sheet, sheet_no, r, c, v)`` for every non-empty cell."""
    z = zipfile.ZipFile(io.BytesIO(content))
    try:
        shared = [_text(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)]
    except KeyError:
        shared = []
    dates = _date_styles(z)
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.iterfind("pr:Relationship", _NS)}
    for no, sh in enumerate(wb.iterfind("m:sheets/m:sheet", _NS), start=1):
        t = target[sh.get(f"{{{_NS['r']}}}id")]
        part = t.lstrip("/") if t.startswith("/") else posixpath.normpath(posixpath.join("xl", t))
        # streamed: each row element is released once its cells are read
        c_tag, row_tag = f"{{{_NS['m']}}}c", f"{{{_NS['m']}}}row"
        with z.open(part) as fh:
            for _, el in ET.iterparse(fh, events=("end",)):
                if el.tag == row_tag:
                    el.clear()
                    continue
                if el.tag != c_tag:
                    continue
                out = _cell_value(el, shared, dates)
                if out is not None:
                    yield sh.get("name"), no, out[0], out[1], out[2]


def _cell_value(cell, shared, dates):
    """``(r, c, text)`` of one ``<c>`` element, or None when empty."""
    m = _REF.match(cell.get("r", ""))
    if not m:
        return None
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        is_ = cell.find("m:is", _NS)
        v = _text(is_) if is_ is not None else None
    else:
        ve = cell.find("m:v", _NS)
        if ve is None or ve.text is None:
            return None
        if kind == "s":
            v = shared[int(ve.text)]
        elif kind == "b":
            v = "True" if ve.text == "1" else "False"
        elif kind in ("str", "e"):
            v = ve.text
        elif kind == "d":  # ISO 8601 date cell
            v = ve.text[:10] if ve.text.endswith("T00:00:00") or len(ve.text) == 10 else ve.text.replace("T", " ")
        else:
            v = _number_text(ve.text, int(cell.get("s", "0")) in dates)
    if v is None or v == "":
        return None
    return int(m.group(2)) - 2, _col_index(m.group(1)), v


# decoded cells leave the task in chunks of this many rows, so memory per
# task stays bounded however large a workbook is
CHUNK_ROWS = 200_000


def _suffixed(cells):
    """Header cells (row -1) with a text that stood further left get ``.1``, ``.2``, ...
    as the reports' own reader names repeated columns: only the first counts as a month."""
    seen: dict = {}
    for sheet, no, r, c, v in cells:
        if r == -1:
            n = seen[no, v] = seen.get((no, v), -1) + 1
            v = f"{v}.{n}" if n else v
        yield sheet, no, r, c, v


CHECKED_SCHEMA = CELL_SCHEMA + ", error string"


def _frame(rows):
    return pd.DataFrame(rows, columns=["file", "sheet", "sheet_no", "r", "c", "v"]).astype(
        {"sheet_no": "Int32", "r": "Int32", "c": "Int32"})


def _decode_batches(batches):
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"]):
            name = path.rsplit("/", 1)[-1]
            for sheet, no, r, c, v in _suffixed(decode_workbook(name, bytes(content))):
                rows.append((path, sheet, no, r, c, v))
                if len(rows) >= CHUNK_ROWS:
                    yield _frame(rows)
                    rows = []
        if rows:
            yield _frame(rows)


def decode_files(files: DataFrame) -> DataFrame:
    """``binaryFile`` rows (path, content) -> cells; a file that is no workbook ends the job."""
    return files.select("path", "content").mapInPandas(_decode_batches, CELL_SCHEMA)


def _check_workbook(content: bytes) -> str | None:
    """Why the content is no workbook that can be read to its end, or None."""
    try:
        for _ in decode_workbook("", content):
            pass
    except Exception as e:  # whatever a damaged file makes the zip or XML reader raise
        return f"{type(e).__name__}: {e}"[:500]
    return None


def _decode_checked_batches(batches):
    for pdf in batches:
        bad = [_check_workbook(bytes(c)) for c in pdf["content"]]
        for frame in _decode_batches([pdf[[b is None for b in bad]]]):
            yield frame.assign(error=None)
        errors = [(p, b) for p, b in zip(pdf["path"], bad) if b is not None]
        if errors:
            yield _frame([(p, None, None, None, None, None) for p, _ in errors]).assign(error=[b for _, b in errors])


def decode_checked(files: DataFrame) -> DataFrame:
    """Cells as :func:`decode_files` gives them, with a column ``error``: a file that cannot be read to its end gives one
    row with the reason, and no cell.  A file is read through before its first cell is passed on, so half a damaged
    workbook never counts and no task holds a whole sheet's cells."""
    return files.select("path", "content").mapInPandas(_decode_checked_batches, CHECKED_SCHEMA)


def workbook_cells(spark: SparkSession, root: str, glob: str = "*.xlsx", recursive: bool = True) -> DataFrame:
    """All workbooks under ``root`` matching ``glob`` as long cells.

    Each file is one row of the binary source; Spark spreads files over
    tasks, so the number of workbooks, not their total size, sets the
    parallelism."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return decode_files(files)


def new_workbook_cells(spark: SparkSession, root: str, manifest: DataFrame, glob: str = "*.xlsx") -> DataFrame:
    """Cells of the workbooks under ``root`` that are not in ``manifest``
    (one column ``name``: file names already loaded).

    Files are listed first (metadata only), the manifest is applied as a
    left-anti join, and only the remaining files are decoded.  Nothing is listed
    on the driver: the rest of the scan's rows meet their decoder where they are."""
    from tresoria.sources.tables import discover_files, new_files
    todo = new_files(discover_files(spark, root, glob), manifest).select("path")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(root))
    return decode_files(files.join(todo, on="path", how="left_semi"))
