"""Minimal .xlsx writer for test workbooks (shared strings, numbers, dates)."""

import datetime as dt
import zipfile
from xml.sax.saxutils import escape


def _col(c: int) -> str:
    s = ""
    c += 1
    while c:
        c, rem = divmod(c - 1, 26)
        s = chr(65 + rem) + s
    return s


def write_xlsx(path, sheets):
    """``sheets``: list of (name, {(row1, col0): value}) with 1-based rows."""
    strings, index = [], {}

    def sid(s):
        if s not in index:
            index[s] = len(strings)
            strings.append(s)
        return index[s]

    sheet_xml = []
    for _, cells in sheets:
        rows = {}
        for (r, c), v in cells.items():
            rows.setdefault(r, []).append((c, v))
        parts = []
        for r in sorted(rows):
            cs = []
            for c, v in sorted(rows[r]):
                ref = f"{_col(c)}{r}"
                if isinstance(v, dt.date):
                    serial = (dt.datetime(v.year, v.month, v.day) - dt.datetime(1899, 12, 30)).days
                    cs.append(f'<c r="{ref}" s="1"><v>{serial}</v></c>')
                elif isinstance(v, (int, float)):
                    cs.append(f'<c r="{ref}"><v>{v}</v></c>')
                else:
                    cs.append(f'<c r="{ref}" t="s"><v>{sid(str(v))}</v></c>')
            parts.append(f'<row r="{r}">{"".join(cs)}</row>')
        sheet_xml.append(
            '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/'
            f'spreadsheetml/2006/main"><sheetData>{"".join(parts)}</sheetData></worksheet>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    wb = (f'<?xml version="1.0" encoding="UTF-8"?><workbook {ns} {rns}><sheets>'
          + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, (n, _) in enumerate(sheets, 1))
          + "</sheets></workbook>")
    rels = ('<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/'
            'package/2006/relationships">'
            + "".join(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
                      f'relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
            + "</Relationships>")
    sst = (f'<?xml version="1.0" encoding="UTF-8"?><sst {ns}>'
           + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>")
    styles = (f'<?xml version="1.0" encoding="UTF-8"?><styleSheet {ns}><cellXfs count="2">'
              '<xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/sharedStrings.xml", sst)
        z.writestr("xl/styles.xml", styles)
        for i, x in enumerate(sheet_xml, 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", x)
