"""Minimal .xlsx writer for tests (stdlib only): strings, numbers, dates, booleans."""

from __future__ import annotations

import datetime as dt
import zipfile
from xml.sax.saxutils import escape

_EPOCH = dt.datetime(1899, 12, 30)


def _col(n: int) -> str:
    s = ""
    while n:
        n, r = divmod(n - 1, 26)
        s = chr(65 + r) + s
    return s


class Raw:
    """A cell given by its type letter and raw value."""

    def __init__(self, kind: str, value: str):
        self.kind, self.value = kind, value


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, Raw):
        return f'<c r="{ref}" t="{v.kind}"><v>{v.value}</v></c>'
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    if isinstance(v, dt.datetime):
        return f'<c r="{ref}" s="1"><v>{(v - _EPOCH).total_seconds() / 86400!r}</v></c>'
    if isinstance(v, dt.date):
        return f'<c r="{ref}" s="1"><v>{(dt.datetime(v.year, v.month, v.day) - _EPOCH).days}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'


def write_xlsx(path: str, sheets: dict[str, dict[int, list]], date1904: bool = False, cut: float = 1.0) -> None:
    """``sheets``: name -> {row number: [cell values from column A]}; ``cut``:
    the share of the last sheet's XML that is written."""
    names = list(sheets)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                      for i in range(1, len(names) + 1))
            + '</Types>'))
        z.writestr("_rels/.rels", (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
            '</Relationships>'))
        z.writestr("xl/workbook.xml", (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
            'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
            + ('<workbookPr date1904="1"/>' if date1904 else "") + '<sheets>'
            + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
            + '</sheets></workbook>'))
        z.writestr("xl/_rels/workbook.xml.rels", (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            + "".join(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>'
                      for i in range(1, len(names) + 1))
            + f'<Relationship Id="rId{len(names) + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/>'
            '</Relationships>'))
        z.writestr("xl/styles.xml", (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
            '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs>'
            '</styleSheet>'))
        for i, n in enumerate(names, 1):
            rows = []
            for r, values in sorted(sheets[n].items()):
                cells = "".join(_cell(f"{_col(c)}{r}", v) for c, v in enumerate(values, 1))
                rows.append(f'<row r="{r}">{cells}</row>')
            xml = (
                '<?xml version="1.0" encoding="UTF-8"?>'
                '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
                + "".join(rows) + '</sheetData></worksheet>')
            z.writestr(f"xl/worksheets/sheet{i}.xml", xml[: int(len(xml) * cut)] if i == len(names) else xml)
