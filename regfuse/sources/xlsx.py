"""Decode one ``.xlsx`` / ``.xlsm`` workbook (bytes) into typed cell rows.

A per-file helper that runs inside a Spark task (see ``workbook.py``): stdlib
``zipfile`` plus streaming XML, no third-party package.  It yields one tuple
per non-empty sheet row: ``(sheet_name, sheet_idx, row_idx, {col_idx: cell}, date1904)``
with ``cell = (cell_type, text, num, ts)``.

* shared strings and inline strings -> ``text``
* numbers -> ``number``; numbers whose cell style is a date format -> ``date``
  (serial converted with the workbook's epoch: 1900 or 1904 system)
* booleans -> ``bool`` (text ``TRUE`` / ``FALSE``), error values -> ``error``
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
import xml.etree.ElementTree as ET

NS_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
NS_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
NS_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"

# --- fixed values: built-in number formats that display dates or times ---
BUILTIN_DATE_FORMATS = set(range(14, 23)) | set(range(27, 37)) | set(range(45, 48)) | set(range(50, 59))

EPOCH_1900 = dt.datetime(1899, 12, 30)
EPOCH_1904 = dt.datetime(1904, 1, 1)

_CELL_REF = re.compile(r"([A-Z]+)([0-9]+)")
_QUOTED = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.')


class WorkbookError(Exception):
    pass


def col_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n


def _is_date_format(code: str) -> bool:
    stripped = _QUOTED.sub("", code).lower()
    return any(ch in stripped for ch in "dmyhs") and "general" not in stripped


def _read_xml(z: zipfile.ZipFile, name: str):
    try:
        with z.open(name) as f:
            return ET.parse(f).getroot()
    except KeyError:
        return None


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    out: list[str] = []
    try:
        f = z.open("xl/sharedStrings.xml")
    except KeyError:
        return out
    with f:
        for _, el in ET.iterparse(f, events=("end",)):
            if el.tag == NS_MAIN + "si":
                out.append("".join(t.text or "" for t in el.iter(NS_MAIN + "t")))
                el.clear()
    return out


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    root = _read_xml(z, "xl/styles.xml")
    if root is None:
        return set()
    custom = {}
    fmts = root.find(NS_MAIN + "numFmts")
    if fmts is not None:
        for nf in fmts.findall(NS_MAIN + "numFmt"):
            custom[int(nf.get("numFmtId"))] = nf.get("formatCode") or ""
    out = set()
    xfs = root.find(NS_MAIN + "cellXfs")
    if xfs is not None:
        for i, xf in enumerate(xfs.findall(NS_MAIN + "xf")):
            fid = int(xf.get("numFmtId", "0"))
            if fid in BUILTIN_DATE_FORMATS or (fid in custom and _is_date_format(custom[fid])):
                out.add(i)
    return out


def _sheets(z: zipfile.ZipFile):
    """[(name, part path)] in workbook order, and the 1904 flag."""
    wb = _read_xml(z, "xl/workbook.xml")
    if wb is None:
        raise WorkbookError("not a spreadsheet package (no xl/workbook.xml)")
    pr = wb.find(NS_MAIN + "workbookPr")
    date1904 = pr is not None and (pr.get("date1904") or "").lower() in ("1", "true")
    rels = {}
    rr = _read_xml(z, "xl/_rels/workbook.xml.rels")
    if rr is not None:
        for r in rr.findall(NS_PKG_REL + "Relationship"):
            target = r.get("Target") or ""
            target = target.lstrip("/")
            if not target.startswith("xl/"):
                target = "xl/" + target
            rels[r.get("Id")] = target
    out = []
    sheets = wb.find(NS_MAIN + "sheets")
    for i, s in enumerate(sheets.findall(NS_MAIN + "sheet") if sheets is not None else [], start=1):
        rid = s.get(NS_REL + "id")
        out.append((s.get("name"), rels.get(rid, f"xl/worksheets/sheet{i}.xml")))
    return out, date1904


def decode_workbook(data: bytes):
    """Yield ``(sheet_name, sheet_idx, row_idx, cells, date1904)`` for every non-empty row."""
    try:
        z = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        raise WorkbookError(f"not a zip package: {e}") from None
    with z:
        sheets, date1904 = _sheets(z)
        strings = _shared_strings(z)
        date_styles = _date_styles(z)
        epoch = EPOCH_1904 if date1904 else EPOCH_1900
        for sheet_idx, (name, part) in enumerate(sheets, start=1):
            try:
                f = z.open(part)
            except KeyError:
                continue
            with f:
                for row in _decode_sheet(f, name, sheet_idx, strings, date_styles, epoch):
                    yield (*row, date1904)


def _decode_sheet(f, name, sheet_idx, strings, date_styles, epoch):
    row_tag, cell_tag = NS_MAIN + "row", NS_MAIN + "c"
    next_row = 1
    for _, el in ET.iterparse(f, events=("end",)):
        if el.tag != row_tag:
            continue
        r = el.get("r")
        row_idx = int(r) if r else next_row
        next_row = row_idx + 1
        cells = {}
        next_col = 1
        for c in el.iter(cell_tag):
            ref = c.get("r")
            if ref:
                m = _CELL_REF.match(ref)
                col = col_number(m.group(1)) if m else next_col
            else:
                col = next_col
            next_col = col + 1
            cell = _decode_cell(c, strings, date_styles, epoch)
            if cell is not None:
                cells[col] = cell
        el.clear()
        if cells:
            yield name, sheet_idx, row_idx, cells


def _decode_cell(c, strings, date_styles, epoch):
    t = c.get("t", "n")
    v = c.find(NS_MAIN + "v")
    val = v.text if v is not None else None
    if t == "inlineStr":
        is_ = c.find(NS_MAIN + "is")
        txt = "".join(x.text or "" for x in is_.iter(NS_MAIN + "t")) if is_ is not None else ""
        return ("text", txt, None, None) if txt != "" else None
    if val is None or val == "":
        return None
    if t == "s":
        txt = strings[int(val)]
        return ("text", txt, None, None) if txt != "" else None
    if t == "str":
        return ("text", val, None, None)
    if t == "b":
        return ("bool", "TRUE" if val.strip() in ("1", "true") else "FALSE", None, None)
    if t == "e":
        return ("error", val, None, None)
    try:
        num = float(val)
    except ValueError:
        return ("text", val, None, None)
    s = c.get("s")
    if s is not None and int(s) in date_styles:
        try:
            return ("date", None, None, epoch + dt.timedelta(days=num))
        except OverflowError:
            return ("number", None, num, None)
    return ("number", None, num, None)
