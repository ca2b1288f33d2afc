"""Minimal ``.xlsx`` writer for tests (standard library only).

``write_workbook(path, sheets)`` with ``sheets = [(title, {(row, col): value})]``,
rows 1-based, columns 0-based. Values: ``str`` -> shared string (or inline
string when wrapped in ``Inline``), ``int``/``float`` -> number,
``datetime`` -> date-styled serial number, ``Error`` -> error cell,
``bool`` -> boolean.
"""

from __future__ import annotations

import datetime as dt
import zipfile
from xml.sax.saxutils import escape


class Inline(str):
    pass


class Error(str):
    pass


def _ref(row: int, col: int) -> str:
    s, c = "", col + 1
    while c:
        c, r = divmod(c - 1, 26)
        s = chr(65 + r) + s
    return f"{s}{row}"


def _serial(t: dt.datetime) -> float:
    d = t - dt.datetime(1899, 12, 30)
    return d.days + d.seconds / 86400


def write_workbook(path: str, sheets, date1904: bool = False) -> None:
    shared: list[str] = []
    index: dict[str, int] = {}

    def sst(s: str) -> int:
        if s not in index:
            index[s] = len(shared)
            shared.append(s)
        return index[s]

    parts = {}
    for i, (title, cells) in enumerate(sheets, start=1):
        rows: dict[int, list] = {}
        for (r, c), v in sorted(cells.items()):
            rows.setdefault(r, []).append((c, v))
        xml = []
        for r in sorted(rows):
            cs = []
            for c, v in rows[r]:
                ref = _ref(r, c)
                if isinstance(v, Error):
                    cs.append(f'<c r="{ref}" t="e"><v>{escape(v)}</v></c>')
                elif isinstance(v, Inline):
                    cs.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>')
                elif isinstance(v, str):
                    cs.append(f'<c r="{ref}" t="s"><v>{sst(v)}</v></c>')
                elif isinstance(v, bool):
                    cs.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, dt.datetime):
                    cs.append(f'<c r="{ref}" s="1"><v>{_serial(v)!r}</v></c>')
                else:
                    cs.append(f'<c r="{ref}"><v>{v!r}</v></c>')
            xml.append(f'<row r="{r}">{"".join(cs)}</row>')
        parts[f"xl/worksheets/sheet{i}.xml"] = (
            '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
            f'<sheetData>{"".join(xml)}</sheetData></worksheet>')
    sheets_xml = "".join(
        f'<sheet name="{escape(t)}" sheetId="{i}" r:id="rId{i}"/>'
        for i, (t, _) in enumerate(sheets, start=1))
    wbpr = '<workbookPr date1904="1"/>' if date1904 else ""
    parts["xl/workbook.xml"] = (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
        'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
        f'{wbpr}<sheets>{sheets_xml}</sheets></workbook>')
    rels = "".join(
        f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
        f'relationships/worksheet" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(sheets) + 1))
    parts["xl/_rels/workbook.xml.rels"] = (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'{rels}</Relationships>')
    parts["xl/sharedStrings.xml"] = (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        + "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in shared) + '</sst>')
    parts["xl/styles.xml"] = (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        '<numFmts count="1"><numFmt numFmtId="164" formatCode="dd.mm.yyyy hh:mm"/></numFmts>'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>')
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(name, body)
