"""Write small workbooks, so that there is something to decode."""

from __future__ import annotations

import io
import zipfile
from datetime import date, datetime
from xml.sax.saxutils import escape

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_STYLES = (
    f'<styleSheet xmlns="{_MAIN}"><numFmts count="1"><numFmt numFmtId="164" formatCode="dd/mm/yyyy\\ hh:mm"/></numFmts>'
    '<cellXfs count="4"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="2"/></cellXfs></styleSheet>'
)


def _letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _cell(ref: str, value, strings: dict[str, int]) -> str:
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, datetime):
        days = (value - datetime(1899, 12, 30)).total_seconds() / 86400
        return f'<c r="{ref}" s="{1 if days.is_integer() else 2}"><v>{days!r}</v></c>'
    if isinstance(value, date):
        return f'<c r="{ref}" s="1"><v>{(value - date(1899, 12, 30)).days}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    if value.startswith("#"):
        return f'<c r="{ref}" t="e"><v>{value}</v></c>'
    if value.startswith("inline:"):
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value[7:])}</t></is></c>'
    return f'<c r="{ref}" t="s"><v>{strings.setdefault(value, len(strings))}</v></c>'


def workbook(sheets: dict[str, list[list]]) -> bytes:
    """Bytes of a workbook; None leaves a gap, ``#..`` is an error, ``inline:..`` an inline string."""
    strings: dict[str, int] = {}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(
                f'<row r="{r + 1}">'
                + "".join(_cell(f"{_letters(k)}{r + 1}", v, strings) for k, v in enumerate(row) if v is not None)
                + "</row>"
                for r, row in enumerate(rows)
                if row
            )
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>')
        names = "".join(
            f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1)
        )
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{names}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_MAIN}">{items}</sst>')
        z.writestr("xl/styles.xml", _STYLES)
    return out.getvalue()
