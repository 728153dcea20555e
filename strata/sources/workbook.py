"""Spreadsheet (.xlsx) landing files as a distributed scan.

There is no Excel data source on the classpath, so a directory of workbooks is
listed with the ``binaryFile`` source (one record per file, content as bytes) and
decoded by ``mapInPandas``: each task parses the workbooks of its split with the
standard library (zip + XML) and emits their rows as text, so parallelism is the
number of workbooks and nothing passes through the driver.

:func:`write_workbooks` is the matching sink (one workbook per partition), used to
land test inputs derived from tables.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# OOXML namespaces and part names.
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_CELL = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _col_letters(i: int) -> str:
    s, i = "", i + 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _text_of(si: ET.Element) -> str:
    return "".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t"))


def _number_text(v: str) -> str:
    try:
        f = float(v)
    except ValueError:
        return v
    return str(int(f)) if f.is_integer() and abs(f) < 1e15 else repr(f)


def iter_sheet(data: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Rows of one sheet (first sheet when ``sheet`` is None) as lists of text.

    The sheet XML is parsed step by step (``iterparse``) and elements are emptied after
    use; the emptied row elements stay attached, so memory still grows with the rows.
    """
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in rels.findall("rel:Relationship", _NS)}
        chosen = None
        for s in wb.find("m:sheets", _NS).findall("m:sheet", _NS):
            if sheet is None or s.get("name") == sheet:
                chosen = targets[s.get(f"{{{_NS['r']}}}id")]
                break
        if chosen is None:
            return
        part = chosen.lstrip("/") if chosen.startswith("/") else f"xl/{chosen}"
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text_of(si) for si in sst.findall("m:si", _NS)]
        row_tag, c_tag = f"{{{_NS['m']}}}row", f"{{{_NS['m']}}}c"
        with z.open(part) as fh:
            for _, row in ET.iterparse(fh, events=("end",)):
                if row.tag != row_tag:
                    continue
                cells: dict[int, str | None] = {}
                for c in row.iter(c_tag):
                    m = _CELL.match(c.get("r", ""))
                    idx = _col_index(m.group(1)) if m else len(cells)
                    kind, v = c.get("t"), c.find("m:v", _NS)
                    if kind == "s" and v is not None:
                        val = shared[int(v.text)]
                    elif kind == "inlineStr":
                        isel = c.find("m:is", _NS)
                        val = _text_of(isel) if isel is not None else None
                    elif kind == "b" and v is not None:
                        val = "TRUE" if v.text == "1" else "FALSE"
                    elif v is not None and v.text is not None:
                        val = v.text if kind in ("str", "e") else _number_text(v.text)
                    else:
                        val = None
                    cells[idx] = val
                row.clear()
                width = max(cells) + 1 if cells else 0
                yield [cells.get(i) for i in range(width)]


def read_sheet(data: bytes, sheet: str | None = None) -> list[list[str | None]]:
    return list(iter_sheet(data, sheet))


def _start(cell: str) -> tuple[int, int]:
    m = _CELL.match(cell.upper())
    if not m:
        raise ValueError(f"bad start cell {cell!r}")
    return int(m.group(2)) - 1, _col_index(m.group(1))


def scan_workbooks(spark: SparkSession, path: str, columns: Sequence[str],
                   sheet: str | None = None, header: bool = True,
                   start_cell: str = "A1", glob: str = "*.xlsx",
                   batch_rows: int = 10_000) -> DataFrame:
    """All workbooks under ``path`` -> one all-string DataFrame + ``_source_file``.

    The table starts at ``start_cell`` of ``sheet`` (``'employees'!A1`` is
    ``sheet="employees", start_cell="A1"``). With ``header=True`` its first row
    names the columns and cells are matched to ``columns`` by header name (missing
    ones are NULL), otherwise by position. Rows leave the task in Arrow batches of
    ``batch_rows``.
    """
    cols = list(columns)
    row0, col0 = _start(start_cell)
    out_schema = ", ".join(f"`{c}` string" for c in [*cols, "_source_file"])

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out_cols = [*cols, "_source_file"]
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                name = p.rsplit("/", 1)[-1]
                rows = iter_sheet(bytes(content), sheet)
                for _ in range(row0):
                    next(rows, None)
                take: list[int | None] = list(range(col0, col0 + len(cols)))
                if header:
                    head_row = next(rows, None)
                    if head_row is None:
                        continue
                    pos = {(h or "").strip(): i for i, h in enumerate(head_row) if i >= col0}
                    take = [pos.get(c) for c in cols]
                chunk: list[list[str | None]] = []
                for r in rows:
                    if not any(x not in (None, "") for x in r[col0:]):
                        continue
                    chunk.append([(r[i] if i is not None and i < len(r) else None)
                                  for i in take] + [name])
                    if len(chunk) >= batch_rows:
                        yield pd.DataFrame(chunk, columns=out_cols)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=out_cols)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path).select("path", "content"))
    return files.mapInPandas(decode, out_schema)


# ----------------------------------------------------------------------- writer

def _sheet_xml(header: list[str], rows: list[list[object]]) -> str:
    def cell(ref: str, v: object) -> str:
        if v is None or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    out = []
    for r, vals in enumerate([header, *rows], start=1):
        cs = "".join(cell(f"{_col_letters(i)}{r}", v) for i, v in enumerate(vals))
        out.append(f'<row r="{r}">{cs}</row>')
    return ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(out)}</sheetData></worksheet>')


def workbook_bytes(sheet: str, header: list[str], rows: list[list[object]]) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                   '</Types>')
        z.writestr("_rels/.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_NS["rel"]}">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
                   '</Relationships>')
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}">'
                   f'<sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_NS["rel"]}">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
                   '</Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", _sheet_xml(header, rows))
    return buf.getvalue()


def write_workbooks(df: DataFrame, path: str, sheet: str) -> int:
    """Land ``df`` as workbooks, one per non-empty partition, under ``path``.

    Each task writes its own file through ``pyarrow.fs`` (local, HDFS or object
    store URIs), so the data never passes through the driver. Returns the number
    of files written.
    """
    cols = df.columns
    token = uuid.uuid4().hex[:8]

    def land(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs
        from pyspark import TaskContext
        frames = list(batches)
        if not frames or sum(len(f) for f in frames) == 0:
            return
        pdf = pd.concat(frames, ignore_index=True)
        rows = [[None if (isinstance(v, float) and v != v) else
                 (v.item() if hasattr(v, "item") else v) for v in r]
                for r in pdf.itertuples(index=False, name=None)]
        pid = TaskContext.get().partitionId()
        target = f"{path.rstrip('/')}/part-{pid:05d}-{token}.xlsx"
        if target.startswith("file:"):
            fsys, p = pafs.LocalFileSystem(), "/" + target[5:].lstrip("/")
        elif "://" in target:
            fsys, p = pafs.FileSystem.from_uri(target)
        else:
            fsys, p = pafs.LocalFileSystem(), target
        fsys.create_dir(p.rsplit("/", 1)[0], recursive=True)
        with fsys.open_output_stream(p) as out:
            out.write(workbook_bytes(sheet, cols, rows))
        yield pd.DataFrame({"file": [target]})

    written = df.mapInPandas(land, "file string").agg(F.count("*").alias("n")).first()
    return int(written["n"])
