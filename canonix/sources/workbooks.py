"""Workbook (``.xlsx``) scan as a Spark job.

Spark has no Excel source, so a folder of workbooks is listed with
``binaryFile`` and each workbook is decoded in ``mapInPandas`` with the
standard library (``zipfile`` + ``xml.etree``): the first sheet, one output row
per sheet row ``(dataset, row_no, cells array<string>)``. A sheet is bounded
(an xlsx sheet holds at most 1,048,576 rows), so one workbook per task is a
bounded unit of work; many workbooks spread over many tasks.

The typed table takes the first row as the header and types every column from
its cells with one aggregate pass (all integral -> bigint, all numeric ->
double, else string).
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.model import quote

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG_REL_NS = "http://schemas.openxmlformats.org/package/2006/relationships"
_CELL_REF = re.compile(r"^([A-Z]+)([0-9]+)$")

ROWS_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("row_no", T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _first_sheet_path(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find("m:sheets/m:sheet", _NS)
    rid = sheet.get(f"{{{_REL_NS}}}id") if sheet is not None else None
    if rid and "xl/_rels/workbook.xml.rels" in z.namelist():
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        for rel in rels.findall(f"{{{_PKG_REL_NS}}}Relationship"):
            if rel.get("Id") == rid:
                target = rel.get("Target")
                return target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)
    return "xl/worksheets/sheet1.xml"


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t"))


def decode_workbook(content: bytes) -> list[list[str | None]]:
    """Rows of the first sheet as lists of cell text (gaps are ``None``)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in sst.findall("m:si", _NS)]
        sheet = ET.fromstring(z.read(_first_sheet_path(z)))
    rows: list[list[str | None]] = []
    for r in sheet.iterfind("m:sheetData/m:row", _NS):
        cells: dict[int, str | None] = {}
        nxt = 0
        for c in r.findall("m:c", _NS):
            ref = c.get("r")
            m = _CELL_REF.match(ref) if ref else None
            idx = _col_index(m.group(1)) if m else nxt
            nxt = idx + 1
            t = c.get("t", "n")
            v = c.find("m:v", _NS)
            if t == "s" and v is not None:
                val = shared[int(v.text)]
            elif t == "inlineStr":
                is_ = c.find("m:is", _NS)
                val = _text(is_) if is_ is not None else None
            elif t == "b" and v is not None:
                val = "True" if v.text == "1" else "False"
            else:
                val = v.text if v is not None else None
            cells[idx] = val
        width = max(cells) + 1 if cells else 0
        rows.append([cells.get(i) for i in range(width)])
    return rows


def _decode_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for name, content in zip(pdf["dataset"], pdf["content"]):
            rows = decode_workbook(bytes(content))
            yield pd.DataFrame({"dataset": [name] * len(rows), "row_no": list(range(len(rows))), "cells": rows})


def decode_workbooks(binary: DataFrame) -> DataFrame:
    """``(dataset, content binary)`` rows -> ``(dataset, row_no, cells)`` sheet rows."""
    return binary.select("dataset", "content").mapInPandas(_decode_batches, ROWS_SCHEMA)


def read_workbook_rows(spark: SparkSession, path: str) -> DataFrame:
    """Sheet rows of every ``.xlsx`` under ``path`` (a file or a folder, any depth)."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xlsx")
        .load(path)
    )
    binary = files.select(F.element_at(F.split("path", "/"), -1).alias("dataset"), "content")
    return decode_workbooks(binary)


def typed_table(rows: DataFrame, header: Sequence[str]) -> DataFrame:
    """Rows after the header as columns, typed by one aggregate pass over the cells."""
    body = rows.where(F.col("row_no") > 0)
    text = body.select("row_no", *[F.get(F.col("cells"), i).alias(h) for i, h in enumerate(header)])
    checks = []
    for j, h in enumerate(header):
        c = F.col(quote(h))
        checks.append(F.count_if(c.isNotNull() & c.try_cast("bigint").isNull()).alias(f"i{j}"))
        checks.append(F.count_if(c.isNotNull() & c.try_cast("double").isNull()).alias(f"d{j}"))
        checks.append(F.count_if(c.isNotNull()).alias(f"n{j}"))
    stats = text.agg(*checks).collect()[0].asDict()  # one row of 3 counts per column
    exprs = []
    for j, h in enumerate(header):
        c = F.col(quote(h))
        if stats[f"n{j}"] and stats[f"i{j}"] == 0:
            exprs.append(c.try_cast("bigint").alias(h))
        elif stats[f"n{j}"] and stats[f"d{j}"] == 0:
            exprs.append(c.try_cast("double").alias(h))
        else:
            exprs.append(c.alias(h))
    return text.select("row_no", *exprs)


def read_workbook_table(spark: SparkSession, path: str) -> DataFrame:
    """One workbook as a typed table (first row is the header; rows kept in sheet order)."""
    rows = read_workbook_rows(spark, path)
    head = rows.where(F.col("row_no") == 0).select("cells").limit(1).collect()
    header = [str(h).strip() if h is not None else f"column_{i}" for i, h in enumerate(head[0][0])] if head else []
    return typed_table(rows, header).orderBy("row_no").drop("row_no")


# ---------------------------------------------------------------------------
# Minimal workbook writer (test fixtures and round trips)
# ---------------------------------------------------------------------------

def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _esc(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def encode_workbook(header: Sequence[str], rows: Sequence[Sequence[object]]) -> bytes:
    """A one-sheet ``.xlsx`` with inline strings and numeric cells."""
    def cell(ci: int, ri: int, v: object) -> str:
        ref = f"{_col_letters(ci)}{ri}"
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v!r}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{_esc(str(v))}</t></is></c>'

    body = []
    for ri, r in enumerate([list(header)] + [list(x) for x in rows], start=1):
        body.append(f'<row r="{ri}">' + "".join(cell(ci, ri, v) for ci, v in enumerate(r)) + "</row>")
    sheet = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             f'<worksheet xmlns="{_NS["m"]}"><sheetData>' + "".join(body) + "</sheetData></worksheet>")
    files = {
        "[Content_Types].xml": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" '
            'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" '
            'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            "</Types>"),
        "_rels/.rels": (
            f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_PKG_REL_NS}">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            'officeDocument" Target="xl/workbook.xml"/></Relationships>'),
        "xl/workbook.xml": (
            f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_NS["m"]}" xmlns:r="{_REL_NS}">'
            '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'),
        "xl/_rels/workbook.xml.rels": (
            f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_PKG_REL_NS}">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            'worksheet" Target="worksheets/sheet1.xml"/></Relationships>'),
        "xl/worksheets/sheet1.xml": sheet,
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in files.items():
            z.writestr(name, text)
    return buf.getvalue()


def encode_partitions(df: DataFrame, name_prefix: str) -> DataFrame:
    """Each partition of ``df`` as one workbook: ``(dataset, content)`` (round-trip fixtures)."""
    header = df.columns

    def enc(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True)
        rows = [[None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r]
                for r in pdf.itertuples(index=False)]
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        yield pd.DataFrame({"dataset": [f"{name_prefix}-{part:05d}.xlsx"], "content": [encode_workbook(header, rows)]})

    return df.mapInPandas(enc, "dataset string, content binary")
