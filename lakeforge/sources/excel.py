"""Excel workbooks as frames: files are opened by tasks, a sheet's rows come as cells, a header names them."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
_CELLS = "path string, row int, cells array<string>"


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iterfind(".//m:t", _NS))


def sheet_rows(data: bytes, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
    """A sheet's rows by their numbers, as texts; none if the workbook hasn't the sheet."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        key = next((s.get(f"{{{_NS['r']}}}id") for s in book.iterfind("m:sheets/m:sheet", _NS) if s.get("name") == sheet), None)
        if key is None:
            return
        links = ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        target = next(x.get("Target") for x in links if x.get("Id") == key)
        shared = [_text(s) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)] if "xl/sharedStrings.xml" in z.namelist() else []
        with z.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{{{_NS['m']}}}row":
                    continue
                cells: list[str | None] = []
                for c in row.iterfind("m:c", _NS):
                    at, kind = _column(c.get("r")) if c.get("r") else len(cells), c.get("t")
                    value = c.find("m:v", _NS)
                    text = _text(c) if kind == "inlineStr" else None if value is None else shared[int(value.text)] if kind == "s" else {"1": "true", "0": "false"}.get(value.text) if kind == "b" else value.text
                    cells += [None] * (at + 1 - len(cells))
                    cells[at] = text
                yield int(row.get("r")), cells
                row.clear()


def read_cells(spark: SparkSession, path: str | list[str], sheet: str) -> DataFrame:
    """``path, row, cells``: rows of a sheet of all workbooks of a path; a workbook is one task's work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = list(sheet_rows(data.as_py(), sheet))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array([r for r, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.list_(pa.string()))], names=["path", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _CELLS)


def read_sheet(spark: SparkSession, path: str | list[str], sheet: str, skip_rows: int = 0, columns: list[str] | None = None, where: str | None = None, pivot: dict | None = None) -> DataFrame:
    """A sheet whose header stands after ``skip_rows``: all columns are texts without outer blanks and non-breaking spaces, rows without any value are left out.

    The header is the first workbook's by path; others must have the same. ``columns`` are names or expressions. ``pivot``: index, column and value (summed as numbers).
    """
    cells = read_cells(spark, path, sheet)
    head = cells.where(F.col("row") == skip_rows + 1).orderBy("path").select("cells").first()
    if head is None:
        raise ValueError(f"sheet {sheet!r} has no row {skip_rows + 1}")
    names = [(c or "").replace("\u00a0", " ").strip() for c in head[0]]
    if repeated := {n for n in names if n and names.count(n) > 1}:
        raise ValueError(f"sheet {sheet!r} has columns twice: {sorted(repeated)}")
    other = F.when(F.col("row") == skip_rows + 1, F.when(~F.col("cells").eqNullSafe(F.array(*[F.lit(c).cast("string") for c in head[0]])), F.raise_error(F.concat(F.lit("another header: "), "path")).cast("boolean")))
    body = cells.where(F.coalesce(other, F.col("row") > skip_rows + 1))
    clean = [F.nullif(F.trim(F.replace(F.get("cells", i), F.lit("\u00a0"), F.lit(" "))), F.lit("")).alias(n) for i, n in enumerate(names) if n]
    out = body.where(F.exists("cells", lambda c: c.isNotNull() & (F.trim(c) != ""))).select(*clean)
    out = out.select(*[F.col(f"`{c}`") if c in names else F.expr(c) for c in columns]) if columns else out
    out = out.where(where) if where else out
    if pivot:
        out = out.groupBy(*pivot["index"]).pivot(pivot["column"], pivot.get("values")).agg(F.sum(F.col(pivot["value"]).try_cast("double")))
    return out


def read_book(spark: SparkSession, path: str, sheets: list[dict]) -> dict[str, DataFrame]:
    """Sheets as a configuration lists them: SheetName, and if given SkipRows, Columns, Filter and Pivot."""
    return {s["SheetName"]: read_sheet(spark, path, s["SheetName"], int(s.get("SkipRows", 0)), s.get("Columns"), s.get("Filter"), s.get("Pivot")) for s in sheets}
