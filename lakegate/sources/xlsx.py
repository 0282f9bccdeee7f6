"""Workbooks: a directory of them is one job, a workbook is one row of it.

Cells are read inside the tasks with the standard library, once, into a table of (path, row, header -> typed text). The
columns of all workbooks are agreed on by one aggregation over headers and cell kinds.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice
from typing import BinaryIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.errors import DecodeError
from lakegate.functions.base import quoted
from lakegate.session import materialised
from lakegate.sources.files import list_files, opened

# Fixed values.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_EPOCH = datetime(1899, 12, 30)

CELLS = (
    "path string, row_no bigint, headers array<string>, cells map<string,struct<kind:string,value:string>>, error string"
)


def unique_headers(headers: list[object]) -> list[str]:
    """Names for the columns of a sheet: a blank header is ``""``; a repeated one gets the first free ``_2``, ``_3``, ...

    A number is free if no header of the sheet spells that name itself, so every column keeps a name of its own.
    """
    names = ["" if h is None else str(h) for h in headers]
    taken, out = set(names), []
    for place, name in enumerate(names):
        if name in names[:place]:
            number = 2
            while f"{name}_{number}" in taken:
                number += 1
            name = f"{name}_{number}"
            taken.add(name)
        out.append(name)
    return out


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]*", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _part(book: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    styles = _part(book, "xl/styles.xml")
    if styles is None:
        return set()
    custom = {
        int(f.get("numFmtId", "0"))
        for f in styles.iter(f"{_MAIN}numFmt")
        if re.search("[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "").lower()))
    }
    formats = styles.find(f"{_MAIN}cellXfs")
    dates = _DATE_FORMATS | custom
    return {i for i, xf in enumerate(formats if formats is not None else ()) if int(xf.get("numFmtId", "0")) in dates}


def _active_sheet(book: zipfile.ZipFile) -> str:
    workbook = _part(book, "xl/workbook.xml")
    links = _part(book, "xl/_rels/workbook.xml.rels")
    if workbook is None or links is None:
        raise ValueError("not a workbook")
    sheets = list(workbook.iter(f"{_MAIN}sheet"))
    view = workbook.find(f".//{_MAIN}workbookView")
    active = int(view.get("activeTab", "0")) if view is not None else 0
    wanted = sheets[min(active, len(sheets) - 1)].get(f"{_REL}id")
    target = next(r.get("Target", "") for r in links.iter(f"{_PACKAGE_REL}Relationship") if r.get("Id") == wanted)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _cell(cell: ElementTree.Element, shared: list[str], dates: set[int]) -> tuple[str, str] | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "string", "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    value = cell.findtext(f"{_MAIN}v")
    if value is None:
        return None
    if kind == "s":
        return "string", shared[int(value)]
    if kind == "b":
        return "boolean", "true" if value == "1" else "false"
    if kind == "d":
        return "timestamp", value
    if kind != "n":
        return "string", value
    number = float(value)
    if int(cell.get("s", "0")) in dates:
        return "timestamp", str(_EPOCH + timedelta(seconds=round(number * 86400)))
    if re.fullmatch(r"[+-]?[0-9]+", value):
        return "bigint", str(int(value))
    return "double", repr(number)


def workbook_rows(file: BinaryIO) -> Iterator[tuple[int, list[str] | None, dict[str, dict[str, str]] | None]]:
    """The headers of the active sheet, then its data rows; rows in between keep their place."""
    with zipfile.ZipFile(file) as book:
        strings = _part(book, "xl/sharedStrings.xml")
        shared = (
            ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in strings.iter(f"{_MAIN}si")]
            if strings is not None
            else []
        )
        dates = _date_styles(book)
        headers: list[str] | None = None
        last = 0
        with book.open(_active_sheet(book)) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_MAIN}row":
                    continue
                number = int(row.get("r", str(last + 1)))
                found: dict[int, tuple[str, str] | None] = {}
                for place, cell in enumerate(row.iter(f"{_MAIN}c")):
                    reference = cell.get("r")
                    found[_column_number(reference) if reference else place] = _cell(cell, shared, dates)
                row.clear()
                if headers is None:
                    width = max(found, default=-1) + 1
                    headers = unique_headers([(found.get(i) or (None, None))[1] for i in range(width)])
                    yield number, headers, None
                else:
                    for blank in range(last + 1, number):
                        yield blank, None, {}
                    yield (
                        number,
                        None,
                        {h: {"kind": c[0], "value": c[1]} for i, h in enumerate(headers) if (c := found.get(i))},
                    )
                last = number


def xlsx_cells(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headers and data rows of every workbook, cells as a map; a workbook that cannot be read is a row with an error.

    Tasks get paths and open the files themselves, one at a time: contents never travel in batches.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "row_no", "headers", "cells", "error"]
        for batch in batches:
            for name in batch["path"]:
                try:
                    fs, inner = opened(name)
                    with fs.open_input_file(inner) as file:
                        rows = ((name, number, headers, cells, None) for number, headers, cells in workbook_rows(file))
                        while chunk := list(islice(rows, 4096)):
                            yield pd.DataFrame(chunk, columns=columns)
                except Exception as problem:  # one bad workbook becomes one row
                    why = f"{type(problem).__name__}: {problem}"
                    yield pd.DataFrame([(name, None, None, None, why)], columns=columns)

    return list_files(spark, path).select("path").mapInPandas(parse, CELLS)


def _common_kind(kinds: list[str]) -> str:
    found = set(kinds)
    if len(found) == 1:
        return {"timestamp": "timestamp_ntz"}.get(kinds[0], kinds[0])
    return "double" if found == {"bigint", "double"} else "string"


def _typed(rows: DataFrame, columns: list[tuple[str, str]], origin: bool) -> DataFrame:
    kept = ["path", "row_no"] if origin else []
    return rows.select(
        *[F.col(quoted(k)) for k in kept],
        *[F.col("cells")[F.lit(header)]["value"].cast(kind).alias(header) for header, kind in columns],
    )


def read_workbooks(
    spark: SparkSession, path: str | list[str], origin: bool = False, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of all readable workbooks, and (path, error) of the others.

    Columns come in sheet order (by their first place in any workbook, then by name), blank ones as text; a column with
    mixed kinds is text. Every workbook is parsed once, into a table of cells. ``schema`` names columns and types and
    saves the pass over the table. ``origin`` keeps path and row number. Rows of a workbook that breaks off count as
    unreadable with it.
    """
    cells = materialised(xlsx_cells(spark, path), "cells")
    bad = cells.where("error IS NOT NULL").select("path", "error")
    rows = cells.where("cells IS NOT NULL").join(bad.select("path"), "path", "left_anti")
    if schema is not None:
        return _typed(rows, [(f.name, f.dataType.simpleString()) for f in schema.fields], origin), bad
    headers = cells.where("headers IS NOT NULL").join(bad.select("path"), "path", "left_anti")
    places = headers.select(F.posexplode("headers").alias("place", "header"))
    places = places.groupBy("header").agg(F.min("place").alias("place"))
    kinds = rows.select(F.explode("cells").alias("header", "cell")).groupBy("header")
    kinds = kinds.agg(F.sort_array(F.collect_set("cell.kind")).alias("kinds"))
    found = places.join(kinds, "header", "left").orderBy("place", "header").collect()  # one row per column
    return _typed(rows, [(r["header"], _common_kind(r["kinds"] or ["string"])) for r in found], origin), bad


def read_xlsx(
    spark: SparkSession, path: str | list[str], origin: bool = False, schema: T.StructType | None = None
) -> DataFrame:
    """Workbooks as typed columns, see :func:`read_workbooks`; a workbook that cannot be read is an error."""
    rows, bad = read_workbooks(spark, path, origin, schema)
    first = bad.orderBy("path").first()
    if first is not None:
        raise DecodeError(f"not a readable workbook: {first['path']!r} ({first['error']})")
    return rows
