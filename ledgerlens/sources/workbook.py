"""Spreadsheets (.xlsx): the file's own XML, read where the file is read; one workbook is one row and one task."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The namespaces of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
LIMIT = 200_000_000  # bytes that a part of a workbook may unpack to; larger ones are refused
SCHEMA = "sheet string, position int, cells array<string>"


def _column(reference: str) -> int:
    """The place, from 0, of a cell reference such as ``AB12``."""
    n = 0
    for c in re.match(r"[A-Z]*", reference.upper())[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _part(archive: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    try:
        info = archive.getinfo(name)
    except KeyError:
        return None
    if info.file_size > LIMIT:
        raise ValueError(f"{name} unpacks to more than {LIMIT} bytes")
    return ElementTree.fromstring(archive.read(info))


def _text(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def sheets(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, position from 0, cells) of every row that has a value; cells as text, booleans as TRUE and FALSE, dates as the
    numbers that the format holds."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        shared = _part(archive, "xl/sharedStrings.xml")
        strings = [_text(x) for x in shared.findall(f"{MAIN}si")] if shared is not None else []
        links = {x.get("Id"): x.get("Target") for x in _part(archive, "xl/_rels/workbook.xml.rels")}
        for sheet in _part(archive, "xl/workbook.xml").iter(f"{MAIN}sheet"):
            target = links[sheet.get(f"{LINKS}id")]
            root = _part(archive, target.lstrip("/") if target.startswith("/") else f"xl/{target}")
            if root is None:
                continue
            position = 0
            for row in root.iter(f"{MAIN}row"):
                cells: list[str | None] = []
                for at, cell in enumerate(row.findall(f"{MAIN}c")):
                    place = _column(cell.get("r", "")) if cell.get("r") else at
                    value, kind = cell.find(f"{MAIN}v"), cell.get("t", "n")
                    raw = value.text if value is not None else None
                    got = _text(cell) if kind == "inlineStr" else raw
                    if raw is not None and kind == "s":
                        got = strings[int(raw)]
                    elif raw is not None and kind == "b":
                        got = "TRUE" if raw == "1" else "FALSE"
                    cells += [None] * (place + 1 - len(cells))
                    cells[place] = got
                if any(c is not None and c.strip() for c in cells):
                    yield sheet.get("name"), position, cells
                    position += 1


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """sheet, position and cells of all rows with a value of the workbooks at a path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = list(sheets(content.as_py()))
                for lo in range(0, len(rows), 5000):
                    names, places, cells = zip(*rows[lo : lo + 5000])
                    yield pa.record_batch({"sheet": pa.array(names, pa.string()), "position": pa.array(places, pa.int32()), "cells": pa.array(cells, pa.list_(pa.string()))})

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, SCHEMA)


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """One sheet (the first by name without one) as text columns by its header row, with ``_position`` from 0 below the
    header. Blank header cells are left out, repeated ones are numbered; missing cells are null."""
    rows = read_workbook(spark, path)
    name = sheet or rows.agg(F.min("sheet")).first()[0]
    rows = rows.where(F.col("sheet") == name)
    header = rows.where("position = 0").select("cells").first()
    if header is None:
        raise ValueError(f"no sheet {name!r} with a header in {path}")
    seen: dict[str, int] = {}
    columns = []
    for i, c in enumerate(header["cells"]):
        if label := (c or "").strip():
            seen[label] = seen.get(label, 0) + 1
            columns.append(F.get("cells", F.lit(i)).alias(label if seen[label] == 1 else f"{label}_{seen[label]}"))
    return rows.where("position > 0").select(*columns, (F.col("position") - 1).alias("_position"))
