"""Office files -> element rows (S4 Word, S5 PowerPoint, S6 Excel).

Files are read with Spark's ``binaryFile`` source; each file is one row and is
parsed by stdlib ``zipfile`` + ``xml.etree`` inside ``mapInArrow``, so parsing
is spread over tasks file by file. The element rows then go to the renderers
in ``memweave.operators.render`` (T1-T3).
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from memweave.functions.parallel import slices
from memweave.sources.files import scan_files

# --- fixed values: OOXML namespaces and part names ---------------------------
NS_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
NS_A = "http://schemas.openxmlformats.org/drawingml/2006/main"
NS_P = "http://schemas.openxmlformats.org/presentationml/2006/main"
NS_R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
NS_S = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
WORD_MAIN = "word/document.xml"
PPT_MAIN = "ppt/presentation.xml"
XL_MAIN = "xl/workbook.xml"
# ---------------------------------------------------------------------------

PARAGRAPH_SCHEMA = "doc string, pos int, text string"
SLIDE_SCHEMA = "doc string, slide_no int, pos int, text string, hidden boolean"
CELL_SCHEMA = "doc string, sheet_no int, row int, col int, is_text boolean, value string"


class OfficeFormatError(ValueError):
    pass


def _q(ns: str, tag: str) -> str:
    return f"{{{ns}}}{tag}"


def _rels(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    """Relationship id -> target part path for ``part``."""
    base = posixpath.dirname(part)
    rel_path = posixpath.join(base, "_rels", posixpath.basename(part) + ".rels")
    if rel_path not in z.namelist():
        return {}
    root = ET.fromstring(z.read(rel_path))
    out = {}
    for rel in root.findall(_q(NS_PKG_REL, "Relationship")):
        target = rel.get("Target", "")
        out[rel.get("Id")] = posixpath.normpath(posixpath.join(base, target)) if not target.startswith("/") else target[1:]
    return out


def word_paragraphs(data: bytes) -> list[str]:
    """Text of every paragraph in document order, nested ones included.

    A paragraph's text is all text under it, so a paragraph inside a text box
    also shows up in its outer paragraph. A missing main part or body is an error.
    """
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        if WORD_MAIN not in z.namelist():
            raise OfficeFormatError(f"no part {WORD_MAIN} in the file")
        root = ET.fromstring(z.read(WORD_MAIN))
    body = root.find(_q(NS_W, "body"))
    if body is None:
        raise OfficeFormatError("the word file holds no body element")
    t_tag = _q(NS_W, "t")
    return ["".join(t.text or "" for t in p.iter(t_tag)) for p in body.iter(_q(NS_W, "p"))]


def slide_texts(data: bytes) -> list[tuple[int, list[str], bool]]:
    """(slide number, texts, hidden) per slide, in slide-id list order.

    Numbers count every listed slide, including hidden or empty ones.
    """
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        if PPT_MAIN not in z.namelist():
            return out
        pres = ET.fromstring(z.read(PPT_MAIN))
        rels = _rels(z, PPT_MAIN)
        lst = pres.find(_q(NS_P, "sldIdLst"))
        if lst is None:
            return out
        for number, sld in enumerate(lst.findall(_q(NS_P, "sldId")), start=1):
            target = rels.get(sld.get(_q(NS_R, "id")))
            if not target or target not in z.namelist():
                continue
            slide = ET.fromstring(z.read(target))
            texts = [t.text or "" for t in slide.iter(_q(NS_A, "t"))]
            if not texts:
                continue
            hidden = slide.get("show") in ("0", "false")
            out.append((number, texts, hidden))
    return out


_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n


def sheet_cells(data: bytes) -> list[tuple[int, int, int, bool, str]]:
    """(sheet_no, row, col, is_text, value) of every cell with a value."""
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            for si in sst.findall(_q(NS_S, "si")):
                shared.append("".join(t.text or "" for t in si.iter(_q(NS_S, "t"))))
        wb = ET.fromstring(z.read(XL_MAIN))
        rels = _rels(z, XL_MAIN)
        sheets = wb.find(_q(NS_S, "sheets"))
        for sheet_no, sh in enumerate([] if sheets is None else sheets.findall(_q(NS_S, "sheet")), start=1):
            target = rels.get(sh.get(_q(NS_R, "id")))
            if not target or target not in names:
                continue
            root = ET.fromstring(z.read(target))
            for c in root.iter(_q(NS_S, "c")):
                m = _CELL_REF.fullmatch(c.get("r", ""))
                if not m:
                    continue
                kind = c.get("t", "n")
                v = c.find(_q(NS_S, "v"))
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(_q(NS_S, "t")))
                elif v is None or v.text is None:
                    continue
                elif kind == "s":
                    value = shared[int(v.text)]
                elif kind == "b":
                    value = "TRUE" if v.text.strip() == "1" else "FALSE"
                else:
                    value = v.text
                is_text = kind in ("s", "str", "inlineStr")
                if value == "":
                    continue
                out.append((sheet_no, int(m.group(2)), _col_number(m.group(1)), is_text, value))
    return out


def sheet_list(data: bytes) -> list[int]:
    """Numbers of all worksheets in workbook order (empty ones included)."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        wb = ET.fromstring(z.read(XL_MAIN))
    sheets = wb.find(_q(NS_S, "sheets"))
    return list(range(1, 1 + (0 if sheets is None else len(sheets.findall(_q(NS_S, "sheet"))))))


def _files_to_rows(kind: str):
    """Batch function of ``mapInArrow``: (path, content) files to element rows, a slice of files at a time."""
    schema, parse = {
        "word": (pa.schema([("doc", pa.string()), ("pos", pa.int32()), ("text", pa.string())]),
                 lambda data: enumerate(word_paragraphs(data))),
        "slides": (pa.schema([("doc", pa.string()), ("slide_no", pa.int32()), ("pos", pa.int32()), ("text", pa.string()), ("hidden", pa.bool_())]),
                   lambda data: ((n, i, t, h) for n, texts, h in slide_texts(data) for i, t in enumerate(texts))),
        "cells": (pa.schema([("doc", pa.string()), ("sheet_no", pa.int32()), ("row", pa.int32()), ("col", pa.int32()), ("is_text", pa.bool_()),
                             ("value", pa.string())]), sheet_cells),
        "sheets": (pa.schema([("doc", pa.string()), ("sheet_no", pa.int32())]), lambda data: ((n,) for n in sheet_list(data))),
    }[kind]

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                rows = [(path, *row) for path, data in zip(part.column("path").to_pylist(), part.column("content").to_pylist())
                        for row in parse(data)]
                columns = zip(*rows) if rows else [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def read_word(spark: SparkSession, path: str) -> DataFrame:
    """.docx files -> (doc, pos, text) paragraph rows."""
    files = scan_files(spark, path, glob="*.docx")
    return files.select("path", "content").mapInArrow(_files_to_rows("word"), PARAGRAPH_SCHEMA)


def read_slides(spark: SparkSession, path: str) -> DataFrame:
    """.pptx files -> (doc, slide_no, pos, text, hidden) rows."""
    files = scan_files(spark, path, glob="*.pptx")
    return files.select("path", "content").mapInArrow(_files_to_rows("slides"), SLIDE_SCHEMA)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """.xlsx files -> (doc, sheet_no, row, col, is_text, value) rows."""
    files = scan_files(spark, path, glob="*.xlsx")
    return files.select("path", "content").mapInArrow(_files_to_rows("cells"), CELL_SCHEMA)


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    """.xlsx files -> (doc, sheet_no) for every worksheet, empty ones included."""
    files = scan_files(spark, path, glob="*.xlsx")
    return files.select("path", "content").mapInArrow(_files_to_rows("sheets"), "doc string, sheet_no int")


def office_to_text(spark: SparkSession, path: str) -> DataFrame:
    """S4-S6 + T1-T3: every Office file under ``path`` as (doc, text)."""
    from memweave.operators import render

    return (render.paragraphs_to_text(read_word(spark, path))
            .unionByName(render.slides_to_text(read_slides(spark, path)))
            .unionByName(render.cells_to_text(read_cells(spark, path), sheets=read_sheets(spark, path))))
