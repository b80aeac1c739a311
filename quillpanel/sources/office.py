"""Workbooks and documents without further packages: both are ZIP archives of XML."""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice
from typing import IO
from xml.etree import ElementTree
from xml.parsers import expat
from xml.sax.saxutils import escape

# Namespaces, content types and relations of the two formats.
_SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
_RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
# The rows of a sheet that the format allows besides the header, and the letters at which a sheet ends before that: the
# part stays under 2 GiB, beyond which spreadsheet programs doubt the archive.
_SHEET_ROWS, _SHEET_LETTERS = 1_048_575, 1 << 28


def _package(z: zipfile.ZipFile, main: str, kind: str, parts: dict[str, str], written: Sequence[str] = ()) -> None:
    """The parts and what an archive must say of them and of those that are ``written`` already."""
    types = f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
    types += "".join(f'<Override PartName="/{name}" ContentType="application/vnd.openxmlformats-officedocument.{kind if name == main else kind.replace("sheet.main", "worksheet")}+xml"/>' for name in [*parts, *written] if not name.endswith(".rels"))
    root = f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_RELATION}/officeDocument" Target="{main}"/></Relationships>'
    for name, text in {"[Content_Types].xml": types + "</Types>", "_rels/.rels": root, **parts}.items():
        z.writestr(name, _HEAD + text)


def _place(reference: str) -> int:
    """Column number of a cell reference, from 0."""
    number = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:  # type: ignore[index]
        number = number * 26 + ord(letter) - 64
    return number - 1


def _sheet_name(number: int, first: str = "Sheet1") -> str:
    return first if number == 1 else f"{first} continued {number}"


def _sheet_rows(sheet: IO[bytes], shared: Sequence[str]) -> Iterator[list[str | None]]:
    """Read as it comes: no tree of the sheet is kept."""
    row_tag, cell_tag, value_tag, text_tag = (f"{_SHEET}}}{t}" for t in ("row", "c", "v", "t"))
    done: list[list[str | None]] = []
    cells: list[str | None] = []
    at, kind, told, texts = 0, "", False, []
    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True

    def start(tag: str, attributes: dict[str, str]) -> None:
        nonlocal cells, at, kind, told
        if tag == cell_tag:
            at = _place(attributes["r"]) if attributes.get("r") else len(cells)
            cells += [None] * (at - len(cells) + 1)
            kind, told = attributes.get("t", ""), False
            texts.clear()
        elif tag == (text_tag if kind == "inlineStr" else value_tag) and not told:
            parser.CharacterDataHandler = texts.append
        elif tag == row_tag:
            cells = []

    def end(tag: str) -> None:
        nonlocal told
        if tag == value_tag or tag == text_tag:
            parser.CharacterDataHandler = None
            told = tag == value_tag
        elif tag == cell_tag:
            value = "".join(texts)
            if kind == "inlineStr":
                cells[at] = value
            elif value:
                cells[at] = shared[int(value)] if kind == "s" else {"1": "TRUE", "0": "FALSE"}.get(value) if kind == "b" else value
        elif tag == row_tag:
            done.append(cells)

    parser.StartElementHandler, parser.EndElementHandler = start, end
    while block := sheet.read(1 << 16):
        parser.Parse(block)
        yield from done
        done.clear()
    parser.Parse(b"", True)
    yield from done


def workbook_rows(path: str) -> Iterator[list[str | None]]:
    """The cells of a workbook's first sheet as text, row by row; empty cells are None.

    Sheets that continue it, by their name and an equal header, as ``write_workbook`` makes them, follow without their
    header; other sheets are not read."""
    with zipfile.ZipFile(path) as z:
        names = set(z.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter(f"{{{_SHEET}}}t")))
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        sheets = list(book.iter(f"{{{_SHEET}}}sheet"))
        header: list[str | None] | None = None
        for number, sheet in enumerate(sheets, 1):
            if sheet.get("name") != _sheet_name(number, str(sheets[0].get("name"))):
                return
            target = str(links[sheet.get(f"{{{_RELATION}}}id")]).lstrip("/")
            with z.open(target if target in names else f"xl/{target}") as part:
                rows = _sheet_rows(part, shared)
                first = next(rows, None)
                if first is None or number > 1 and first != header:
                    return
                if number == 1:
                    yield (header := first)
                yield from rows


def write_workbook(path: str, header: Sequence[str], rows: Iterable[Sequence[object]], sheet_rows: int = _SHEET_ROWS) -> None:
    """A sheet of text and numbers, written row by row; None is an empty cell. What a sheet can't hold goes to further
    ones with the same header, ``Sheet1 continued 2`` and so on."""

    def cell(v: object) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"<c><v>{v}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    line = lambda r: f"<row>{''.join(map(cell, r))}</row>"
    rest, sheets = iter(rows), []
    pending: list[Sequence[object]] = list(islice(rest, 1))
    with zipfile.ZipFile(f"{path}.part", "w", zipfile.ZIP_DEFLATED) as z:
        while pending or not sheets:
            sheets.append(f"worksheets/sheet{len(sheets) + 1}.xml")
            with io.TextIOWrapper(z.open(f"xl/{sheets[-1]}", "w"), "utf-8", newline="") as part:
                letters = part.write(f'{_HEAD}<worksheet xmlns="{_SHEET}"><sheetData>{line(header)}')
                for r in islice(chain(pending, rest), sheet_rows):
                    letters += part.write(line(r))
                    if letters > _SHEET_LETTERS:
                        break
                part.write("</sheetData></worksheet>")
            pending = list(islice(rest, 1))
        listed = "".join(f'<sheet name="{_sheet_name(i)}" sheetId="{i}" r:id="r{i}"/>' for i, _ in enumerate(sheets, 1))
        linked = "".join(f'<Relationship Id="r{i}" Type="{_RELATION}/worksheet" Target="{s}"/>' for i, s in enumerate(sheets, 1))
        parts = {
            "xl/workbook.xml": f'<workbook xmlns="{_SHEET}" xmlns:r="{_RELATION}"><sheets>{listed}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">{linked}</Relationships>',
        }
        _package(z, "xl/workbook.xml", "spreadsheetml.sheet.main", parts, [f"xl/{s}" for s in sheets])
    os.replace(f"{path}.part", path)


def write_document(path: str, markdown: str) -> None:
    """A .docx of headings, paragraphs and tables, from the Markdown that ``report`` makes."""

    def paragraph(text: str, size: int = 22, bold: bool = False) -> str:
        return f'<w:p><w:r><w:rPr>{"<w:b/>" if bold else ""}<w:sz w:val="{size}"/></w:rPr><w:t xml:space="preserve">{escape(text)}</w:t></w:r></w:p>'

    edges = "".join(f'<w:{side} w:val="single" w:sz="4"/>' for side in ("top", "left", "bottom", "right", "insideH", "insideV"))
    out: list[str] = []
    table: list[str] = []

    def close() -> None:
        if table:
            out.append(f"<w:tbl><w:tblPr><w:tblBorders>{edges}</w:tblBorders></w:tblPr>{''.join(table)}</w:tbl>")
            table.clear()

    for line in markdown.split("\n"):
        if line.startswith("|"):
            if not re.fullmatch(r"[|\-]+", line):
                cells = line.strip("|").split("|")
                table.append(f"<w:tr>{''.join(f'<w:tc>{paragraph(c.strip())}</w:tc>' for c in cells)}</w:tr>")
            continue
        close()
        if line.strip():
            level = len(line) - len(line.lstrip("#"))
            out.append(paragraph(line.lstrip("# ") if level else line.strip("*"), 34 - 4 * level if level else 22, level > 0))
    close()
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        _package(z, "word/document.xml", "wordprocessingml.document.main", {"word/document.xml": f'<w:document xmlns:w="{_WORD}"><w:body>{"".join(out)}</w:body></w:document>'})
