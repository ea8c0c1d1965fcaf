"""Word documents of plain paragraphs: packed and read in Arrow batches."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BinaryType, StringType

RUN = "struct<text: string, bold: boolean, italics: boolean, size: int, color: string>"
#: before, after: space in twentieths of a point; rule: a line below; size in half points.
PARAGRAPHS = f"array<struct<before: int, after: int, rule: boolean, runs: array<{RUN}>>>"

_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
_TYPES = "application/vnd.openxmlformats-officedocument.wordprocessingml"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_NOT_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")

_PARTS = {
    "[Content_Types].xml": f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="{_TYPES}.document.main+xml"/><Override PartName="/word/styles.xml" ContentType="{_TYPES}.styles+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_RELATIONS}/officeDocument" Target="word/document.xml"/></Relationships>',
    "word/_rels/document.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_RELATIONS}/styles" Target="styles.xml"/></Relationships>',
    "word/styles.xml": f'<w:styles xmlns:w="{_W}"><w:docDefaults><w:rPrDefault><w:rPr><w:rFonts w:ascii="Calibri" w:hAnsi="Calibri" w:cs="Calibri"/><w:sz w:val="18"/></w:rPr></w:rPrDefault></w:docDefaults></w:styles>',
}


def _run(r) -> str:
    look = "<w:b/>" * bool(r["bold"]) + "<w:i/>" * bool(r["italics"]) + (f'<w:color w:val="{escape(r["color"])}"/>' if r["color"] else "") + (f'<w:sz w:val="{int(r["size"])}"/>' if r["size"] else "")
    return f'<w:r><w:rPr>{look}</w:rPr><w:t xml:space="preserve">{escape(_NOT_XML.sub("", r["text"] or ""))}</w:t></w:r>'


def _paragraph(p) -> str:
    rule = '<w:pBdr><w:bottom w:val="single" w:sz="4" w:color="2B5C6E"/></w:pBdr>' * bool(p["rule"])
    space = f'<w:spacing w:before="{int(p["before"] or 0)}" w:after="{int(p["after"] or 0)}"/>'
    return f"<w:p><w:pPr>{rule}{space}</w:pPr>{''.join(map(_run, p['runs'] if p['runs'] is not None else ()))}</w:p>"


def packed(paragraphs) -> bytes:
    """The file of a document; the same bytes whenever it is made."""
    body = "".join(map(_paragraph, paragraphs))
    margins = '<w:sectPr><w:pgMar w:top="720" w:right="720" w:bottom="720" w:left="720" w:header="0" w:footer="0" w:gutter="0"/></w:sectPr>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in {**_PARTS, "word/document.xml": f'<w:document xmlns:w="{_W}"><w:body>{body}{margins}</w:body></w:document>'}.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), _HEAD + text, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def unpacked(content: bytes) -> list[str] | None:
    """The paragraphs' texts; null for what is no document."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    return ["".join(t.text or "" for t in p.iter(f"{{{_W}}}t")) for p in root.iter(f"{{{_W}}}p")]


@pandas_udf(BinaryType())
def document(paragraphs: pd.Series) -> pd.Series:
    return paragraphs.map(lambda x: None if x is None else packed(x))


@pandas_udf(ArrayType(StringType()))
def document_texts(content: pd.Series) -> pd.Series:
    return content.map(lambda x: None if x is None else unpacked(x))


def paragraph(*runs: Column, before: int = 0, after: int = 40, rule: bool = False) -> Column:
    return F.struct(F.lit(before).alias("before"), F.lit(after).alias("after"), F.lit(rule).alias("rule"), F.array(*runs).cast(f"array<{RUN}>").alias("runs"))


def run(text: Column, size: int = 18, color: str = "3a3a3a", bold: bool = False, italics: bool = False) -> Column:
    return F.struct(F.coalesce(text, F.lit("")).alias("text"), F.lit(bold).alias("bold"), F.lit(italics).alias("italics"), F.lit(size).alias("size"), F.lit(color).alias("color"))
