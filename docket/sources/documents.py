"""Binary document sources: DOCX (standard library only) and text of simple PDF streams."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text(data: bytes) -> str:
    """Paragraphs of a DOCX file, runs joined, empty ones dropped, a blank line between them."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    parts = ("".join(t.text or "" for t in p.iter(f"{_WORD}t")).strip() for p in root.iter(f"{_WORD}p"))
    return "".join(p + "\n\n" for p in parts if p).rstrip("\n") + "\n"


def pdf_text(data: bytes) -> str:
    """Strings shown in the (deflated) streams of a simple PDF; adjacent equal lines count once."""
    lines: list[str] = []
    for m in re.finditer(rb"stream\r?\n(.*?)endstream", data, re.DOTALL):
        try:
            body = zlib.decompress(m[1])
        except zlib.error:
            body = m[1]
        for shown in re.findall(rb"\(((?:\\.|[^\\()])*)\)\s*Tj", body):
            line = re.sub(rb"\\(.)", rb"\1", shown).decode("latin-1").strip()
            if line and (not lines or lines[-1] != line):
                lines.append(line)
    return "\n".join(lines)


def read_documents(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``(path, kind, text)`` of the DOCX and PDF files in a folder; a file that cannot be read has a null text."""

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            kinds, texts = [], []
            for data in b["content"]:
                kind = "docx" if data[:2] == b"PK" else "pdf" if data[:4] == b"%PDF" else "other"
                try:
                    text = docx_text(data) if kind == "docx" else pdf_text(data) if kind == "pdf" else None
                except (KeyError, zipfile.BadZipFile, ElementTree.ParseError):
                    text = None
                kinds.append(kind)
                texts.append(text)
            yield pd.DataFrame({"path": b["path"], "kind": kinds, "text": texts})

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")
    return files.mapInPandas(parsed, "path string, kind string, text string")


def read_statutes(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, title, dokid, last_change, content)`` of XHTML files whose first 3000 characters name a document id."""
    from pyspark.sql import functions as F

    head = F.substring("value", 1, 3000)
    files = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value"), head.alias("head"))
    found = files.select(
        "path", F.trim(F.regexp_extract("head", r"(?is)<title>(.*?)</title>", 1)).alias("title"), F.regexp_extract("head", r'(?i)dokid["\s:=>]+([A-Za-z0-9/_-]+)', 1).alias("dokid"),
        F.regexp_extract("head", r'(?i)lastChangeInForce["\s:=>]+([0-9-]+)', 1).alias("last_change"), F.col("value").alias("content"),
    )
    return found.where("dokid <> ''")
