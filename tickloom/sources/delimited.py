"""Delimited quote files: encoding and separator found from the head, columns read as text."""

from __future__ import annotations

import codecs
import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD = 64 * 1024
#: Byte order marks, longest first, and separators in the order that wins ties.
MARKS = ((codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))
SEPARATORS = (",", ";", "\t", "|")
ZERO_SHARE = 0.15


def detect_encoding(head: bytes) -> str:
    """By mark; then by the share of zero bytes (UTF-16, by the side they are on); then UTF-8 if it decodes; else cp1252.

    A character that the end of a full head cuts off doesn't count against UTF-8."""
    for mark, name in MARKS:
        if head.startswith(mark):
            return name
    if head and head.count(0) / len(head) > ZERO_SHARE:
        odd, even = (head[i::2].count(0) / max(1, len(head[i::2])) for i in (1, 0))
        return "utf-16-le" if odd > even else "utf-16-be"
    try:
        codecs.getincrementaldecoder("utf-8")("strict").decode(head, final=len(head) < HEAD)
        return "utf-8"
    except UnicodeDecodeError:
        return "cp1252"


def detect_separator(text: str) -> str:
    line = next((x for x in text.splitlines() if x.strip()), "")
    counts = [line.count(s) for s in SEPARATORS]
    if max(counts, default=0):
        return SEPARATORS[counts.index(max(counts))]
    try:
        return csv.Sniffer().sniff(line, delimiters="".join(SEPARATORS)).delimiter
    except csv.Error:
        return ","


def head_of(spark: SparkSession, path: str, size: int = HEAD) -> bytes:
    """The first bytes of a file that Spark can read, wherever it is."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        raise FileNotFoundError(path)
    if fs.getFileStatus(at).isDirectory():
        parts = [s.getPath() for s in fs.listStatus(at) if s.isFile() and s.getLen() and not s.getPath().getName().startswith(("_", "."))]
        if not parts:
            raise ValueError(f"no data in {path}")
        at = sorted(parts, key=lambda p: p.getName())[0]
    stream = fs.open(at)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


#: What Spark's reader decodes itself; UTF-16 needs whole files, since line ends are two bytes there. A byte of cp1252 is read as the
#: Latin-1 character of its number, and what cp1252 has in the place of these controls is put there in the rows.
NATIVE = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "cp1252": "ISO-8859-1", "utf-16": "UTF-16", "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE", "utf-32": "UTF-32"}
#: Read by parts of a file.
SPLIT = ("utf-8", "utf-8-sig", "cp1252")


def _from_latin(text: Column) -> Column:
    controls = range(0x80, 0xA0)
    return F.translate(text, "".join(map(chr, controls)), "".join(bytes([b]).decode("cp1252", "replace") for b in controls))


def read_quotes_text(spark: SparkSession, path: str, encoding: str | None = None, separator: str | None = None, quoted: bool = False) -> DataFrame:
    """All columns of a delimited file with a header, as text. Rows with too few fields get nulls.

    UTF-8 and cp1252 files are split between tasks, at line ends. UTF-16 and UTF-32 files are read whole, a file to a task; so are
    all files with `quoted`, which says that quoted fields may hold line ends. Split such data into many files.
    """
    head = head_of(spark, path)
    if not head.strip(b"\0\r\n \xef\xbb\xbf"):
        raise ValueError(f"empty file: {path}")
    encoding = encoding or detect_encoding(head)
    text = codecs.getincrementaldecoder(encoding)("replace").decode(head, final=False)
    separator = separator or detect_separator(text)
    header = next(csv.reader([next(x for x in text.splitlines() if x.strip())], delimiter=separator))
    header = [h.strip().lstrip("﻿") for h in header]
    schema = ", ".join(f"`{h or f'_c{i}'}` string" for i, h in enumerate(header))
    if encoding not in NATIVE:
        raise ValueError(f"no reader for {encoding}")
    whole = encoding not in SPLIT or quoted
    options = {"header": True, "sep": separator, "mode": "PERMISSIVE", "enforceSchema": True, "encoding": NATIVE[encoding], "multiLine": whole}
    rows = spark.read.options(**options).schema(schema).csv(path)
    return rows.select(*[_from_latin(F.col(f"`{c}`")).alias(c) for c in rows.columns]) if encoding == "cp1252" else rows
