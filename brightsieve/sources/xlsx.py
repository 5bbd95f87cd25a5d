"""Excel workbooks (xlsx) with the standard library: zip and XML."""

from __future__ import annotations

import re
import zipfile
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _sheets(z: zipfile.ZipFile) -> dict[str, str]:
    """Member names by sheet."""
    book, rels = ET.fromstring(z.read("xl/workbook.xml")), ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels}
    return {s.get("name"): (t.lstrip("/") if (t := targets[s.get(_REL)]).startswith("/") else f"xl/{t}") for s in book.find("m:sheets", _NS)}


def sheet_names(path: str) -> list[str]:
    with zipfile.ZipFile(path) as z:
        return list(_sheets(z))


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def rows(path: str, sheet: str):
    """The rows of a sheet as lists of strings and None."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))]
        with z.open(_sheets(z)[sheet]) as f:
            for _, row in ET.iterparse(f):
                if not row.tag.endswith("}row"):
                    continue
                out: list[str | None] = []
                for i, cell in enumerate(row.findall("m:c", _NS)):
                    at = _column(cell.get("r")) if cell.get("r") else i
                    out += [None] * (at + 1 - len(out))
                    value, kind = cell.find("m:v", _NS), cell.get("t")
                    if kind == "inlineStr":
                        out[at] = "".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t"))
                    elif value is not None and kind == "s":
                        out[at] = shared[int(value.text)]
                    elif value is not None and kind == "b":
                        out[at] = "True" if value.text == "1" else "False"
                    elif value is not None:
                        out[at] = value.text
                yield out
                row.clear()


class _Reader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.sheet, self.width = options["path"], options["sheet"], len(schema.fields)

    def partitions(self):
        return [InputPartition(0)]  # a sheet is one XML stream

    def read(self, partition):
        body = rows(self.path, self.sheet)
        next(body, None)
        for r in body:
            yield tuple((r + [None] * self.width)[: self.width])


class XlsxSource(DataSource):
    """``spark.read.format("xlsx").option("path", ...).option("sheet", ...)``: the first row names the columns."""

    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        names = next(rows(self.options["path"], self.options["sheet"]), [])
        return ", ".join(f"`{n or f'_c{i}'}` string" for i, n in enumerate(names))

    def reader(self, schema):
        return _Reader(self.options, schema)


def read_sheet(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    spark.dataSource.register(XlsxSource)
    return spark.read.format("xlsx").option("path", path).option("sheet", sheet).load()
