"""File sources: discovery, encoding and delimiter sniffing, CSV scans, the registry."""

from __future__ import annotations

import codecs
import csv
import fnmatch
import io
import logging
import os
import re
from dataclasses import dataclass, field

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightsieve.functions.vocab import NA_TOKENS
from brightsieve.sources import csv_splits
from brightsieve.sources.xlsx import read_sheet, sheet_names

log = logging.getLogger(__name__)
SNIFF_BYTES = 100_000
#: From this size on a local CSV file is read in parts.
SPLIT_BYTES = 32 << 20
DELIMITERS = [",", "\t", ";", "|"]


def discover(folder: str, pattern: str = "*", spark: SparkSession | None = None) -> list[str]:
    """CSV and Excel files of a folder, by kind and then by name; with ``spark`` a folder of any store that Spark reads."""
    if "://" in folder and spark:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = sorted(x.getPath().getName() for x in fs.listStatus(where) if x.isFile())
    else:
        names = sorted(os.listdir(folder))
    return [os.path.join(folder, n) for ext in ("csv", "xlsx", "xls") for n in names if fnmatch.fnmatch(n, f"{pattern}.{ext}")]


def check(path: str) -> None:
    """S12."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    if not os.path.isfile(path):
        raise ValueError(f"not a regular file: {path}")


def sniff_encoding(data: bytes) -> str:
    """A byte order mark, strict UTF-8, else Latin-1 (which Spark reads, and which can't fail)."""
    for mark, name in ((codecs.BOM_UTF8, "UTF-8"), (codecs.BOM_UTF16_LE, "UTF-16"), (codecs.BOM_UTF16_BE, "UTF-16")):
        if data.startswith(mark):
            return name
    try:
        codecs.getincrementaldecoder("utf-8")().decode(data)
        return "UTF-8"
    except UnicodeDecodeError:
        return "ISO-8859-1"


def sniff_delimiter(lines: list[str]) -> str:
    """The commonest of the four in the first five lines; the first listed of equals, a comma if none occurs."""
    text = "\n".join(lines[:5])
    best = max(DELIMITERS, key=lambda d: (text.count(d), -DELIMITERS.index(d)))
    return best if text.count(best) else ","


def _head(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read(SNIFF_BYTES)


def nulled(df: DataFrame) -> DataFrame:
    """Missing-value tokens as null; everything stays a string, so that leading zeros live."""
    return df.select(*[F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in df.columns])


def _late_latin(spark: SparkSession, path: str) -> bool:
    """Whether any line of a file isn't UTF-8, however far down."""
    return spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count() > 0


def read_csv(spark: SparkSession, path: str, encoding: str | None = None, delimiter: str | None = None, quote: str = '"', escape: str | None = None, skip_rows: int = 0, lineage: bool = True, strings: bool = True, through_spark: bool = False, split: bool | None = None, place: bool = False) -> DataFrame:
    """A CSV file as strings, in parallel. Short rows are filled up with nulls, rows with too many fields left out.

    With lineage, ``_source_file`` and ``_extraction_time`` are added. ``through_spark``
    (and any path with a scheme) sniffs by Spark's reader: folders and remote stores; ``skip_rows``
    skips lines of one file, of which quoted line ends are no ends. Files of SPLIT_BYTES, and all that are
    read through Spark, are read in parts (``csv_splits``; ``split`` decides otherwise); UTF-16 and
    files whose lines end with a carriage return alone can't be. With ``place``, parts tell each row's place in a column of that name.
    """
    remote = through_spark or "://" in path
    given = encoding
    if remote:
        split = split is not False and encoding in (None, "UTF-8", "ISO-8859-1")
        encoding = encoding or ("UTF-8" if split else "ISO-8859-1" if _late_latin(spark, path) else "UTF-8")
        reader = spark.read.option("lineSep", "\n") if split else spark.read.option("encoding", encoding)
        first = reader.text(path).select("value", F.octet_length("value").alias("n")).limit(5 + 2 * skip_rows).collect()
        head, sizes = "\n".join(r.value for r in first), [r.n for r in first]
    else:
        check(path)
        data = _head(path)
        found = encoding or sniff_encoding(data)
        large = os.path.getsize(path) >= SPLIT_BYTES if split is None else split
        split = large and found in ("UTF-8", "ISO-8859-1") and not (b"\r" in data and b"\n" not in data)
        encoding = "ISO-8859-1" if not encoding and not split and found == "UTF-8" and os.path.getsize(path) > len(data) and _late_latin(spark, path) else found
        head, sizes = data.decode(encoding, "replace").removeprefix("\ufeff"), list(map(len, data.split(b"\n")))
    lines = head.splitlines()
    if split:
        return _split(spark, path, head, sizes, given or ("ISO-8859-1" if encoding != "UTF-8" else None), delimiter, quote, escape, skip_rows, lineage, strings, place)
    if skip_rows:  # lines of the text that are skipped, as records of the reader
        skipped = sum(1 for r in csv.reader(io.StringIO("\n".join(lines[:skip_rows]) + "\n"), quotechar=quote) if r)
        lines = lines[skip_rows:]
    delimiter = delimiter or sniff_delimiter(lines)
    names = _header(lines, delimiter, quote)
    if not names:
        return with_lineage(spark.createDataFrame([], ""), os.path.basename(path)) if lineage else spark.createDataFrame([], "")
    shape = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "__over", "__raw"]])
    reader = spark.read.schema(shape).option("sep", delimiter).option("quote", quote).option("escape", escape or quote).option("encoding", encoding)
    reader = reader.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__raw")
    if skip_rows:
        # a file of many-line records is one partition: its records are numbered as they are read
        df = reader.option("header", False).csv(path).withColumn("__n", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).where(F.col("__n") > skipped).drop("__n")
    else:
        df = reader.option("header", True).csv(path)
    df = _whole_rows(df, names, delimiter, quote)
    df = nulled(df) if strings else df
    return with_lineage(df, os.path.basename(path)) if lineage else df


def _split(spark, path, head, sizes, encoding, delimiter, quote, escape, skip_rows, lineage, strings, place) -> DataFrame:
    """``read_csv`` by ``csv_splits``: skipped lines and the header are so many lines of the file, of ``sizes`` bytes."""
    records = csv.reader(io.StringIO(head, newline=""), quotechar=quote, delimiter=delimiter or ",")
    for _ in zip(range(skip_rows), records):
        pass
    lines = head.split("\n")[records.line_num :]
    delimiter = delimiter or sniff_delimiter([x.removesuffix("\r") for x in lines])
    records, before = csv.reader(io.StringIO("\n".join(lines), newline=""), quotechar=quote, delimiter=delimiter), records.line_num
    found = next((r for r in records if r), [])
    names = _named(found)
    if not names:
        return with_lineage(spark.createDataFrame([], ""), os.path.basename(path)) if lineage else spark.createDataFrame([], "")
    header = [sum(sizes[:k]) + k for k in range(before + records.line_num)]
    df = csv_splits.read(spark, path, names, header, delimiter, quote, escape, encoding)
    at = df.columns[-1]
    df = _whole_rows(df, names, delimiter, quote)
    rows = [F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c) if strings else F.col(f"`{c}`") for c in names]
    df = df.select(*rows, *([at] if place else []))
    return with_lineage(df, os.path.basename(path)) if lineage else df


def _whole_rows(df: DataFrame, names: list[str], delimiter: str, quote: str) -> DataFrame:
    # a row of just one field more is no corrupt record of this schema; of the others (kept raw) delimiters outside quotes are counted
    bare = F.regexp_replace("__raw", f"{re.escape(quote)}[^{re.escape(quote)}]*{re.escape(quote)}", "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit("")))
    return df.where(F.col("__raw").isNotNull() & F.col("__over").isNull() & (fields < len(names))).drop("__over", "__raw")


def _header(lines: list[str], delimiter: str, quote: str) -> list[str]:
    """The names of the first record that isn't empty; an empty one is numbered, a repeated one gets a number."""
    return _named(next((r for r in csv.reader(io.StringIO("\n".join(lines)), delimiter=delimiter, quotechar=quote) if r), []))


def _named(found: list[str]) -> list[str]:
    names: list[str] = []
    for i, n in enumerate(found):
        n = n.lstrip("\ufeff") or f"Unnamed: {i}"
        k = 0
        while (n if not k else f"{n}.{k}") in names:
            k += 1
        names.append(n if not k else f"{n}.{k}")
    return names


def with_lineage(df: DataFrame, file: str, sheet: str | None = None) -> DataFrame:
    more = {"_source_file": F.lit(file), "_extraction_time": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")}
    return df.withColumns(more | ({"_source_sheet": F.lit(sheet)} if sheet else {}))


def extract(spark: SparkSession, folder: str, pattern: str = "*", registry: Registry | None = None) -> dict[str, DataFrame]:
    """A frame per file or sheet; a source that can't be read is logged and left out."""
    found: dict[str, DataFrame] = {}
    for path in discover(folder, pattern, spark):
        name = os.path.basename(path)
        try:
            if path.endswith(".csv"):
                c = registry.match(name) if registry else None
                found[name] = read_csv(spark, path, *((c.encoding, c.delimiter, '"', None, c.skip_rows) if c else ()), place=True)
            else:
                for sheet in sheet_names(path):
                    df = read_sheet(spark, path, sheet)
                    found[f"{os.path.splitext(name)[0]}__{sheet}.csv"] = with_lineage(nulled(df), name, sheet)
        except Exception as e:  # one bad source must not stop the others
            log.warning("%s is left out: %s", name, e)
    return found


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Path, name, size and time of files, from Spark's own metadata, with row counts."""
    rows = spark.read.text(path).select("_metadata.*")
    return rows.groupBy("file_path", "file_name", "file_size", "file_modification_time").agg(F.count(F.lit(1)).alias("lines")).withColumn("size_mb", F.round(F.col("file_size") / 1048576, 2))


@dataclass
class SourceConfig:
    name: str
    pattern: str
    column_map: dict[str, str] = field(default_factory=dict)
    transformations: dict = field(default_factory=dict)
    file_type: str = "csv"
    encoding: str | None = None
    delimiter: str | None = None
    skip_rows: int = 0

    def matches(self, file: str) -> bool:
        """``*`` is any text, and only the beginning has to match; case doesn't count."""
        return re.match(self.pattern.replace("*", ".*"), file, re.IGNORECASE) is not None


class Registry:
    """Configured sources; the first that matches a file, else the default."""

    def __init__(self, path: str | None = None):
        self.sources: dict[str, SourceConfig] = {}
        for name, c in ((yaml.safe_load(open(path)) or {}).get("sources") or {}).items() if path else ():
            if name == "default":  # its patterns name columns of sources that nothing else matches
                self.register(SourceConfig("default", "*", column_map=dict(c.get("patterns") or {})))
                continue
            known = {k: v for k, v in c.items() if k in SourceConfig.__dataclass_fields__ and k not in ("name", "pattern")}
            self.register(SourceConfig(name=name, pattern=c.get("pattern", "*"), **known))
        self.sources.setdefault("default", SourceConfig("default", "*"))

    def register(self, config: SourceConfig) -> None:
        self.sources[config.name] = config

    def column_mapping(self, source: str) -> dict[str, str]:
        """The configured target and source columns of a source, none for one that isn't registered."""
        return dict(self.sources[source].column_map) if source in self.sources else {}

    def transformations_of(self, source: str) -> dict:
        return dict(self.sources[source].transformations) if source in self.sources else {}

    def list(self) -> list[str]:
        return list(self.sources)

    def match(self, file: str) -> SourceConfig:
        return next((c for n, c in self.sources.items() if n != "default" and c.matches(file)), self.sources["default"])
