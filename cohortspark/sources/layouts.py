"""Layouts of extract files: which files have which columns, and one scan for each layout."""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How CSV extracts are read: quotes are doubled inside quoted cells.
CSV = {"quote": '"', "escape": '"'}

#: Columns of a scan besides those of the files; no header has such names.
FILE, BAD = "__file", "__bad_row"

_WHOLE_FILES = str(1 << 50)


@dataclass(frozen=True)
class Part:
    """A file of an extract; ``file`` is its name in the scans' metadata."""

    extract: str
    path: str
    file: str


@dataclass(frozen=True)
class Layout:
    """Parts with the same columns in the same order, as written in their headers."""

    header: tuple[str, ...]
    parts: tuple[Part, ...]
    types: T.StructType | None = None  # of Parquet files

    @property
    def extracts(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(p.extract for p in self.parts))


def _bare(path: str) -> str:
    return re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", path).rstrip("/")


def _is_parquet(path: str) -> bool:
    return path.lower().rstrip("/").endswith(".parquet")


def part_files(spark: SparkSession, extracts: Sequence[str]) -> list[Part]:
    """The files of each extract, a file or a folder; one listing, nothing is read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    rows = listing.load([str(e) for e in extracts]).where("length > 0")
    found = rows.select("path", F.col("_metadata.file_path").alias("file")).collect()  # names only
    owners = {_bare(str(e)): str(e) for e in extracts}
    parts = []
    for row in found:
        name = _bare(row["path"])
        # the extract is the longest given path that the file is, or lies below
        own = [k for k in owners if f"{name}/".startswith(f"{k}/") or (not k.startswith("/") and f"/{k}/" in f"{name}/")]
        if own:
            parts.append(Part(owners[max(own, key=len)], row["path"], row["file"]))
    return sorted(parts, key=lambda p: p.path)


def first_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """The first line of every text file, from one job with a task for each file.

    Python workers take a partition to its end whatever they need of it, so later lines
    are passed over before any line leaves the scan.
    """
    session = spark.newSession()  # settings of its own: files are neither split nor packed
    for name in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{name}", _WHOLE_FILES)
    lines = session.read.text(list(files)).select(F.col("_metadata.file_path").alias("file"), "value")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within its file
    found = lines.withColumn("__place", place).where(F.col("__place") == 0)
    return {row["file"]: row["value"] for row in found.collect()}  # one for each file


def csv_names(line: str, separator: str = ",") -> list[str] | None:
    """Names in a header line; none when a quoted name goes on in the next line."""
    if line.count('"') % 2:
        return None
    return next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")], delimiter=separator), [])


def clean_header(path: str, raw: Sequence[str]) -> list[str]:
    """Names with single blanks; repeated ones are an error."""
    names = [" ".join(name.split()) for name in raw]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"{path}: repeated headers {', '.join(repeated)}")
    return names


def raw_header(spark: SparkSession, path: str, separator: str = ",", multi_line: bool = False) -> list[str]:
    """Column names of one extract as they are written: a header row or a footer."""
    if _is_parquet(path):
        return spark.read.parquet(path).columns
    row = spark.read.options(sep=separator, multiLine=multi_line, **CSV).csv(path).first()
    names = ["" if cell is None else cell for cell in row or ()]
    return [name.removeprefix("\ufeff") for name in names]


def find_layouts(
    spark: SparkSession, extracts: Sequence[str], separator: str = ",", multi_line: bool = False
) -> list[Layout]:
    """The layouts of all files of the extracts.

    Headers of CSV files come from one job over all of them, schemas of Parquet extracts
    from their footers. Extracts may differ in layout; the CSV parts of one may not.
    """
    parts = part_files(spark, extracts)
    bare = set(map(str, extracts)) - {p.extract for p in parts}
    if bare:
        raise ValueError(f"no rows and no header in {', '.join(sorted(bare))}")
    text = [p for p in parts if not _is_parquet(p.extract) and not _is_parquet(p.path)]
    lines = first_lines(spark, [p.path for p in text]) if text else {}
    groups: dict[tuple, list[Part]] = {}
    headers: dict[str, tuple[str, ...]] = {}
    for part in text:
        names = csv_names(lines.get(part.file, ""), separator)
        header = tuple(raw_header(spark, part.path, separator, multi_line) if names is None else names)
        if not header:
            raise ValueError(f"{part.path}: no header")
        if headers.setdefault(part.extract, header) != header:
            raise ValueError(f"{part.path}: its header is not the one of other parts of {part.extract}")
        groups.setdefault((header, None), []).append(part)
    read, by_extract = {p.path for p in text}, {}
    for part in parts:
        if part.path not in read:
            by_extract.setdefault(part.extract, []).append(part)
    for some in by_extract.values():
        schema = spark.read.option("mergeSchema", True).parquet(*[p.path for p in some]).schema
        groups.setdefault((tuple(schema.names), schema.json()), []).extend(some)
    return [
        Layout(header, tuple(some), T.StructType.fromJson(json.loads(schema)) if schema else None)
        for (header, schema), some in groups.items()
    ]


def scan_layout(
    spark: SparkSession, layout: Layout, separator: str = ",", multi_line: bool = False, keep_bad_rows: bool = False
) -> DataFrame:
    """One scan of all files of a layout, with the file of each row.

    Every cell of a CSV row is looked at, whatever columns are selected later, so that
    rows with too few or too many cells never pass: they end the job, or with
    ``keep_bad_rows`` carry their text in a column of its own.
    """
    paths = [p.path for p in layout.parts]
    source = F.col("_metadata.file_path").alias(FILE)
    if layout.types is not None:
        rows = spark.read.schema(layout.types).parquet(*paths)
        return rows.select("*", source, F.lit(None).cast("string").alias(BAD))
    cells = [T.StructField(name, T.StringType()) for name in layout.header]
    options = {"header": True, "sep": separator, "enforceSchema": False, "multiLine": multi_line, "columnPruning": False}
    if not keep_bad_rows:
        rows = spark.read.schema(T.StructType(cells)).options(**options, mode="FAILFAST", **CSV).csv(paths)
        return rows.select("*", source, F.lit(None).cast("string").alias(BAD))
    schema = T.StructType([*cells, T.StructField(BAD, T.StringType())])
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    rows = spark.read.schema(schema).options(**options, **CSV).csv(paths).select("*", source)
    # true for all rows: the reader refuses plans in which only the bad rows' text is used
    return rows.where(F.length(F.coalesce(F.col(f"`{layout.header[0]}`"), F.lit(""))) >= 0)
