"""Extract files: discovery, manifest, header audit and the standard load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import typed
from ..functions.derive import years_and_months
from ..functions.staging import staged_text
from ..functions.text import (
    SPACE,
    check_period,
    detect_period,
    file_name,
    fold,
    is_wanted_extract,
    squeeze,
)
from ..operators.relational import settle
from ..presets import EXPECTED_PERIODS, LABOUR_SURVEY
from ..session import compilable
from ..spec import DatasetSpec, FieldSpec, PeriodNaming, RequiredColumnsError
from .layouts import BAD, FILE, Layout, clean_header, find_layouts, raw_header, scan_layout

#: Extract formats the loader reads, by file suffix.
SUFFIXES = (".csv", ".parquet")

#: Fixed value: how many available columns an error message shows.
PREVIEW = 40

_LISTING = "path string, length long, partes long, modificado timestamp, huella long"
PROVENANCE = ("archivo_origen", "periodo_archivo", "anio_archivo", "trimestre_calendario")


# --- discovery ---------------------------------------------------------------


def list_files(
    spark: SparkSession, roots: str | Sequence[str], recursive: bool = True
) -> DataFrame:
    """All extracts below the roots; a missing root is empty.

    Each has its path, length, number of parts, time of the last change and a digest of
    the names, lengths and times of its parts, which tells whether any part changed. An extract is a file, or a folder of part files whose name ends like one; the parts
    count as one extract, and files that start with ``_`` or ``.`` as none. The listing
    source prunes file contents, so nothing is read.
    """
    listings = []
    for root in [roots] if isinstance(roots, str) else list(roots):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
        try:
            listings.append(reader.load(str(root)).select("path", "length", "modificationTime"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not listings:
        return spark.createDataFrame([], _LISTING)
    files = reduce(DataFrame.unionByName, listings)
    folder = F.regexp_extract("path", r"(?i)^(.*?\.(?:csv|parquet))/", 1)
    extract = F.when(folder != "", folder).otherwise(F.col("path"))
    real = files.where(~file_name(F.col("path")).rlike("^[_.]"))
    return real.groupBy(extract.alias("path")).agg(
        F.sum("length").alias("length"),
        F.count("*").alias("partes"),
        F.max("modificationTime").alias("modificado"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("huella"),
    )


def select_extracts(
    listing: DataFrame,
    naming: PeriodNaming = LABOUR_SURVEY.naming,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """Wanted extracts of a listing with their period, in time order.

    Files without a recognisable period come last and carry the reason.
    """
    wanted = listing.where(is_wanted_extract(F.col("path"), naming, tuple(suffixes)))
    return (
        wanted.withColumn("__period", detect_period(F.col("path"), naming))
        .select(*listing.columns, file_name(F.col("path")).alias("archivo"), "__period.*")
        .orderBy(
            F.asc_nulls_last("anio_archivo"),
            F.asc_nulls_last("trimestre_calendario"),
            F.lower("path"),
        )
    )


def find_person_files(
    spark: SparkSession,
    roots: str | Sequence[str],
    *,
    recursive: bool = True,
    suffixes: Sequence[str] = SUFFIXES,
    naming: PeriodNaming = LABOUR_SURVEY.naming,
) -> DataFrame:
    """Extracts below the roots; see :func:`select_extracts`."""
    return select_extracts(list_files(spark, roots, recursive), naming, suffixes)


def ignored_extracts(extracts: DataFrame) -> DataFrame:
    """``(path, archivo, status)`` of wanted extracts whose name gives no single period."""
    return extracts.where(F.col("status") != "ok").select("path", "archivo", "status")


def find_dictionaries(
    listing: DataFrame, naming: PeriodNaming = LABOUR_SURVEY.naming
) -> DataFrame:
    """Companion dictionary files; they are listed and never loaded."""
    name = fold(file_name(F.col("path")))
    wanted = name.contains(naming.exclude_name[0])
    for token in naming.include:
        wanted = wanted & name.contains(token)
    return listing.where(wanted).orderBy("path")


def detect_period_from_filename(spark: SparkSession, path: str) -> dict[str, int | str]:
    """Period of one file name; an unclear name is an error."""
    names = spark.createDataFrame([(str(path),)], "path string")
    found = names.select(detect_period(F.col("path"), LABOUR_SURVEY.naming).alias("p")).first()["p"]
    if found["status"] != "ok":
        raise ValueError(f"no single period in the name {path!r}: {found['status']}")
    return {k: found[k] for k in PROVENANCE[1:]}


def manifest(expected: DataFrame, extracts: DataFrame) -> DataFrame:
    """Expected periods with the file found for each and how many there are."""
    found = (
        extracts.where(F.col("status") == "ok")
        .groupBy("periodo_archivo")
        .agg(F.count("*").alias("n_archivos"), F.min("archivo").alias("archivo"))
    )
    return (
        expected.select(F.col("periodo").alias("periodo"))
        .join(found, F.col("periodo") == F.col("periodo_archivo"), "left")
        .select(
            "periodo",
            "archivo",
            F.col("archivo").isNotNull().alias("encontrado"),
            F.coalesce("n_archivos", F.lit(0)).cast("long").alias("n_archivos"),
        )
        .orderBy("periodo")
    )


def require_complete(table: DataFrame) -> None:
    """Fail when a period has no file or several; partial results are refused.

    All periods are looked at, in one aggregate.
    """
    wrong = table.agg(
        *[
            f(test)
            for test in (F.col("n_archivos") > 1, F.col("n_archivos") == 0)
            for f in (F.count_if, lambda t: F.min(F.when(t, F.col("periodo"))), lambda t: F.max(F.when(t, F.col("periodo"))))
        ]
    ).first()
    for n, low, high, what, error in (
        (*wrong[:3], "more than one extract", ValueError),
        (*wrong[3:], "no extract", FileNotFoundError),
    ):
        if n:
            named = low if n == 1 else f"{n} periods from {low} to {high}"
            raise error(f"{what} for {named}")


# --- headers -----------------------------------------------------------------


def header_audit(headers: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows ``(periodo, archivo, columna)`` to one audit row per file.

    Gives the number of columns, the required ones that are absent and the names
    that collide once whitespace is cleaned.
    """
    names = headers.select("periodo", "archivo", squeeze(F.col("columna")).alias("columna"))
    per_name = names.groupBy("periodo", "archivo", "columna").agg(F.count("*").alias("__n"))
    wanted = F.array(*[F.lit(c) for c in sorted(required)])
    listed = F.collect_set(F.when(F.col("columna").isin(*required), F.col("columna")))
    # Names of one header, as many as a table has columns.
    repeated = F.sort_array(F.collect_set(F.when(F.col("__n") > 1, F.col("columna"))))
    return (
        per_name.groupBy("periodo", "archivo")
        .agg(
            F.sum("__n").alias("columnas_originales"),
            F.array_except(wanted, listed).alias("__missing"),
            repeated.alias("__repeated"),
        )
        .select(
            "periodo",
            "archivo",
            "columnas_originales",
            *[
                F.when(F.size(c) == 0, F.lit("ninguna")).otherwise(F.array_join(c, ", ")).alias(a)
                for c, a in (
                    ("__missing", "columnas_faltantes"),
                    ("__repeated", "columnas_repetidas"),
                )
            ],
        )
        .orderBy("periodo", "archivo")
    )


def read_header(
    spark: SparkSession, path: str, separator: str = ",", multi_line: bool = False
) -> list[str]:
    """Clean column names of one extract."""
    return clean_header(path, raw_header(spark, path, separator, multi_line))


def require_header(path: str, header: Sequence[str], required: Sequence[str]) -> None:
    """Fail when a header lacks required columns, naming related ones it has."""
    absent = [c for c in required if c not in header]
    if not absent:
        return
    stems = tuple({c[:3].upper() for c in required})
    related = [c for c in header if c.upper().startswith(stems)] or list(header)
    more = ", ..." if len(related) > PREVIEW else ""
    raise RequiredColumnsError(
        f"{path}: missing columns {', '.join(absent)}; "
        f"related columns: {', '.join(related[:PREVIEW])}{more}"
    )


# --- load --------------------------------------------------------------------


def standardise(
    staged: DataFrame,
    provenance: Mapping[str, Column],
    spec: DatasetSpec = LABOUR_SURVEY,
    fields: Sequence[FieldSpec] | None = None,
) -> DataFrame:
    """Staged text to the standard typed table, with provenance columns."""
    chosen = spec.fields if fields is None else fields
    table = staged.select(
        *[typed(f, F.col(f"`{f.source}`"), spec.unknown).alias(f.name) for f in chosen],
        *[column.alias(name) for name, column in provenance.items()],
    )
    if spec.duration is None:
        return table
    total, years, months = spec.duration
    if not {years, months} <= set(table.columns):
        return table
    names = [f.name for f in chosen]
    return table.select(
        *names, years_and_months(F.col(years), F.col(months)).alias(total), *provenance
    )


@dataclass(frozen=True)
class LoadedExtracts:
    """The standard table of extracts and what was found on the way."""

    table: DataFrame
    #: (provenance, registro, celdas): rows of another width, as written and as parsed.
    bad_rows: DataFrame
    layouts: tuple[Layout, ...]


def scan_extracts(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    spec: DatasetSpec = LABOUR_SURVEY,
    selected: Sequence[str] | Mapping[str, str] | None = None,
    required: Sequence[str] | None = None,
    metadata: Mapping[str, object] | None = None,
    separator: str = ",",
    multi_line: bool = False,
    keep_bad_rows: bool = True,
) -> LoadedExtracts:
    """Standard table of several extracts, tagged with the period of each.

    An extract is the file of one period, or a folder of part files with one
    layout whose name carries the period. All headers and periods are checked
    before anything is planned. Extracts with the same columns in the same order
    share one scan, whatever their number; the provenance of a row is that of its
    file, looked up in a table of file names. ``metadata`` may supply the period of
    an extract whose name lacks one. With ``multi_line``, quoted CSV cells may hold
    line breaks; such a file is not split. Rows of another width than the header
    are kept apart, or fail the job without ``keep_bad_rows``.
    """
    if not paths:
        raise ValueError("no extracts to load")
    fields = spec.resolve(selected)
    sources = [f.source for f in fields]
    needed = sources if required is None else [" ".join(c.split()) for c in required]
    outside = [c for c in needed if c not in sources]
    if outside:
        raise ValueError(f"required columns are not selected: {', '.join(outside)}")

    periods = extract_periods(compilable(spark), paths, spec.naming, metadata)
    layouts = find_layouts(spark, list(map(str, paths)), separator, multi_line)
    tables, rest = [], []
    for layout in layouts:
        header = clean_header(layout.extracts[0], layout.header)
        require_header(layout.extracts[0], header, needed)
        rows = scan_layout(spark, layout, separator, multi_line, keep_bad_rows)
        files = [(p.file, *[periods[p.extract][name] for name in PROVENANCE]) for p in layout.parts]
        known = spark.createDataFrame(files, _FILES)
        rows = rows.join(known, F.col(FILE) == F.col("__name"))
        provenance = {name: F.col(f"__{name}") for name in PROVENANCE}
        good = rows.where(F.col(BAD).isNull()) if keep_bad_rows and layout.types is None else rows
        staged = good.select(*_staged(layout, header, sources), *provenance.values())
        tables.append(standardise(staged, provenance, spec, fields))
        cells = F.array(*[F.col(f"`{f}`").cast("string") for f in layout.header])
        tags = [column.alias(name) for name, column in provenance.items()]
        rest.append(rows.where(F.col(BAD).isNotNull()).select(*tags, F.col(BAD).alias("registro"), cells.alias("celdas")))
    return LoadedExtracts(harmonised_union(tables), harmonised_union(rest), tuple(layouts))


_FILES = (
    "__name string, __archivo_origen string, __periodo_archivo string, "
    "__anio_archivo int, __trimestre_calendario int"
)


def _staged(layout: Layout, header: Sequence[str], sources: Sequence[str]) -> list[Column]:
    """Text of the wanted columns of a layout; absent ones are null."""
    written = dict(zip(header, layout.header))
    absent = F.lit(None).cast("string")

    def text(source: str) -> Column:
        if source not in written:
            return absent
        kind = T.StringType() if layout.types is None else layout.types[written[source]].dataType
        return staged_text(F.col(f"`{written[source]}`"), kind)

    return [text(c).alias(c) for c in sources]


def load_extracts(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    """The table of :func:`scan_extracts`; a row of another width fails the job."""
    return scan_extracts(spark, paths, keep_bad_rows=False, **options).table


def header_rows(spark: SparkSession, loaded: LoadedExtracts) -> DataFrame:
    """``(periodo, archivo, columna)`` of every extract, for :func:`header_audit`."""
    extracts = [e for layout in loaded.layouts for e in layout.extracts]
    periods = extract_periods(spark, extracts)
    names = [
        (periods[e]["periodo_archivo"], periods[e]["archivo_origen"], column)
        for layout in loaded.layouts
        for e in layout.extracts
        for column in layout.header
    ]
    return spark.createDataFrame(names, "periodo string, archivo string, columna string")


def extract_periods(
    spark: SparkSession,
    paths: Sequence[str],
    naming: PeriodNaming = LABOUR_SURVEY.naming,
    metadata: Mapping[str, object] | None = None,
) -> dict[str, dict[str, object]]:
    """Provenance of each given extract; an unclear or contradicting one is an error."""
    supplied = dict(metadata or {})
    said = [
        F.lit(None if supplied.get(k) is None else str(supplied[k])).cast("string")
        for k in PROVENANCE[1:]
    ]
    names = spark.createDataFrame([(str(p),) for p in paths], "extract string")
    bare = F.regexp_replace("extract", "/+$", "")
    found = names.select("extract", bare.alias("bare"), detect_period(bare, naming).alias("p"))
    values = [
        F.coalesce(F.col(f"p.{name}").cast("string"), s) for name, s in zip(PROVENANCE[1:], said)
    ]
    rows = found.select(
        "extract",
        "p.status",
        check_period(*said, detected=F.col("p")).alias("check"),
        file_name(F.col("bare")).alias("archivo_origen"),
        F.regexp_replace(values[0], SPACE, "").alias("periodo_archivo"),
        F.trim(values[1]).try_cast("int").alias("anio_archivo"),
        F.trim(values[2]).try_cast("int").alias("trimestre_calendario"),
    ).collect()  # one row per extract named by the caller
    for row in rows:
        if row["check"] != "ok":
            why = row["status"] if row["check"] == "undetermined" else row["check"]
            raise ValueError(f"period of {row['extract']}: {why}")
    return {row["extract"]: {name: row[name] for name in PROVENANCE} for row in rows}


def load_person_period(
    spark: SparkSession, path: str, *, metadata: Mapping[str, object] | None = None
) -> DataFrame:
    """Standard table of one labour-survey extract."""
    return load_extracts(spark, [path], metadata=metadata, required=LABOUR_SURVEY.source_columns)


def load_study(
    spark: SparkSession,
    roots: str | Sequence[str],
    expected: Sequence[str] = EXPECTED_PERIODS,
    spec: DatasetSpec = LABOUR_SURVEY,
) -> DataFrame:
    """All expected periods below the roots, or an error naming what is wrong."""
    extracts = settle(find_person_files(spark, roots, naming=spec.naming))
    periods = spark.createDataFrame([(p,) for p in expected], "periodo string")
    require_complete(manifest(periods, extracts))
    wanted = extracts.join(periods, F.col("periodo") == F.col("periodo_archivo"), "left_semi")
    paths = [row["path"] for row in wanted.select("path").collect()]  # one per period
    return load_extracts(spark, paths, spec=spec, required=spec.source_columns)


# --- unions ------------------------------------------------------------------


def harmonised_union(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name; every table must have the same columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), tables)


def sparse_union(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name with absent columns filled by null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
