"""Landing-zone readers.  Every reader takes an explicit schema: no inference
pass over the data, and a stable plan."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityzones.functions.checks import require_not_null
from cityzones.functions.text import patch_quoted_comma, split_fields, strip_char_all
from cityzones.schemas import (
    INCIDENT_FIELDS,
    INCOME_RAW_DDL,
    INCOME_RAW_NAME_KEY,
    RENT_DDL,
    field_names,
)

# Snapshot folders are named YYYY_MM_DD_<anything> (optionally as the value
# of a partition folder, key=YYYY_MM_DD_<anything>), data files part-*.
SNAPSHOT_DATE_PATTERN = r"/(?:[^/=]*=)?(\d+_\d+_\d+)[^/]*/part-[^/]*$"


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema.  A missing key gives null (check it
    with ``require_not_null`` where the source promises it); a value that does
    not fit its declared type fails the job instead of becoming null."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


INCOME_REQUIRED = ["_id", "neigh_name", "district_id", "district_name", "info"]


def read_income(spark: SparkSession, path: str, require_keys: bool = True) -> DataFrame:
    """Raw income series; the trailing-space name key is renamed ``neigh_name``.

    ``require_keys`` fails the job when an object lacks one of the object-level
    keys (the JSON reader cannot tell a missing key from a null, so a null
    fails too); measurement fields inside ``info`` may be null."""
    df = read_json_lines(spark, path, INCOME_RAW_DDL).withColumnRenamed(
        INCOME_RAW_NAME_KEY, "neigh_name")
    return require_not_null(df, INCOME_REQUIRED) if require_keys else df


def path_date_columns(df: DataFrame, path_col: str = "_path", strict: bool = True) -> DataFrame:
    """Add int ``year``, ``month``, ``day`` parsed from the snapshot folder name.

    ``strict`` fails the job on a file outside a ``YYYY_MM_DD_*`` folder;
    otherwise its dates are null."""
    found = F.regexp_extract(F.col(path_col), SNAPSHOT_DATE_PATTERN, 1)
    date = F.split(found, "_")
    parts = {}
    for i, name in enumerate(("year", "month", "day")):
        value = F.get(date, i).try_cast("int")
        if strict:
            value = F.when(found == "", F.raise_error(F.concat(
                F.lit("not in a YYYY_MM_DD_* snapshot folder: "), F.col(path_col)))).otherwise(value)
        parts[name] = value
    return df.withColumns(parts)


def read_snapshots(spark: SparkSession, root: str, schema: str, folders: str = "*",
                   strict_dates: bool = True) -> DataFrame:
    """Every ``root/<YYYY_MM_DD_*>/part-*`` file in one scan with ``schema``,
    plus the snapshot date as int year / month / day columns.

    ``folders`` is a glob over the snapshot folder names (e.g. ``2021_0[1-6]_*``
    or ``{2021_06_*,2021_07_*}``): only matching folders are listed and read."""
    df = (spark.read.schema(schema).option("recursiveFileLookup", "false")
          .parquet(f"{root.rstrip('/')}/{folders}/part-*"))
    cols = [c for c in df.columns if c in set(field_names(schema))]
    with_path = df.select(*cols, F.col("_metadata.file_path").alias("_path"))
    return path_date_columns(with_path, strict=strict_dates).drop("_path")


def read_rent(spark: SparkSession, root: str, folders: str = "*") -> DataFrame:
    """Raw rent listings: the 37 listing fields + year, month, day."""
    return read_snapshots(spark, root, RENT_DDL, folders)


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True,
             infer: bool = False, **options) -> DataFrame:
    """CSV with a header per file.  With ``schema`` no inference pass is run;
    ``infer=True`` reproduces type inference (an extra pass over the data)."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def _permissive_csv(reader, fields: list[str], path: str) -> DataFrame:
    """``fields`` as strings and ``_corrupt``: the raw line where its field count differs, else null."""
    ddl = ", ".join(f"`{f}` string" for f in fields) + ", _corrupt string"
    return (reader.option("header", True).option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("columnNameOfCorruptRecord", "_corrupt").schema(ddl).csv(path))


def strict_csv(reader, fields: list[str], path: str) -> DataFrame:
    """``read_csv_strict`` through any CSV reader (batch or stream)."""
    df = _permissive_csv(reader, fields, path)
    # A data column in the filter: Spark refuses to read the corrupt column alone.
    whole = F.col("_corrupt").isNull() & (F.length(F.coalesce(F.col(fields[0]), F.lit(""))) >= 0)
    return df.where(whole).drop("_corrupt")


def read_csv_marked(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Every line of headered CSV files: ``fields`` as strings, ``file``, and ``line`` = the raw line where its field
    count differs (its fields are then what could be read of it), else null."""
    df = _permissive_csv(spark.read, fields, path)
    first = F.coalesce(F.col(fields[0]), F.lit(""))
    line = F.when(F.length(first) >= 0, F.col("_corrupt"))  # never the corrupt column alone, as above
    return df.select(*fields, F.col("_metadata.file_path").alias("file"), line.alias("line"))


def read_csv_strict(spark: SparkSession, path: str, fields: list[str],
                    check_header: bool = False) -> DataFrame:
    """Headered CSV, all ``fields`` strings; rows with a different field count
    are dropped.  Quoted fields may hold commas.

    The parser always reads every column (``columnPruning`` off): a line's
    field count is then judged alike for any selection and for ``count()``.
    ``check_header`` fails the job where a file's header names other fields."""
    return strict_csv(spark.read.option("enforceSchema", not check_header), fields, path)


def read_csv_naive(spark: SparkSession, path: str, fields: list[str],
                   patch_quoted: bool = False) -> DataFrame:
    """Parity reader: text lines split on every comma.

    Every line equal to the first line read (the header) is removed, in all
    files; ``patch_quoted`` applies the quoted-comma patch first; quotes are
    stripped from both ends of each field; lines that do not give exactly
    ``len(fields)`` fields are dropped.  Empty fields stay ``''``."""
    return parse_csv_naive(spark.read.text(path), fields, patch_quoted)


def parse_csv_naive(lines: DataFrame, fields: list[str], patch_quoted: bool = False) -> DataFrame:
    """The rows of ``read_csv_naive`` from a table of lines (column ``value``)."""
    header = lines.first()
    if header is not None:
        lines = lines.where(F.col("value") != F.lit(header[0]))
    value = patch_quoted_comma("value") if patch_quoted else F.col("value")
    arr = strip_char_all(split_fields(value))
    parsed = lines.select(arr.alias("_f")).where(F.size("_f") == len(fields))
    return parsed.select(*[F.col("_f")[i].alias(f) for i, f in enumerate(fields)])


def read_incidents(spark: SparkSession, path: str, naive_split: bool = False) -> DataFrame:
    """Raw incident rows with the 25 incident fields as strings."""
    if naive_split:
        return read_csv_naive(spark, path, INCIDENT_FIELDS)
    return read_csv_strict(spark, path, INCIDENT_FIELDS)


CSV_FILES = "*.{csv,csv.gz,csv.snappy}"


def csv_headers(spark: SparkSession, folder: str, pattern: str = CSV_FILES) -> dict[str, list[str]]:
    """Files of ``folder`` by their first line.

    Two passes over the first block of every file: the smallest row id per file, numbers only, so a task keeps one
    row per file; then the lines of these ids.  (Text as an aggregate's value, as in ``min_by``, would sort all
    lines.)  The driver gets the list of files, as it does for any read."""
    lines = (spark.read.option("pathGlobFilter", pattern).text(folder)
             .select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
             .where(F.col("_metadata.file_block_start") == 0))
    first = [r["row"] for r in lines.groupBy("file").agg(F.min("row").alias("row")).collect()]
    heads: dict[str, list[str]] = {}
    for r in lines.where(F.col("row").isin(first)).select("value", "file").collect():
        heads.setdefault(r["value"], []).append(r["file"])
    return {head: sorted(files) for head, files in heads.items()}


def read_csv_columns(spark: SparkSession, folder: str, columns: list[str], per_file_header: bool = True,
                     line_breaks: bool = True) -> DataFrame:
    """Named columns of every ``*.csv`` file in ``folder`` (``CSV_FILES``: or compressed),
    each file read by its own header (files may order their columns differently).

    Files are grouped by their header line; each distinct header is one read of
    Spark's CSV reader over the files that have it, and the reads are united by
    name.  Quoted commas, doubled quotes and quoted line breaks are kept; empty
    fields, quoted or not, are null.  A file without one of ``columns`` fails,
    a folder without files gives no rows.  Reading quoted line breaks takes a
    whole file per task: ``line_breaks=False`` splits large files instead.

    ``per_file_header=False`` uses the plain CSV reader, which names columns
    from one header and reads every file by position; a file whose header
    differs then fails the job (``enforceSchema=false``)."""
    if not per_file_header:
        df = (spark.read.option("header", True).option("enforceSchema", False)
              .option("pathGlobFilter", CSV_FILES).csv(folder))
        return df.select(*columns)
    out = None
    for head, files in sorted(csv_headers(spark, folder).items()):
        names = [n.strip("\ufeff") for n in next(csv.reader([head]), [])]
        for c in columns:
            if c not in names:
                raise ValueError(f"column {c} missing in {', '.join(files[:3])}")
        # positions as names: a header may repeat a name in a column nobody asks for
        schema = ", ".join(f"c{i} string" for i in range(len(names)))
        df = (spark.read.schema(schema).option("header", True).option("multiLine", line_breaks)
              .option("quote", '"').option("escape", '"').csv(files))
        found = [F.col(f"c{names.index(c)}") for c in columns]
        df = df.select(*[F.when(v != "", v).alias(c) for v, c in zip(found, columns)])
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    return out
