"""CSV files of readings: 12 columns by position, lenient values, strict shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.scalars import (
    format_float,
    format_rfc3339nano,
    parse_rfc3339,
    parse_value,
    trim_text,
)
from gaugeline.schemas import READING_COLUMNS, ZERO_TIME
from gaugeline.sources.csv_splits import csv_records

_RECORD = "_corrupt_record"
_RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in [*READING_COLUMNS, _RECORD]]
)


def _options(multi_line: bool) -> dict[str, str]:
    return {
        "header": "true",
        "quote": '"',
        "escape": '"',
        "multiLine": str(multi_line).lower(),
        "ignoreLeadingWhiteSpace": "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _RECORD,
        # Field counts are only checked when every column is parsed.
        "columnPruning": "false",
    }


def field_count(record: Column) -> Column:
    """Fields of a raw CSV record, separators inside quotes not counted."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return F.size(F.split(bare, ","))


def _is_short(wanted: int) -> Column:
    """A flagged record is either too short, or longer than needed, which is allowed.

    Spark refuses queries on nothing but the corrupt-record column, such as a count of the
    good rows, so the always true length of a data column is part of the condition.
    """
    record = F.col(_RECORD)
    flagged = record.isNotNull() & (F.coalesce(F.length(READING_COLUMNS[0]), F.lit(0)) > -1)
    return flagged & (field_count(record) < wanted)


def _typed(raw: DataFrame) -> DataFrame:
    columns = []
    for c in READING_COLUMNS:
        text = trim_text(F.coalesce(F.col(c), F.lit("")))
        if c == "timestamp":
            text = parse_rfc3339(text)
        elif c == "value":
            text = parse_value(text)
        columns.append(text.alias(c))
    return raw.select(*columns)


def _readings(raw: DataFrame, mode: str, wanted: int = len(READING_COLUMNS)) -> DataFrame:
    short = _is_short(wanted)
    if mode == "quarantine":
        return _typed(raw.filter(~short))
    if mode == "strict":
        failure = F.raise_error(
            F.concat(F.lit(f"expected {wanted} fields: "), F.col(_RECORD))
        ).cast("string")
        # A filter, so that the check is made whatever columns are read in the end.
        return _typed(raw.filter(F.when(short, failure).isNull()))
    raise ValueError(f"mode must be 'quarantine' or 'strict', not {mode!r}")


def _raw(
    spark: SparkSession, path: str | list[str], by_header: bool, multi_line: bool | str
) -> tuple[DataFrame, int]:
    """The text columns with the record of flagged rows, and how many fields a record needs."""
    if multi_line == "split":
        if by_header:
            raise ValueError("files are split by position only")
        kinds = ", ".join(f"{f.name} string" for f in _RAW_SCHEMA)
        parsed = F.from_csv("record", kinds, {k: v for k, v in _options(True).items() if k != "header"})
        return csv_records(spark, path).select(F.inline(F.array(parsed))), len(READING_COLUMNS)
    reader = spark.read.options(**_options(multi_line))
    if not by_header:
        return reader.schema(_RAW_SCHEMA).csv(path), len(READING_COLUMNS)
    header = spark.read.options(**_options(multi_line)).csv(path).columns
    named = {c.strip().lower().replace("_", ""): i for i, c in enumerate(header) if c != _RECORD}
    missing = [c for c in READING_COLUMNS if c.replace("_", "") not in named]
    if missing:
        raise ValueError(f"columns missing from the header: {', '.join(missing)}")
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in header if c != _RECORD]
        + [T.StructField(_RECORD, T.StringType())]
    )
    # enforceSchema=false: a file whose header differs from the first one's is an error.
    raw = reader.option("enforceSchema", "false").schema(schema).csv(path)
    picked = raw.select(
        *[F.col(f"`{header[named[c.replace('_', '')]]}`").alias(c) for c in READING_COLUMNS],
        _RECORD,
    )
    return picked, len(schema) - 1


def read_telemetry_csv(
    spark: SparkSession,
    path: str | list[str],
    by_header: bool = False,
    mode: str = "quarantine",
    multi_line: bool | str = True,
) -> DataFrame:
    """Readings of CSV files, each with a header line.

    Columns count by position, or by header name (ignoring case and ``_``) with
    ``by_header``. Records with fewer than 12 fields fail the read in ``strict`` mode, which
    also wants at least one data row, or are left to :func:`read_rejected_csv`. Quoted line
    breaks need ``multi_line``, which reads each file in one task. Big files are split over many tasks with
    ``multi_line="split"``, which reads them twice, or without it, if no field has a line break.
    """
    raw, wanted = _raw(spark, path, by_header, multi_line)
    readings = _readings(raw, mode, wanted)
    if mode == "strict" and raw.isEmpty():
        raise ValueError(f"csv {path!r} contains no data rows")
    return readings


def read_rejected_csv(
    spark: SparkSession, path: str | list[str], by_header: bool = False, multi_line: bool | str = True
) -> DataFrame:
    """The records :func:`read_telemetry_csv` sets aside, with their file and field count; split files are not named."""
    raw, wanted = _raw(spark, path, by_header, multi_line)
    record = F.col(_RECORD)
    return raw.filter(_is_short(wanted)).select(
        (F.lit("") if multi_line == "split" else F.input_file_name()).alias("file"),
        record.alias("record"),
        field_count(record).alias("fields"),
    )


def stream_telemetry_csv(
    spark: SparkSession,
    folder: str,
    max_files_per_trigger: int | None = None,
    mode: str = "quarantine",
    multi_line: bool = True,
) -> DataFrame:
    """Readings of the CSV files that arrive in a folder."""
    reader = spark.readStream.schema(_RAW_SCHEMA).options(**_options(multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _readings(reader.csv(folder), mode)


def csv_texts(df: DataFrame) -> DataFrame:
    """Readings as the 12 texts a CSV file holds, in file order."""
    columns = []
    for c in READING_COLUMNS:
        if c == "timestamp":
            zero = F.lit(ZERO_TIME).cast("timestamp")  # what telemetry holds for no time
            text = format_rfc3339nano(F.nullif(F.col(c), zero))
        elif c == "value":
            text = format_float(F.coalesce(F.col(c), F.lit(0.0)))
        else:
            text = F.coalesce(F.col(c), F.lit(""))
        columns.append(text.alias(c))
    return df.select(*columns)


def write_telemetry_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write readings; the files appear only once the job has committed."""
    (
        csv_texts(df).write.mode(mode)
        .options(
            header="true", quote='"', escape='"', emptyValue="", nullValue="",
            ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        )
        .csv(path)
    )
