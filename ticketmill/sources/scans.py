"""Scans of landed files and stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill import schemas

#: Column that holds the text of a line that can't be parsed.
CORRUPT = "_corrupt"


def source_position() -> Column:
    """Order of rows in their source, for a DataFrame read straight from files: older files first,
    then by place in the file.

    The block orders the splits of a file, the increasing id the rows inside a split. The id alone
    would not do: Spark hands out splits by size. The path is hashed, since it only has to tell
    files of one age apart and would otherwise travel with every row.
    """
    return F.struct(
        F.unix_micros("_metadata.file_modification_time").alias("landed"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns of the header in its order: declared ones with their types, others as text."""
    header = spark.read.option("header", True).csv(path).columns
    missing = [name for name in schemas.RAW_CITATIONS.names if name not in header]
    if missing:
        raise ValueError(f"{path}: the header lacks {missing}")
    types = {f.name: f.dataType for f in schemas.RAW_CITATIONS}
    return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header])


def _scan(
    spark: SparkSession, path: str, fmt: str, mode: str, timestamp_format: str | None
) -> DataFrame:
    """Declared columns by name, with a source position, and CORRUPT where lines may be."""
    schema = _csv_schema(spark, path) if fmt == "csv" else schemas.RAW_CITATIONS
    names = schemas.RAW_CITATIONS.names
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
        names = [*names, CORRUPT]
    reader = spark.read.schema(schema).format(fmt)
    if fmt in ("csv", "json"):
        reader = reader.option("mode", mode).option("columnNameOfCorruptRecord", CORRUPT)
        if timestamp_format:
            reader = reader.option("timestampNTZFormat", timestamp_format)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return (
        reader.load(path)
        .withColumn(schemas.SEQ, source_position())
        .select(*(F.col(f"`{n}`") for n in names), schemas.SEQ)
        .withColumnRenamed(schemas.ID_HEADER, schemas.CITATION_KEY)
    )


def read_citations(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    mode: str = "FAILFAST",
    timestamp_format: str | None = None,
) -> DataFrame:
    """Raw citations with a source position. A missing path, a missing column or an unparsable value is
    an error.

    The id is declared a string, so long numeric ids keep every digit, and only its header is
    tidied. All other names and values stay as they are. CSV columns go by the names in the header, in
    any order, the same in all files; further columns are ignored.
    """
    return _scan(spark, path, fmt, mode, timestamp_format)


def read_quarantined(
    spark: SparkSession, path: str, fmt: str = "csv", timestamp_format: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(raw citations, damaged lines): as read_citations(), but a line that can't be parsed ends up in
    the second frame, as text under CORRUPT with its source position, instead of ending the job."""
    rows = _scan(spark, path, fmt, "PERMISSIVE", timestamp_format)
    # Spark parses no more columns than a query uses, and finds no damage in others: the condition is
    # true for every row, but needs all of them.
    names = [c for c in rows.columns if c not in (CORRUPT, schemas.SEQ)]
    rows = rows.filter(F.xxhash64(*(F.col(f"`{n}`") for n in names)) % 2 < 2)
    damaged = F.col(CORRUPT).isNotNull()
    return rows.filter(~damaged).drop(CORRUPT), rows.filter(damaged).select(CORRUPT, schemas.SEQ)


def read_payloads(
    spark: SparkSession, path: str, multi_line: bool = False, quarantine: bool = False
) -> DataFrame:
    """Daily weather payloads laid out as <path>/campus=<name>/<file>.json.

    One scan reads every campus; the directory name becomes the campus column. A payload is one
    line, as the service sends it; other layouts fail. With `multi_line` each file holds a single
    payload, spread over any number of lines. With `quarantine` nothing fails: what can't be parsed is a
    row without a payload and with its text under CORRUPT.
    """
    campus = T.StructField("campus", T.StringType())
    corrupt = [T.StructField(CORRUPT, T.StringType())] if quarantine else []
    return (
        spark.read.schema(T.StructType([*schemas.WEATHER_PAYLOAD, *corrupt, campus]))
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE" if quarantine else "FAILFAST")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .withColumn(schemas.SEQ, source_position())
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table in the column order of its contract (partition columns are read last)."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
