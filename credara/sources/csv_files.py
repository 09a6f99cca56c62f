"""Monthly credit files: CSV in, failure log and generated data out."""

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

from credara.schemas import NA_TOKENS, RAW_COLUMNS
from credara.sources import csv_records
from credara.sources.workspace import Workspace

_BROKEN = "_linea_mala"
_FORMAT = {"quote": '"', "escape": '"', "encoding": "UTF-8"}


def _options(reader):
    return reader.option("header", True).options(**_FORMAT)


def header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names of a file or folder; every credit column must be there once, others may be."""
    names = _options(spark.read).csv(path).columns
    missing = [c for c in RAW_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"{path}: columns missing or repeated: {', '.join(missing)}")
    return names


def blank_na(df: DataFrame) -> DataFrame:
    """NA spellings become NULL, as an NA-detecting CSV reader does."""
    tokens = ", ".join(f"'{t}'" for t in NA_TOKENS)
    return df.withColumns({c: F.expr(f"CASE WHEN {c} NOT IN ({tokens}) THEN {c} END") for c in RAW_COLUMNS})


def file_lines(reader: DataFrameReader, path: str | list[str]) -> DataFrame:
    """Lines of credit files with the split each was read from, of a batch or a stream; ``number_rows`` makes rows."""
    return csv_records.lines(reader, path)


def number_rows(ws: Workspace, lines: DataFrame, per_file: bool, columns: list[str] | None = None) -> DataFrame:
    """Credit columns and ``fila``, the row number with the header as row 1; a record of several lines is one row.

    All columns are text, found under ``columns``, the order they have in the files; doubled quotes inside quoted fields
    stand for one. A file whose header has other names or another order fails, and so do records with too few or too
    many fields and quotes that are never closed.
    """
    found = csv_records.records(ws, csv_records.landed(ws, lines))
    rows = csv_records.parsed(found, columns or RAW_COLUMNS, _FORMAT, _BROKEN)
    number = F.col(csv_records.NUMBER)
    if per_file:
        name = F.element_at(F.split(csv_records.FILE, "/"), -1).alias("archivo")
        return rows.select(*RAW_COLUMNS, name, number.cast("bigint").alias("fila"))
    return rows.select(*RAW_COLUMNS, (number + F.col(csv_records.BASE)).cast("bigint").alias("fila"))


def read_credits(ws: Workspace, path: str | list[str], na_tokens: bool = True, per_file: bool = False) -> DataFrame:
    """Raw credits with ``fila``.

    ``na_tokens``: NA spellings become NULL. ``per_file``: number each file on its own and keep its name in
    ``archivo``; otherwise the files are one sequence in name order. Columns are found by their header names; all
    files of one call must have them in the same order. Quoted fields may hold line breaks.
    """
    numbered = number_rows(ws, file_lines(ws.spark.read, path), per_file, header(ws.spark, path))
    return blank_na(numbered) if na_tokens else numbered


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with header, replaced if present; values keep their blanks."""
    writer = _options(df.write.mode("overwrite"))
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
