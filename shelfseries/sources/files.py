"""CSV and Parquet readers and writers, and the saved forecast tables."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from .schemas import SALES_COLUMNS, SALES_REQUIRED, TITLE_COLUMNS, TITLES_REQUIRED, text_schema

REPLACEMENT = "�"


def _read_csv(spark: SparkSession, paths: list[str], encoding: str, header: bool = True, width: int = 0) -> DataFrame:
    """CSV files as text columns: those their first file names, or ``width`` numbered ones with header lines as rows."""
    reader = spark.read.option("encoding", encoding).option("multiLine", False)
    if not header:
        return reader.schema(text_schema([f"_c{i}" for i in range(width)])).option("header", False).csv(paths)
    names = reader.option("header", True).option("inferSchema", False).csv(paths).columns  # reads one line
    return reader.schema(text_schema(names)).option("header", True).option("enforceSchema", True).csv(paths)


def _plain(uri: str) -> str:
    """The path of a file's URI as a reader takes it: decoded, and without patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def _damaged_files(spark: SparkSession, paths: list[str], encoding: str, width: int) -> set[str]:
    """Files with a line, header lines included, that the encoding does not decode: one scan, a row per such file."""
    lines = _read_csv(spark, paths, encoding, header=False, width=width)
    damaged = F.lit(False)
    for name in lines.columns:
        damaged = damaged | F.coalesce(F.col(name).contains(REPLACEMENT), F.lit(False))
    return {_plain(r[0]) for r in lines.where(damaged).select(F.input_file_name()).distinct().collect()}


def load_csv(
    spark: SparkSession,
    path: str,
    date_columns: tuple[str, ...] = (),
    encodings: tuple[str, ...] = ("UTF-8", "ISO-8859-1", "windows-1252"),
) -> DataFrame:
    """CSV files with headers, all columns text, each file in the first encoding that decodes it.

    A reader never fails on undecodable bytes but yields U+FFFD. One scan finds the files in which that character turns up;
    only these are tried in the next encoding, the last of which takes all that is left. The result is a union of one
    read per encoding, by column name. The files of a folder share their columns.
    """
    whole = _read_csv(spark, [path], encodings[0])
    width, left = len(whole.columns), [path]
    parts = []
    for position, encoding in enumerate(encodings):
        last = position == len(encodings) - 1
        damaged = set() if last else _damaged_files(spark, left, encoding, width)
        files = [path] if not damaged and not position else sorted({_plain(f) for f in _read_csv(spark, left, encoding).inputFiles()} - damaged)
        if files:
            parts.append(_read_csv(spark, files, encoding))
        left = sorted(damaged)
        if not left:
            break
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    for name in date_columns:
        if name in frame.columns:
            frame = frame.withColumn(name, F.try_to_timestamp(F.col(f"`{name}`")))
    return frame


def load_sales(spark: SparkSession, path: str) -> DataFrame:
    """Raw sales transactions; the required columns are checked."""
    return quality.require_columns(load_csv(spark, path), SALES_REQUIRED)


def load_titles(spark: SparkSession, path: str) -> DataFrame:
    """Raw title sales; the required columns are checked."""
    return quality.require_columns(load_csv(spark, path), TITLES_REQUIRED)


def load_table(spark: SparkSession, path: str, date_columns: tuple[str, ...] = ()) -> DataFrame | None:
    """A stored table with its dates typed, or None when it is absent.

    Folders written by ``save`` are Parquet; a ``.csv`` path is read as CSV
    with a header and its numbers inferred.
    """
    try:
        if path.rstrip("/").endswith(".csv"):
            frame = spark.read.option("header", True).option("inferSchema", True).csv(path)
        else:
            frame = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    for name in date_columns:
        if name in frame.columns:
            frame = frame.withColumn(name, F.to_date(F.col(f"`{name}`")))
    return frame


def save(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Write a frame, replacing what is there; parent folders are created."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def export_forecast(forecast: DataFrame, path: str, horizon: int | None = None) -> str:
    """The forecast table as CSV, cut to the first ``horizon`` months when given."""
    if horizon is not None and "step" in forecast.columns:
        forecast = forecast.where(F.col("step") <= horizon)
    return save(forecast, path, fmt="csv")


__all__ = [
    "SALES_COLUMNS", "TITLE_COLUMNS", "export_forecast", "load_csv", "load_sales",
    "load_table", "load_titles", "save",
]
