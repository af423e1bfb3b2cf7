"""File sources: Parquet streams and tables, delimited dimensions, column-oriented JSON, file metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.schemas import bronze_schema

# Error conditions that mean "there is no table here yet". Anything else is a real failure and is raised.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Newly arrived Parquet files under a declared schema."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_bronze(spark: SparkSession, path: str, precision: int = 10, scale: int = 0) -> DataFrame:
    """The whole Bronze history; files of unfinished batches are left out by the sink's own log."""
    return spark.read.schema(bronze_schema(precision, scale)).parquet(path)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where nothing has been written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if (error.getCondition() or "").startswith(_ABSENT):
            return None
        raise


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Comma-separated rows with a header; texts may be quoted, with quotes doubled inside; an empty value is NULL."""
    options = {"header": "true", "mode": "FAILFAST", "escape": '"'}
    return spark.read.schema(schema).options(**options).csv(path)


def columns_from_json(documents: DataFrame, text: str, columns: dict[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows of column-oriented JSON documents ``{"column": {"index": value}}``.

    ``columns`` names the columns and their types. ``keys`` identify a document when there are several; one document
    is one input row, so a large table should come as many documents.
    """
    parsed = F.from_json(text, "map<string, map<string, string>>")
    cells = documents.select(*keys, F.explode(parsed).alias("_column", "_values")).select(
        *keys, "_column", F.explode("_values").alias("row_index", "_value")
    )
    # All cells of a document start in one task, so the partial aggregation folds a row before it is shuffled.
    return cells.groupBy(*keys, F.col("row_index").cast("bigint").alias("row_index")).agg(
        *[
            F.max(F.when(F.col("_column") == name, F.col("_value"))).cast(kind).alias(name)
            for name, kind in columns.items()
        ]
    )


def read_column_json(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Column-oriented JSON files, one document per file."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file_path"))
    return columns_from_json(files, "value", columns, ["file_path"])


def first_data_file(spark: SparkSession, path: str, suffix: str = ".parquet") -> str | None:
    """Path of the first data file in name order, from the listing alone."""
    if read_if_present(spark, path) is None:
        return None
    listing = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path)
    return listing.agg(F.min("path").alias("path")).first()["path"]


def last_modified_ms(table: DataFrame) -> DataFrame:
    """One row: time of the newest file of a table, in epoch milliseconds."""
    return table.select("_metadata.file_modification_time").agg(
        F.unix_millis(F.max("file_modification_time")).alias("last_modified_ms")
    )
