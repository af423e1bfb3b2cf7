"""Relational tables over JDBC. The driver jar and the credentials come from the cluster's configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_options(
    connection: dict[str, str], table: str, partition_column: str | None = None, lower: int | None = None,
    upper: int | None = None, partitions: int | None = None,
) -> dict[str, str]:
    """Reader options of one table, read in ranges of ``partition_column`` where one is named."""
    options = {**connection, "dbtable": table}
    if partition_column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partitioned read needs lower, upper and partitions")
        options.update(
            partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A fresh scan of a table; filters and column choices are pushed to the database."""
    return spark.read.format("jdbc").options(**options).load()


def max_key_query(table: str, key: str) -> str:
    return f"SELECT COALESCE(MAX({key}), 0) AS max_key FROM {table}"


def read_max_key(spark: SparkSession, connection: dict[str, str], table: str, key: str) -> int:
    """The highest key, computed by the database; 0 for an empty table."""
    options = {**connection, "query": max_key_query(table, key)}
    return int(spark.read.format("jdbc").options(**options).load().first()[0])


def append_rows(rows: DataFrame, options: dict[str, str]) -> None:
    rows.write.format("jdbc").options(**options).mode("append").save()


def max_key(rows: DataFrame, key: str) -> DataFrame:
    """The same scalar over any DataFrame."""
    return rows.agg(F.coalesce(F.max(key), F.lit(0)).alias("max_key"))


def look_up(table: DataFrame, key: str, value: object, *columns: str) -> DataFrame:
    """The rows of one key. Over JDBC the comparison runs in the database."""
    return table.filter(F.col(key) == F.lit(value)).select(*columns)
