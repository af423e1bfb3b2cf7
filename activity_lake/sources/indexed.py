"""Tables laid out for lookups of single keys.

Rows are range-partitioned and sorted by the key, so that a file, a row group and a page each hold a short range of keys,
and columns that are not sorted get a Bloom filter. A lookup then opens the files whose range or filter can hold the key
and reads single pages of them: Spark pushes the comparison to the scan, which uses the statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_ROWS = 1_000
#: So many keys are compared in the scan itself; more are joined, which reads the table.
KEYS_IN_SCAN = 1_000


def write_indexed(rows: DataFrame, path: str, key: str, bloom: Sequence[str] = (), partitions: int | None = None,
                  page_rows: int = PAGE_ROWS, mode: str = "error") -> None:
    """Write a table for lookups by ``key``, and by the columns in ``bloom``."""
    ranged = rows.repartitionByRange(key) if partitions is None else rows.repartitionByRange(partitions, key)
    writer = ranged.sortWithinPartitions(key).write.mode(mode).option("parquet.page.row.count.limit", page_rows)
    for column in (key, *bloom):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def look_up_keys(table: DataFrame, key: str, values: Sequence[object]) -> DataFrame:
    """The rows of some keys; NULL is no key."""
    wanted = [value for value in dict.fromkeys(values) if value is not None]
    if len(wanted) <= KEYS_IN_SCAN:
        return table.filter(F.col(key).isin(wanted))
    keys = table.sparkSession.createDataFrame([(value,) for value in wanted], table.select(key).schema)
    return table.join(keys, key, "left_semi").select(*table.columns)


def rows_scanned(rows: DataFrame) -> int:
    """Compute the rows and say how many the file scans delivered, of those that a scan's statistics let through."""
    rows.collect()
    leaves = rows._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(at).metrics().get("numOutputRows") for at in range(leaves.size())]
    return sum(metric.get().value() for metric in metrics if metric.isDefined())


def read_indexed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
