"""Quality suites kept batch by batch, equal to a suite over all rows.

    rows/batch=<n>/          counts of the expectations about single rows
    keys-<i>/batch=<n>/      rows per key of expectation i, for unique keys and for references
    .../upto=<n>/            the same of all batches up to n, once folded

Counts add up, and so do rows per key: whether a key is unique or has a parent is decided when the results are read, from the
counts of all batches and the parents of that time. A batch handed over again overwrites what it wrote, or is left out
if it has been folded.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.operators.quality import _RESULT, _label, _row_results, judged
from activity_lake.sinks.hadoop import HadoopFiles

_COUNTS = ("element_count", "missing_count", "unexpected_count")
_FOLDER = re.compile(r"(batch|upto)=(\d+)")


class SuiteState:
    """State of one suite below ``root``; the expectations and their order must stay the same."""

    def __init__(self, spark: SparkSession, root: str, expectations: Sequence, fold_after: int = 16):
        self._spark = spark
        self._root = root
        self._files = HadoopFiles(spark, root)
        self._fold_after = fold_after
        self._by_row = [item for item in expectations if hasattr(item, "unexpected")]
        self._by_key = [item for item in expectations if not hasattr(item, "unexpected")]

    def _folders(self, part: str) -> tuple[int, list[str]]:
        """The last batch that has been folded, -1 for none, and the folders that together hold all batches."""
        found = [match for match in map(_FOLDER.fullmatch, self._files.names(f"{self._root}/{part}")) if match]
        done = [match for match in found if self._files.exists(f"{self._root}/{part}/{match[0]}/_SUCCESS")]
        upto = max((int(match[2]) for match in done if match[1] == "upto"), default=-1)
        kept = [match[0] for match in done if (match[1] == "upto") == (int(match[2]) <= upto) and int(match[2]) >= upto]
        return upto, [f"{self._root}/{part}/{name}" for name in sorted(kept)]

    def _stored(self, part: str) -> DataFrame | None:
        _, folders = self._folders(part)
        return reduce(DataFrame.unionByName, map(self._spark.read.parquet, folders)) if folders else None

    def _parts(self) -> list[tuple[str, tuple[str, ...], tuple[str, ...]]]:
        """Name, key columns and counts of every part of the state."""
        rows = [("rows", ("expectation", "column_name", "parameters"), _COUNTS)] if self._by_row else []
        return rows + [(f"keys-{at}", item.columns, ("_rows",)) for at, item in enumerate(self._by_key)]

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of rows."""
        made = {"rows": lambda: _row_results(batch, self._by_row)}
        made.update({f"keys-{at}": lambda item=item: item.key_counts(batch) for at, item in enumerate(self._by_key)})
        for part, _, _ in self._parts():
            upto, folders = self._folders(part)
            if batch_id <= upto:
                continue
            made[part]().write.mode("overwrite").parquet(f"{self._root}/{part}/batch={batch_id}")
            if len(folders) >= self._fold_after:
                self.fold(part, batch_id)

    def fold(self, part: str, batch_id: int) -> None:
        """Add up one part's batches so far. What the last fold was made of stays until the next, for readers in the middle."""
        previous, _ = self._folders(part)
        _, keys, counts = next(x for x in self._parts() if x[0] == part)
        total = self._stored(part).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))
        total.write.mode("overwrite").parquet(f"{self._root}/{part}/upto={batch_id}")
        for name in self._files.names(f"{self._root}/{part}"):
            match = _FOLDER.fullmatch(name)
            if match and int(match[2]) < previous + (match[1] == "batch"):
                self._files.delete(f"{self._root}/{part}/{name}")

    def results(self, suite: str = "suite") -> DataFrame:
        """One row per expectation over all batches, as ``run_suite`` gives it for all rows."""
        found = []
        for part, keys, counts in self._parts():
            stored = self._stored(part)
            if stored is None:
                raise ValueError(f"no batch has been taken in below {self._root}")
            total = stored.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))
            item = None if part == "rows" else self._by_key[int(part.removeprefix("keys-"))]
            found.append(total if item is None else _label(item.of_counts(total), item))
        return judged(reduce(DataFrame.unionByName, [rows.select(*_RESULT) for rows in found]), suite)
