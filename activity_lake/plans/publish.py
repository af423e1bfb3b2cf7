"""Versions of a table and their publication at one fixed path."""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from activity_lake.sinks.hadoop import HadoopFiles

_LOG = logging.getLogger(__name__)
_VERSION = re.compile(r"version=(\d+)")


LAYOUTS = ("folder", "file")


class SnapshotStore:
    """A table written as a new version each time; readers of a version never see it change.

    The newest version is published at a fixed path, which is always a file, whatever the size of the table. With the layout
    ``folder`` it is a pointer, a line of text naming the version's folder. With ``file`` every version is one data file,
    written by one task, and the fixed path is a copy of it, for readers that expect a single file.
    """

    def __init__(
        self, spark: SparkSession, root: str, layout: str = "folder", published: str | None = None, keep: int = 2,
    ):
        if layout not in LAYOUTS:
            raise ValueError(f"unknown layout {layout!r}")
        self._spark = spark
        self._root = root
        self._files = HadoopFiles(spark, root)
        self._layout = layout
        self.published_path = f"{root}/{published or ('silver_latest.path' if layout == 'folder' else 'silver_latest.parquet')}"
        self._pointer = self.published_path if layout == "folder" else f"{root}/_published_version"
        self._keep = max(keep, 1)

    def _version_path(self, version: int) -> str:
        return f"{self._root}/versions/version={version}"

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        found = [_VERSION.fullmatch(name) for name in self._files.names(f"{self._root}/versions")]
        numbers = sorted(int(match.group(1)) for match in found if match)
        return [number for number in numbers if self._files.exists(f"{self._version_path(number)}/_SUCCESS")]

    def read(self) -> DataFrame | None:
        """The newest complete version, or None."""
        known = self.versions()
        return self._spark.read.parquet(self._version_path(known[-1])) if known else None

    def write(self, table: DataFrame, total: str) -> dict[str, int]:
        """Write the next version; its row count and sum are observed on the way, without a second job."""
        version = max(self.versions(), default=-1) + 1
        seen = Observation(f"version-{version}")
        observed = (table if self._layout == "folder" else table.repartition(1)).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("total")
        )
        observed.write.mode("overwrite").parquet(self._version_path(version))
        self._drop_old()
        return dict(seen.get)

    def _drop_old(self) -> None:
        for number in self.versions()[: -self._keep]:
            self._files.delete(self._version_path(number))

    def publish(self) -> str | None:
        """Put the newest version at the fixed path and return that path; None where there is no version yet.

        Nothing is written if that version is published already, so this also repairs a run that stopped before publication.
        """
        known = self.versions()
        if not known:
            _LOG.warning("nothing to publish below %s", self._root)
            return None
        version = self._version_path(known[-1])
        if self.is_published() and self._files.read_text(self._pointer) == version:
            return self.published_path
        if self._layout == "file":
            part = next(name for name in self._files.names(version) if name.endswith(".parquet"))
            staged = f"{self._root}/_staged"
            self._files.copy_file(f"{version}/{part}", staged)
            self._files.replace_file(staged, self.published_path)
        staged = f"{self._root}/_pointer"
        self._files.write_text(staged, version)
        self._files.replace_file(staged, self._pointer)
        return self.published_path

    def is_published(self) -> bool:
        return self._files.exists(self.published_path)

    def read_published(self, *columns: str) -> DataFrame:
        path = self.published_path if self._layout == "file" else self._files.read_text(self._pointer)
        published = self._spark.read.parquet(path)
        return published.select(*columns) if columns else published
