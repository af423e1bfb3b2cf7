"""Compaction of tables that grow by small files, under a snapshot log that readers follow.

    segments/<n>-<id>/   rows of many small files in few large ones
    covered/<n>-<id>     names of the source files whose rows a segment has
    log/<n>              the segments that make up snapshot n, each with its list of covered files

The source stays as it is: a stream goes on appending to it, and readers of it see nothing change. A reader of the compacted
table takes the newest snapshot's segments and the source files that none of them covers. A snapshot is committed by creating
its log file, which one of several compactors can; its files are complete by then. Files that only an older snapshot named
are removed one snapshot later, so a reader in the middle keeps what it has listed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from activity_lake.sinks.hadoop import HadoopFiles
from activity_lake.sources.files import read_if_present

TARGET_BYTES = 128 << 20
#: Segments of a snapshot before they are rewritten as one.
MOST_SEGMENTS = 8


class CompactedTable:
    """A Parquet table ``source`` and what has been compacted of it below ``root``.

    The source may be the folder of a streaming sink, whose own log says which files are complete, or of batch appends.
    """

    def __init__(self, spark: SparkSession, source: str, root: str, schema: T.StructType, min_files: int = 16, target_bytes: int = TARGET_BYTES):
        self._spark = spark
        self._source = source
        self._root = root
        self._schema = schema
        self._files = HadoopFiles(spark, root)
        self._min_files = min_files
        self._target = target_bytes

    # The log

    def snapshots(self) -> list[int]:
        return sorted(int(name) for name in self._files.names(f"{self._root}/log") if name.isdigit())

    def _segments(self, snapshot: int | None) -> list[str]:
        """Names of the segments of a snapshot."""
        if snapshot is None:
            return []
        return json.loads(self._files.read_text(f"{self._root}/log/{snapshot:012d}"))

    def _covered(self, segments: list[str]) -> set[str]:
        return {name for segment in segments for name in self._files.read_text(f"{self._root}/covered/{segment}").split("\n") if name}

    def _source_files(self) -> list[str]:
        """The complete files of the source: names only, as a scan would list them."""
        table = read_if_present(self._spark, self._source)
        return sorted(table.inputFiles()) if table is not None else []

    # Reading

    def read(self) -> DataFrame:
        """All rows of the source, most of them from segments."""
        known = self.snapshots()
        segments = self._segments(known[-1] if known else None)
        covered = self._covered(segments)
        fresh = [name for name in self._source_files() if name not in covered]
        paths = [f"{self._root}/segments/{segment}" for segment in segments]
        reader = self._spark.read.schema(self._schema)
        parts = [reader.parquet(*some) for some in (paths, fresh) if some]
        if not parts:
            return self._spark.createDataFrame([], self._schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def file_count(self) -> int:
        """Files that a reader opens now."""
        return len(self.read().inputFiles())

    # Compacting

    def compact(self) -> bool:
        """Add a segment of the small files that have come since the last one, if there are enough; False if nothing was done.

        Also rewrites the segments as one when they have become many. If another compactor commits first, this one's files are
        not named by any snapshot, and it starts anew the next time.
        """
        known = self.snapshots()
        last = known[-1] if known else None
        segments = self._segments(last)
        covered = self._covered(segments)
        fresh = [name for name in self._source_files() if name not in covered]
        if len(fresh) < self._min_files:
            return False
        merged = len(segments) >= MOST_SEGMENTS
        paths = [f"{self._root}/segments/{segment}" for segment in segments] if merged else []
        number = (last if last is not None else -1) + 1
        name = f"{number}-{uuid.uuid4().hex}"
        size = sum(map(self._files.size, [*paths, *fresh]))
        reader = self._spark.read.schema(self._schema)
        rows = reader.parquet(*fresh) if not paths else reader.parquet(*paths).unionByName(reader.parquet(*fresh))
        rows.repartition(max(-(-size // self._target), 1)).write.parquet(f"{self._root}/segments/{name}")
        self._files.write_text(f"{self._root}/covered/{name}", "\n".join([*fresh, *(sorted(covered) if merged else [])]))
        entry = [name] if merged else [*segments, name]
        if not self._files.create_text(f"{self._root}/log/{number:012d}", json.dumps(entry)):
            return False
        self._drop_old(number)
        return True

    def _drop_old(self, number: int) -> None:
        """Remove what neither this snapshot nor the one before names; files of compactors that have not committed stay."""
        named = {segment for snapshot in self.snapshots()[-2:] for segment in self._segments(snapshot)}
        for folder in ("segments", "covered"):
            for name in self._files.names(f"{self._root}/{folder}"):
                if int(name.split("-")[0]) < number and name not in named:
                    self._files.delete(f"{self._root}/{folder}/{name}")
        for snapshot in self.snapshots()[:-2]:
            self._files.delete(f"{self._root}/log/{snapshot:012d}")
