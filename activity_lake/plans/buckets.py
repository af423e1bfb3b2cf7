"""A table in key buckets, of which a new version rewrites only those that have changed.

    data/version=<n>-<id>/bucket=<b>/   rows of a bucket, as a writer of version n wrote them
    manifests/<n>                       the folder, row count, total and fingerprint of every bucket of version n

Buckets are compared by a fingerprint that does not depend on the order of their rows: row count, sum of the total and sum of
row hashes. A manifest is the commit: it is created as a new file, so that of two writers of one version only one succeeds,
and readers follow the newest one. Folders of buckets that no kept manifest names are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.sinks.hadoop import HadoopFiles

_BUCKET = "bucket"


class BucketStore:
    """Versions of a table whose rows are dealt to ``buckets`` by ``key``; the number must stay the same for a root.

    ``by`` deals otherwise than by hash. ``ignore`` names columns that alone make no change. A manifest has one line a bucket,
    so choose as many as keep a bucket a good file: thousands, not millions. ``total`` of a table is the sum of a count column.
    """

    def __init__(
        self, spark: SparkSession, root: str, key: str, buckets: int = 64, by: Column | None = None, ignore: Sequence[str] = (),
        keep: int = 2,
    ):
        self._spark = spark
        self._root = root
        self._files = HadoopFiles(spark, root)
        self._by = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int") if by is None else by.cast("int")
        self._ignore = tuple(ignore)
        self._keep = max(keep, 1)

    # Manifests

    def _manifest_path(self, version: int) -> str:
        return f"{self._root}/manifests/{version:012d}"

    def versions(self) -> list[int]:
        return sorted(int(name) for name in self._files.names(f"{self._root}/manifests") if name.isdigit())

    def manifest(self, version: int) -> dict:
        """The schema of a version and its buckets: number to folder (below the root), rows, total and fingerprint."""
        return json.loads(self._files.read_text(self._manifest_path(version)))

    # Reading

    def read(self, version: int | None = None) -> DataFrame | None:
        """A version, by default the newest; None where nothing has been written. Lists only the folders of its manifest."""
        known = self.versions()
        if not known:
            return None
        held = self.manifest(known[-1] if version is None else version)
        folders = sorted(f"{self._root}/{entry['folder']}" for entry in held["buckets"].values())
        reader = self._spark.read.schema(held["schema"])
        return reader.parquet(*folders) if folders else self._spark.createDataFrame([], held["schema"])

    def is_published(self) -> bool:
        return bool(self.versions())

    def publish(self) -> str | None:
        """The manifest is the publication; returns its path, None where nothing has been written."""
        known = self.versions()
        return self._manifest_path(known[-1]) if known else None

    def read_published(self, *columns: str) -> DataFrame:
        table = self.read()
        return table.select(*columns) if columns else table

    # Writing

    def fingerprints(self, table: DataFrame, total: str) -> DataFrame:
        """One row a bucket. Partial sums are formed before the shuffle, so large buckets cost no more than small ones."""
        columns = [F.col(f"`{name}`") for name in sorted(table.columns) if name not in self._ignore]
        row_hash = F.xxhash64(*columns, *[column.isNull() for column in columns])
        return table.groupBy(self._by.alias(_BUCKET)).agg(
            F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("total"),
            F.sum(row_hash.cast("decimal(38,0)")).cast("string").alias("row_hash"))

    def write(self, table: DataFrame, total: str) -> dict:
        """Write the next version and say how many rows and what total it has and which buckets were written.

        Without a change there is no new version. The table is computed for the comparison and, if something has changed,
        again for the changed buckets, so hold it if it is dear. Raises FileExistsError if another writer was faster.
        """
        known = self.versions()
        version = (known[-1] if known else -1) + 1
        held = self.manifest(known[-1]) if known else {"schema": None, "buckets": {}}
        schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in table.schema)
        old = held["buckets"] if held["schema"] == schema else {}
        # One row a bucket comes to the driver; how many there are is a setting.
        new = {str(row[_BUCKET]): row.asDict() for row in self.fingerprints(table, total).collect()}
        same = {number for number, row in new.items() if number in old and all(old[number][c] == row[c] for c in ("rows", "total", "row_hash"))}
        changed = sorted(int(number) for number in new if number not in same)
        seen = {"rows": sum(row["rows"] for row in new.values()), "total": sum(row["total"] for row in new.values()), "buckets": changed}
        if known and not changed and set(old) == set(new) and held["schema"] == schema:
            return seen
        # of its own, so that writers of the same version don't touch each other's files
        folder = f"data/version={version}-{uuid.uuid4().hex}"
        if changed:
            rows = table.withColumn(_BUCKET, self._by).filter(F.col(_BUCKET).isin(changed))
            rows.repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self._root}/{folder}")
        entries = {
            number: old[number] if number in same else {
                "folder": f"{folder}/{_BUCKET}={number}", **{c: row[c] for c in ("rows", "total", "row_hash")}}
            for number, row in new.items()}
        if not self._files.create_text(self._manifest_path(version), json.dumps({"schema": schema, "buckets": entries})):
            raise FileExistsError(f"version {version} below {self._root} has been written by someone else")
        self._drop_old()
        return seen

    def _drop_old(self) -> None:
        known = self.versions()
        for version in known[: -self._keep]:
            self._files.delete(self._manifest_path(version))
        named = {entry["folder"] for version in known[-self._keep:] for entry in self.manifest(version)["buckets"].values()}
        for version in self._files.names(f"{self._root}/data"):
            if int(version.removeprefix("version=").split("-")[0]) > known[-1]:
                continue  # somebody is writing it
            folders = [name for name in self._files.names(f"{self._root}/data/{version}") if name.startswith(f"{_BUCKET}=")]
            unused = [name for name in folders if f"data/{version}/{name}" not in named]
            for name in [None] if len(unused) == len(folders) else unused:
                self._files.delete(f"{self._root}/data/{version}" + (f"/{name}" if name else ""))
