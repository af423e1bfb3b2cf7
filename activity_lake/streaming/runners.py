"""The streams of the pipeline: topic to Bronze, Bronze to Silver, topic to messages, snapshot to metrics."""

from __future__ import annotations

import logging
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from activity_lake.config import METRICS_INTERVAL, TRIGGER_INTERVAL, LakePaths, MobilityRules
from activity_lake.operators import notify
from activity_lake.operators.bronze import parse_changes, to_bronze
from activity_lake.operators.current_state import grand_total, live_counts
from activity_lake.operators.delivery import Delivery
from activity_lake.operators.lookup import DistanceCache, Resolver
from activity_lake.operators.metrics import append_gauges, gauges, run_log
from activity_lake.plans.buckets import BucketStore
from activity_lake.plans.gate import is_changed
from activity_lake.plans.publish import SnapshotStore
from activity_lake.plans.silver import COUNT, LINEAGE, resolve_commutes, silver_table, with_commutes
from activity_lake.schemas import bronze_schema
from activity_lake.sinks.hadoop import HadoopFiles
from activity_lake.sinks.streams import append_parquet, each_batch
from activity_lake.sources.files import read_bronze, stream_parquet
from activity_lake.streaming.incremental import IncrementalCounts
from activity_lake.streaming.replay import once_per_position

ReadTable = Callable[[], DataFrame]

_LOG = logging.getLogger(__name__)
_KEPT_RUNS = 100


def start_bronze(
    topic: DataFrame, paths: LakePaths, interval: str | None = TRIGGER_INTERVAL, by_day: bool = False,
    precision: int = 10, scale: int = 0, replay_within: str | None = None,
) -> StreamingQuery:
    """Decode a topic into Bronze, rejects included; ``by_day`` stores it in a folder per broker day.

    ``precision`` and ``scale`` are those of the distance; whoever reads this Bronze must name the same. With
    ``replay_within`` positions that the topic delivers again are left out, see ``once_per_position``.
    """
    rows = to_bronze(topic, precision, scale)
    if replay_within is not None:
        rows = once_per_position(rows, replay_within)
    if not by_day:
        return append_parquet(rows, paths.bronze, paths.checkpoint("bronze"), interval)
    rows = rows.withColumn("ingest_date", F.to_date("kafka_ts"))
    return append_parquet(rows, paths.bronze, paths.checkpoint("bronze"), interval, ["ingest_date"])


class SilverRefresh:
    """Handler of Bronze micro-batches. A batch is only the trigger: the table follows from the whole history.

    ``counts="incremental"`` reads the batch and the state of the keys it touches. ``counts="recount"`` reads all of Bronze
    for each batch and gives the same counts. With ``year`` only activities dated in it count. Every batch leaves its run in
    the metrics table; ``log`` keeps the last ones at hand. With the layout ``buckets`` only key buckets with a changed row are
    written; rows of the others keep the lineage of the batch that wrote them.
    """

    def __init__(
        self, spark: SparkSession, paths: LakePaths, read_employees: ReadTable, read_modes: ReadTable,
        resolver: Resolver, rules: MobilityRules | None = None, gate: str = "total", counts: str = "incremental", buckets: int = 64,
        parallel_calls: int = 8, precision: int = 10, scale: int = 0, year: int | None = None, layout: str = "folder",
    ):
        if counts not in ("recount", "incremental"):
            raise ValueError(f"unknown way to count {counts!r}")
        self._spark = spark
        self._paths = paths
        self._read_employees = read_employees
        self._read_modes = read_modes
        self._resolver = resolver
        self._rules = rules or MobilityRules()
        self._gate = gate
        self._parallel_calls = parallel_calls
        self._cache = DistanceCache(spark, paths.distance_cache)
        self._decimal = (precision, scale)
        self._year = year
        self._state = IncrementalCounts(spark, paths.event_state, buckets, year=year) if counts == "incremental" else None
        if layout == "buckets":
            self.store = BucketStore(spark, paths.silver, "employe_id", buckets, ignore=LINEAGE)
        else:
            self.store = SnapshotStore(spark, paths.silver, layout)
        self.log: deque[dict] = deque(maxlen=_KEPT_RUNS)

    @property
    def bronze_schema(self) -> StructType:
        return bronze_schema(*self._decimal)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if self._state is not None:
            self._state.apply(batch, batch_id)
        self.refresh(batch_id)

    def _counts(self, batch_id: int) -> DataFrame:
        if self._state is not None:
            return self._state.counts(batch_id)
        return live_counts(read_bronze(self._spark, self._paths.bronze, *self._decimal), year=self._year)

    def refresh(self, batch_id: int) -> None:
        """Recompute the table and publish it where it has changed."""
        employees = self._read_employees()
        modes = self._read_modes()
        counts = self._counts(batch_id).persist()
        held = None
        try:
            total = grand_total(counts, COUNT).first()["total"]
            existing = self.store.read()
            if self._gate == "total" and not is_changed(counts, existing, COUNT, "total", new_total=total):
                self._record(batch_id, total)
                return
            resolve_commutes(
                employees, modes, self._rules, self._cache, self._resolver, batch_id, self._parallel_calls
            )
            checked = with_commutes(employees, modes, self._rules, self._cache)
            table = silver_table(checked, counts, batch_id)
            if self._gate == "fingerprint":
                # Kept, because it is read for the comparison and again for the write.
                table = held = table.persist()
                if not is_changed(table, existing, COUNT, "fingerprint", LINEAGE):
                    self._record(batch_id, total)
                    return
            seen = self.store.write(table, COUNT)
            self.store.publish()
            self._record(batch_id, total, seen["rows"])
        finally:
            counts.unpersist()
            if held is not None:
                held.unpersist()

    def _record(self, batch_id: int, total: int, rows: int | None = None) -> None:
        """What a batch came to: the total, and the rows of the table if it was written."""
        self.log.append({"batch_id": batch_id, "written": rows is not None, "total": total, "rows": rows})
        append_gauges(run_log(self._spark, batch_id, total, rows), self._paths.metrics)
        if rows is None:
            _LOG.info("batch %d: table is up to date, %d activities", batch_id, total)
        else:
            _LOG.info("batch %d: table written, %d employees, %d activities", batch_id, rows, total)


def start_silver(
    spark: SparkSession, paths: LakePaths, handler: SilverRefresh, interval: str | None = TRIGGER_INTERVAL,
    max_files: int | None = None,
) -> StreamingQuery:
    """Refresh Silver for each set of new Bronze files. What is there already is published at once."""
    HadoopFiles(spark, paths.bronze).make_folder(paths.bronze)
    stream = stream_parquet(spark, paths.bronze, handler.bronze_schema, max_files)
    handler.store.publish()
    return each_batch(stream, handler, paths.checkpoint("silver"), interval)


def start_notifications(
    topic: DataFrame, people: DataFrame, paths: LakePaths, interval: str | None = TRIGGER_INTERVAL,
    send: notify.Sender | None = None, include_deleted: bool = False, delivery: Delivery | None = None,
) -> StreamingQuery:
    """One outbox row per activity event. Without a sender the messages are queued for one outside.

    With ``delivery`` a message is sent once even if senders die; its log is the outbox then.
    """
    texts = notify.messages(parse_changes(topic), people, include_deleted)
    if delivery is not None:
        return each_batch(texts, delivery, paths.checkpoint("outbox"), interval)
    rows = notify.queued(texts) if send is None else notify.deliver(texts, send)
    return append_parquet(rows, paths.outbox, paths.checkpoint("outbox"), interval)


def sample_metrics(store: SnapshotStore, paths: LakePaths) -> bool:
    """Append the gauges of the published snapshot; False while nothing is published."""
    if not store.is_published():
        return False
    append_gauges(gauges(store.read_published()), paths.metrics)
    return True


def start_metrics(spark: SparkSession, store: SnapshotStore, paths: LakePaths, interval: str = METRICS_INTERVAL) -> StreamingQuery:
    """Sample the gauges at intervals; the rate stream is only the clock."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return each_batch(clock, lambda _, __: sample_metrics(store, paths), paths.checkpoint("metrics"), interval)
