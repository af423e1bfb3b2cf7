"""Live counts from state that the streaming engine keeps per activity.

One state per activity: its newest event, delete markers included, so that an older event arriving later cannot revive a
deleted activity. Activities lie together in small blocks, since each call from Python to the state costs more than what it
carries: a micro-batch reads and writes the blocks of the activities it names and no other. The state lies in RocksDB, on disk
beside the executors and by its changes in the checkpoint. Every event that changes what an owner has to count leaves as a
change (owner, +1 or -1), each exactly once, and the counts are the sum of the changes.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from activity_lake.config import TRIGGER_INTERVAL
from activity_lake.operators.current_state import EVENT_ORDER
from activity_lake.sinks.streams import append_parquet

KEY, OWNER, COUNT = "id_evenement_sportif", "employe_id", "pratique_sportive_annuelle"
CHANGE = "employe_id BIGINT, change BIGINT"
# An event as numbers: activity, owner (0 if there is none), 1 if live, its place in the order of events.
_FIELDS = [KEY, OWNER, "live", "at", "part", "place"]
_ID, _OWNER, _LIVE, _AT, _PART, _PLACE = range(len(_FIELDS))
# Most activities of a block on average, and rows that are sorted at once.
BLOCK, CHUNK = 1024, 200_000
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextlib.contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings that a stream started inside takes with it; the session has its own again afterwards.

    ``partitions`` is how many parts the state has; a checkpoint keeps the number it was started with.
    """
    wanted = {**STATE_SETTINGS, **({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(batch[_FIELDS].to_numpy("int64"))
        if sum(map(len, held)) >= CHUNK:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def _newest(events: np.ndarray) -> np.ndarray:
    """The newest event of every activity, by activity."""
    ordered = events[np.lexsort([events[:, field] for field in (_PLACE, _PART, _AT, _ID)])]
    return ordered[np.append(ordered[1:, _ID] != ordered[:-1, _ID], True)]


def _is_newer(events: np.ndarray, others: np.ndarray) -> np.ndarray:
    newer = np.zeros(len(events), bool)
    for field in (_PLACE, _PART, _AT):
        newer = (events[:, field] > others[:, field]) | (events[:, field] == others[:, field]) & newer
    return newer


def _by_block(events: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Events by activity, dealt to 2**bits blocks."""
    mixed = (events[:, _ID].astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    block = (mixed & np.uint64((1 << bits) - 1)).astype("int64")
    order = np.argsort(block, kind="stable")
    starts = np.flatnonzero(np.diff(block[order], prepend=-1))
    for start, part in zip(starts, np.split(events[order], starts[1:])):
        yield int(block[order[start]]), part


class NewestEvents(StatefulProcessor):
    """The newest event of every activity of a bucket by broker time, then position; its changes of live counts.

    The blocks of a bucket are doubled, one after the other, when there are more activities than fit.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        # A checkpoint with another state under this name is refused.
        self._newest = handle.getMapState("newest", "block INT", "events BINARY")
        self._shape = handle.getValueState("shape", "bits INT, activities BIGINT")

    def _block(self, block: int) -> np.ndarray:
        found = self._newest.getValue((block,))
        return np.frombuffer(b"" if found is None else bytes(found[0]), "int64").reshape(-1, len(_FIELDS))

    def _put(self, block: int, events: np.ndarray) -> None:
        self._newest.updateValue((block,), (events.tobytes(),))

    def _room_for(self, activities: int, bits: int) -> int:
        """Double the blocks until the activities fit; the new number of bits."""
        more = bits
        while activities > BLOCK << more and more < 30:
            more += 1
        if more > bits:
            for block in range(1 << bits):
                events = self._block(block)
                kept = dict(_by_block(events, more)) if len(events) else {}
                if kept and block not in kept:
                    self._newest.removeKey((block,))
                for part, rows in kept.items():
                    self._put(part, rows)
        return more

    def _changes(self, block: int, events: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """Put newer events into a block: how many activities are new to it, the owners to count less and those to count more."""
        held = self._block(block).copy()
        at = np.searchsorted(held[:, _ID], events[:, _ID])
        known = np.zeros(len(events), bool)
        inside = at < len(held)
        known[inside] = held[at[inside], _ID] == events[inside, _ID]
        old = np.zeros_like(events)
        old[known] = held[at[known]]
        taken = ~known | _is_newer(events, old)
        if not taken.any():
            return 0, old[:0, _OWNER], old[:0, _OWNER]
        over = known & taken
        held[at[over]] = events[over]
        self._put(block, np.insert(held, at[~known], events[~known], axis=0))
        events, old = events[taken], old[taken]
        was, become = old[:, _LIVE] == 1, events[:, _LIVE] == 1
        same = was & become & (old[:, _OWNER] == events[:, _OWNER])
        return int((~known).sum()), old[was & ~same, _OWNER], events[become & ~same, _OWNER]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(rows):
            # One event per activity is left of a chunk before the state is asked.
            events = _newest(chunk)
            bits, activities = self._shape.get() or (0, 0)
            bits = self._room_for(activities + len(events), bits)
            made = [self._changes(block, part) for block, part in _by_block(events, bits)]
            self._shape.update((bits, activities + sum(new for new, _, _ in made)))
            less, more = (np.concatenate([change[side] for change in made]) for side in (1, 2))
            if len(less) + len(more):
                yield pd.DataFrame({"employe_id": np.concatenate([less, more]), "change": np.repeat([-1, 1], [len(less), len(more)])})

    def close(self) -> None:
        pass


def count_changes(bronze: DataFrame, year: int | None = None, buckets: int = 256) -> DataFrame:
    """Changes of the live counts of a Bronze stream, whatever the order of arrival and however often a row is repeated.

    Activities are handled in ``buckets`` by hash, which must stay the same for a checkpoint: Python is called once for the
    rows of a bucket, and has its state block by block. Rows without a time are older than any with one.
    """
    live = F.coalesce(F.col("is_deleted") == F.lit(False), F.lit(False))
    if year is not None:
        live = live & F.coalesce(F.year("date") == year, F.lit(False))
    time, part, place = EVENT_ORDER
    none = F.lit(-(2**63)).cast("bigint")
    # An activity without an owner counts for nobody, as one that is not live.
    counted = (live & F.col(OWNER).isNotNull()).cast("bigint")
    events = bronze.filter(F.col(KEY).isNotNull()).select(
        F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int").alias("bucket"), KEY, F.coalesce(F.col(OWNER), F.lit(0)).cast("bigint").alias(OWNER),
        counted.alias("live"), F.coalesce(F.unix_micros(time), none).alias("at"), F.coalesce(F.col(part), F.lit(-1)).cast("bigint").alias("part"),
        F.coalesce(F.col(place), none).alias("place"))
    rows = events.groupBy("bucket")
    return rows.transformWithStateInPandas(NewestEvents(), CHANGE, outputMode="append", timeMode="none")


def start_count_changes(
    spark: SparkSession, bronze: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL,
    year: int | None = None, partitions: int | None = None, buckets: int = 256,
) -> StreamingQuery:
    """Append the changes of the live counts to a Parquet table, each once, also across restarts."""
    with state_settings(spark, partitions):
        return append_parquet(count_changes(bronze, year, buckets), path, checkpoint, interval)


def counts(spark: SparkSession, path: str) -> DataFrame:
    """Live activities per owner: the sum of all changes so far."""
    changes = spark.read.schema(CHANGE).parquet(path)
    return changes.groupBy(OWNER).agg(F.sum("change").alias(COUNT)).filter(F.col(COUNT) > 0)
