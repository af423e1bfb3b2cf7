"""Keyed state, replays, bucket publication, indexed lookups, delivery, grids, incremental suites, key ranges."""

import datetime
import os
import random
import re
import threading
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from activity_lake.config import LakePaths
from activity_lake.operators import quality
from activity_lake.operators.current_state import live_counts
from activity_lake.operators.delivery import Delivery
from activity_lake.operators.keys import KeyRanges, with_next_keys
from activity_lake.operators.metrics import series_grid
from activity_lake.operators.quality_state import SuiteState
from activity_lake.plans.buckets import BucketStore
from activity_lake.plans.silver import COUNT
from activity_lake.schemas import bronze_schema
from activity_lake.sinks.compaction import CompactedTable
from activity_lake.sinks.hadoop import HadoopFiles
from activity_lake.sinks.streams import append_parquet
from activity_lake.sources.files import read_bronze, stream_parquet
from activity_lake.sources.indexed import look_up_keys, rows_scanned, write_indexed
from activity_lake.sources.topics import stream_topic_files
from activity_lake.streaming import keyed_state
from activity_lake.streaming.orphans import stream_orphans
from activity_lake.streaming.runners import SilverRefresh, start_bronze, start_silver
from tests.data import as_dict, bronze_rows, change, employees, modes, topic

# Keyed state


def take_in(spark, folder, events, **options):
    bronze_rows(spark, events).coalesce(1).write.mode("append").parquet(f"{folder}/bronze")
    stream = stream_parquet(spark, f"{folder}/bronze", bronze_schema())
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    keyed_state.start_count_changes(spark, stream, f"{folder}/changes", f"{folder}/check", None, partitions=2, buckets=4, **options).awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    return as_dict(keyed_state.counts(spark, f"{folder}/changes"), "employe_id", COUNT)


def test_state_follows_the_newest_event_across_restarts(spark, folder):
    assert take_in(spark, folder, [(1, 10, False, 0, 0, 0), (2, 10, False, 1, 0, 1), (3, 20, False, 2, 0, 2), (None, 9, False, 3, 0, 3)]) == {10: 2, 20: 1}
    # a delete, an older event of the deleted, a move to another owner, a repetition
    events = [(1, 10, True, 9, 0, 9), (1, 10, False, 5, 0, 5), (3, 30, False, 8, 0, 8), (2, 10, False, 1, 0, 1)]
    assert take_in(spark, folder, events) == {10: 1, 30: 1}
    assert take_in(spark, folder, [(1, 10, False, 7, 0, 7), (2, None, False, 9, 0, 1), (3, 30, None, 8, 0, 9)]) == {}
    assert take_in(spark, folder, [(1, 10, False, 9, 1, 0)]) == {10: 1}


def test_state_equals_a_recount_for_any_arrival(spark, folder):
    rng = random.Random(4)
    events = [(rng.randrange(25), rng.choice([1, 2, 3, 2**53 + 1]), rng.random() < 0.4, rng.randrange(30), rng.randrange(2), at) for at in range(160)]
    rng.shuffle(events)
    for start in range(0, 160, 80):
        found = take_in(spark, folder, events[start:start + 80])
        assert found == as_dict(live_counts(read_bronze(spark, f"{folder}/bronze")), "employe_id", COUNT)


class CountedState(dict):
    """Map state and value state in memory; counts the calls that would go to the engine."""

    calls = 0

    def _called(self, answer=None):
        self.calls += 1
        return answer

    def getValue(self, key): return self._called(self.get(key))
    def updateValue(self, key, value): return self._called(self.__setitem__(key, value))
    def removeKey(self, key): return self._called(self.pop(key))
    def getMapState(self, *_): return self
    def getValueState(self, *_): return CountedValue()


class CountedValue(list):
    def get(self): return self[-1] if self else None
    def update(self, value): self.append(value)


@pytest.mark.parametrize("block", [8, 512])
def test_state_is_asked_by_blocks(monkeypatch, block):
    monkeypatch.setattr(keyed_state, "BLOCK", block, raising=False)
    rng = random.Random(block)
    processor, state = keyed_state.NewestEvents(), CountedState()
    processor.init(state)
    newest, totals, seen = {}, {}, 0
    for size in (1, 3000, 3000, 1, 2000):
        rows = [(0, rng.choice([-1, 1]) * rng.randrange(2500), rng.randrange(4), int(rng.random() < 0.6), rng.randrange(9), rng.randrange(3), seen + at) for at in range(size)]
        seen += size
        before = state.calls
        frames = [pd.DataFrame(rows[at:at + 700], columns=["bucket", "id_evenement_sportif", "employe_id", "live", "at", "part", "place"]) for at in range(0, size, 700)]
        for changes in processor.handleInputRows((0,), iter(frames), None):
            for owner, change in changes.itertuples(index=False):
                totals[owner] = totals.get(owner, 0) + change
        for _, activity, owner, live, *place in rows:
            newest[activity] = max(newest.get(activity, ([-1],)), (place, owner, live))
        want = {owner: sum(1 for _, by, live in newest.values() if live and by == owner) for owner in range(4)}
        assert {owner: n for owner, n in totals.items() if n} == {owner: n for owner, n in want.items() if n}
        # reading and writing each activity would be two calls an event
        assert state.calls - before <= max(8 * 4000 / block, 12)
    assert max(len(bytes(events)) // 48 for events, in state.values()) < 3 * block


# Replay


def test_positions_count_once_across_a_restart(spark, folder):
    paths = LakePaths(f"{folder}/lake")
    rows = topic(spark, [change(key) for key in range(40)])

    def drain(*arriving):
        for part in arriving:
            part.write.mode("append").parquet(f"{folder}/topic")
        start_bronze(stream_topic_files(spark, f"{folder}/topic"), paths, interval=None, replay_within="10 seconds").awaitTermination()
        return sorted(r["kafka_offset"] for r in read_bronze(spark, paths.bronze).collect())

    assert drain(rows.filter("offset < 20"), rows.filter("offset < 20")) == list(range(20))
    # of the replayed, those before the watermark are late and the others known; new ones come through
    assert drain(rows.filter("offset < 30")) == list(range(30))
    assert drain(rows.filter("offset >= 25"), rows.filter("offset >= 12")) == list(range(40))


# Bucket publication


def bucket_store(spark, folder, **options):
    return BucketStore(spark, f"{folder}/table", "k", by=F.col("k") % 4, **options)


TABLE = "k long, n long, t string"


def test_only_changed_buckets_are_written(spark, folder):
    store = bucket_store(spark, folder, ignore=["t"])
    rows = [(k, k, "a") for k in range(20)]
    assert store.read() is None and store.publish() is None and not store.is_published()
    assert store.write(spark.createDataFrame(rows, TABLE), "n") == {"rows": 20, "total": 190, "buckets": [0, 1, 2, 3]}
    first = store.read()
    # another order and another value of an ignored column are no change
    assert store.write(spark.createDataFrame(rows[::-1], TABLE).withColumn("t", F.lit("b")), "n")["buckets"] == [] and store.versions() == [0]
    changed = [(k, n + (k == 6), t) for k, n, t in rows if k not in (3, 7, 11, 15, 19)] + [(4, None, None)]
    assert store.write(spark.createDataFrame(changed, TABLE), "n")["buckets"] == [0, 2] and store.versions() == [0, 1]
    assert sorted(map(str, store.read_published().collect())) == sorted(map(str, spark.createDataFrame(changed, TABLE).collect()))
    folders = {re.sub("-[0-9a-f]{32}", "", entry["folder"]) for entry in store.manifest(1)["buckets"].values()}
    assert folders == {"data/version=0/bucket=1", "data/version=1/bucket=0", "data/version=1/bucket=2"}
    assert first.count() == 20  # a reader of the version before
    assert store.write(spark.createDataFrame([], TABLE), "n") == {"rows": 0, "total": 0, "buckets": []}
    assert store.read().count() == 0 and store.versions() == [1, 2]
    assert store.write(spark.createDataFrame(changed[:1], TABLE).withColumn("more", F.lit(1)), "n")["buckets"] == [0]
    assert store.read().columns == ["k", "n", "t", "more"] and [name for name in HadoopFiles(spark, folder).names(f"{folder}/table/data") if name.startswith("version=0")] == []


def test_one_of_two_writers_of_a_version_wins(spark, folder, monkeypatch):
    store, other = bucket_store(spark, folder), bucket_store(spark, folder)
    store.write(spark.createDataFrame([(1, 1, "a")], TABLE), "n")
    behind = other.versions()
    store.write(spark.createDataFrame([(1, 2, "a")], TABLE), "n")
    monkeypatch.setattr(other, "versions", lambda: behind)
    with pytest.raises(FileExistsError):
        other.write(spark.createDataFrame([(1, 3, "a")], TABLE), "n")
    assert [r["n"] for r in store.read().collect()] == [2]


def test_silver_by_buckets(spark, folder):
    paths = LakePaths(f"{folder}/lake")
    refresh = SilverRefresh(
        spark, paths, lambda: employees(spark, [(key, "1 km", 0) for key in range(1, 9)]), lambda: modes(spark),
        lambda keys: pd.Series([1.0] * len(keys)), gate="fingerprint", counts="recount", buckets=8, parallel_calls=2, layout="buckets")
    for at, event in enumerate([(1, 1, False, 0, 0, 0), (2, 2, False, 1, 0, 1)]):
        bronze_rows(spark, [event]).coalesce(1).write.mode("append").parquet(paths.bronze)
        start_silver(spark, paths, refresh, interval=None).awaitTermination()
    rows = {r["employe_id"]: (r[COUNT], r["batch_id"]) for r in refresh.store.read_published().collect()}
    assert {key: n for key, (n, _) in rows.items()} == {1: 1, 2: 1, **{key: 0 for key in range(3, 9)}}
    assert rows[2][1] == 1 and {batch for _, batch in rows.values()} == {0, 1}


# Lookups


def test_lookup_reads_single_pages(spark, folder):
    rows = spark.range(0, 40_000, 2).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("t"))
    write_indexed(rows.orderBy(F.rand(3)), f"{folder}/t", "k", bloom=["t"], partitions=4, page_rows=100)
    table = spark.read.parquet(f"{folder}/t")
    found = look_up_keys(table, "k", [4, 4, None, 39_998, 5])
    assert sorted(r["k"] for r in found.collect()) == [4, 39_998] and 2 <= rows_scanned(found) <= 300
    assert rows_scanned(look_up_keys(table, "k", [])) == 0
    text = table.filter("k = 8888").first()["t"]
    assert rows_scanned(table.filter(F.col("t") == text)) <= 6_000  # the Bloom filters leave one of four files
    many = list(range(0, 8_000, 2))
    assert look_up_keys(table, "k", many).count() == len(many)


# Delivery


class Service:
    """Takes messages down in a folder and fails when told to."""

    def __init__(self, folder):
        self.folder = f"{folder}/received"
        os.makedirs(self.folder)

    def take(self, messages):
        messages[["kafka_partition", "kafka_offset"]].to_csv(f"{self.folder}/{uuid.uuid4().hex}.csv", index=False)
        return pd.Series([200 if offset % 3 else 500 for offset in messages["kafka_offset"]])

    def die(self, messages):
        self.take(messages.iloc[: len(messages) // 2])
        raise ConnectionError("died")

    def settle(self, keys):
        known = pd.concat([pd.read_csv(f"{self.folder}/{name}") for name in os.listdir(self.folder)] or [keys.iloc[:0]]).assign(found=1)
        found = keys.merge(known, "left", ["kafka_partition", "kafka_offset"])
        return pd.Series([(200 if offset % 3 else 500) if hit == 1 else float("nan") for offset, hit in zip(found["kafka_offset"], found["found"])])

    def received(self):
        return sorted(row for name in os.listdir(self.folder) for row in pd.read_csv(f"{self.folder}/{name}").itertuples(index=False, name=None))


def messages(spark, offsets):
    rows = [(offset % 2, offset, 7, f"text {offset}") for offset in offsets]
    return spark.createDataFrame(rows, "kafka_partition int, kafka_offset long, employe_id long, message_text string")


def test_each_message_is_sent_once_though_senders_die(spark, folder):
    service = Service(folder)
    first, second = messages(spark, [*range(50), 3, 3]), messages(spark, range(40, 70))
    for send in (service.die, service.die):
        with pytest.raises(Exception, match="died"):
            Delivery(spark, folder, send, service.settle, wave_rows=20, parallel_calls=2)(first, 0)
    delivery = Delivery(spark, folder, service.take, service.settle, wave_rows=20, parallel_calls=2)
    delivery(first, 0)
    delivery(first, 0)
    delivery(second, 1)
    assert service.received() == sorted((offset % 2, offset) for offset in range(70))
    outbox = {r["kafka_offset"]: (r["status"], r["status_code"], r["message_text"]) for r in delivery.outbox().collect()}
    assert outbox == {offset: (("sent", 200) if offset % 3 else ("failed", 500)) + (f"text {offset}",) for offset in range(70)}
    assert delivery.outbox().count() == 70


def test_nothing_to_deliver(spark, folder):
    service = Service(folder)
    delivery = Delivery(spark, folder, service.take, service.settle)
    assert delivery.outbox().count() == 0
    delivery(messages(spark, []), 0)
    assert delivery.outbox().count() == 0 and service.received() == []


# Series on a grid


@pytest.mark.parametrize("piece_steps", [1, 3, 1000])
def test_series_on_a_grid(spark, piece_steps):
    start = datetime.datetime(2025, 1, 1, tzinfo=datetime.timezone.utc)
    rng = random.Random(piece_steps)
    samples = [(name, start + datetime.timedelta(seconds=rng.randrange(-50, 150)), rng.choice([None, 1.0, 2.0, 3.5])) for name in "aab" for _ in range(12)]
    samples += [("a", start, 9.0), ("late", start + datetime.timedelta(seconds=500), 1.0), ("none", start, None)]
    samples = list({(name, at): value for name, at, value in samples}.items())
    samples = [(name, at, value) for (name, at), value in samples]
    micros = int(start.timestamp()) * 1_000_000
    made = series_grid(spark.createDataFrame(samples, "m string, at timestamp, v double"), "m", "v", "at", micros, micros + 100_000_000, 7_000_000, piece_steps)
    want = {}
    for name in ("a", "b", "late", "none"):
        for tick in range(0, 101, 7):
            before = [(at, v) for m, at, v in samples if m == name and v is not None and at <= start + datetime.timedelta(seconds=tick)]
            want[name, micros + tick * 1_000_000] = max(before)[1] if before else None
    assert {(r["m"], r["tick"]): r["v"] for r in made.collect()} == want and made.count() == len(want)


# Suites kept batch by batch


def test_suite_state_equals_the_suite_over_all_rows(spark, folder):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(30)]), rng.choice(["x", "y", None]), rng.uniform(0, 10)) for _ in range(90)]
    parents = spark.createDataFrame([(key,) for key in range(20)], "p long")
    checks = [quality.Between("v", 1, 9), quality.NotNull("k"), quality.InSet("t", ("x",)), quality.Unique(("k", "t")), quality.References("k", parents, "p")]
    state = SuiteState(spark, f"{folder}/s", checks, fold_after=2)
    with pytest.raises(ValueError):
        state.results()
    frame = lambda part: spark.createDataFrame(part, "k long, t string, v double")
    for batch in range(6):
        state.apply(frame(rows[batch * 15:batch * 15 + 15]), batch)
        if batch % 2:
            state.apply(frame(rows[batch * 15:batch * 15 + 15]), batch)  # handed over again
        whole = quality.run_suite(frame(rows[:batch * 15 + 15]), checks)
        assert sorted(map(tuple, state.results().collect())) == sorted(map(tuple, whole.collect()))
    state.apply(frame(rows[:15]), 0)  # folded long ago
    assert sorted(map(tuple, state.results().collect())) == sorted(map(tuple, whole.collect()))
    assert len(HadoopFiles(spark, folder).names(f"{folder}/s/rows")) < 6


# Keys of several writers


def test_writers_share_a_log_of_ranges(spark, folder):
    taken = []

    def writer(seed):
        rng, ranges = random.Random(seed), KeyRanges(spark, f"{folder}/ranges", 100)
        for _ in range(5):
            count = rng.randrange(0, 9)
            taken.append((ranges.claim(count), count))

    threads = [threading.Thread(target=writer, args=(seed,)) for seed in range(3)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    claims = KeyRanges(spark, f"{folder}/ranges", 100).claims()
    assert sorted(taken) == sorted(claims) and len(claims) == 15
    assert [first for first, _ in claims] == [101 + sum(n for _, n in claims[:at]) for at in range(15)]


def test_interleaved_appends_number_without_gaps(spark, folder):
    ranges = KeyRanges(spark, f"{folder}/ranges", 7)
    existing = spark.createDataFrame([(7,)], "k long")
    parts = [spark.createDataFrame([(f"{name}{at}",) for at in range(size)], "v string") for name, size in (("a", 5), ("b", 0), ("c", 9))]
    made = [with_next_keys(part, existing, "k", ["v"], partitions=3, ranges=ranges) for part in parts]
    rows = [(r["k"], r["v"]) for part in reversed(made) for r in part.collect()]
    assert sorted(rows) == [(8 + at, v) for at, v in enumerate([f"a{i}" for i in range(5)] + [f"c{i}" for i in range(9)])]


# Orphans of streams


def test_orphans_leave_when_no_parent_can_come(spark, folder):
    row = "k long, at timestamp, name string"
    at = lambda minute: datetime.datetime(2025, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(minutes=minute)

    def arrive(children, parents):
        for name, rows in (("c", children), ("p", parents)):
            spark.createDataFrame([(k, at(m), f"{k}-{m}") for k, m in rows], row).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        streams = [stream_parquet(spark, f"{folder}/{name}", spark.createDataFrame([], row).schema) for name in "cp"]
        found = stream_orphans(*streams, "k", "k", "at", "at", "5 MINUTES", "10 MINUTES", "20 minutes")
        append_parquet(found, f"{folder}/orphans", f"{folder}/check", None).awaitTermination()
        return sorted(r["name"] for r in spark.read.schema(row).parquet(f"{folder}/orphans").collect())

    assert arrive([(1, 0), (2, 0), (3, 1), (None, 1)], [(1, -3), (3, 12)]) == []  # 3 has its parent too late, but one may still come
    assert arrive([(4, 20)], [(2, 9)]) == []  # a late parent
    assert arrive([(5, 60)], [(9, 60)]) == ["3-1", "4-20"]
    assert arrive([(98, 500)], [(99, 500)]) == ["3-1", "4-20", "5-60"]


# Compaction


def test_compaction_keeps_rows_and_readers(spark, folder):
    schema = spark.createDataFrame([], "v long").schema
    table = CompactedTable(spark, f"{folder}/t", f"{folder}/c", schema, min_files=3)
    values = lambda frame: sorted(r["v"] for r in frame.collect())
    assert values(table.read()) == [] and not table.compact()

    def append(*numbers):
        for number in numbers:
            spark.createDataFrame([(number,)], schema).coalesce(1).write.mode("append").parquet(f"{folder}/t")

    append(1, 2)
    assert not table.compact() and values(table.read()) == [1, 2]
    append(3, 3)
    reader = table.read()
    assert table.compact() and table.file_count() == 1 and values(table.read()) == [1, 2, 3, 3]
    append(4)
    older = table.read()
    append(5, 6)
    assert table.compact() and not table.compact()
    assert values(reader) == [1, 2, 3, 3] and values(older) == [1, 2, 3, 3, 4] and values(table.read()) == [1, 2, 3, 3, 4, 5, 6]
    monkey = [7]
    for _ in range(8):
        append(*(monkey[-1] + k for k in range(3)))
        monkey.append(monkey[-1] + 3)
        assert table.compact()
    assert table.file_count() <= 8 and values(table.read()) == [1, 2, 3, 3, *range(4, monkey[-1])]
    assert len(table.snapshots()) == 2


def test_of_two_compactors_one_commits(spark, folder, monkeypatch):
    schema = spark.createDataFrame([], "v long").schema
    spark.range(4).toDF("v").repartition(4).write.parquet(f"{folder}/t")
    one, two = (CompactedTable(spark, f"{folder}/t", f"{folder}/c", schema, min_files=2) for _ in "ab")
    monkeypatch.setattr(two, "snapshots", lambda: [])
    assert one.compact() and not two.compact()
    assert sorted(r["v"] for r in one.read().collect()) == [0, 1, 2, 3] and one.file_count() == 1
