import gc
import os
import weakref

import pandas as pd
import pytest

from activity_lake.config import LakePaths
from activity_lake.operators import notify
from activity_lake.operators.bronze import parse_changes, to_bronze
from activity_lake.operators.current_state import live_counts
from activity_lake.operators.delivery import Delivery
from activity_lake.plans.silver import COUNT
from activity_lake.sources.files import read_bronze
from activity_lake.sources.topics import stream_topic_files
from activity_lake.streaming.runners import (
    SilverRefresh, sample_metrics, start_bronze, start_metrics, start_notifications, start_silver,
)
from tests.data import as_dict, bronze_rows, change, employees, modes, topic

PEOPLE = [(1, "10 km", 2), (2, "26 km", 3), (3, "1 km", 0)]


def resolver(keys: pd.DataFrame) -> pd.Series:
    return keys["adresse"].str.replace(" km", "").astype("float64") * 1000


def handler(spark, paths, people=PEOPLE, **options):
    return SilverRefresh(spark, paths, lambda: employees(spark, people), lambda: modes(spark), resolver, parallel_calls=2, **options)


def drain_bronze(spark, paths, folder):
    start_bronze(stream_topic_files(spark, f"{folder}/topic"), paths, interval=None).awaitTermination()


def drain_silver(spark, paths, refresh, **options):
    start_silver(spark, paths, refresh, interval=None, **options).awaitTermination()


def silver(refresh):
    return as_dict(refresh.store.read_published(), "employe_id", COUNT, "distance_km", "coherence_distance")


EVENTS = [change(1, 1), change(2, 1), change(3, 2), change(2, 1, "true"), "broken", None, change(4, 99), change(5, 99)]


def test_stream_gives_the_rows_of_the_batch(spark, folder):
    paths = LakePaths(f"{folder}/lake")
    topic(spark, EVENTS).repartition(3).write.parquet(f"{folder}/topic")
    drain_bronze(spark, paths, folder)
    streamed = read_bronze(spark, paths.bronze)
    batch = to_bronze(topic(spark, EVENTS))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert streamed.schema == batch.schema


def test_restart_reads_only_what_is_new(spark, folder):
    paths = LakePaths(f"{folder}/lake")
    rows = topic(spark, EVENTS)
    rows.filter("offset < 3").write.parquet(f"{folder}/topic")
    drain_bronze(spark, paths, folder)
    drain_bronze(spark, paths, folder)
    assert read_bronze(spark, paths.bronze).count() == 3
    rows.filter("offset >= 3").write.mode("append").parquet(f"{folder}/topic")
    drain_bronze(spark, paths, folder)
    assert read_bronze(spark, paths.bronze).count() == 7


def test_bronze_by_day(spark, folder):
    paths = LakePaths(f"{folder}/lake")
    topic(spark, EVENTS).write.parquet(f"{folder}/topic")
    start_bronze(stream_topic_files(spark, f"{folder}/topic"), paths, None, by_day=True).awaitTermination()
    assert os.path.isdir(f"{paths.bronze}/ingest_date=2025-01-01")
    assert as_dict(live_counts(read_bronze(spark, paths.bronze)), "employe_id", COUNT) == {1: 1, 2: 1, 99: 2}


@pytest.mark.parametrize("counts", ["recount", "incremental"])
@pytest.mark.parametrize("gate", ["total", "fingerprint"])
def test_topic_to_silver(spark, folder, counts, gate):
    paths = LakePaths(f"{folder}/lake")
    rows = topic(spark, EVENTS)
    rows.filter("offset < 3").write.parquet(f"{folder}/topic")
    drain_bronze(spark, paths, folder)
    refresh = handler(spark, paths, gate=gate, counts=counts)
    drain_silver(spark, paths, refresh)
    assert silver(refresh) == {1: (2, 10.0, "OK"), 2: (1, 26.0, "ERREUR"), 3: (0, None, None)}

    rows.filter("offset >= 3").write.mode("append").parquet(f"{folder}/topic")
    drain_bronze(spark, paths, folder)
    drain_silver(spark, paths, refresh)
    assert silver(refresh) == {1: (1, 10.0, "OK"), 2: (1, 26.0, "ERREUR"), 3: (0, None, None)}
    # Activities of unknown employees are in the total of the counts but not in the table.
    assert refresh.log[-1]["total"] == 4 and refresh.log[-1]["rows"] == 3


def test_gate_skips_what_does_not_change_the_total(spark, folder):
    paths = LakePaths(f"{folder}/lake")
    bronze_rows(spark, [(1, 1, False, 0, 0, 0), (2, 2, False, 1, 0, 1)]).write.parquet(paths.bronze)
    by_total, by_print = handler(spark, paths), handler(spark, LakePaths(f"{folder}/lake"), gate="fingerprint")
    drain_silver(spark, paths, by_total)
    # One activity deleted, one added.
    bronze_rows(spark, [(1, 1, True, 2, 0, 2), (3, 2, False, 3, 0, 3)]).write.mode("append").parquet(paths.bronze)
    drain_silver(spark, paths, by_total)
    assert [entry["written"] for entry in by_total.log] == [True, False]
    assert silver(by_total)[1][0] == 1
    by_print.refresh(9)
    assert by_print.log[-1]["written"] and silver(by_print)[1][0] == 0 and silver(by_print)[2][0] == 2
    by_print.refresh(10)
    assert not by_print.log[-1]["written"]


class Batches:
    """Stands for a frame of messages: hands batches to a function as a task would."""

    def select(self, *_): return self

    def mapInPandas(self, post, _):
        self.made = post(pd.DataFrame({
            "kafka_partition": 0, "kafka_offset": range(n, n + 3), "employe_id": 1, "message_text": ["a", "view", None], "wave": 0}) for n in range(0, 36, 3))
        return self

    write = property(lambda self: self)
    mode = lambda self, _: self
    parquet = lambda self, _: None


@pytest.mark.parametrize("kind", ["deliver", "delivery"])
def test_sent_texts_are_let_go(spark, folder, kind):
    handed, batches = [], Batches()

    def send(given):
        texts = given if kind == "deliver" else given["message_text"]
        handed.append(weakref.ref(texts))
        return texts.str.contains("view", na=False).map({True: 500, False: 200})

    if kind == "deliver":
        notify.deliver(batches, send)
    else:
        delivery = Delivery(spark, folder, send, lambda keys: pd.Series([float("nan")] * len(keys)))
        assert delivery._files.create_text(f"{folder}/started/batch=0-wave=0", "")  # so it is in doubt
        delivery._deliver(batches, 0, 0)
    gc.collect()
    gc.disable()
    try:
        for made in batches.made:
            assert list(made["status"]) == ["sent", "failed", "sent"]
            assert sum(texts() is not None for texts in handed) <= 1
    finally:
        gc.enable()
    assert len(handed) == 12


@pytest.mark.parametrize("counts", ["recount", "incremental"])
def test_a_new_checkpoint_does_not_count_twice(spark, folder, counts):
    paths = LakePaths(f"{folder}/lake")
    bronze_rows(spark, [(1, 1, False, 0, 0, 0), (2, 1, False, 1, 0, 1)]).write.parquet(paths.bronze)
    first = handler(spark, paths, counts=counts, gate="fingerprint")
    drain_silver(spark, paths, first)
    os.rename(paths.checkpoint("silver"), paths.checkpoint("silver-old"))
    again = handler(spark, paths, people=[*PEOPLE, (4, "2 km", 2)], counts=counts, gate="fingerprint")
    drain_silver(spark, paths, again)
    assert {key: row[0] for key, row in silver(again).items()} == {1: 2, 2: 0, 3: 0, 4: 0}


def test_empty_batch_does_nothing(spark, folder):
    refresh = handler(spark, LakePaths(f"{folder}/lake"))
    refresh(bronze_rows(spark, []), 0)
    assert not refresh.log and refresh.store.read() is None


def test_first_run_without_activities_writes_once(spark, folder):
    paths = LakePaths(f"{folder}/lake")
    bronze_rows(spark, [(1, 1, True, 0, 0, 0)]).write.parquet(paths.bronze)
    refresh = handler(spark, paths)
    refresh.refresh(0)
    refresh.refresh(1)
    assert [entry["written"] for entry in refresh.log] == [True, False]
    assert silver(refresh)[1][0] == 0


def test_start_publishes_what_is_there(spark, folder):
    paths = LakePaths(f"{folder}/lake")
    bronze_rows(spark, [(1, 1, False, 0, 0, 0)]).write.parquet(paths.bronze)
    refresh = handler(spark, paths)
    drain_silver(spark, paths, refresh)
    os.remove(refresh.store.published_path)
    drain_silver(spark, paths, handler(spark, paths))
    assert silver(refresh)[1][0] == 1


def test_messages(spark, folder):
    people = employees(spark, PEOPLE)
    bare = change(3, 77, type_pratique_sportive=None, commentaire=None, distance=None)
    events = [change(1, 1, value=35, scale=1), change(2, 77, deleted="true"), bare, "broken"]
    parsed = parse_changes(topic(spark, events))
    texts = as_dict(notify.messages(parsed, people), "kafka_offset", "message_text")
    assert set(texts) == {0, 2}
    assert "Félicitations Prenom1 Nom1 !" in texts[0] and "3.50 km" in texts[0] and "1h02m05s" in texts[0] and "01/01/2025" in texts[0]
    assert "Félicitations Employé #77 !" in texts[2] and "N/A" in texts[2] and "_" "_\n\n" in texts[2]
    assert notify.messages(parsed, people, include_deleted=True).count() == 3


def test_outbox_stream(spark, folder):
    paths = LakePaths(f"{folder}/lake")
    topic(spark, [change(1, 1), change(2, 2), change(3, 77)]).write.parquet(f"{folder}/topic")
    people = employees(spark, PEOPLE)

    def send(texts: pd.Series) -> pd.Series:
        return texts.str.contains("Prenom2").map({True: 500, False: 200})

    def run(**options):
        start_notifications(stream_topic_files(spark, f"{folder}/topic"), people, paths, None, **options).awaitTermination()
        return as_dict(spark.read.parquet(paths.outbox), "employe_id", "status")

    assert run(send=send) == {1: "sent", 2: "failed", 77: "sent"}
    topic(spark, [None, None, None, change(4, 3)]).write.mode("append").parquet(f"{folder}/topic")
    assert run() == {1: "sent", 2: "failed", 77: "sent", 3: "queued"}


def test_names_come_by_a_join(spark, folder):
    parsed = parse_changes(topic(spark, [change(1, 1)]))
    plan = notify.messages(parsed, employees(spark, PEOPLE))._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Python" not in plan


def test_metrics_of_the_published_snapshot(spark, folder):
    import time

    paths = LakePaths(f"{folder}/lake")
    bronze_rows(spark, [(1, 1, False, 0, 0, 0), (2, 1, False, 1, 0, 1)]).write.parquet(paths.bronze)
    refresh = handler(spark, paths, counts="recount")
    assert not sample_metrics(refresh.store, paths)
    refresh.refresh(0)
    query = start_metrics(spark, refresh.store, paths, "1 second")
    try:
        deadline = time.time() + 60
        while query.lastProgress is None or query.lastProgress.batchId < 1:
            assert time.time() < deadline
            time.sleep(0.5)
    finally:
        query.stop()
    stored = spark.read.parquet(paths.metrics)
    runs = as_dict(stored.filter("metric LIKE 'silver_run%'"), "metric", "value")
    assert runs == {"silver_run_batch_id": 0, "silver_run_activities": 2, "silver_run_rows_written": 3}
    values = as_dict(stored.filter("metric NOT LIKE 'silver_run%'"), "metric", "value")
    assert values["pipeline_silver_activites_total"] == 2 and values["pipeline_silver_employes_total"] == 3
