import tempfile

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from activity_lake.operators.current_state import live_counts
from activity_lake.plans.silver import COUNT
from activity_lake.streaming.incremental import IncrementalCounts
from tests.data import as_dict, bronze_rows


def recounted(spark, events):
    counts = as_dict(live_counts(bronze_rows(spark, events)), "employe_id", COUNT)
    return {employee: count for employee, count in counts.items() if count and employee is not None}


def kept(state, upto=None):
    return as_dict(state.counts(upto), "employe_id", COUNT)


def new_state(spark, **options):
    return IncrementalCounts(spark, tempfile.mkdtemp(prefix="activity-lake-test-"), **options)


def test_nothing_yet(spark):
    assert kept(new_state(spark)) == {}


EVENTS = [
    (1, 10, False, 0, 0, 0), (2, 10, False, 1, 0, 1), (1, 10, True, 5, 0, 5), (3, 11, False, 2, 0, 2), (3, 12, False, 7, 0, 7),
    (4, 13, None, 3, 0, 3), (-5, 10, False, 4, 0, 4), (10**12, 10, False, 8, 0, 8), (None, 10, False, 9, 0, 9), (6, None, False, 9, 0, 10),
]


@pytest.mark.parametrize("fold_share", [0.0, 0.5, 1e9])
def test_each_batch_equals_a_recount(spark, fold_share):
    state = new_state(spark, buckets=2, fold_share=fold_share)
    for batch in range(5):
        state.apply(bronze_rows(spark, EVENTS[batch * 2:batch * 2 + 2]), batch)
        assert kept(state) == recounted(spark, EVENTS[:batch * 2 + 2])


def test_late_event_does_not_revive_a_deleted_activity(spark):
    state = new_state(spark)
    state.apply(bronze_rows(spark, [(1, 10, True, 5, 0, 5)]), 0)
    state.apply(bronze_rows(spark, [(1, 10, False, 1, 0, 1)]), 1)
    assert kept(state) == {}


@pytest.mark.parametrize("fold_share", [0.0, 1e9])
def test_repeated_batch_changes_nothing(spark, fold_share):
    state = new_state(spark, fold_share=fold_share)
    batches = [EVENTS[:3], EVENTS[3:6], EVENTS[6:]]
    for number, events in enumerate(batches):
        state.apply(bronze_rows(spark, events), number)
        before = kept(state)
        state.apply(bronze_rows(spark, events), number)
        assert kept(state) == before
    # The same events under a new batch id change nothing either.
    state.apply(bronze_rows(spark, EVENTS), 3)
    assert kept(state) == recounted(spark, EVENTS)


def test_unfinished_fold_is_ignored(spark):
    import os
    state = new_state(spark, fold_share=1e9)
    state.apply(bronze_rows(spark, EVENTS[:3]), 0)
    state.apply(bronze_rows(spark, EVENTS[3:6]), 1)
    state.fold(1)
    expected = kept(state)
    root = state._root
    os.remove(f"{root}/base/upto=1/_SUCCESS")
    assert kept(state) == expected
    state.apply(bronze_rows(spark, EVENTS[6:]), 2)
    assert kept(state) == recounted(spark, EVENTS)


def test_only_touched_folders_are_read(spark):
    state = new_state(spark, buckets=10)
    state.apply(bronze_rows(spark, [(n, 1, False, n, 0, n) for n in range(100)]), 0)
    touched = bronze_rows(spark, [(42, 1, True, 500, 0, 500)])
    plan = state._predecessors(touched, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "bucket#" in plan


def test_files_do_not_depend_on_the_keys(spark):
    import glob
    files = []
    for step in (1, 10**12 + 39):
        state = new_state(spark, buckets=8)
        state.apply(bronze_rows(spark, [(n * step, 1, False, n, 0, n) for n in range(300)]), 0)
        files.append(len(glob.glob(f"{state._root}/deltas/batch=0/bucket=*/*.parquet")))
        assert kept(state) == {1: 300}
    assert files == [8, 8]


def test_only_a_year_counts(spark):
    state = new_state(spark, year=2025)
    rows = bronze_rows(spark, EVENTS)
    other = rows.withColumn("date", F.when(F.col("id_evenement_sportif") == 2, F.col("date") + F.expr("INTERVAL 2 YEARS")).otherwise(F.col("date")))
    for batch in range(3):
        state.apply(other.filter(f"kafka_offset % 3 = {batch}"), batch)
    counts = as_dict(live_counts(other, year=2025), "employe_id", COUNT)
    assert kept(state) == {employee: count for employee, count in counts.items() if count and employee is not None} != recounted(spark, EVENTS)


rows = st.tuples(
    st.integers(1, 6), st.integers(1, 3), st.sampled_from([True, False, False, None]), st.integers(0, 4), st.integers(0, 1),
)


@settings(max_examples=4, deadline=None)
@given(st.lists(rows, min_size=1, max_size=24), st.integers(1, 4), st.randoms(use_true_random=False))
def test_any_arrival_in_any_batches(spark, drawn, batches, random):
    # An offset belongs to one event of a partition.
    events = [(*row, offset) for offset, row in enumerate(drawn)]
    expected = recounted(spark, events)
    random.shuffle(events)
    state = new_state(spark, buckets=3, fold_share=0.5)
    for batch in range(batches):
        state.apply(bronze_rows(spark, events[batch::batches]), batch)
    assert kept(state) == expected
