import itertools
import re

import pytest

from activity_lake.operators.current_state import (
    EVENT_ORDER, count_by, drop_deleted, grand_total, latest_by_hash, latest_by_max, latest_by_rank, live_counts, live_events,
)
from tests.data import as_dict, bronze_rows

KEY = ["id_evenement_sportif"]
FORMS = [latest_by_rank, latest_by_max]

# key, employee, deleted, seconds, partition, offset
STORY = [
    (1, 10, False, 0, 0, 0), (1, 10, False, 1, 0, 1), (1, 10, True, 2, 0, 2),   # inserted, changed, deleted
    (2, 10, True, 3, 0, 3), (2, 10, False, 4, 0, 4),                            # deleted, inserted again
    (3, 11, False, 5, 0, 5), (3, 12, False, 6, 0, 6),                           # moved to another employee
    (4, 12, None, 7, 0, 7),                                                     # unknown flag
]


def counts(frame):
    return as_dict(frame, "employe_id", "pratique_sportive_annuelle")


def test_live_counts_of_a_story(spark):
    assert counts(live_counts(bronze_rows(spark, STORY))) == {10: 1, 12: 1}


@pytest.mark.parametrize("form", FORMS)
def test_any_order_of_arrival_gives_the_same(spark, form):
    for order in itertools.islice(itertools.permutations(STORY[:5]), 0, 120, 29):
        assert count_by(drop_deleted(form(bronze_rows(spark, order), KEY)), "employe_id", "n").collect() == [(10, 1)]


@pytest.mark.parametrize("form", FORMS)
def test_equal_time_is_decided_by_position(spark, form):
    events = [(1, 10, True, 0, 0, 5), (1, 11, False, 0, 1, 2), (1, 12, True, 0, 1, 1), (2, 20, False, 0, 0, 9), (2, 21, False, 0, 0, 10)]
    assert as_dict(form(bronze_rows(spark, events), KEY), "id_evenement_sportif", "employe_id") == {1: 11, 2: 21}


def test_replayed_events_count_once(spark):
    assert counts(live_counts(bronze_rows(spark, STORY + STORY))) == {10: 1, 12: 1}


def test_filtering_first_would_revive_deleted_rows(spark):
    rows = bronze_rows(spark, STORY[:3])
    assert live_events(rows, KEY).count() == 0
    assert latest_by_rank(drop_deleted(rows), KEY).count() == 1


def test_missing_position_and_keys(spark):
    events = [(1, 10, False, 0, None, None), (1, 11, False, 0, 0, 0), (None, 12, None, 0, 0, 1), (None, 12, False, 0, 0, 2)]
    for form in FORMS:
        latest = form(bronze_rows(spark, events), KEY)
        assert as_dict(latest, "id_evenement_sportif", "employe_id") == {1: 11, None: 12}
    # Rows without a key name no activity.
    assert counts(live_counts(bronze_rows(spark, events))) == {11: 1}


def test_employee_unknown_is_a_group_of_zero(spark):
    assert counts(live_counts(bronze_rows(spark, [(1, None, False, 0, 0, 0), (2, 5, False, 0, 0, 1)]))) == {None: 0, 5: 1}


def test_hash_form_agrees_and_rows_stay_whole_on_ties(spark):
    rows = bronze_rows(spark, STORY).select("id_evenement_sportif", "employe_id", "is_deleted", "kafka_ts")
    by_rank = {tuple(row) for row in latest_by_rank(rows, KEY, ["kafka_ts"]).collect()}
    assert {tuple(row) for row in latest_by_hash(rows, KEY, "kafka_ts").collect()} == by_rank
    ties = bronze_rows(spark, [(1, n, n % 2 == 0, 0, 0, n) for n in range(200)]).repartition(8)
    row = latest_by_hash(ties.select("id_evenement_sportif", "employe_id", "is_deleted", "kafka_ts"), KEY, "kafka_ts").first()
    assert row.is_deleted == (row.employe_id % 2 == 0)


def test_count_of_one_year(spark):
    rows = bronze_rows(spark, STORY)
    assert counts(live_counts(rows, year=2025)) == {10: 1, 12: 1}
    assert counts(live_counts(rows, year=2024)) == {}


def test_total_of_nothing_is_zero(spark):
    assert grand_total(live_counts(bronze_rows(spark, [])), "pratique_sportive_annuelle").first()["total"] == 0


def test_hot_key_is_reduced_before_the_shuffle(spark, folder):
    bronze_rows(spark, STORY).write.parquet(f"{folder}/bronze")
    history = spark.read.parquet(f"{folder}/bronze")
    plan = live_counts(history)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.rindex("Exchange hashpartitioning(id_evenement_sportif"):]
    assert "WindowGroupLimit" in before and "Partial" in before
    # The delete filter is above the window, not in the scan; only the needed columns are read.
    assert "is_deleted" not in plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    read = re.search(r"FileScan parquet \[(.*?)\]", plan).group(1)
    assert set(re.findall(r"(\w+)#", read)) == {"id_evenement_sportif", "employe_id", "is_deleted", *EVENT_ORDER}


def test_single_order_column_needs_no_sort(spark, folder):
    bronze_rows(spark, STORY).write.parquet(f"{folder}/bronze")
    rows = spark.read.parquet(f"{folder}/bronze").select("id_evenement_sportif", "employe_id", "is_deleted", "kafka_ts")
    plan = latest_by_hash(rows, KEY, "kafka_ts")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
