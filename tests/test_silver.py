import pandas as pd
import pytest

from activity_lake.config import LakePaths, MobilityRules
from activity_lake.operators.lookup import DistanceCache, lookup_keys, resolve_keys
from activity_lake.plans.gate import fingerprint, is_changed
from activity_lake.plans.publish import SnapshotStore
from activity_lake.plans.silver import COUNT, LINEAGE, add_lookup_mode, resolve_commutes, silver_table, soft_mobility, with_commutes
from tests.data import as_dict, employees, modes

RULES = MobilityRules()
PEOPLE = [(1, "15 km", 2), (2, "15.5 km", 2), (3, "25 km", 3), (4, "26 km", 3), (5, "3 km", 0), (6, "3 km", 1), (7, "unknown", 2)]


def by_address(keys: pd.DataFrame) -> pd.Series:
    """Metres from an address such as ``15 km``; no answer for others."""
    return pd.to_numeric(keys["adresse"].str.replace(" km", ""), errors="coerce") * 1000


def no_calls(keys: pd.DataFrame) -> pd.Series:
    raise AssertionError("asked for a known key")


def commutes(spark, folder, people, resolver=by_address, batch_id=0):
    cache = DistanceCache(spark, f"{folder}/cache")
    resolve_commutes(people, modes(spark), RULES, cache, resolver, batch_id, parallel_calls=2)
    return with_commutes(people, modes(spark), RULES, cache)


def test_only_soft_modes_are_checked_and_all_employees_kept(spark, folder):
    people = employees(spark, PEOPLE)
    counts = spark.createDataFrame([(1, 4), (5, 2), (99, 7)], f"employe_id bigint, {COUNT} bigint")
    table = silver_table(commutes(spark, folder, people), counts, 3)
    assert as_dict(table, "employe_id", "distance_km", "coherence_distance", COUNT) == {
        1: (15.0, "OK", 4), 2: (15.5, "ERREUR", 0), 3: (25.0, "OK", 0), 4: (26.0, "ERREUR", 0), 5: (None, None, 2),
        6: (None, None, 0), 7: (None, None, 0),
    }
    assert set(table.columns) == {*people.columns, "distance_km", "coherence_distance", COUNT, *LINEAGE}
    assert table.first()["batch_id"] == 3


def test_no_employee_with_a_soft_mode(spark, folder):
    people = employees(spark, PEOPLE[4:6])
    counts = spark.createDataFrame([], f"employe_id bigint, {COUNT} bigint")
    table = silver_table(commutes(spark, folder, people, no_calls), counts, 0)
    assert as_dict(table, "employe_id", "coherence_distance", COUNT) == {5: (None, 0), 6: (None, 0)}


def test_label_selects_and_id_limits(spark):
    people = employees(spark, [(1, "a", 2), (2, "b", 3), (3, "c", 8), (4, "d", 9), (5, "e", 0)])
    labels = spark.createDataFrame([(2, "autre"), (3, "Vélo/Trottinette/Autres"), (8, "Marche/running"), (0, "x")], modes(spark).schema)
    soft = add_lookup_mode(soft_mobility(people, labels, RULES), RULES)
    assert as_dict(soft, "employe_id", "mode") == {2: "bicycling", 3: None}


def test_limits_need_both_label_and_id(spark, folder):
    people = employees(spark, [(1, "5 km", 2), (2, "5 km", 3), (3, "5 km", 8)])
    labels = spark.createDataFrame([(2, "autre"), (3, "Vélo/Trottinette/Autres"), (8, "Marche/running")], modes(spark).schema)
    cache = DistanceCache(spark, f"{folder}/cache")
    resolve_commutes(people, labels, RULES, cache, by_address, 0)
    checked = with_commutes(people, labels, RULES, cache)
    assert as_dict(checked, "employe_id", "coherence_distance") == {1: None, 2: "OK", 3: None}
    assert cache.read().count() == 1


def test_label_filter_reaches_the_scan(spark, folder):
    employees(spark, PEOPLE).write.parquet(f"{folder}/p")
    modes(spark).write.parquet(f"{folder}/m")
    plan = soft_mobility(spark.read.parquet(f"{folder}/p"), spark.read.parquet(f"{folder}/m"), RULES)
    assert "PushedFilters: [In(nom_moyen_deplacement" in plan._jdf.queryExecution().executedPlan().toString()


def test_known_keys_are_not_asked_for_again(spark, folder):
    people = employees(spark, PEOPLE[:4])
    first = as_dict(commutes(spark, folder, people), "employe_id", "distance_km")
    assert as_dict(commutes(spark, folder, people, no_calls, 1), "employe_id", "distance_km") == first


def test_a_move_of_house_is_noticed(spark, folder):
    commutes(spark, folder, employees(spark, [(1, "10 km", 2)])).collect()
    moved = commutes(spark, folder, employees(spark, [(1, "12 km", 2)]), batch_id=1)
    assert as_dict(moved, "employe_id", "distance_km") == {1: 12.0}


def test_unanswered_keys_are_asked_for_again_but_not_in_every_batch(spark, folder):
    people = employees(spark, [(7, "unknown", 2)])
    assert commutes(spark, folder, people).first()["distance_km"] is None
    assert commutes(spark, folder, people, no_calls, 1).first()["distance_km"] is None
    later = commutes(spark, folder, people, lambda keys: pd.Series([2000.0] * len(keys)), 100)
    assert later.first()["distance_km"] == 2.0
    assert commutes(spark, folder, people, no_calls, 300).first()["distance_km"] == 2.0


def test_unanswered_keys_may_never_be_asked_for_again(spark, folder):
    keys = lookup_keys(add_lookup_mode(soft_mobility(employees(spark, [(7, "unknown", 2)]), modes(spark), RULES), RULES))
    cache = DistanceCache(spark, f"{folder}/cache", retry_after=None)
    cache.fill(keys, by_address, 0)
    cache.fill(keys, no_calls, 10**6)


def test_retried_batch_leaves_one_answer_per_key(spark, folder):
    cache = DistanceCache(spark, f"{folder}/cache")
    keys = lookup_keys(add_lookup_mode(soft_mobility(employees(spark, PEOPLE[:4]), modes(spark), RULES), RULES))
    answers = resolve_keys(keys, by_address, 2)
    cache.remember(answers, 0)
    cache.remember(answers, 0)
    assert cache.read().count() == 4
    assert cache.missing(keys, 1).count() == 0


def table(spark, rows):
    return spark.createDataFrame(rows, f"employe_id bigint, name string, {COUNT} bigint, batch_id int")


def test_gate_modes(spark):
    old = table(spark, [(1, "a", 2, 0), (2, "b", 3, 0)])
    same = table(spark, [(2, "b", 3, 9), (1, "a", 2, 9)])
    offset = table(spark, [(1, "a", 3, 0), (2, "b", 2, 0)])
    renamed = table(spark, [(1, None, 2, 0), (2, "b", 3, 0)])
    more = table(spark, [(1, "a", 2, 0), (2, "b", 4, 0)])

    def verdicts(new):
        return is_changed(new, old, COUNT), is_changed(new, old, COUNT, "fingerprint", ["batch_id"])

    assert verdicts(same) == (False, False)
    assert verdicts(offset) == (False, True)
    assert verdicts(renamed) == (False, True)
    assert verdicts(more) == (True, True)
    assert is_changed(old, None, COUNT)
    assert is_changed(same, old, COUNT, new_total=6) and not is_changed(same, old, COUNT, new_total=5)
    with pytest.raises(ValueError):
        is_changed(same, old, COUNT, "other")


def test_fingerprint_sees_where_nulls_are_and_counts_copies(spark):
    def of(rows):
        return fingerprint(spark.createDataFrame(rows, "a bigint, b bigint, n bigint"), "n").first()

    assert of([(None, 1, 0)]) != of([(1, None, 0)])
    assert of([(1, 1, 0)]) != of([(1, 1, 0), (1, 1, 0)])
    assert of([(1, 2, 0), (3, 4, 0)]) == of([(3, 4, 0), (1, 2, 0)])


@pytest.mark.parametrize("layout", ["folder", "file"])
def test_publication(spark, folder, layout):
    store = SnapshotStore(spark, f"{folder}/silver", layout, keep=2)
    assert store.read() is None and store.publish() is None
    for version, rows in enumerate([[(1, "a", 2, 0)], [(1, "a", 5, 1), (2, "b", 1, 1)], [(1, "a", 6, 2)]]):
        seen = store.write(table(spark, rows), COUNT)
        assert seen == {"rows": len(rows), "total": sum(row[2] for row in rows)}
        assert store.publish() == store.published_path
        assert store.read_published().count() == len(rows)
        assert store.versions()[-1] == version
    assert store.versions() == [1, 2]
    import os
    assert os.path.isfile(store.published_path)
    assert store.read_published(COUNT).collect() == [(6,)]
    assert store.publish() == store.published_path


def test_new_version_may_be_computed_from_the_old_one(spark, folder):
    store = SnapshotStore(spark, f"{folder}/silver")
    store.write(table(spark, [(1, "a", 2, 0)]), COUNT)
    store.write(store.read().selectExpr("employe_id", "name", f"{COUNT} + 1 AS {COUNT}", "batch_id"), COUNT)
    assert store.read().first()[COUNT] == 3


def test_unfinished_version_is_not_read(spark, folder):
    store = SnapshotStore(spark, f"{folder}/silver")
    store.write(table(spark, [(1, "a", 2, 0)]), COUNT)
    table(spark, [(1, "a", 9, 0)]).write.parquet(f"{folder}/silver/versions/version=1")
    import os
    os.remove(f"{folder}/silver/versions/version=1/_SUCCESS")
    assert store.read().first()[COUNT] == 2


@pytest.mark.parametrize("layout", ["folder", "file"])
def test_fixed_path_is_a_file_at_any_size(spark, folder, layout):
    import os
    store = SnapshotStore(spark, f"{folder}/silver", layout)
    for n in (1, 5000):
        store.write(table(spark, [(k, "a", 1, 0) for k in range(n)]).repartition(4), COUNT)
        store.publish()
        assert os.path.isfile(store.published_path) and store.read_published().count() == n
    before = os.stat(store.published_path).st_mtime_ns
    assert store.publish() == store.published_path and os.stat(store.published_path).st_mtime_ns == before
    if layout == "file":
        assert spark.read.parquet(store.published_path).count() == 5000
    with pytest.raises(ValueError):
        SnapshotStore(spark, folder, "rows")


def test_paths_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("ACTIVITY_LAKE_ROOT", "/somewhere/lake/")
    paths = LakePaths.from_env()
    assert paths.bronze == "/somewhere/lake/bronze" and paths.event_state.startswith(paths.checkpoint("silver"))
