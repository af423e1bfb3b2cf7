import datetime
from decimal import Decimal

from activity_lake.operators.bronze import BRONZE_COLUMNS, keyed_events, parse_changes, rejects, to_bronze
from activity_lake.schemas import bronze_schema
from tests.data import UTC, as_dict, change, packed, topic


def test_sample_rows(spark):
    events = [change(1), change(2, scale=1, value=35, commentaire=None), change(3, deleted="true", distance=None, date=0)]
    rows = to_bronze(topic(spark, events)).orderBy("kafka_offset").collect()
    assert [row.distance_km for row in rows] == [Decimal(5), Decimal(4), None]
    assert [row.is_deleted for row in rows] == [False, False, True]
    assert [row.reject_reason for row in rows] == [None, None, None]
    assert rows[0].date == datetime.datetime(2025, 1, 1)
    assert rows[0].temps_ecoule == 3725 and rows[0].type_pratique_sportive == "Vélo"


def test_schema_is_the_declared_one(spark):
    frame = to_bronze(topic(spark, [change(1)]))
    assert tuple(frame.columns) == BRONZE_COLUMNS
    assert [field.dataType for field in frame.schema] == [field.dataType for field in bronze_schema()]
    assert str(to_bronze(topic(spark, [change(1)]), 12, 2).schema["distance_km"].dataType) == "DecimalType(12,2)"


def test_reject_reasons(spark):
    events = [
        change(1), "not json", None, "", change("absent"), change(2, date="x"), change(3, distance={"scale": 0, "value": "?!"}),
        change(4, value=10**11), change(5, temps_ecoule="long"), change(6, distance={"scale": 0, "value": ""}),
    ]
    rows = to_bronze(topic(spark, events))
    reasons = as_dict(rows, "kafka_offset", "reject_reason")
    # The tombstone at offset 2 is gone.
    assert reasons == {
        0: None, 1: "bad_json", 3: "bad_json", 4: "no_key", 5: "bad_date", 6: "bad_distance", 7: "bad_distance",
        8: "bad_field", 9: "bad_distance",
    }
    assert rejects(rows).count() == 8
    assert rejects(rows).filter("reject_reason = 'bad_json'").orderBy("kafka_offset").first()["raw_value"] == "not json"
    # A bad field does not lose the event.
    assert sorted(row[0] for row in keyed_events(rows).select("id_evenement_sportif").collect()) == [1, 2, 3, 4, 5, 6]


def test_delete_flag_has_three_values(spark):
    events = [change(1, deleted="true"), change(2, deleted="false"), change(3, deleted="absent"), change(4, deleted="TRUE")]
    assert as_dict(to_bronze(topic(spark, events)), "id_evenement_sportif", "is_deleted") == {1: True, 2: False, 3: None, 4: False}


def test_ids_beyond_32_bits_are_kept(spark):
    assert to_bronze(topic(spark, [change(2**40, employee=2**41)])).first()["employe_id"] == 2**41


def test_microseconds_are_exact(spark):
    row = to_bronze(topic(spark, [change(1, date=1735689600123457)])).first()
    assert row.date == datetime.datetime(2025, 1, 1, 0, 0, 0, 123457)
    assert row.kafka_ts.replace(tzinfo=UTC) == datetime.datetime(2025, 1, 1, tzinfo=UTC)


def test_decoding_is_one_projection_without_python(spark):
    plan = to_bronze(topic(spark, [change(1)]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_text_is_parsed_once(spark, folder):
    topic(spark, [change(1), change(2, value=7)]).write.parquet(f"{folder}/topic")
    parsed = parse_changes(spark.read.parquet(f"{folder}/topic")).filter("__deleted = 'false'")
    assert parsed._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    assert parsed.count() == 2
    assert packed(7) == parsed.filter("id_evenement_sportif = 2").first()["distance"]["value"]
