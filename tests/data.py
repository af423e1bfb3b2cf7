"""Small invented inputs."""

import base64
import datetime
import json

from activity_lake.schemas import TABLES, TOPIC, bronze_schema

UTC = datetime.timezone.utc
START = datetime.datetime(2025, 1, 1, tzinfo=UTC)


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def packed(value: int) -> str:
    """Base64 text of the shortest signed bytes of an integer."""
    size = ((value if value >= 0 else value + 1).bit_length() + 8) // 8
    return base64.b64encode(value.to_bytes(size, "big", signed=True)).decode()


def change(key, employee=10, deleted="false", scale=0, value=5, **more):
    event = {
        "id_evenement_sportif": key, "employe_id": employee, "type_pratique_sportive": "Vélo",
        "date": 1735689600000000, "distance": {"scale": scale, "value": packed(value)}, "temps_ecoule": 3725,
        "commentaire": "ok", "__deleted": deleted,
    }
    event.update(more)
    return {name: field for name, field in event.items() if field != "absent"}


def topic(spark, events):
    """Topic rows, one second and one offset apart; an event may be a dict, a raw text or None."""
    rows = []
    for offset, event in enumerate(events):
        text = json.dumps(event, ensure_ascii=False) if isinstance(event, dict) else event
        rows.append((None if text is None else bytearray(text, "utf-8"), at(offset), 0, offset))
    return spark.createDataFrame(rows, TOPIC)


def bronze_rows(spark, events):
    """Bronze rows from (key, employee, deleted, seconds, partition, offset)."""
    rows = [
        (key, employee, "Vélo", START, 60, None, deleted, at(seconds), None, partition, offset, None, None)
        for key, employee, deleted, seconds, partition, offset in events
    ]
    return spark.createDataFrame(rows, bronze_schema())


def employees(spark, rows):
    """Employees from (id, address, mode)."""
    day = datetime.date(1990, 1, 1)
    return spark.createDataFrame(
        [(key, f"Nom{key}", f"Prenom{key}", day, 1, day, None, 0, address, mode, 25) for key, address, mode in rows],
        TABLES["salarie"].schema,
    )


# Ids and labels of the transport modes.
MODES = [(0, "Transports en commun"), (1, "véhicule thermique/électrique"), (2, "Marche/running"), (3, "Vélo/Trottinette/Autres")]


def modes(spark):
    return spark.createDataFrame(MODES, TABLES["moyen_deplacement"].schema)


def as_dict(frame, key, *columns):
    return {row[key]: row[columns[0]] if len(columns) == 1 else tuple(row[c] for c in columns) for row in frame.collect()}
