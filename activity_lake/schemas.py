"""Declared schemas, and the constraints of the relational model that the quality checks verify."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


LONG, INT, TEXT, DAY, FLAG, TIME = (
    T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.BooleanType(), T.TimestampType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# The column names and types of the tables and messages below.

# One change event, flattened: the row itself plus a textual delete marker.
CHANGE_VALUE = _struct(
    id_evenement_sportif=LONG, employe_id=LONG, type_pratique_sportive=TEXT, date=TEXT,
    distance=_struct(scale=INT, value=TEXT), temps_ecoule=LONG, commentaire=TEXT, __deleted=TEXT,
)

# What the topic source delivers and what the decoder reads.
TOPIC = _struct(value=T.BinaryType(), timestamp=TIME, partition=INT, offset=LONG)


def bronze_schema(precision: int = 10, scale: int = 0) -> T.StructType:
    return _struct(
        id_evenement_sportif=LONG, employe_id=LONG, type_pratique_sportive=TEXT, date=TIME, temps_ecoule=LONG,
        commentaire=TEXT, is_deleted=FLAG, kafka_ts=TIME, distance_km=T.DecimalType(precision, scale),
        kafka_partition=INT, kafka_offset=LONG, reject_reason=TEXT, raw_value=TEXT,
    )


@dataclass(frozen=True)
class Table:
    """A relational table: schema, primary key, required columns and foreign keys (column, parent table, parent key)."""

    schema: T.StructType
    primary_key: tuple[str, ...]
    required: tuple[str, ...]
    foreign_keys: tuple[tuple[str, str, str], ...] = ()


TABLES = {
    "departement": Table(
        _struct(departement_id=LONG, nom_departement=TEXT),
        ("departement_id",),
        ("departement_id", "nom_departement"),
    ),
    "contrat": Table(
        _struct(contrat_id=LONG, nom_contrat=TEXT),
        ("contrat_id",),
        ("contrat_id", "nom_contrat"),
    ),
    "moyen_deplacement": Table(
        _struct(moyen_deplacement_id=LONG, nom_moyen_deplacement=TEXT),
        ("moyen_deplacement_id",),
        ("moyen_deplacement_id", "nom_moyen_deplacement"),
    ),
    "salarie": Table(
        _struct(
            employe_id=LONG, nom_employe=TEXT, prenom_employe=TEXT, date_naissance_employe=DAY,
            departement_id=LONG, date_embauche=DAY, salaire=T.DecimalType(18, 2), type_contrat_id=LONG,
            adresse=TEXT, moyen_deplacement_id=LONG, nombre_conges=LONG,
        ),
        ("employe_id",),
        (
            "employe_id", "nom_employe", "prenom_employe", "date_naissance_employe", "departement_id",
            "date_embauche", "salaire", "type_contrat_id", "adresse", "moyen_deplacement_id", "nombre_conges",
        ),
        (
            ("departement_id", "departement", "departement_id"),
            ("type_contrat_id", "contrat", "contrat_id"),
            ("moyen_deplacement_id", "moyen_deplacement", "moyen_deplacement_id"),
        ),
    ),
    "pratique_sport": Table(
        _struct(
            id_evenement_sportif=LONG, employe_id=LONG, type_pratique_sportive=TEXT, date=TIME,
            distance=T.DecimalType(38, 18), temps_ecoule=LONG, commentaire=TEXT,
        ),
        ("id_evenement_sportif",),
        ("id_evenement_sportif", "employe_id", "type_pratique_sportive", "date", "temps_ecoule"),
        (("employe_id", "salarie", "employe_id"),),
    ),
    "avantage_salarie": Table(
        _struct(
            employe_id=LONG, annee=INT, eligible_prime_salaire=FLAG, montant_prime=T.DecimalType(18, 2),
            eligible_jour_be=FLAG, nb_activite_annee=INT, avantage_id=LONG,
        ),
        ("avantage_id",),
        (
            "employe_id", "annee", "eligible_prime_salaire", "montant_prime", "eligible_jour_be",
            "nb_activite_annee", "avantage_id",
        ),
        (("employe_id", "salarie", "employe_id"),),
    ),
}

# The employee file has the columns of `salarie` in another order; the survey has an optional sport.
EMPLOYEE_CSV = _struct(
    employe_id=LONG, nom_employe=TEXT, prenom_employe=TEXT, date_naissance_employe=DAY, date_embauche=DAY,
    nombre_conges=LONG, salaire=T.DecimalType(18, 2), adresse=TEXT, type_contrat_id=LONG, departement_id=LONG,
    moyen_deplacement_id=LONG,
)
SURVEY_CSV = T.StructType([
    T.StructField("ID salarié", T.LongType()),
    T.StructField("Pratique d'un sport", T.StringType()),
])
