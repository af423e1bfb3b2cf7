import pytest
from pyspark.sql import functions as F

from activity_lake.operators import joins
from tests.data import as_dict


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("join", ["name", "lookup", "orphans", "label"])
def test_hot_key_is_split(spark, no_broadcast, join):
    """Two thirds of the rows share a key: the join splits its partition, and the result is whole."""
    count = 120_000
    hot = F.when(F.col("id") % 3 > 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(20_000)))
    rows = spark.range(0, count, 1, 8).select(hot.alias("employe_id"), F.md5(F.col("id").cast("string")).alias("text"))
    people = spark.range(20_000).select(
        F.col("id").alias("employe_id"), F.lit("A").alias("prenom_employe"), F.md5(F.col("id").cast("string")).alias("nom_employe")
    )
    if join == "name":
        joined, expected = joins.with_person_name(rows, people), count
    elif join == "lookup":
        joined, expected = joins.with_lookup(rows, people, "employe_id", "nom_employe", "?"), count
    elif join == "label":
        joined, expected = joins.with_label(rows, people, "employe_id"), count
    else:
        even = people.filter("employe_id % 2 = 0")
        joined, expected = joins.orphans(rows, even, "employe_id", "employe_id"), rows.filter("employe_id % 2 = 1").count()
    everything = joined.agg(F.count(F.lit(1)).alias("n"), *[F.max(column) for column in joined.columns])
    assert everything.first()["n"] == expected
    assert "skew=true" in _final_plan(everything)


def _final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_join_back_keeps_rows_and_columns(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k bigint, x string")
    results = spark.createDataFrame([(1, 0.5, "no"), (3, 1.0, "no")], "k bigint, km double, other string")
    joined = joins.join_back(rows, results, "k", ["km"])
    assert joined.columns == ["k", "x", "km"]
    assert as_dict(joined, "x", "k", "km") == {"a": (1, 0.5), "b": (1, 0.5), "c": (2, None), "d": (None, None)}
    counts = spark.createDataFrame([(1, 4)], "k bigint, n bigint")
    assert as_dict(joins.with_count(rows, counts, "k", "n"), "x", "n") == {"a": 4, "b": 4, "c": 0, "d": 0}


def test_names_fall_back(spark):
    people = spark.createDataFrame([(1, "A", "B")], "employe_id bigint, prenom_employe string, nom_employe string")
    rows = spark.createDataFrame([(1,), (2,)], "employe_id bigint")
    assert as_dict(joins.with_person_name(rows, people), "employe_id", "nom_complet") == {1: "A B", 2: "Employé #2"}


def test_values_are_kept_by_label(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "label string")
    assert joins.keep_values(rows, "label", ["a", "c"]).collect() == [("a",)]
