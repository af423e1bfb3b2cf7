from pyspark.sql import functions as F

from activity_lake.config import SPORTS
from activity_lake.operators import quality
from activity_lake.operators.joins import orphans, with_lookup
from activity_lake.schemas import TABLES
from tests.data import as_dict, employees, modes

ROWS = [(1, 5.0, "Vélo"), (2, 0.01, "Voile"), (3, 0.0, "Tennis"), (4, None, None), (4, -1.0, "Marche")]


def activities(spark):
    return spark.createDataFrame(ROWS, "id bigint, distance double, type_pratique_sportive string")


def test_activity_suite(spark):
    results = quality.run_suite(activities(spark), quality.activity_expectations(SPORTS), "controles")
    got = as_dict(results, "column_name", "success", "element_count", "missing_count", "unexpected_count", "unexpected_percent")
    assert got == {"distance": (False, 5, 1, 2, 50.0), "type_pratique_sportive": (False, 5, 1, 1, 25.0)}
    verdict = quality.suite_success(results).first()
    assert (verdict["success"], verdict["expectations"], verdict["failed"]) == (False, 2, 2)


def test_open_and_closed_bounds(spark):
    checks = [quality.Between("distance", None, 0.0), quality.Between("distance"), quality.Between("distance", -1, 5)]
    results = quality.run_suite(activities(spark), checks)
    assert sorted(row["unexpected_count"] for row in results.collect()) == [0, 0, 2]


def test_row_checks_take_one_pass(spark, folder):
    activities(spark).write.parquet(f"{folder}/a")
    checks = [*quality.activity_expectations(SPORTS), quality.NotNull("id")]
    plan = quality.run_suite(spark.read.parquet(f"{folder}/a"), checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_required_unique_and_parent(spark):
    parents = spark.createDataFrame([(1,), (2,), (2,), (None,)], "pid bigint")
    rows = spark.createDataFrame([(1, 1), (2, 2), (2, 7), (None, None), (None, 7)], "id bigint, parent bigint")
    checks = [quality.NotNull("id"), quality.Unique(("id",)), quality.References("parent", parents, "pid", "parents")]
    got = as_dict(quality.run_suite(rows, checks), "expectation", "element_count", "missing_count", "unexpected_count")
    assert got == {
        quality.NotNull.name: (5, 2, 2), quality.Unique.name: (5, 2, 2), quality.References.name: (5, 1, 2),
    }
    assert as_dict(quality.duplicate_keys(rows.filter("id IS NOT NULL"), "id"), "id", "copies") == {2: 2}
    assert as_dict(quality.orphan_keys(rows, parents, "parent", "pid"), "parent", "orphan_rows") == {7: 2}
    assert orphans(rows, parents, "parent", "pid").count() == 2


def test_empty_table_meets_every_expectation(spark):
    empty = activities(spark).limit(0)
    checks = [*quality.activity_expectations(SPORTS), quality.NotNull("id"), quality.Unique(("id",))]
    rows = quality.run_suite(empty, checks).collect()
    assert all(row["success"] and row["element_count"] == 0 and row["unexpected_percent"] == 0.0 for row in rows)


def test_report_lines(spark):
    checks = [quality.Between("distance", 0.01), quality.NotNull("type_pratique_sportive"), quality.InSet("id", (1, 2, 3, 4))]
    results = quality.run_suite(activities(spark), checks)
    lines = as_dict(quality.with_report_line(results), "column_name", "report_line")
    assert lines["distance"] == "-- KO -- [distance] expect_column_values_to_be_between {min_value=0.01, max_value=None} : 2/5 (50.0%)"
    assert lines["id"].startswith("-- OK -- [id]") and lines["id"].endswith("{value_set=1|2|3|4}")


def test_declared_constraints(spark):
    people = employees(spark, [(1, "a", 2), (1, "b", 3), (3, None, 9)]).withColumn("salaire", F.lit(1).cast("decimal(18,2)"))
    checks = quality.table_expectations(TABLES["salarie"], {"moyen_deplacement": modes(spark)})
    failed = {
        (row["expectation"], row["column_name"]): row["unexpected_count"]
        for row in quality.run_suite(people, checks).filter("NOT success").collect()
    }
    assert failed == {
        (quality.NotNull.name, "adresse"): 1, (quality.Unique.name, "employe_id"): 2,
        (quality.References.name, "moyen_deplacement_id"): 1,
    }
    assert all(set(table.primary_key) <= set(table.required) <= set(table.schema.fieldNames()) for table in TABLES.values())
    assert sum(len(table.foreign_keys) for table in TABLES.values()) == 5


def test_null_in_a_set_passes_nothing(spark):
    rows = spark.createDataFrame([("a",), ("zz",), (None,)], "v string")
    for values, bad in ((("a", None), 1), ((None,), 2), (("a", "zz"), 0)):
        result = quality.run_suite(rows, [quality.InSet("v", values)]).first()
        assert (result["unexpected_count"], result["missing_count"], result["success"]) == (bad, 1, bad == 0)


def test_lookup_default(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    labels = spark.createDataFrame([(1, 7)], "k bigint, q int")
    assert as_dict(with_lookup(rows, labels, "k", "q", "none"), "k", "q") == {1: "7", 2: "none", None: "none"}
