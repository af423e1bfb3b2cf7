import json
import os
import random
import re

import pytest

from activity_lake.operators import metrics
from activity_lake.operators.keys import with_next_keys
from activity_lake.operators.synth import synthetic_activities
from activity_lake.config import COMMENTS, SPORTS
from activity_lake.schemas import EMPLOYEE_CSV, SURVEY_CSV, TABLES
from activity_lake.session import scratch_dir, shared_root
from activity_lake.sinks.streams import as_topic_rows
from activity_lake.sources import files, polling, relational, topics
from activity_lake.sources.column_json import cells, read_column_document
from tests.data import as_dict
from pyspark.sql import functions as F


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


def test_employee_file_with_quoted_addresses(spark, folder):
    path = write(f"{folder}/e.csv", ",".join(EMPLOYEE_CSV.fieldNames()) + '\n1,Nom,Prénom,1990-07-06,2020-12-14,29,30940,"12, rue ""X""",1,2,3\n')
    row = files.read_csv(spark, path, EMPLOYEE_CSV).first()
    assert row.adresse == '12, rue "X"' and row.salaire == 30940 and row.moyen_deplacement_id == 3
    assert set(EMPLOYEE_CSV.fieldNames()) == set(TABLES["salarie"].schema.fieldNames())


def test_survey_file_with_missing_sports(spark, folder):
    path = write(f"{folder}/s.csv", "ID salarié,Pratique d'un sport\n1,Tennis\n2,\n")
    assert [tuple(row) for row in files.read_csv(spark, path, SURVEY_CSV).collect()] == [(1, "Tennis"), (2, None)]


def test_column_oriented_json(spark, folder):
    document = {"ID salarié": {"0": 59, "1": 19, "10": 7}, "Pratique d'un sport": {"0": None, "1": "Tennis", "10": "Vélo"}}
    write(f"{folder}/a/one.json", json.dumps(document))
    write(f"{folder}/a/two.json", json.dumps({"ID salarié": {"0": 1}}))
    rows = files.read_column_json(spark, f"{folder}/a", {"ID salarié": "bigint", "Pratique d'un sport": "string"})
    assert sorted((os.path.basename(r[0]), *r[1:]) for r in rows.collect())[1:] == [
        ("one.json", 1, 19, "Tennis"), ("one.json", 10, 7, "Vélo"), ("two.json", 0, 1, None)
    ]
    assert rows.count() == 4


def test_absent_table_is_none_and_other_errors_are_raised(spark, folder):
    assert files.read_if_present(spark, f"{folder}/nothing") is None
    os.makedirs(f"{folder}/empty")
    assert files.read_if_present(spark, f"{folder}/empty") is None
    write(f"{folder}/broken/part-0.parquet", "this is not parquet")
    with pytest.raises(Exception, match="(?i)parquet|FAILED_READ"):
        files.read_if_present(spark, f"{folder}/broken").count()


def test_first_data_file_and_file_time(spark, folder):
    assert files.first_data_file(spark, f"{folder}/none") is None
    spark.range(40).repartition(3).write.parquet(f"{folder}/t")
    first = files.first_data_file(spark, f"{folder}/t")
    assert os.path.basename(first) == min(name for name in os.listdir(f"{folder}/t") if name.endswith(".parquet"))
    newest = max(os.path.getmtime(f"{folder}/t/{name}") for name in os.listdir(f"{folder}/t") if name.endswith(".parquet"))
    got = files.last_modified_ms(spark.read.parquet(f"{folder}/t")).first()[0]
    assert abs(got - newest * 1000) < 2


def test_published_metrics(spark, folder):
    rows = spark.createDataFrame([(1, 4), (2, None), (3, 0)], "employe_id bigint, pratique_sportive_annuelle bigint")
    rows.write.parquet(f"{folder}/s")
    snapshot = spark.read.parquet(f"{folder}/s")
    samples = metrics.gauges(snapshot)
    values = as_dict(samples, "metric", "value")
    assert values[metrics.TOTAL] == 4 and values[metrics.PEOPLE] == 3 and values[metrics.UPDATED] > 1.6e12
    metrics.append_gauges(samples, f"{folder}/m")
    metrics.append_gauges(samples, f"{folder}/m")
    assert spark.read.parquet(f"{folder}/m").count() == 6
    plan = metrics.volume(snapshot)._jdf.queryExecution().executedPlan().toString()
    assert "employe_id" not in plan[plan.index("FileScan"):]


def test_last_value_in_a_range(spark):
    samples = spark.createDataFrame(
        [("a", 1.0, "2025-01-01 10:00:00"), ("a", None, "2025-01-01 11:00:00"), ("a", 9.0, "2025-01-01 13:00:00"),
         ("b", 2.0, "2025-01-01 05:59:59"), ("c", 3.0, "2025-01-01 06:00:00")], "metric string, value double, at string",
    ).withColumn("at", F.to_timestamp("at"))
    recent = metrics.within(samples, F.to_timestamp(F.lit("2025-01-01 12:00:00")))
    assert as_dict(metrics.last_not_null(recent), "metric", "value") == {"a": 1.0, "c": 3.0}


def test_broker_options():
    options = topics.broker_options("h:9092", ["a", "b"], max_per_trigger=5)
    assert options == {"kafka.bootstrap.servers": "h:9092", "startingOffsets": "earliest", "subscribe": "a,b", "maxOffsetsPerTrigger": "5"}
    assert topics.broker_options("h", pattern="cdc.*", starting="latest")["subscribePattern"] == "cdc.*"
    for wrong in ({}, {"topics": ["a"], "pattern": "b"}):
        with pytest.raises(ValueError):
            topics.broker_options("h", **wrong)


def test_relational_options(spark):
    options = relational.table_options({"url": "jdbc:x"}, "public.salarie", "employe_id", 1, 100, 4)
    assert options == {
        "url": "jdbc:x", "dbtable": "public.salarie", "partitionColumn": "employe_id", "lowerBound": "1",
        "upperBound": "100", "numPartitions": "4",
    }
    assert relational.table_options({"url": "jdbc:x"}, "t") == {"url": "jdbc:x", "dbtable": "t"}
    with pytest.raises(ValueError):
        relational.table_options({}, "t", "k")
    assert relational.max_key_query("t", "k") == "SELECT COALESCE(MAX(k), 0) AS max_key FROM t"
    assert relational.max_key(spark.range(5), "id").first()[0] == 4 and relational.max_key(spark.range(0), "id").first()[0] == 0
    assert relational.look_up(spark.range(5), "id", 3, "id").collect() == [(3,)]


def test_envelope_and_messages(spark):
    rows = spark.createDataFrame([(1, None)], "id bigint, name string")
    wrapped = polling.with_envelope(rows, "src", F.to_timestamp(F.lit("2025-01-01 00:00:00")))
    assert wrapped.first()["metadata"]["source"] == "src"
    message = json.loads(as_topic_rows(wrapped, "id").first()["value"])
    assert message["id"] == 1 and message["name"] is None and message["metadata"]["source"] == "src"


def test_polling_sends_the_whole_table_each_time(spark, folder):
    import time

    def send(rows, batch_id):
        rows.write.parquet(f"{folder}/out/batch={batch_id}")

    query = polling.start_polling(spark, lambda: spark.range(3), send, "src", f"{folder}/c", "1 second")
    try:
        deadline = time.time() + 60
        while query.lastProgress is None or query.lastProgress.batchId < 1:
            assert time.time() < deadline
            time.sleep(0.5)
    finally:
        query.stop()
    sent = spark.read.parquet(f"{folder}/out/batch=0")
    assert sent.count() == 3 and sent.first()["metadata"]["source"] == "src"


def test_next_keys_follow_the_order_without_gaps(spark):
    new = spark.createDataFrame([(f"n{n:03d}", n % 5) for n in range(300)], "name string, grp int").repartition(7)
    existing = spark.createDataFrame([(41,), (7,)], "id bigint")
    rows = with_next_keys(new, existing, "id", ["grp", "name"], partitions=6).collect()
    wanted = sorted(((n % 5, f"n{n:03d}") for n in range(300)))
    assert [(row.grp, row.name) for row in sorted(rows, key=lambda row: row.id)] == wanted
    assert sorted(row.id for row in rows) == list(range(42, 342))
    assert [row.id for row in with_next_keys(new.limit(1), existing.limit(0), "id", ["name"]).collect()] == [1]


def test_synthetic_activities(spark):
    people = spark.createDataFrame([(100 + n,) for n in range(7)], "employe_id bigint")
    numbers = spark.range(1, 2001)
    rows = synthetic_activities(people, numbers, seed=1)
    first = {row.id_evenement_sportif: row for row in rows.collect()}
    assert sorted(first) == list(range(1, 2001))
    assert {row.id_evenement_sportif: row for row in synthetic_activities(people, numbers.repartition(5), seed=1).collect()} == first
    assert {row.employe_id for row in first.values()} == set(range(100, 107))
    assert {row.type_pratique_sportive for row in first.values()} == set(SPORTS)
    assert {row.commentaire for row in first.values()} == set(COMMENTS)
    assert {row.distance for row in first.values()} == set(range(1, 15))
    assert {row.date.year for row in first.values()} == {2025} and len({row.date for row in first.values()}) > 350
    assert all(600 <= row.temps_ecoule <= 3599 for row in first.values())
    assert synthetic_activities(people, numbers, seed=2).first() != first[1]


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("block", [64, 1_000_000])
def test_one_document_in_blocks(spark, folder, block):
    rng = random.Random(block)
    texts = ["", "a,b", '"', ',"', '\\\\",', "}{", '{"x":{', "é,\\n", None, 'end\\\\']
    document = {"id": {str(i): i * 3 for i in range(60)}, "empty": {}, 'odd "name", {': {"1": 1},
                "t": {str(i): rng.choice(texts) for i in range(50, -1, -1)}, "f": {"7": 1.5, "8": True, "61": None}}
    for name, text in (("dense", json.dumps(document, separators=(",", ":"))), ("spaced", json.dumps(document, ensure_ascii=False) + "\n")):
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/doc.json", "w", encoding="utf-8") as out:
            out.write(text)
        before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        try:
            for key in before:
                spark.conf.set(key, block)
            made = read_column_document(spark, f"{folder}/{name}", {"id": "bigint", "t": "string", "f": "string"})
            rows = {r["row_index"]: (r["id"], r["t"], r["f"]) for r in made.collect()}
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)
        show = {1.5: "1.5", True: "true", None: None}
        want = {i: (document["id"].get(str(i)), document["t"].get(str(i)), show[document["f"].get(str(i))]) for i in [*range(60), 61]}
        assert rows == want


def test_a_document_is_neither_shuffled_nor_written_with_its_path(spark, folder):
    path = f"{folder}/{'long-' * 30}"
    os.makedirs(path)
    with open(f"{path}/doc.json", "w") as out:
        json.dump({"id": {str(i): i for i in range(20_000)}}, out)
    spark.sparkContext.setCheckpointDir(f"{folder}/kept")
    try:
        found = cells(spark, path)
        assert found.agg(F.sum(F.col("value").cast("bigint")), F.countDistinct("row_index")).first() == (199_990_000, 20_000)
    finally:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    written = sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(f"{folder}/kept") for name in names)
    assert written < 20_000 * 80
    # what meets elsewhere is one entry a block
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) <= {"entry"}


def test_empty_documents(spark, folder):
    for name, text in (("a", "{}"), ("b", '{"id":{}}'), ("c", "")):
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/doc.json", "w") as out:
            out.write(text)
        assert read_column_document(spark, f"{folder}/{name}", {"id": "bigint"}).count() == 0
