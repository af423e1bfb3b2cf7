"""Every operator as a query over the test tables. Timestamps are returned as epoch microseconds."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from decimal import Decimal

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.config import DISK_STEPS, LakePaths
from activity_lake.functions.decimals import decode_decimal, encode_integer
from activity_lake.functions.rules import check_limit, level, map_category, percent_used
from activity_lake.operators import bronze, joins, metrics, notify, quality
from activity_lake.operators.current_state import (
    count_by, drop_deleted, grand_total, latest_by_hash, latest_by_max, latest_by_rank, live_counts,
)
from activity_lake.operators.delivery import Delivery
from activity_lake.operators.keys import KeyRanges, with_next_keys
from activity_lake.operators.lookup import DistanceCache, lookup_keys
from activity_lake.operators.quality_state import SuiteState
from activity_lake.operators.synth import synthetic_activities
from activity_lake.plans.buckets import BucketStore
from activity_lake.plans.gate import MODES, is_changed
from activity_lake.plans.publish import SnapshotStore
from activity_lake.plans.silver import with_lineage
from activity_lake.session import scratch_dir
from activity_lake.sinks.compaction import CompactedTable
from activity_lake.sinks.streams import append_parquet, as_topic_rows, each_batch
from activity_lake.sources.column_json import read_column_document
from activity_lake.sources.files import columns_from_json, first_data_file, read_bronze, read_csv, stream_parquet
from activity_lake.sources.indexed import look_up_keys, rows_scanned, write_indexed
from activity_lake.sources.polling import with_envelope
from activity_lake.sources.relational import max_key
from activity_lake.sources.topics import stream_topic_files
from activity_lake.schemas import bronze_schema
from activity_lake.standins import (
    DELETE_TYPE, SOFT_SEGMENTS, as_topic, cents, event_key, keyed_state, micros, stream_table, table,
)
from activity_lake.streaming import keyed_state as keyed_state_counts
from activity_lake.streaming.incremental import IncrementalCounts
from activity_lake.streaming.orphans import stream_orphans
from activity_lake.streaming.runners import SilverRefresh, start_bronze, start_notifications, start_silver

Query = Callable[[SparkSession, str], DataFrame]
COUNT = "pratique_sportive_annuelle"
_LOOKUP_MODES = {segment: mode for segment, (mode, _) in SOFT_SEGMENTS.items()}
_LIMITS = {segment: limit for segment, (_, limit) in SOFT_SEGMENTS.items()}

# Bronze and current state


def _shown_bronze(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id_evenement_sportif", "employe_id", "type_pratique_sportive", F.unix_micros("date").alias("date_us"),
        "temps_ecoule", "commentaire", "is_deleted", F.unix_micros("kafka_ts").alias("kafka_us"),
        F.col("distance_km").cast("bigint").alias("distance_km"), "kafka_partition", "kafka_offset",
    )


def bronze_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_bronze(bronze.to_bronze(as_topic(table(spark, sf_dir, "events"))))


def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events damaged in a way that depends on their type; counts per reason."""
    kind = F.col("event_type")
    text = F.concat(
        F.lit('{"id_evenement_sportif":'), F.col("event_id").cast("string"),
        F.lit(',"employe_id":'), F.col("user_id").cast("string"),
        F.lit(',"date":"'), F.when(kind == "click", "soon").otherwise(micros("ts").cast("string")),
        F.lit('","distance":{"scale":2,"value":"'),
        F.when(kind == "signup", "not base64").otherwise(encode_integer(cents())), F.lit('"},"__deleted":"false"'),
        F.when(kind == "view", "").otherwise("}"),
    )
    topic = table(spark, sf_dir, "events").select(
        F.when(kind != "error", text).cast("binary").alias("value"), F.timestamp_micros(micros("ts")).alias("timestamp"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
    )
    return bronze.reject_counts(bronze.to_bronze(topic))


def decimal_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed decimals whose scale changes from row to row, and the key times 2^160 at scale 48, of 49 digits and more."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") * 1000003 - 5000000000).alias("_unscaled"),
        (F.col("o_orderkey") % 7).cast("int").alias("_scale"),
    )
    value = decode_decimal(encode_integer(F.col("_unscaled")), F.col("_scale"), 38, 6)
    wide = F.base64(F.unhex(F.concat(F.lpad(F.hex("o_orderkey"), 16, "0"), F.lit("0" * 40))))
    return orders.select(
        "o_orderkey", (value * 1000000).cast("bigint").alias("millionths"),
        decode_decimal(wide, F.lit(48), 38, 0).cast("bigint").alias("wide"),
    )


def decimal_unsigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bytes read without a sign, and nine."""
    low = F.col("o_orderkey") % 65536
    two, nine = F.lpad(F.hex(low), 4, "0"), F.concat(F.lit("FF"), F.lpad(F.hex("o_orderkey"), 16, "0"))
    decoded = [decode_decimal(F.base64(F.unhex(digits)), F.lit(0), 38, 0, signed=False) for digits in (two, nine)]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", decoded[0].cast("bigint").alias("two_bytes"),
        (decoded[1] - F.lit(Decimal(255 * 2**64))).cast("bigint").alias("nine_bytes"),
    )


def _state_columns(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "event_id", "event_type", "value", micros("ts").alias("ts_us"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")


def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_columns(latest_by_rank(_events(spark, sf_dir), ["user_id"], ["ts"]))


def current_state_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_columns(latest_by_max(_events(spark, sf_dir), ["user_id"], ["ts"]))


def live_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _events(spark, sf_dir).withColumn("is_deleted", F.col("event_type") == DELETE_TYPE)
    return _state_columns(drop_deleted(latest_by_rank(flagged, ["user_id"], ["ts"])))


def live_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_by_hash(keyed_state(table(spark, sf_dir, "events")), ["id_evenement_sportif"], "ts")
    return count_by(drop_deleted(newest), "employe_id", COUNT)


def change_stream_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: topic rows, decoded, newest per activity, deletes dropped, counted per employee."""
    return live_counts(bronze.to_bronze(as_topic(table(spark, sf_dir, "events"), event_key())))


def live_count_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events are of one year, so a day shift by the key spreads the activities over three."""
    return live_counts(bronze.to_bronze(_events_of_years(table(spark, sf_dir, "events"))), year=2024)


def _events_of_years(events: DataFrame) -> DataFrame:
    return as_topic(events, event_key(), date=micros("ts") + event_key() % 3 * F.lit(366 * 86_400_000_000))


def total_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grand_total(live_count(spark, sf_dir), COUNT)


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bronze_out_of_order(spark: SparkSession, sf_dir: str, path: str) -> int:
    """A Bronze table with the events of an activity spread over its files; returns how many files there are."""
    files = max(_shuffle_partitions(spark), 4)
    rows = bronze.to_bronze(as_topic(table(spark, sf_dir, "events"), event_key()))
    rows.repartition(files, "kafka_offset").write.parquet(path)
    return files


def incremental_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts kept batch by batch, with the events arriving out of order."""
    paths = LakePaths(scratch_dir(spark, "incremental-count"))
    _bronze_out_of_order(spark, sf_dir, paths.bronze)
    state = IncrementalCounts(spark, paths.event_state, buckets=8)
    history = read_bronze(spark, paths.bronze)
    for batch in range(3):
        state.apply(history.filter(F.pmod(F.hash("kafka_offset"), F.lit(3)) == batch), batch)
    return state.counts()


# Silver


def mode_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    labelled = joins.with_label(table(spark, sf_dir, "customer"), nations, "c_nationkey")
    return joins.keep_values(labelled, "c_mktsegment", list(SOFT_SEGMENTS)).select(
        "c_custkey", "c_name", "c_nationkey", "n_name", "c_mktsegment"
    )


def threshold_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    km = F.col("c_nationkey").cast("double")
    return mode_filter(spark, sf_dir).select(
        "c_custkey", "c_mktsegment", map_category(F.col("c_mktsegment"), _LOOKUP_MODES).alias("lookup_mode"),
        km.alias("distance_km"), check_limit(F.col("c_mktsegment"), km, _LIMITS).alias("coherence_distance"),
    )


def enrich_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.join_back(customers, threshold_check(spark, sf_dir), "c_custkey", ["distance_km", "coherence_distance"])


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return joins.with_count(enrich_back(spark, sf_dir), count_by(done, "c_custkey", COUNT), "c_custkey", COUNT)


def change_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each mode of the gate says about a copy whose distances changed and whose total did not."""
    new = silver(spark, sf_dir)
    old = new.withColumn("distance_km", F.col("distance_km") + 1)
    return spark.createDataFrame([(mode, is_changed(new, old, COUNT, mode)) for mode in MODES], "gate string, is_changed boolean")


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "folder")


def publish_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "file")


def _published(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    store = SnapshotStore(spark, scratch_dir(spark, "silver"), layout)
    store.write(silver(spark, sf_dir), COUNT)
    store.publish()
    return store.read_published("c_custkey", "distance_km", "coherence_distance", COUNT)


def publish_at_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version that was written but not published is published when the stream starts, without any new event."""
    paths = LakePaths(scratch_dir(spark, "publish-at-start"))
    refresh = SilverRefresh(spark, paths, lambda: None, lambda: None, lambda keys: None)
    refresh.store.write(silver(spark, sf_dir), COUNT)
    start_silver(spark, paths, refresh, interval=None).awaitTermination()
    return refresh.store.read_published("c_custkey", "distance_km", "coherence_distance", COUNT)


def silver_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of every row, and that it has a time of processing."""
    rows = with_lineage(enrich_back(spark, sf_dir), 7)
    return rows.select("c_custkey", "batch_id", F.col("processing_time").isNotNull().alias("has_time"))


# Quality


def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_results(quality.run_suite(table(spark, sf_dir, "customer"), [quality.Between("c_acctbal", 0.01)]))


def dq_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = quality.InSet("event_type", ("click", "purchase", "signup", "view"))
    return _shown_results(quality.run_suite(table(spark, sf_dir, "events"), [allowed]))


def dq_in_set_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL in the set lets nothing else pass."""
    return _shown_results(quality.run_suite(table(spark, sf_dir, "events"), [quality.InSet("event_type", ("click", None, "view"))]))


def _shown_results(results: DataFrame) -> DataFrame:
    return results.select(
        "expectation", "column_name", "success", "element_count", "missing_count", "unexpected_count",
        F.round("unexpected_percent", 4).alias("unexpected_percent"),
    )


def _event_checks(spark: SparkSession, sf_dir: str) -> list:
    return [
        quality.Between("value", 0.01, 400.0), quality.InSet("event_type", ("click", "purchase", "signup", "view")),
        quality.NotNull("user_id"), quality.Unique(("event_id",)),
        quality.References("event_id", table(spark, sf_dir, "customer"), "c_custkey", "customer"),
    ]


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_results(quality.run_suite(table(spark, sf_dir, "events"), _event_checks(spark, sf_dir)))


def dq_suite_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [quality.Between("l_quantity", 1, 50), quality.InSet("l_linestatus", ("O", "F")), quality.Between("l_tax", 0, 0.05)]
    return quality.suite_success(quality.run_suite(table(spark, sf_dir, "lineitem"), checks, "lineitem"))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [quality.Between("l_quantity", 1, 50), quality.InSet("l_returnflag", ("A", "N"))]
    results = quality.run_suite(table(spark, sf_dir, "lineitem"), checks)
    return quality.with_report_line(results).select("report_line")


def dq_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns of the documents with their labels, where a label may be missing."""
    labelled = joins.join_back(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id", ["quality"])
    return _shown_results(quality.run_suite(labelled, [quality.NotNull(name) for name in ("doc_id", "lang", "quality")]))


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def dq_unique_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return _shown_results(quality.run_suite(turns, [quality.Unique(("conv_id", "turn")), quality.Unique(("conv_id",))]))


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return joins.orphans(documents, table(spark, sf_dir, "labels"), "doc_id", "doc_id")


def dq_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose number no supplier has; there are more parts than suppliers."""
    return joins.orphan_keys(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier"), "l_partkey", "s_suppkey")


# Notification


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the role of employees. Events name their own number as employee, and not every number is a customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("employe_id"), F.col("c_mktsegment").alias("prenom_employe"),
        F.col("c_name").alias("nom_employe"),
    )


def notify_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = bronze.parse_changes(as_topic(table(spark, sf_dir, "events"), owner=F.col("event_id")))
    return notify.messages(parsed, _people(spark, sf_dir)).select("kafka_offset", "employe_id", "message_text")


def stream_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream, delivered by a sender that refuses some of them."""
    paths = LakePaths(scratch_dir(spark, "outbox"))
    topic = as_topic(stream_table(spark, sf_dir, "events"), owner=F.col("event_id"))

    def send(texts: pd.Series) -> pd.Series:
        return texts.str.contains("view").map({True: 500, False: 200})

    start_notifications(topic, _people(spark, sf_dir), paths, interval=None, send=send).awaitTermination()
    return spark.read.parquet(paths.outbox).select("kafka_offset", "employe_id", "status", "status_code")


def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return joins.with_lookup(documents, table(spark, sf_dir, "labels"), "doc_id", "quality", "unknown")


def memo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the soft segments: half of them are in the cache already, the others are asked for."""

    def resolver(keys: pd.DataFrame) -> pd.Series:
        number = keys["adresse"].str.slice(-9).astype("int64")
        return (number % 30) * 1000 + 500.0

    people = threshold_check(spark, sf_dir).select(
        F.col("c_custkey").alias("employe_id"), F.col("lookup_mode").alias("mode"),
        F.format_string("Customer#%09d", "c_custkey").alias("adresse"),
    )
    keys = lookup_keys(people)
    cache = DistanceCache(spark, scratch_dir(spark, "distance_cache"))
    known = keys.filter("employe_id % 2 = 0").withColumn("km", (F.col("employe_id") % 30).cast("double") + 0.5)
    cache.remember(known, 0)
    cache.fill(keys, resolver, 1, parallel_calls=_shuffle_partitions(spark))
    return cache.add_km(people).select("employe_id", "mode", "distance_km")


# Metrics and small reads


def metrics_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.volume(silver(spark, sf_dir), COUNT)


def published_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gauges of a published snapshot; the file time, which changes, is only shown to be there."""
    store = SnapshotStore(spark, scratch_dir(spark, "silver"))
    store.write(silver(spark, sf_dir), COUNT)
    store.publish()
    samples = metrics.gauges(store.read_published(), COUNT)
    return samples.select(
        "metric", F.when(F.col("metric") == metrics.UPDATED, F.signum("value")).otherwise(F.col("value")).alias("value")
    )


def last_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest value per type in the last six hours before noon of the 20th, where values below 50 are unknown."""
    samples = table(spark, sf_dir, "events").select(
        "event_type", "ts", F.when(F.col("value") >= 50, F.col("value")).alias("value")
    )
    recent = metrics.within(samples, F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"), 6, "ts")
    return metrics.last_not_null(recent, "event_type", "value", "ts")


def level_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = percent_used(50 - F.col("l_quantity"), F.lit(50.0))
    return (
        table(spark, sf_dir, "lineitem").select(F.round(used, 6).alias("used"))
        .select(level(F.col("used"), DISK_STEPS).alias("level"))
        .groupBy("level").agg(F.count(F.lit(1)).alias("readings"))
    )


def column_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders packed into column-oriented documents of at most 500 keys, and read back as rows."""
    document = F.floor(F.col("o_orderkey") / 500).alias("document")
    index = F.col("o_orderkey").cast("string")

    def packed(name: str) -> F.Column:
        return F.map_from_entries(F.collect_list(F.struct(index, F.col(name).cast("string")))).alias(name)

    documents = table(spark, sf_dir, "orders").groupBy(document).agg(
        packed("o_custkey"), packed("o_orderpriority")
    ).select("document", F.to_json(F.struct("o_custkey", "o_orderpriority")).alias("json_text"))
    rows = columns_from_json(documents, "json_text", {"o_custkey": "bigint", "o_orderpriority": "string"}, ["document"])
    return rows.select(F.col("row_index").alias("o_orderkey"), "o_custkey", "o_orderpriority")


def csv_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through a CSV file with a header, where a missing segment is an empty value."""
    path = scratch_dir(spark, "customer-csv")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("1, rue \"A\", "), F.col("c_name")).alias("address"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path, rows.schema)


def poll_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_envelope(table(spark, sf_dir, "nation"), "table-polling")
    return rows.select("n_nationkey", "n_name", "n_regionkey", F.col("metadata.source").alias("source"))


def topic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON messages, with missing values kept, and parsed again."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus")
    )
    sent = as_topic_rows(rows, "o_orderkey")
    parsed = sent.select("key", F.from_json("value", rows.schema).alias("row"), F.length("value").alias("json_length"))
    return parsed.select("key", "row.*", "json_length")


def highest_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_key(table(spark, sf_dir, "orders"), "o_orderkey")


def next_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events appended to the orders as new rows."""
    orders = table(spark, sf_dir, "orders")
    new = table(spark, sf_dir, "events").select("event_id", "user_id")
    return with_next_keys(new.withColumnRenamed("user_id", "o_custkey"), orders, "o_orderkey", ["o_custkey", "event_id"])


def synth_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic activity per order, for customers drawn at random."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("employe_id"))
    numbers = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("id"))
    return synthetic_activities(customers, numbers, seed=7).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


# Streams


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LakePaths(scratch_dir(spark, "bronze"))
    start_bronze(as_topic(stream_table(spark, sf_dir, "events")), paths, interval=None).awaitTermination()
    return _shown_bronze(read_bronze(spark, paths.bronze))


def stream_bronze_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze with distances of two decimals."""
    paths = LakePaths(scratch_dir(spark, "bronze-scale"))
    start_bronze(as_topic(stream_table(spark, sf_dir, "events")), paths, interval=None, precision=12, scale=2).awaitTermination()
    rows = read_bronze(spark, paths.bronze, 12, 2)
    return rows.select("kafka_offset", (F.col("distance_km") * 100).cast("bigint").alias("hundredths"))


def stream_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental counts of one year, from a stream."""
    paths = LakePaths(scratch_dir(spark, "year"))
    files = max(_shuffle_partitions(spark), 4)
    rows = bronze.to_bronze(_events_of_years(table(spark, sf_dir, "events")))
    rows.repartition(files, "kafka_offset").write.parquet(paths.bronze)
    state = IncrementalCounts(spark, paths.event_state, buckets=8, year=2024)
    stream = stream_parquet(spark, paths.bronze, bronze_schema(), max_files=files // 2)
    each_batch(stream, state.apply, paths.checkpoint("silver"), interval=None).awaitTermination()
    return state.counts()


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live counts after a stream of Bronze files in no order, recounted from the whole history for each batch."""
    paths = LakePaths(scratch_dir(spark, "recount"))
    written = _bronze_out_of_order(spark, sf_dir, paths.bronze)
    store = SnapshotStore(spark, paths.silver)

    def recount(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            store.write(live_counts(read_bronze(spark, paths.bronze)), COUNT)

    files = stream_parquet(spark, paths.bronze, bronze_schema(), max_files=written // 2)
    each_batch(files, recount, paths.checkpoint("silver"), interval=None).awaitTermination()
    return store.read()


def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the batches alone."""
    paths = LakePaths(scratch_dir(spark, "incremental"))
    written = _bronze_out_of_order(spark, sf_dir, paths.bronze)
    state = IncrementalCounts(spark, paths.event_state, buckets=8)
    files = stream_parquet(spark, paths.bronze, bronze_schema(), max_files=written // 2)
    each_batch(files, state.apply, paths.checkpoint("silver"), interval=None).awaitTermination()
    return state.counts()


def stream_silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole Silver stream: customers as employees, regions as transport modes, distances from the customer number."""
    paths = LakePaths(scratch_dir(spark, "silver-table"))
    written = _bronze_out_of_order(spark, sf_dir, paths.bronze)

    def read_employees() -> DataFrame:
        return table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("employe_id"), F.col("c_name").alias("adresse"),
            (F.col("c_nationkey") % 5).cast("bigint").alias("moyen_deplacement_id"),
        )

    def read_modes() -> DataFrame:
        key = F.col("r_regionkey")
        label = F.when(key == 2, "Marche/running").when(key == 3, "Vélo/Trottinette/Autres").otherwise(F.col("r_name"))
        return table(spark, sf_dir, "region").select(
            key.cast("bigint").alias("moyen_deplacement_id"), label.alias("nom_moyen_deplacement")
        )

    def resolver(keys: pd.DataFrame) -> pd.Series:
        return (keys["adresse"].str.slice(-9).astype("int64") % 30) * 1000 + 500.0

    refresh = SilverRefresh(
        spark, paths, read_employees, read_modes, resolver, gate="fingerprint",
        parallel_calls=_shuffle_partitions(spark),
    )
    start_silver(spark, paths, refresh, interval=None, max_files=written // 2).awaitTermination()
    return refresh.store.read_published("employe_id", "moyen_deplacement_id", "distance_km", "coherence_distance", COUNT)


# Keyed state, replays, deliveries


def _in_two_halves(spark: SparkSession, rows: DataFrame, path: str, first: F.Column) -> None:
    rows.withColumn("_first", first).repartition(max(_shuffle_partitions(spark), 4), "kafka_offset").write.partitionBy("_first").parquet(path)


def stream_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live counts from state that the engine keeps per activity; events out of order, the stream restarted halfway."""
    paths = LakePaths(scratch_dir(spark, "keyed-state"))
    rows = bronze.to_bronze(as_topic(table(spark, sf_dir, "events"), event_key()))
    _in_two_halves(spark, rows, f"{paths.root}/arriving", F.pmod(F.hash("kafka_offset"), F.lit(2)) == 0)
    for first in (True, False):
        arriving = spark.read.schema(bronze_schema()).parquet(f"{paths.root}/arriving/_first={str(first).lower()}")
        arriving.write.mode("append").parquet(paths.bronze)
        stream = stream_parquet(spark, paths.bronze, bronze_schema())
        keyed_state_counts.start_count_changes(
            spark, stream, f"{paths.root}/changes", paths.checkpoint("counts"), interval=None, buckets=32).awaitTermination()
    return keyed_state_counts.counts(spark, f"{paths.root}/changes")


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze from a topic whose first half arrives again with the second, after a restart from the checkpoint."""
    paths = LakePaths(scratch_dir(spark, "replay"))
    events = table(spark, sf_dir, "events")
    half = events.agg(((F.min(micros("ts")) + F.max(micros("ts"))) / 2).cast("bigint").alias("at")).first()["at"]
    halves = [events.filter(condition) for condition in (micros("ts") <= half, micros("ts") > half)]
    for arriving in ([halves[0]], halves):
        for rows in arriving:
            as_topic(rows).write.mode("append").parquet(f"{paths.root}/topic")
        topic = stream_topic_files(spark, f"{paths.root}/topic")
        start_bronze(topic, paths, interval=None, replay_within="40 days").awaitTermination()
    return _shown_bronze(read_bronze(spark, paths.bronze))


def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze by a stream that looks for files at intervals, stopped when there are no more."""
    paths = LakePaths(scratch_dir(spark, "interval"))
    query = start_bronze(as_topic(stream_table(spark, sf_dir, "events")), paths, interval="1 second")
    query.processAllAvailable()
    query.stop()
    return _shown_bronze(read_bronze(spark, paths.bronze))


def _changed_silver(spark: SparkSession, sf_dir: str) -> tuple[BucketStore, dict]:
    """Silver in 32 buckets by customer number, written again with some counts raised and some customers gone."""
    store = BucketStore(spark, scratch_dir(spark, "buckets"), "c_custkey", by=F.col("c_custkey") % 32)
    rows = silver(spark, sf_dir)
    store.write(rows, COUNT)
    part = F.col("c_custkey") % 64
    changed = rows.filter(part != 41).withColumn(COUNT, F.col(COUNT) + F.when(part == 5, 1).otherwise(0))
    return store, store.write(changed, COUNT)


def publish_buckets_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buckets that a known change has rewritten."""
    _, seen = _changed_silver(spark, sf_dir)
    return spark.createDataFrame([(bucket,) for bucket in seen["buckets"]], "bucket int")


def publish_buckets_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after the change, most of it from files of the first version."""
    store, _ = _changed_silver(spark, sf_dir)
    return store.read_published("c_custkey", "distance_km", "coherence_distance", COUNT)


def lookup_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by key from a table laid out for that, and that the scan has delivered less than 5 % of the table."""
    orders, path = table(spark, sf_dir, "orders"), scratch_dir(spark, "orders-by-key")
    write_indexed(orders, path, "o_orderkey", page_rows=20)
    last = max_key(orders, "o_orderkey").first()["max_key"]
    indexed = spark.read.parquet(path)
    found = look_up_keys(indexed.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", [last, last // 2, last // 3])
    few = rows_scanned(found) < 0.05 * indexed.count()
    return found.withColumn("few_scanned", F.lit(few))


def delivery_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages, sent by a sender that dies midway and is started again: outcomes, and how often each was sent.

    The service is played by a folder that takes down what it has been sent.
    """
    root = scratch_dir(spark, "delivery")
    received = f"{root.removeprefix('file:')}/received"
    os.makedirs(received)
    texts_of = lambda: as_topic(stream_table(spark, sf_dir, "events"), owner=F.col("event_id"))

    def take(messages: pd.DataFrame) -> pd.Series:
        codes = messages["message_text"].str.contains("view").map({True: 500, False: 200})
        messages[["kafka_partition", "kafka_offset"]].assign(code=codes).to_csv(f"{received}/{uuid.uuid4().hex}.csv", index=False)
        return codes

    def die(messages: pd.DataFrame) -> pd.Series:
        if (messages["kafka_offset"] % 7 == 0).any():
            take(messages.iloc[: len(messages) // 2].reset_index(drop=True))
            raise ConnectionError("the sender has died")
        return take(messages)

    def settle(keys: pd.DataFrame) -> pd.Series:
        known = pd.concat([pd.read_csv(f"{received}/{name}") for name in os.listdir(received)] or [keys.iloc[:0].assign(code=0.0)])
        return keys.merge(known, "left", ["kafka_partition", "kafka_offset"])["code"]

    calls, people = _shuffle_partitions(spark), _people(spark, sf_dir)
    for send in (die, take):
        delivery = Delivery(spark, root, send, settle, wave_rows=20_000, parallel_calls=calls)
        query = start_notifications(texts_of(), people, LakePaths(root), interval=None, delivery=delivery)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if send is take:
                raise
    sends = spark.read.option("header", True).schema("kafka_partition int, kafka_offset bigint, code int").csv(received).groupBy(
        "kafka_offset").agg(F.count(F.lit(1)).alias("sends"))
    return delivery.outbox().join(sends, "kafka_offset", "left").select("kafka_offset", "employe_id", "status", "status_code", "sends")


def series_on_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last known value of every event type at every hour of January, where values below 50 are unknown."""
    samples = table(spark, sf_dir, "events").select(
        "event_type", "ts", F.when(F.col("value") >= 50, F.col("value")).alias("value"))
    hour, first = 3_600_000_000, 1_704_067_200_000_000
    return metrics.series_grid(samples, "event_type", "value", "ts", first, first + 31 * 24 * hour, hour, piece_steps=24)


def dq_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite of ``dq_suite`` from three batches, the second of them handed over twice."""
    events = table(spark, sf_dir, "events")
    state = SuiteState(spark, scratch_dir(spark, "suite"), _event_checks(spark, sf_dir), fold_after=2)
    for batch in (0, 1, 1, 2):
        state.apply(events.filter(F.pmod(F.hash("event_id"), F.lit(3)) == batch), batch)
    return _shown_results(state.results())


def next_keys_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers append events to the orders at a time; each takes its range of keys from the log."""
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("o_custkey"), "event_type")
    ranges = KeyRanges(spark, scratch_dir(spark, "key-ranges"), max_key(orders, "o_orderkey").first()["max_key"])
    view = F.col("event_type") == "view"
    first, second = (
        with_next_keys(rows.drop("event_type"), orders, "o_orderkey", ["o_custkey", "event_id"], ranges=ranges)
        for rows in (events.filter(view), events.filter(~view)))
    return second.unionByName(first)


def first_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first data file of a table in four folders."""
    path = scratch_dir(spark, "orders-in-parts")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 4).alias("part"))
    rows.repartition("part").write.partitionBy("part").parquet(path)
    return spark.read.parquet(first_data_file(spark, path))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs have come to, the second of which wrote nothing."""
    path, rows = scratch_dir(spark, "runs"), silver(spark, sf_dir)
    seen = metrics.volume(rows, COUNT).first()
    metrics.append_gauges(metrics.run_log(spark, 0, seen["total_activities"], seen["total_people"]), path)
    metrics.append_gauges(metrics.run_log(spark, 1, seen["total_activities"], None), path)
    return spark.read.parquet(path).select("metric", "value")


def orphans_of_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases without a signup of their user within the hour before or after, where the signups arrive later."""
    root = scratch_dir(spark, "orphans")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.timestamp_micros(micros("ts")).alias("at"))
    # A row of nobody far ahead tells that nothing more will come.
    end = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"), F.lit("end").alias("event_type"),
        F.lit("2100-01-01 00:00:00").cast("timestamp").alias("at"))
    arrivals = (("children", events.filter("event_type = 'purchase'")), ("parents", events.filter("event_type = 'signup'")),
                ("children", end), ("parents", end))
    for step in range(0, 4):
        name, rows = arrivals[step]
        rows.write.mode("append").parquet(f"{root}/{name}")
        if step == 0:
            events.limit(0).write.mode("append").parquet(f"{root}/parents")
        if step == 2:
            continue
        streams = [stream_parquet(spark, f"{root}/{name}", events.schema) for name in ("children", "parents")]
        found = stream_orphans(streams[0], streams[1], "user_id", "user_id", "at", "at", "1 HOUR", "1 HOUR", "40 days")
        append_parquet(found.select("event_id", "user_id"), f"{root}/orphans", f"{root}/check", None).awaitTermination()
    return spark.read.schema("event_id bigint, user_id bigint").parquet(f"{root}/orphans")


def compacted_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze from a topic in many small files, read from its compacted form, and that this is few files."""
    paths = LakePaths(scratch_dir(spark, "compacted-bronze"))
    rows = as_topic(table(spark, sf_dir, "events"))
    rows.repartition(24, "offset").write.parquet(f"{paths.root}/topic")
    compacted = CompactedTable(spark, paths.bronze, f"{paths.root}/compacted", bronze_schema(), min_files=8)
    start_bronze(stream_topic_files(spark, f"{paths.root}/topic", max_files=12), paths, interval=None).awaitTermination()
    compacted.compact()
    as_topic(table(spark, sf_dir, "events").limit(0)).write.mode("append").parquet(f"{paths.root}/topic")
    start_bronze(stream_topic_files(spark, f"{paths.root}/topic"), paths, interval=None).awaitTermination()
    few = compacted.file_count() < 8
    return _shown_bronze(compacted.read()).withColumn("few_files", F.lit(few))


def compacted_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distances of ``memo_lookup`` from a cache that has been filled in twelve batches and compacted on the way."""
    people = threshold_check(spark, sf_dir).select(
        F.col("c_custkey").alias("employe_id"), F.col("lookup_mode").alias("mode"),
        F.format_string("Customer#%09d", "c_custkey").alias("adresse"),
    )
    cache = DistanceCache(spark, scratch_dir(spark, "compacted-cache"), min_files=3)
    keys = lookup_keys(people).withColumn("km", (F.col("employe_id") % 30).cast("double") + 0.5)
    for batch in range(12):
        cache.remember(keys.filter(F.col("employe_id") % 12 == batch).coalesce(1), batch)
        cache.compact()
    few = cache.file_count() < 8
    return cache.add_km(people).select("employe_id", "mode", "distance_km", F.lit(few).alias("few_files"))


def column_json_one_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as one column-oriented document, with commas, quotes and braces in its texts, and read back as rows."""
    path = scratch_dir(spark, "one-document")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    first, last = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    text = F.concat(F.lit('a,"'), F.col("o_orderpriority"), F.lit('",\\{"0":{ ,'))
    cell = F.explode(F.array(
        F.struct(F.lit(0).alias("c"), F.lit("o_custkey").alias("name"), F.col("o_custkey").cast("string").alias("value")),
        F.struct(F.lit(1).alias("c"), F.lit("o_orderpriority").alias("name"), F.substring(F.to_json(F.array(text)), 2, 1 << 20).alias("value"))))
    # the last bracket of the JSON array goes with it
    rows = orders.select("o_orderkey", cell.alias("x")).select("o_orderkey", "x.c", "x.name", F.when(
        F.col("x.c") == 1, F.expr("substring(x.value, 1, length(x.value) - 1)")).otherwise(F.col("x.value")).alias("value"))
    begins, ends = F.col("o_orderkey") == first, F.col("o_orderkey") == last
    written = rows.select("c", "o_orderkey", F.concat(
        F.when(begins & (F.col("c") == 0), "{").otherwise(""), F.when(begins, F.concat(F.lit('"'), "name", F.lit('":{'))).otherwise(""),
        F.lit('"'), "o_orderkey", F.lit('":'), "value", F.when(ends, "}").otherwise(""), F.when(ends & (F.col("c") == 1), "}").otherwise("")).alias("value"))
    ranged = written.repartitionByRange(_shuffle_partitions(spark), "c", "o_orderkey").sortWithinPartitions("c", "o_orderkey")
    ranged.select("value").write.option("lineSep", ",").text(path)
    found = read_column_document(spark, path, {"o_custkey": "bigint", "o_orderpriority": "string"})
    return found.withColumnRenamed("row_index", "o_orderkey")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        bronze_decode, bronze_rejects, decimal_scales, current_state, current_state_agg, live_state, live_count,
        change_stream_count, live_count_of_year, total_activities, incremental_count, mode_filter, threshold_check,
        enrich_back, silver, change_gate, publish_roundtrip, dq_between, dq_in_set, dq_suite, dq_suite_success,
        dq_report, dq_required, dq_unique, dq_unique_composite, dq_orphans, dq_orphan_keys, notify_text, stream_outbox,
        lookup_default, memo_lookup, metrics_row, published_gauges, last_not_null, level_steps, column_json,
        csv_dimension, poll_envelope, topic_roundtrip, highest_key, next_keys, synth_activities, stream_bronze,
        stream_silver, stream_incremental, stream_silver_table, decimal_unsigned, publish_one_file, publish_at_start,
        silver_lineage, dq_in_set_null, stream_bronze_scale, stream_year, stream_state_counts, stream_replay, stream_interval,
        publish_buckets_rewritten, publish_buckets_content, lookup_point, delivery_once, series_on_grid, dq_incremental,
        next_keys_two_writers, first_file, run_log, orphans_of_streams, compacted_bronze, compacted_cache,
        column_json_one_document,
    )
}
