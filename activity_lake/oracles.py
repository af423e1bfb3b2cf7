"""The queries again as plain SQL over the test tables, written independently of the operators."""

from __future__ import annotations

# Shared subqueries

_CENTS = "CAST(round(value * 100) AS BIGINT)"
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_STATE = """
    SELECT user_id, event_id, event_type, value, epoch_us(ts) AS ts_us
    FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
"""

_LIVE_COUNT = f"""
    SELECT user_id AS employe_id, count(user_id) AS pratique_sportive_annuelle
    FROM (
        SELECT user_id, event_type FROM (SELECT *, user_id * 100 + {_K} AS activity FROM events)
        QUALIFY row_number() OVER (PARTITION BY activity ORDER BY ts DESC, event_id % 4 DESC, event_id DESC) = 1
    )
    WHERE event_type <> 'error' GROUP BY user_id
"""

_LIVE_OF_YEAR = _LIVE_COUNT.replace(
    "<> 'error'", "<> 'error' AND year(ts + to_days(CAST(activity % 3 * 366 AS INTEGER))) = 2024"
).replace("SELECT user_id, event_type FROM", "SELECT user_id, event_type, ts, activity FROM")

_BRONZE = f"""
    SELECT event_id AS id_evenement_sportif, user_id AS employe_id, event_type AS type_pratique_sportive,
           epoch_us(ts) AS date_us, {_K} * 97 AS temps_ecoule, props AS commentaire,
           event_type = 'error' AS is_deleted, epoch_us(ts) AS kafka_us, ({_CENTS} + 50) // 100 AS distance_km,
           CAST(event_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset
    FROM events
"""

_MODES = """
    SELECT c_custkey, c_name, c_nationkey, n_name, c_mktsegment
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')
"""

_CHECKED = f"""
    SELECT c_custkey, c_mktsegment,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'walking' ELSE 'bicycling' END AS lookup_mode,
           CAST(c_nationkey AS DOUBLE) AS distance_km,
           CASE WHEN c_nationkey <= CASE c_mktsegment WHEN 'MACHINERY' THEN 5 ELSE 15 END THEN 'OK' ELSE 'ERREUR' END
               AS coherence_distance
    FROM ({_MODES})
"""

_ENRICHED = f"""
    SELECT c.c_custkey, c.c_name, c.c_mktsegment, d.distance_km, d.coherence_distance
    FROM customer c LEFT JOIN ({_CHECKED}) d ON c.c_custkey = d.c_custkey
"""

_SILVER = f"""
    SELECT e.*, coalesce(n.done, 0) AS pratique_sportive_annuelle
    FROM ({_ENRICHED}) e
    LEFT JOIN (SELECT o_custkey, count(*) AS done FROM orders GROUP BY o_custkey) n
        ON e.c_custkey = n.o_custkey
"""


def _check(name: str, column: str, table: str, unexpected: str, missing: str, of_all: bool = False) -> str:
    """One result row of a quality check, from conditions on a row."""
    checked = "count(*)" if of_all else f"(count(*) - count(*) FILTER (WHERE {missing}))"
    bad = f"count(*) FILTER (WHERE {unexpected})"
    return f"""
    SELECT '{name}' AS expectation, '{column}' AS column_name, {bad} = 0 AS success, count(*) AS element_count,
           count(*) FILTER (WHERE {missing}) AS missing_count, {bad} AS unexpected_count,
           round(coalesce({bad} * 100.0::DOUBLE / nullif({checked}, 0), 0), 4) AS unexpected_percent
    FROM {table}
    """


_BETWEEN = "expect_column_values_to_be_between"
_IN_SET = "expect_column_values_to_be_in_set"
_NOT_NULL = "expect_column_values_to_not_be_null"
_UNIQUE = "expect_compound_columns_to_be_unique"
_PARENT = "expect_column_values_to_have_parent"
_FOUR_TYPES = "('click', 'purchase', 'signup', 'view')"

_LABELLED = "(SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
_EVENTS_OF_KNOWN = """(
    SELECT e.*, c.c_custkey, count(*) OVER (PARTITION BY event_id) AS copies
    FROM events e LEFT JOIN customer c ON e.event_id = c.c_custkey
)"""
_TURNS = """(
    SELECT *, count(*) OVER (PARTITION BY conv_id, turn) AS turn_copies, count(*) OVER (PARTITION BY conv_id) AS conv_copies
    FROM conversations
)"""

# The wording and layout of the message.
_MESSAGE = f"""
    SELECT event_id AS kafka_offset, event_id AS employe_id,
        chr(10) || chr(10) || '*Félicitations '
        || coalesce(c_mktsegment || ' ' || c_name, 'Employé #' || event_id)
        || ' ! Nouvelle séance de ' || lower(event_type) || ' enregistrée !*' || chr(10)
        || '━━━━━━━━━━━━━━━━━━━━━━━━' || chr(10)
        || '🏃 *Sport*      : ' || event_type || chr(10)
        || '📅 *Date*       : ' || strftime(ts, '%d/%m/%Y') || chr(10)
        || '📏 *Distance*   : ' || printf('%d.%02d km', {_CENTS} // 100, {_CENTS} % 100) || chr(10)
        || '⏱️ *Temps*      : ' || CASE WHEN {_K} * 97 >= 3600
            THEN printf('%dh%02dm%02ds', {_K} * 97 // 3600, {_K} * 97 // 60 % 60, {_K} * 97 % 60)
            ELSE printf('%dm%02ds', {_K} * 97 // 60, {_K} * 97 % 60) END || chr(10)
        || '💬 *Commentaire*: _' || props || '_' || chr(10) || chr(10) AS message_text, event_type
    FROM events LEFT JOIN customer ON event_id = c_custkey
    WHERE event_type <> 'error'
"""


def _draw(start: int, digits: int, bound: str) -> str:
    return f"CAST('0x' || substr(hash, {start}, {digits}) AS BIGINT) % {bound}"


_SPORTS = "['Course à pied', 'Vélo', 'Natation', 'Marche', 'Trotinette', 'Voile']"
_COMMENTS = """['Super séance, je me suis senti(e) en pleine forme !',
    'Pas mal, mais j''ai eu du mal à trouver mon rythme.', 'A refaire très vite !',
    'J''ai adoré cette activité, c''était vraiment génial !']"""

_SYNTH = f"""
    SELECT id AS id_evenement_sportif, c_custkey AS employe_id,
           {_SPORTS}[{_draw(16, 8, '6')} + 1] AS type_pratique_sportive,
           strftime(DATE '2025-01-01' + CAST({_draw(32, 8, '365')} AS INTEGER), '%Y-%m-%d') AS date,
           {_draw(24, 8, '14')} + 1 AS distance, {_draw(40, 8, '3000')} + 600 AS temps_ecoule,
           {_COMMENTS}[{_draw(48, 8, '4')} + 1] AS commentaire
    FROM (
        SELECT *, {_draw(1, 15, '(SELECT count(*) FROM customer)')} + 1 AS number
        FROM (SELECT o_orderkey + 1 AS id, sha256('7:' || (o_orderkey + 1)) AS hash FROM orders)
    ) a
    JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS number FROM customer) p ON p.number = a.number
"""

ORACLES: dict[str, str] = {
    "bronze_decode": _BRONZE,
    "bronze_rejects": """
        SELECT CASE event_type WHEN 'view' THEN 'bad_json' WHEN 'click' THEN 'bad_date' ELSE 'bad_distance' END
                   AS reject_reason, count(*) AS rejected
        FROM events WHERE event_type IN ('view', 'click', 'signup') GROUP BY 1
    """,
    "decimal_scales": """
        SELECT o_orderkey, (o_orderkey * 1000003 - 5000000000) * CAST(power(10, 6 - o_orderkey % 7) AS BIGINT)
                   AS millionths,
               CAST(round(o_orderkey * 1.4615016373309029182036848327::DECIMAL(29, 28)) AS BIGINT) AS wide
        FROM orders
    """,
    "current_state": _STATE,
    "current_state_agg": _STATE,
    "live_state": f"SELECT * FROM ({_STATE}) WHERE event_type <> 'error'",
    "live_count": _LIVE_COUNT,
    "change_stream_count": _LIVE_COUNT,
    "live_count_of_year": _LIVE_OF_YEAR,
    "total_activities": f"""
        SELECT CAST(coalesce(sum(pratique_sportive_annuelle), 0) AS BIGINT) AS total FROM ({_LIVE_COUNT})
    """,
    "incremental_count": _LIVE_COUNT,
    "mode_filter": _MODES,
    "threshold_check": _CHECKED,
    "enrich_back": _ENRICHED,
    "silver": _SILVER,
    "change_gate": f"""
        WITH new AS ({_SILVER}), old AS (SELECT * REPLACE (distance_km + 1 AS distance_km) FROM new)
        SELECT 'total' AS gate, (SELECT sum(pratique_sportive_annuelle) FROM new)
                   <> (SELECT sum(pratique_sportive_annuelle) FROM old) AS is_changed
        UNION ALL
        SELECT 'fingerprint', EXISTS (SELECT * FROM new EXCEPT SELECT * FROM old)
    """,
    "publish_roundtrip": f"""
        SELECT c_custkey, distance_km, coherence_distance, pratique_sportive_annuelle FROM ({_SILVER})
    """,
    "dq_between": _check(_BETWEEN, "c_acctbal", "customer", "c_acctbal < 0.01", "c_acctbal IS NULL"),
    "dq_in_set": _check(_IN_SET, "event_type", "events", f"event_type NOT IN {_FOUR_TYPES}", "event_type IS NULL"),
    "dq_suite": " UNION ALL ".join([
        _check(_BETWEEN, "value", "events", "value < 0.01 OR value > 400", "value IS NULL"),
        _check(_IN_SET, "event_type", "events", f"event_type NOT IN {_FOUR_TYPES}", "event_type IS NULL"),
        _check(_NOT_NULL, "user_id", "events", "user_id IS NULL", "user_id IS NULL", of_all=True),
        _check(_UNIQUE, "event_id", _EVENTS_OF_KNOWN, "copies > 1 AND event_id IS NOT NULL", "event_id IS NULL"),
        _check(_PARENT, "event_id", _EVENTS_OF_KNOWN, "c_custkey IS NULL AND event_id IS NOT NULL", "event_id IS NULL"),
    ]),
    "dq_suite_success": """
        WITH checks AS (
            SELECT count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50) AS a,
                   count(*) FILTER (WHERE l_linestatus NOT IN ('O', 'F')) AS b,
                   count(*) FILTER (WHERE l_tax < 0 OR l_tax > 0.05) AS c
            FROM lineitem
        )
        SELECT 'lineitem' AS suite, a + b + c = 0 AS success, CAST(3 AS BIGINT) AS expectations,
               CAST((a > 0)::INT + (b > 0)::INT + (c > 0)::INT AS BIGINT) AS failed
        FROM checks
    """,
    "dq_report": """
        WITH counts AS (
            SELECT count(*) AS n, count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50) AS a,
                   count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS b
            FROM lineitem
        )
        SELECT CASE WHEN a = 0 THEN '-- OK --' ELSE '-- KO --' END
               || ' [l_quantity] expect_column_values_to_be_between {min_value=1, max_value=50}'
               || CASE WHEN a = 0 THEN '' ELSE printf(' : %d/%d (%.1f%%)', a, n, a * 100.0 / n) END AS report_line
        FROM counts
        UNION ALL
        SELECT CASE WHEN b = 0 THEN '-- OK --' ELSE '-- KO --' END
               || ' [l_returnflag] expect_column_values_to_be_in_set {value_set=A|N}'
               || CASE WHEN b = 0 THEN '' ELSE printf(' : %d/%d (%.1f%%)', b, n, b * 100.0 / n) END
        FROM counts
    """,
    "dq_required": " UNION ALL ".join(
        _check(_NOT_NULL, column, _LABELLED, f"{column} IS NULL", f"{column} IS NULL", of_all=True)
        for column in ("doc_id", "lang", "quality")
    ),
    "dq_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """,
    "dq_unique_composite": " UNION ALL ".join([
        _check(_UNIQUE, "conv_id,turn", _TURNS, "turn_copies > 1", "conv_id IS NULL OR turn IS NULL"),
        _check(_UNIQUE, "conv_id", _TURNS, "conv_copies > 1", "conv_id IS NULL"),
    ]),
    "dq_orphans": """
        SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT * FROM labels l WHERE l.doc_id = d.doc_id)
    """,
    "dq_orphan_keys": """
        SELECT l_partkey, count(*) AS orphan_rows FROM lineitem
        WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY l_partkey
    """,
    "notify_text": f"SELECT kafka_offset, employe_id, message_text FROM ({_MESSAGE})",
    "stream_outbox": f"""
        SELECT kafka_offset, employe_id, CASE WHEN event_type = 'view' THEN 'failed' ELSE 'sent' END AS status,
               CASE WHEN event_type = 'view' THEN 500 ELSE 200 END AS status_code
        FROM ({_MESSAGE})
    """,
    "lookup_default": """
        SELECT d.doc_id, d.lang, coalesce(CAST(l.quality AS VARCHAR), 'unknown') AS quality
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
    "memo_lookup": f"""
        SELECT c_custkey AS employe_id, lookup_mode AS mode, c_custkey % 30 + 0.5::DOUBLE AS distance_km
        FROM ({_CHECKED})
    """,
    "metrics_row": f"""
        SELECT CAST(coalesce(sum(pratique_sportive_annuelle), 0) AS BIGINT) AS total_activities,
               count(*) AS total_people
        FROM ({_SILVER})
    """,
    "published_gauges": f"""
        SELECT 'pipeline_silver_activites_total' AS metric, CAST(sum(pratique_sportive_annuelle) AS DOUBLE) AS value
        FROM ({_SILVER})
        UNION ALL SELECT 'pipeline_silver_employes_total', CAST(count(*) AS DOUBLE) FROM ({_SILVER})
        UNION ALL SELECT 'pipeline_silver_last_update_timestamp', 1.0::DOUBLE
    """,
    "last_not_null": """
        SELECT event_type, arg_max(value, ts) AS value FROM events
        WHERE value >= 50 AND ts BETWEEN TIMESTAMP '2024-01-20 06:00:00' AND TIMESTAMP '2024-01-20 12:00:00'
        GROUP BY event_type
    """,
    "level_steps": """
        SELECT CASE WHEN l_quantity * 2 >= 90 THEN 'red' WHEN l_quantity * 2 >= 70 THEN 'orange' ELSE 'green' END AS level,
               count(*) AS readings
        FROM lineitem GROUP BY 1
    """,
    "column_json": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "csv_dimension": """
        SELECT c_custkey, '1, rue "A", ' || c_name AS address,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment
        FROM customer
    """,
    "poll_envelope": "SELECT n_nationkey, n_name, n_regionkey, 'table-polling' AS source FROM nation",
    "topic_roundtrip": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey, o_custkey,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
               CAST(length('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":'
                   || CASE WHEN o_orderstatus <> 'P' THEN '"' || o_orderstatus || '"' ELSE 'null' END || '}')
                   AS INTEGER) AS json_length
        FROM orders
    """,
    "highest_key": "SELECT coalesce(max(o_orderkey), 0) AS max_key FROM orders",
    "next_keys": """
        SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY user_id, event_id) AS o_orderkey,
               event_id, user_id AS o_custkey
        FROM events
    """,
    "synth_activities": _SYNTH,
    "decimal_unsigned": """
        SELECT o_orderkey, o_orderkey % 65536 AS two_bytes, o_orderkey AS nine_bytes FROM orders
    """,
    "publish_one_file": f"SELECT c_custkey, distance_km, coherence_distance, pratique_sportive_annuelle FROM ({_SILVER})",
    "publish_at_start": f"SELECT c_custkey, distance_km, coherence_distance, pratique_sportive_annuelle FROM ({_SILVER})",
    "silver_lineage": "SELECT c_custkey, 7 AS batch_id, true AS has_time FROM customer",
    "dq_in_set_null": _check(
        _IN_SET, "event_type", "events", "event_type NOT IN ('click', 'view')", "event_type IS NULL"
    ),
    "stream_bronze_scale": f"SELECT event_id AS kafka_offset, {_CENTS} AS hundredths FROM events",
    "stream_year": _LIVE_OF_YEAR,
    "stream_bronze": _BRONZE,
    "stream_silver": _LIVE_COUNT,
    "stream_incremental": _LIVE_COUNT,
    "stream_silver_table": f"""
        SELECT employe_id, moyen_deplacement_id, distance_km,
               CASE WHEN distance_km IS NULL THEN NULL
                    WHEN distance_km <= CASE moyen_deplacement_id WHEN 2 THEN 15 ELSE 25 END THEN 'OK'
                    ELSE 'ERREUR' END AS coherence_distance,
               coalesce(n.pratique_sportive_annuelle, 0) AS pratique_sportive_annuelle
        FROM (
            SELECT c_custkey AS employe_id, CAST(c_nationkey % 5 AS BIGINT) AS moyen_deplacement_id,
                   CASE WHEN c_nationkey % 5 IN (2, 3) THEN c_custkey % 30 + 0.5::DOUBLE END AS distance_km
            FROM customer
        ) LEFT JOIN ({_LIVE_COUNT}) n USING (employe_id)
    """,
    "stream_state_counts": _LIVE_COUNT,
    "stream_replay": _BRONZE,
    "stream_interval": _BRONZE,
    "publish_buckets_rewritten": """
        SELECT DISTINCT CAST(c_custkey % 32 AS INTEGER) AS bucket FROM customer WHERE c_custkey % 64 IN (5, 41)
    """,
    "publish_buckets_content": f"""
        SELECT c_custkey, distance_km, coherence_distance,
               pratique_sportive_annuelle + CASE WHEN c_custkey % 64 = 5 THEN 1 ELSE 0 END AS pratique_sportive_annuelle
        FROM ({_SILVER}) WHERE c_custkey % 64 <> 41
    """,
    "lookup_point": """
        WITH last AS (SELECT max(o_orderkey) AS k FROM orders)
        SELECT o_orderkey, o_custkey, o_totalprice, true AS few_scanned
        FROM orders, last WHERE o_orderkey IN (k, k // 2, k // 3)
    """,
    "delivery_once": f"""
        SELECT kafka_offset, employe_id, CASE WHEN event_type = 'view' THEN 'failed' ELSE 'sent' END AS status,
               CASE WHEN event_type = 'view' THEN 500 ELSE 200 END AS status_code, CAST(1 AS BIGINT) AS sends
        FROM ({_MESSAGE})
    """,
    "series_on_grid": """
        WITH ticks AS (
            SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 1 HOUR)) AS t),
        series AS (SELECT DISTINCT event_type FROM events), known AS (SELECT event_type, ts, value FROM events WHERE value >= 50)
        SELECT s.event_type, epoch_us(t) AS tick, k.value
        FROM (SELECT event_type, t FROM series CROSS JOIN ticks) s
        ASOF LEFT JOIN known k ON k.event_type = s.event_type AND k.ts <= s.t
    """,
    "next_keys_two_writers": """
        SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY event_type <> 'view', user_id, event_id) AS o_orderkey,
               event_id, user_id AS o_custkey
        FROM events
    """,
    "orphans_of_streams": """
        SELECT event_id, user_id FROM events p WHERE event_type = 'purchase' AND NOT EXISTS (
            SELECT 1 FROM events s WHERE s.event_type = 'signup' AND s.user_id = p.user_id
                AND s.ts BETWEEN p.ts - INTERVAL 1 HOUR AND p.ts + INTERVAL 1 HOUR)
    """,
    "compacted_bronze": f"SELECT *, true AS few_files FROM ({_BRONZE})",
    "compacted_cache": f"""
        SELECT c_custkey AS employe_id, lookup_mode AS mode, c_custkey % 30 + 0.5::DOUBLE AS distance_km, true AS few_files
        FROM ({_CHECKED})
    """,
    "column_json_one_document": """
        SELECT o_orderkey, o_custkey, 'a,"' || o_orderpriority || '",\\{"0":{ ,' AS o_orderpriority FROM orders
    """,
    "first_file": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 = 0",
    "run_log": f"""
        WITH seen AS (SELECT CAST(sum(pratique_sportive_annuelle) AS DOUBLE) AS total, CAST(count(*) AS DOUBLE) AS people FROM ({_SILVER}))
        SELECT 'silver_run_batch_id' AS metric, b::DOUBLE AS value FROM (VALUES (0), (1)) AS x(b)
        UNION ALL SELECT 'silver_run_activities', total FROM seen, (VALUES (0), (1))
        UNION ALL SELECT 'silver_run_rows_written', people FROM seen
        UNION ALL SELECT 'silver_run_rows_written', NULL
    """,
}
ORACLES["dq_incremental"] = ORACLES["dq_suite"]
