"""Sharding by proportional stratified interleaving.

The rows of each source are ranked in a seeded shuffle. Row ``r`` of ``n`` gets the fractional rank ``(2r - 1) / 2n``;
all rows are sorted by it and the sequence is cut into pieces of equal length. Every stretch of it, and so every shard,
holds the sources in the proportions of the whole.

A window over a source, or over everything, would be one task. Within a source, shuffle keys are uniform, so equal key
ranges hold about equal numbers of rows; a small table of bucket counts gives each bucket its first rank, and only the rows
of one bucket are sorted together. Fractional ranks are not uniform (every source of one row has 1/2), so the whole sequence
is cut into ranges of rank and source that are written, and counted in their turn. Both numbers grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_lake.llm.common import cut, power_of_two, unused

ROWS_PER_BUCKET = 20_000
COPIES_TOGETHER = 10_000  # equal rows that are told apart at a time
SEED = "interleave"


def shuffle_key(seed: str, *parts: Column) -> Column:
    """60 uniform bits from the parts; an order that depends on nothing but the seed and the row."""
    text = F.concat_ws(":", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def interleave(rows: DataFrame, shards: int, stratum: str, key: Column, order: list[Column],
               rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (place in the shard, gapless from 0) to every row.

    Shard sizes differ by one row at most, and a source's rows in a shard differ from its share by one or so. A null
    source is a source of its own. Rows that agree in ``key`` and ``order`` are interchangeable, and equal rows travel as
    one with their number until they are ranked, so the rows should be lean: they are written twice, and need columns that
    can be grouped by. An empty table gives an empty table; columns named shard or slot in the input are replaced.
    """
    rows = rows.drop("shard", "slot")
    k, low, rank, n, part, g, s, f, before, c = (
        unused(rows, x) for x in ("k_", "low_", "rank_", "n_", "part_", "g_", "s_", "f_", "before_", "c_"))
    source = F.struct(F.col(stratum).isNull().alias("isnull"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("name"))
    distinct = cut(rows.withColumn(k, key).withColumn(s, source).groupBy(*rows.columns, k, s).agg(F.count("*").alias(c)), "strata")
    total = distinct.agg(F.coalesce(F.sum(c), F.lit(0)).alias("n")).first()["n"]
    buckets = power_of_two(total, rows_per_bucket)
    distinct = distinct.withColumn(low, F.shiftright(F.col(k), 60 - (buckets.bit_length() - 1)).cast("int"))
    counts = distinct.groupBy(s, low).agg(F.sum(c).alias("sum"))
    within = Window.partitionBy(s)
    first = counts.select(
        s, low,
        (F.sum("sum").over(within.orderBy(low).rowsBetween(Window.unboundedPreceding, 0)) - F.col("sum")).alias(before),
        F.sum("sum").over(within).alias(n))
    bucket = Window.partitionBy(s, low).orderBy(k, *order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = each_copy(distinct.join(first, [s, low]).withColumn(before, F.col(before) + F.sum(c).over(bucket) - F.col(c)), before, c, rank)
    share = (2 * F.col(rank) - 1).cast("double") / (2 * F.col(n)).cast("double")
    ordered = ranked.withColumn(f, share).select(*rows.columns, s, f)
    # A source has a rank once, so (f, source) is a row's own: however many sources share a rank, ranges of both are even.
    ranged = cut(ordered.repartitionByRange(buckets, f, s).withColumn(part, F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy(part).agg(F.count("*").alias(c))  # one row a range: the window below sees few rows
    starts = sizes.select(part, (F.sum(c).over(
        Window.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)) - F.col(c)).alias(before))
    placed = ranged.join(starts, part).withColumn(
        g, F.col(before) + F.row_number().over(Window.partitionBy(part).orderBy(f, s)) - 1)
    shard = F.expr(f"cast(({g} * {shards}) div {max(total, 1)} as int)")
    slot = F.expr(f"{g} - (shard * cast({total} as bigint) + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", slot).select(*rows.columns, "shard", "slot")


def each_copy(rows: DataFrame, before: str, count: str, rank: str) -> DataFrame:
    """A row for each of ``count`` copies with its rank, ``before`` + 1 and up; no array holds more than COPIES_TOGETHER of them."""
    last = F.col(before) + F.col(count)
    begun = rows.withColumn(rank, F.explode(F.sequence(F.col(before) + 1, last, F.lit(COPIES_TOGETHER).cast("long"))))
    return begun.withColumn(rank, F.explode(F.sequence(F.col(rank), F.least(F.col(rank) + COPIES_TOGETHER - 1, last))))


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none if null) and one for the record's end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def checksum(text: Column) -> Column:
    """CRC-32 of the text's UTF-8 bytes; of none if it is null."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def shard_documents(docs: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """Whole documents with shard and slot; a shard's files are its rows in the order of slot.

    Places are found for lean rows, and then looked up by source, id, checksum, size and the number among rows that agree in
    these; texts are dealt only for that. A third of the rows may share an id or a source, but rows that agree in all four are
    numbered in one task.
    """
    docs = docs.drop("shard", "slot")
    digest = {"doc_id": F.col("doc_id"), "source": F.col("source"), "crc": checksum(F.col("text")), "size": text_size(F.col("text"))}
    lean = docs.select(*(value.alias(name) for name, value in digest.items()))
    placed = interleave(lean, shards, "source", shuffle_key(seed, F.col("doc_id"), F.col("crc")), [F.col("doc_id"), F.col("size")])
    placed = placed.withColumn("copy", F.row_number().over(Window.partitionBy(*digest).orderBy("shard", "slot")))
    own = {name: unused(docs, f"{name}_") for name in (*digest, "copy")}
    numbered = docs.withColumns({own[name]: value for name, value in digest.items()})
    numbered = numbered.withColumn(own["copy"], F.row_number().over(Window.partitionBy(*(own[x] for x in digest)).orderBy("text")))
    place = placed.select(*(F.col(name).alias(f"place_{name}") for name in own), F.col("shard").alias("place_shard"), F.col("slot").alias("place_slot"))
    place = place.select(F.struct(*place.columns).alias(unused(docs, "place_")))
    at = unused(docs, "place_")
    same = [numbered[name].eqNullSafe(place[f"{at}.place_{x}"]) for x, name in own.items()]
    joined = numbered.join(place, same)
    return joined.select(*(F.col(f"`{column}`") for column in docs.columns), F.col(f"{at}.place_shard").alias("shard"), F.col(f"{at}.place_slot").alias("slot"))


def op1_shards(docs: DataFrame, shards: int = 8, seed: str = SEED) -> DataFrame:
    """The digest: no text travels, only its size and checksum. Law ``rows``; shards don't grow by it, so null."""
    lean = docs.select("doc_id", "source", text_size(F.col("text")).alias("size"), checksum(F.col("text")).alias("text_crc32"))
    placed = interleave(lean, shards, "source", shuffle_key(seed, F.col("doc_id"), F.col("text_crc32")),
                        [F.col("doc_id"), F.col("size")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


# DuckDB has no CRC-32: eight shifts make the table, a fold over the bytes of the text the sum.
CRC32_SQL = """
crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1
            THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) AS r(i))),
bytes AS (
    SELECT *, hex(encode(coalesce(text, ''))) AS h FROM documents),
checked AS (
    SELECT b.* EXCLUDE h, coalesce(octet_length(encode(text)), 0) + 1 AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2),
            lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
            lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS text_crc32
    FROM bytes AS b, crc_table)
"""

ORACLE = f"""
WITH {CRC32_SQL.strip()},
keyed AS (
    SELECT *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '-') || ':' || text_crc32), 1, 15))::BIGINT AS k
    FROM checked),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST, size) AS r,
        count(*) OVER (PARTITION BY source) AS n FROM keyed),
placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * r - 1)::DOUBLE / (2 * n)::DOUBLE, source IS NULL, coalesce(source, ''), k,
        doc_id NULLS FIRST, size) - 1 AS g, count(*) OVER () AS total FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (g * 8 // total)::INT AS shard,
    (g - ((g * 8 // total) * total + 7) // 8)::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed
"""
