"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Each document of a source expects ``e = target / size of the source`` copies. Expected copies are prefix-summed over the
source, one random offset per source is added, and a document is emitted once per integer boundary that its own step
crosses. A source's documents are taken in order of their size class (quarter octaves), shuffled within: neighbours are
about equally long, so the words taken follow the target much more closely than in an unordered source.

A prefix sum over a source would be one task; the sum of equal steps is ``rank * e``, and ranks come from counts per
(source, size class, hash range) as small tables, with sorting only inside one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_lake.llm.common import cut, power_of_two, unused
from activity_lake.llm.sharding import ROWS_PER_BUCKET, shuffle_key

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mixing"
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size -> the same with target: weighted shares of all words, none above ``most`` times its source.

    Water filling in closed form: in the order of cap / weight, the sources before the first one that stays below its
    cap are full, and the rest of the words is shared by weight among the others. One row a source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    place = F.row_number().over(by_name) - 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long"))
    filled = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").isNull(), "source")
    earlier = filled.rowsBetween(Window.unboundedPreceding, -1)
    later = filled.rowsBetween(0, Window.unboundedFollowing)
    everything = filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.select(
        "*",
        (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))).alias("left"),
        F.sum("weight").over(later).alias("among"))
    over = most * F.col("source_size") * F.col("among") > F.col("weight") * F.col("left")
    ranked = levels.withColumn("at", F.row_number().over(filled)).withColumn("free", over)
    first = F.min(F.when(F.col("free"), F.struct("at", "left", "among"))).over(everything)
    return ranked.withColumn("first", first).select(
        "source", "source_size",
        F.when(F.col("first").isNull() | (F.col("at") < F.col("first.at")), (most * F.col("source_size")).cast("double"))
        .otherwise((F.col("weight") * F.col("first.left")).cast("double") / F.col("first.among").cast("double"))
        .alias("target"))


def offset(seed: str, source: Column) -> Column:
    """One number in [0, 1) per source, a multiple of 2 ** -20."""
    text = F.concat_ws(":", F.lit(seed), F.coalesce(source, F.lit("-")))
    return F.conv(F.substring(F.md5(text), 1, 5), 16, 10).cast("long").cast("double") / F.lit(1048576.0)


def copies(rows: DataFrame, size: str, key: Column, order: list[Column], seed: str = SEED,
           weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add source_size, target and copies (0 to ``most``) to rows that have ``source`` and a size column.

    A null source is a source of its own, last in order. Rows without words may be taken: they cost nothing. A source
    without words has the target 0 and is left out. Equal rows are interchangeable; columns of the added names in the
    input are replaced. An empty table gives an empty table.
    """
    rows = rows.drop("source_size", "target", "copies")
    buckets = power_of_two(rows.count(), rows_per_bucket)
    k, low, band, rank, name, first, step, start = (
        unused(rows, x) for x in ("k_", "low_", "band_", "rank_", "name_", "before_", "step_", "start_"))
    keyed = (rows.withColumn(k, key)
             .withColumn(low, F.shiftright(F.col(k), 60 - (buckets.bit_length() - 1)).cast("int"))
             .withColumn(band, size_class(F.col(size)))
             .withColumn(name, F.struct(F.col("source").isNull().alias("isnull"), F.coalesce("source", F.lit("")).alias("name"))))
    counts = keyed.groupBy(name, band, low).agg(F.count("*").alias("c"), F.sum(size).alias("words"))
    targets = source_targets(
        counts.groupBy(name).agg(F.sum("words").alias("source_size"))
        .select(F.when(~F.col(f"{name}.isnull"), F.col(f"{name}.name")).alias("source"), "source_size"), weights, most)
    targets = targets.select(
        F.struct(F.col("source").isNull().alias("isnull"), F.coalesce("source", F.lit("")).alias("name")).alias(name),
        "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0)).alias(step),
        offset(seed, F.col("source")).alias(start))
    before = F.sum("c").over(Window.partitionBy(name).orderBy(band, low).rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")
    groups = counts.select(name, band, low, before.alias(first)).join(targets, name)
    ranked = keyed.join(groups, [name, band, low]).withColumn(
        rank, (F.col(first) + F.row_number().over(Window.partitionBy(name, band, low).orderBy(k, *order))).cast("double"))
    crossed = F.floor(F.col(rank) * F.col(step) + F.col(start)) - F.floor((F.col(rank) - 1) * F.col(step) + F.col(start))
    return (ranked.withColumn("copies", F.least(crossed, F.lit(most)).cast("int"))
            .drop(k, low, band, rank, name, first, step, start))


def size_class(size: Column) -> Column:
    """The bit length of the size and its next two bits: four classes an octave, in order of size."""
    length = F.length(F.bin(size))
    shift = F.greatest(length - 3, F.lit(0))
    return (length * 8 + F.call_function("shiftright", size, shift)).cast("int")


def mix(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The mixed documents themselves: each as often as its step crosses a boundary, all columns as they came.

    The rows travel as one column, so theirs may have any names. Nulls, repeated rows and empty tables: see ``copies``.
    """
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row_"), "doc_id", "source",
                       word_count(F.col("text")).alias("n_words"))
    counted = copies(held, "n_words", shuffle_key(seed, F.col("doc_id"), F.col("n_words")), [F.col("doc_id")], seed, weights, most)
    emitted = counted.filter("copies > 0").select("row_", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return emitted.select("row_.*")


def op7_mixture(docs: DataFrame, seed: str = SEED) -> DataFrame:
    lean = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")  # texts are read once
    counted = copies(lean, "size", shuffle_key(seed, F.col("doc_id"), F.col("size")), [F.col("doc_id")], seed)
    return counted.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = f"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
keyed AS (
    SELECT *, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '-') || ':' || size), 1, 15))::BIGINT AS k,
        length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 3, 0)) AS band FROM sized),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
weighed AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM sizes),
levels AS (
    SELECT *, row_number() OVER o AS place, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER
        (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS among
    FROM weighed WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)),
opened AS (
    SELECT * FROM levels WHERE 3 * source_size * among > weight * rest ORDER BY place LIMIT 1),
targets AS (
    SELECT l.source, l.source_size, CASE WHEN f.place IS NULL OR l.place < f.place THEN (3 * l.source_size)::DOUBLE
        ELSE (l.weight * f.rest)::DOUBLE / f.among::DOUBLE END AS target,
        ('0x' || substr(md5('{SEED}:' || coalesce(l.source, '-')), 1, 5))::BIGINT::DOUBLE / 1048576.0 AS start
    FROM levels AS l LEFT JOIN opened AS f ON true),
ranked AS (
    SELECT k.*, source_size, target, start,
        CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0 END AS step,
        (row_number() OVER (PARTITION BY k.source ORDER BY band, k, doc_id NULLS FIRST))::DOUBLE AS r
    FROM keyed AS k JOIN targets AS t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
    (size * least(floor(r * step + start) - floor((r - 1) * step + start), 3))::BIGINT AS taken
FROM ranked
"""
