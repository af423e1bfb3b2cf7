from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from activity_lake.llm import mixing, sharding
from activity_lake.llm.common import cut
from tests.llm.data import CLASHING, documents


def test_shards_match_the_mixture(spark):
    docs = documents(spark)
    made = sharding.shard_documents(docs, 5).collect()
    assert len(made) == docs.count()
    sizes, slots, mixture = Counter(), defaultdict(list), Counter()
    for row in made:
        sizes[row["shard"]] += 1
        slots[row["shard"]].append(row["slot"])
        mixture[row["shard"], row["source"]] += 1
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(5))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for source, n in Counter(row["source"] for row in made).items():
        assert all(abs(mixture[shard, source] - n / 5) <= 2 for shard in sizes)


def test_shards_keep_columns_and_agree_when_run_again(spark):
    docs = documents(spark)
    one, two = (sharding.shard_documents(d, 3) for d in (docs, docs.repartition(7)))
    assert set(one.columns) == {*docs.columns, "shard", "slot"}
    key = ["doc_id", "text", "shard", "slot"]
    assert one.select(key).exceptAll(two.select(key)).isEmpty()


def test_fewer_rows_than_shards_and_none(spark):
    docs = documents(spark, clashing=False)
    assert sorted(r["shard"] for r in sharding.op1_shards(docs.limit(3), 8).collect()) == [0, 2, 5]
    assert sharding.op1_shards(docs.limit(0)).count() == 0
    few = sharding.op1_shards(docs.filter("text is null"), 2).collect()
    assert {(r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in few} == {(1, 0, "rows", None)}


def plain_places(rows, shards):
    """doc_id -> (shard, slot) of rows (doc_id, source, key), sorted as a whole."""
    of, ranked = defaultdict(list), []
    for doc_id, source, key in rows:
        of[source].append((key, doc_id))
    for source, own in of.items():
        ranked += [((2 * r - 1) / (2 * len(own)), source, doc_id) for r, (_, doc_id) in enumerate(sorted(own), 1)]
    places, slots = {}, Counter()
    for g, (_, _, doc_id) in enumerate(sorted(ranked)):
        shard = g * shards // len(rows)
        places[doc_id] = (shard, slots[shard])
        slots[shard] += 1
    return places


def test_many_sources_of_one_row_are_spread(spark, monkeypatch):
    """All of them have the fractional rank 1/2; no range takes much more than its share, and the order is the plain one."""
    rows = [(i, f"s{i}" if i % 3 else "hot") for i in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string").repartition(4)
    written = []
    monkeypatch.setattr(sharding, "cut", lambda df, purpose: written.append((purpose, kept := cut(df, purpose))) or kept)
    made = sharding.interleave(docs, 7, "source", sharding.shuffle_key("x", F.col("doc_id")), [F.col("doc_id")], 200)
    keys = {r["doc_id"]: r["k"] for r in docs.select("doc_id", sharding.shuffle_key("x", F.col("doc_id")).alias("k")).collect()}
    want = plain_places([(i, source, keys[i]) for i, source in rows], 7)
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in made.collect()} == want
    sizes = [r["count"] for r in dict(written)["ranges"].groupBy("part_").count().collect()]
    assert len(sizes) >= 30 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_equal_rows_travel_as_one(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES_TOGETHER", 7)
    rows = [(1, "same", "en", "a", 4)] * 100 + [(None, "none", "en", None, 4)] * 50 + [(i, "w", "en", "b", 1) for i in range(9)]
    docs = documents(spark, rows, False)
    made = sharding.op1_shards(docs, 4).collect()
    assert Counter(r["doc_id"] for r in made)[1] == 101 and len({(r["shard"], r["slot"]) for r in made}) == 159
    whole = sharding.shard_documents(docs, 4).collect()
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in whole) == Counter((r["doc_id"], r["shard"], r["slot"]) for r in made)
    assert Counter(tuple(r)[:5] for r in whole) == Counter(rows)


@pytest.mark.parametrize("sizes", [
    [("a", 100), ("b", 100), ("c", 100)], [("a", 1), ("b", 1000), ("c", 2), (None, 5)], [("a", 0), ("b", 7)], [("a", 0)],
    [(f"s{i:02}", 10 ** (i % 5)) for i in range(12)],
])
def test_targets(spark, sizes):
    made = mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long"))
    found = {r["source"]: r["target"] for r in made.collect()}
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, (s, _) in enumerate(order)}
    capped, total = set(), sum(n for _, n in sizes)
    while True:
        left = total - sum(3 * n for s, n in sizes if s in capped)
        among = sum(weight[s] for s, _ in sizes if s not in capped)
        want = {s: 3 * n if s in capped else left * weight[s] / among for s, n in sizes}
        above = {s for s, n in sizes if s not in capped and want[s] > 3 * n}
        if not above:
            break
        capped |= above
    assert found == pytest.approx(want)


def test_taken_words_follow_the_targets(spark):
    docs = documents(spark, [(i, " ".join(["w"] * (1 + i * i % 97)), None, "abc"[i % 3] if i % 5 else None, 0) for i in range(3000)], False)
    rows = mixing.op7_mixture(docs).collect()
    assert len(rows) == 3000 and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    taken, target = Counter(), {}
    for r in rows:
        source = "abc"[r["doc_id"] % 3] if r["doc_id"] % 5 else None
        taken[source] += r["taken"]
        target[source] = r["target"]
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert all(abs(taken[source] - t) <= 200 for source, t in target.items())
    again = mixing.op7_mixture(docs.repartition(9)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_emits_copies(spark):
    docs = documents(spark)
    made = mixing.mix(docs)
    assert made.columns == docs.columns
    counted = mixing.op7_mixture(docs.select("doc_id", "text", "source")).agg(F.sum("taken")).first()[0]
    assert made.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == counted
    assert mixing.mix(docs.limit(0)).count() == 0 and len(CLASHING) > 3


def test_mix_keeps_values_of_clashing_columns(spark):
    docs = documents(spark).withColumn("target", F.concat(F.lit("t"), "doc_id")).withColumn("source_size", F.lit("x")).withColumn("copies", F.col("text"))
    made = mixing.mix(docs)
    assert made.schema == docs.schema
    rows = Counter(map(tuple, docs.collect()))
    assert all(n <= 3 * rows[row] for row, n in Counter(map(tuple, made.collect())).items())


def test_main_path_has_no_python(spark):
    plan = mixing.mix(documents(spark, clashing=False).coalesce(1).drop("x"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
