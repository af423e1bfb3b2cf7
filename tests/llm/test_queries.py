"""The subpackage's queries against their SQL, and what they promise of the whole."""

import glob
import random
import re
from collections import Counter

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from activity_lake.llm import quality
from activity_lake.llm.registry import LLM_ORACLES, LLM_QUERIES
from tests.llm import brute
from tests.llm.data import documents
from tests.oracle import SF_DIR, assert_same, connect


def test_registered():
    assert set(LLM_QUERIES) <= set(registry.queries())
    assert {name.split("_")[0] for name in LLM_QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_same_as_sql(spark, name):
    assert assert_same(LLM_QUERIES[name](spark, SF_DIR), connect(), LLM_ORACLES[name]) > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixture", "shards"]
    made = LLM_QUERIES["pipeline"](spark, SF_DIR)
    assert made.columns == [*docs.columns, "shard", "slot"]
    counts = [r["count"] for r in made.groupBy("shard").count().collect()]
    assert len(counts) == corpus_pipeline.SHARDS and max(counts) - min(counts) <= 1
    ids = {r["doc_id"] for r in made.select("doc_id").distinct().collect()}
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 0").collect()}
    leaking = {r["doc_id"] for r in LLM_QUERIES["op6_decontamination"](spark, SF_DIR).filter("n_hit > 20").collect()}
    assert ids and not ids & bad and not ids & leaking


def corpus(rng):
    """Clean texts, near copies, junk, and texts with long and short runs of a benchmark item; the ids of the clean ones."""
    prose = lambda n: " ".join("".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 9))) for _ in range(n))
    item, texts = prose(40), {}
    for i in range(150):
        texts[i] = prose(rng.randint(60, 200)).capitalize() + "."
    clean = set(texts)
    for i in range(12):
        texts[200 + i] = texts[i].rsplit(" ", 1)[0] + " end."
        texts[300 + i] = f"{prose(80)} {' '.join(item.split()[:30])} {prose(80)}."
        texts[400 + i] = f"{prose(80)}, {' '.join(item.split()[i:i + 12])}, {prose(80)}."
    for i in range(60):
        texts[500 + i] = " ".join(rng.choice(["!!!", "$$$", "0123", "###", "@@", "||", "X1"]) for _ in range(rng.randint(60, 200)))
    rows = [(i, text, "en", "aab"[i % 3] if i % 10 else "c", len(text)) for i, text in texts.items()]
    return rows, [(1, item)], clean


def without_leaks(rows, item):
    """Plain decontamination: runs of more than 20 words or a fifth of a text drop it, shorter ones are cut out."""
    wanted, made = {tuple(item.split()[i:i + 10]) for i in range(len(item.split()) - 9)}, {}
    for doc, text in rows:
        at = list(re.finditer("[a-z0-9]+", text.lower()))
        found = [m[0] for m in at]
        hit = "".join("x" if any(tuple(found[k:k + 10]) in wanted for k in range(max(i - 9, 0), i + 1)) else "." for i in range(len(at)))
        runs = list(re.finditer("x+", hit))
        if all(len(run[0]) <= 20 for run in runs) and 5 * hit.count("x") <= len(hit):
            for run in reversed(runs):
                text = text[:at[run.start()].start()] + text[at[run.end() - 1].end():]
            made[doc] = text
    return made


def plain_targets(sizes):
    """Shares by weight of all words, none above three times its source."""
    weight = dict(zip(sorted(sizes), (5, 2, 1)))
    full: set = set()
    while True:
        left, among = sum(sizes.values()) - sum(3 * sizes[s] for s in full), sum(weight[s] for s in sizes if s not in full)
        targets = {s: 3 * sizes[s] if s in full else weight[s] * left / among for s in sizes}
        over = {s for s in sizes if targets[s] > 3 * sizes[s]}
        if not over:
            return targets
        full |= over


def test_pipeline_against_a_plain_chain(spark, folder, monkeypatch):
    rows, items, clean = corpus(random.Random(6))
    labels = [(row[0], int(row[0] < 500)) for row in rows if row[0] % 2 == 0]
    tables = {"documents": documents(spark, rows, False), "benchmark": spark.createDataFrame(items, "item_id long, text string"),
              "labels": spark.createDataFrame(labels, "doc_id long, quality int")}
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    monkeypatch.setattr(corpus_pipeline, "shared_folder", lambda spark: folder)
    made = corpus_pipeline.run(spark, folder).collect()
    (run,) = glob.glob(f"{folder}/pipeline-*")
    read = lambda stage: [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{run}/{stage}").collect()]

    decided = {r["doc_id"] for r in quality.op5_quality(tables["documents"], tables["labels"]).collect() if r["keep"]}
    assert clean <= decided and not decided & set(range(500, 600))
    kept = [(row[0], row[1]) for row in rows if row[0] in decided]
    assert sorted(read("quality")) == sorted(kept)
    least = {doc for doc, _, component in brute.linked(kept, 5, 80) if doc == component}
    assert clean <= least and not least & set(range(200, 212))
    single = [(doc, text) for doc, text in kept if doc in least]
    assert sorted(read("near_duplicates")) == sorted(single)
    whole = without_leaks(single, items[0][1])
    assert clean <= set(whole) and not set(whole) & set(range(300, 312)) and set(range(400, 412)) <= set(whole)
    assert sorted(read("decontamination")) == sorted(whole.items())

    source, sizes, taken = {row[0]: row[3] for row in rows}, Counter(), Counter()
    for doc, text in whole.items():
        sizes[source[doc]] += len(text.split())
    mixed = read("mixture")
    for doc, text in mixed:
        assert whole[doc] == text
        taken[source[doc]] += len(text.split())
    assert max(Counter(mixed).values()) <= 3
    targets = plain_targets(sizes)
    assert set(taken) == set(targets) and all(abs(taken[s] - targets[s]) <= 0.1 * targets[s] for s in targets)

    assert sorted((r["doc_id"], r["text"]) for r in made) == sorted(mixed)
    slots = {k: sorted(r["slot"] for r in made if r["shard"] == k) for k in range(corpus_pipeline.SHARDS)}
    assert all(slot == list(range(len(slot))) for slot in slots.values())
    assert sum(map(len, slots.values())) == len(made) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_pipeline_of_awkward_tables(spark, folder, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "shared_folder", lambda spark: folder)
    docs = documents(spark).drop("shard", "slot")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(3, 60)], "doc_id long, quality int")
    items = spark.createDataFrame([(1, None), (None, ""), (2, "not in any document of this table " * 3)], "item_id long, text string")
    rows = {"docs": docs, "none": docs.limit(0)}
    made = {}
    for name, table in rows.items():
        for kind, frame in (("documents", table), ("labels", labels), ("benchmark", items)):
            frame.write.parquet(f"{folder}/{name}/{kind}.parquet")
        made[name] = corpus_pipeline.run(spark, f"{folder}/{name}").collect()
    assert made["none"] == []
    given = Counter(tuple(r) for r in docs.collect())
    found = Counter(tuple(r)[:-2] for r in made["docs"])
    assert made["docs"][0].__fields__ == [*docs.columns, "shard", "slot"]
    assert found and set(found) <= set(given) and max(found.values()) <= 3  # no value of any column has changed
