"""Neighbours, archives, repeated strings and near duplicates."""

import glob
import gzip
import hashlib
import os
import random

from collections import Counter

import numpy as np
import pandas as pd
import pytest

from activity_lake.llm import jaccard, knn, suffix_dedup, warc
from activity_lake.llm.common import cut
from activity_lake.llm.hashing import BASE, BYTE_CODES, grams, sliding_min
from tests.llm import brute
from tests.llm.data import documents, words


def test_neighbours_of_awkward_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.3]) for _ in range(3)]) for i in range(200)]
    rows += [(50, None), (300, [float("nan"), 0.0, 0.0]), (301, [None, 0.0, 0.0]), (302, [float("inf")]), (None, [0.1, 0.1, 0.1]),
             (250, [0.5]), (350, []), rows[3], rows[100], rows[100], (400, [1e30, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    data = [(r["vec_id"], [int(np.floor(np.float64(np.float32(x)) * 256)) for x in r["embedding"]]) for r in df.collect()
            if r["vec_id"] is not None and r["embedding"] is not None and r["vec_id"] not in (300, 301, 302)]
    data = [(i, [min(max(x, -2 ** 63), 2 ** 63 - 1) for x in v]) for i, v in data]
    wanted = set()
    for q, v in {(i, tuple(v)) for i, v in data if i % 50 == 0}:
        scored = sorted((-max(min(sum(a * b for a, b in zip(v, w)), 2 ** 63 - 1), -2 ** 63), i) for i, w in data if i != q)
        wanted |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])}
    assert {tuple(r) for r in knn.op3_neighbours(df).collect()} == wanted


def test_neighbours_with_cells_that_exclude(spark, monkeypatch):
    monkeypatch.setattr(knn, "VECTORS_PER_PIVOT", 20)
    monkeypatch.setattr(knn, "QUERIES_PER_GROUP", 5)
    rng = np.random.default_rng(1)
    centres = np.eye(8) * 0.9
    vectors = np.concatenate([c + rng.normal(0, 0.01, (100, 8)) for c in centres]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    ints = np.floor(vectors.astype(float) * 256).astype(np.int64)
    got = {}
    for r in knn.op3_neighbours(df, k=3, every=40).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 800, 40))
    for q, found in got.items():
        scores = ints @ ints[q]
        order = [i for i in np.lexsort((np.arange(800), -scores)) if i != q][:3]
        assert sorted(found) == [(k + 1, i, scores[i]) for k, i in enumerate(order)]


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [0.5]), (1, [1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in knn.op3_neighbours(df).collect()] == [(0, 1, 1, 128 * 256)]
    assert knn.op3_neighbours(df.filter("vec_id = 0")).count() == 0 == knn.op3_neighbours(df.limit(0)).count()


def brute_neighbours(rows, k, every):
    """Of vec_id and whole numbers; query_id, rank, vec_id, score."""
    wanted = set()
    width = max(len(v) for _, v in rows)
    ids, table = np.array([i for i, _ in rows]), np.array([[*v, *[0] * (width - len(v))] for _, v in rows], object)
    for q, v in {(i, tuple(v)) for i, v in rows if i % every == 0}:
        scores = np.clip(table[:, :len(v)] @ np.array(v, object), -2 ** 63, 2 ** 63 - 1) if v else np.zeros(len(ids), object)
        found = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if i != q)[:k]
        wanted |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(found)}
    return wanted


def test_neighbours_in_sets_parts_and_split_cells(spark, monkeypatch):
    for name, value in (("VECTORS_PER_PIVOT", 60), ("QUERIES_PER_GROUP", 7), ("SET_BYTES", 3 * 7 * 4 * 4), ("PART_VECTORS", 150), ("BLOCK_ROWS", 64)):
        monkeypatch.setattr(knn, name, value)
    rng = np.random.default_rng(5)
    vectors = np.concatenate([c + rng.normal(0, 0.1, (200, 4)) for c in np.eye(4)]).tolist()
    vectors += [[0.5, -0.25, 0.0, 0.125]] * 400 + [[0.0] * 4] * 40 + [[-0.25, 0.25]] * 60
    rng.shuffle(vectors)
    vectors += [[s * 10.0 ** e, 0.0, 0.0, 0.0] for e in (3, 8, 17, 25, 30) for s in (1, -1)]
    rows = [(i * 7 % 1_301, v) for i, v in enumerate(vectors)]
    rows += [(i, v) for i, v in rows[:90] for _ in range(9)] + [(i + 1, v) for i, v in rows[90:150]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    ints = [(i, [int(min(max(np.floor(x * 256), -2 ** 63), 2 ** 63 - 1)) for x in v]) for i, v in rows]
    got = [tuple(r) for r in knn.op3_neighbours(df, k=4, every=5).collect()]
    assert set(got) == brute_neighbours(ints, 4, 5)


def moved_bytes(df):
    """Shuffled or broadcast by the plan that ran."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        below = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan() if kind.endswith("QueryStageExec") else None
        own = node.metrics().apply("dataSize").value() if kind in ("ShuffleExchangeExec", "BroadcastExchangeExec") else 0
        return own + (walk(below) if below else sum(walk(node.children().apply(i)) for i in range(node.children().size())))

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_neighbours_send_a_vector_once_to_many_groups(spark, monkeypatch):
    monkeypatch.setattr(knn, "QUERIES_PER_GROUP", 5)
    monkeypatch.setattr(knn, "VECTORS_PER_PIVOT", 40)
    vectors = np.random.default_rng(2).normal(0, 0.2, (3_000, 16))  # nothing is excluded
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")
    assert moved_bytes(knn.op3_neighbours(df, every=10)) < 5 * vectors.nbytes


def test_best_of_ties_in_any_order():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(-2, 2, (6, 500)), rng.permutation(500)
    scores[0], scores[1] = -2 ** 63, 2 ** 63 - 1
    best = knn.Best(6, 5)
    for at in np.array_split(np.arange(500), 9):
        q, v = np.nonzero(np.ones((6, len(at)), bool))
        best.add(q, scores[q, at[v]], ids[at[v]])
    for q in range(6):
        order = np.lexsort((ids, ~scores[q]))[:5]
        assert (best.ids[q] == ids[order]).all() and (best.scores[q] == scores[q][order]).all() and not best.open[q].any()


def test_equal_vectors_stay_while_they_can_count():
    ids = np.array([1] * 6 + [2] * 2 + [3, 4, 5, 6, 7] + [9])
    rows = np.zeros((len(ids), 3), np.int16)
    rows[-1] = 1
    assert knn.undominated(ids, rows, 2).tolist() == [0, 1, 6, 7, 13]
    assert len(knn.undominated(np.arange(5), np.eye(5, dtype=np.int16), 1)) == 5


PAGES = "page_id long, url string, html string"


def test_archives_round_trip(spark, folder):
    big = "é\r\n\r\nWARC/1.1\r\n" * 40
    rows = [(1, "u1", "a"), (2, None, "a"), (3, "u3", big), (4, "line\nbreak", None), (5, "u5", ""), (None, "u6", "a"), (7, "u7", big),
            (7, "u7", big), (8, "u8", "b" * 1000), (None, None, "alone")]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    warc.write_archives(pages, f"{folder}/w", segment_bytes=100)
    parts = warc.read_parts(spark, f"{folder}/w")
    assert parts.filter("kind = 'continuation'").count() > 10
    made = warc.read_archives(spark, f"{folder}/w").collect()
    newest = {}
    for page, _, html in rows:
        newest[html or ""] = max(newest.get(html or "", -1), -1 if page is None else page)
    got = sorted(((r["page_id"], r["record_type"], r["payload_bytes"], r["refers_to"]) for r in made), key=str)
    wanted = []
    for page, _, html in rows:
        top = newest[html or ""]
        first = top == (-1 if page is None else page)
        wanted.append((page, "response" if first else "revisit", len((html or "").encode()), None if first else top))
    assert got == sorted(wanted, key=str)
    texts = {bytes(r["payload"]).decode() for r in made if r["record_type"] == "response"}
    assert texts == {"a", big, "", "b" * 1000, "alone"}


def test_lost_segment_and_wrong_digest_are_errors(spark, folder):
    pages = spark.createDataFrame([(1, "u", "x" * 500)], PAGES).coalesce(1)
    warc.write_archives(pages, f"{folder}/w", segment_bytes=100)
    whole = warc.read_parts(spark, f"{folder}/w").count()
    assert whole > 5
    (path,) = glob.glob(f"{folder}/w/*.gz")
    content = gzip.open(path).read()
    records = content.split(b"WARC/1.1\r\n")[1:]
    for name, kept in (("lost", records[:2] + records[3:]), ("changed", [r.replace(b"xxx", b"xyx", 1) for r in records])):
        os.makedirs(f"{folder}/{name}")
        with open(f"{folder}/{name}/part.txt", "wb") as out:
            out.write(b"".join(b"WARC/1.1\r\n" + r for r in kept))
        with pytest.raises(Exception, match="segments missing|wrong digest"):
            warc.read_archives(spark, f"{folder}/{name}").collect()


def test_chunks():
    for n in (0, 1, 5, 6, 17):
        assert warc.from_chunks(warc.to_chunks(b"y" * n, 5)) == b"y" * n
    assert warc.from_chunks(b"3;a=b\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.from_chunks(b"5\r\nabc\r\n0\r\n\r\n")


def test_no_pages(spark):
    assert warc.op8_archives(spark.createDataFrame([], PAGES)).count() == 0


def test_grams_and_minima():
    text = np.frombuffer(b"the quick brown fox jumps over it", np.uint8)
    for length in (1, 2, 7, 16, 25):
        made = grams(BYTE_CODES[text], length)
        assert len(made) == len(text) - length + 1
        value = 0
        for b in text[3:3 + length] if len(made) > 3 else ():
            value = (value * int(BASE) + int(BYTE_CODES[b])) % 2 ** 64
        assert len(made) <= 3 or int(made[3]) == value
    values = np.array([5, 3, 8, 1, 9, 2, 7], np.uint64)
    for width in range(1, 8):
        assert sliding_min(values, width).tolist() == [min(values[i:i + width]) for i in range(len(values) - width + 1)]


@pytest.mark.parametrize("seed, small", [(1, False), (2, True)])
def test_repeats_against_brute_force(spark, seed, small, monkeypatch):
    rng = random.Random(seed)
    base = "".join(rng.choices("ab ", k=2500))
    docs = []
    for i in range(100):
        a = rng.randint(0, 2400)
        text = base[a:a + rng.randint(0, 300)]
        for _ in range(rng.randint(0, 4)):
            j = rng.randint(0, len(text))
            text = text[:j] + rng.choice("abcé") + text[j + 1:]
        docs.append((i, text + "z" * rng.choice([0, 0, 60, 200])))
    docs += [(3, docs[3][1]), (None, docs[5][1]), (None, None), (1000, None), (1001, ""), (1002, "x" * 49), (1003, "x" * 49),
             (1004, "x" * 50), (1005, "x" * 51), (-5, docs[7][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    made = suffix_dedup.remove_repeats(df, 1_000 if small else suffix_dedup.PART_BYTES)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in made.collect()]
    assert brute.in_order(got) == brute.in_order(brute.repeats(docs))


def test_repeats_of_awkward_tables(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert brute.in_order(suffix_dedup.op9_repeats(docs).collect()) == brute.in_order(brute.repeats(rows))
    assert suffix_dedup.op9_repeats(docs.limit(0)).count() == 0


def shared_ids(rng):
    """Long different texts under null and repeated ids, with passages of smaller ids and of each other in them."""
    letters = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    common, docs = [letters(120) for _ in range(6)], []
    for i in range(60):
        text = letters(rng.randint(200, 500)) + rng.choice(common)[rng.randint(0, 40):] + letters(rng.randint(0, 300))
        docs.append((rng.choice([None, None, 5, 7, 7, 2 ** 40, i + 10]), text))
    return docs + [docs[0], docs[1], (None, None), (7, None), (7, common[0][:60]), (None, common[1][:49])]


@pytest.mark.parametrize("part_bytes", [1_000, suffix_dedup.PART_BYTES])
def test_repeats_of_rows_that_share_an_id(spark, part_bytes):
    docs = shared_ids(random.Random(8))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    made = suffix_dedup.remove_repeats(df, part_bytes)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in made.collect()]
    assert brute.in_order(got) == brute.in_order(brute.repeats(docs))


def test_rows_that_share_an_id_are_spread(spark):
    layout = suffix_dedup.Layout(16, 64)
    batch = pd.DataFrame({"doc_id": [suffix_dedup.NO_ID] * 400 + [1, 2], "id_bit": 0, "text_hash": np.random.default_rng(1).integers(0, 2 ** 62, 402)})
    ids, keys = suffix_dedup.RowKeys(None).of(batch)
    assert keys[400:].tolist() == [0, 0]
    assert np.bincount(layout.of_document(ids, keys)[:400], minlength=16).max() < 60


@pytest.mark.parametrize("words_, percent, chunk", [(3, 90, 4096), (5, 80, 4096), (2, 75, 12), (1, 60, 5)])
def test_links_against_brute_force(spark, words_, percent, chunk, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = jaccard.near_duplicates(docs, words_, percent).collect()
    assert brute.in_order(got) == brute.in_order(brute.linked(rows, words_, percent))


def test_large_group_of_near_copies_is_settled_by_its_own_set(spark, monkeypatch):
    """Three hundred near copies fill fifteen chunks of a hub; few stay open for a second meeting, and no link is lost."""
    monkeypatch.setattr(jaccard, "CHUNK", 20)
    opened = []
    monkeypatch.setattr(jaccard, "cut", lambda df, purpose, *packed, **named: (
        kept := cut(df, purpose, *packed, **named), opened.append(kept.count()) if purpose == "open" else None)[0])
    rng, base = random.Random(12), [f"b{i}" for i in range(200)]
    rows = []
    for i in range(300):
        own = list(base)
        own[rng.randrange(30, 200)] = f"x{i}"
        rows.append((i + 5, " ".join(own)))
    for i in range(6):  # share half of their words with the copies, and are linked with nothing
        rows.append((400 + i, " ".join(base[:100] + [f"y{i}z{j}" for j in range(100)])))
    docs = spark.createDataFrame(rows + [rows[3], rows[3], (None, rows[7][1])], "doc_id long, text string").repartition(6)
    got = jaccard.near_duplicates(docs, 3, 90).collect()
    assert brute.in_order(got) == brute.in_order(brute.linked([tuple(r) for r in docs.collect()], 3, 90))
    assert opened and max(opened) <= 30


def test_no_pair_is_skipped():
    rng = random.Random(9)
    limit = jaccard.Threshold(80)
    for _ in range(200):
        size = np.array([rng.randint(1, 40) for _ in range(rng.randint(2, 30))])
        at = np.array([rng.randrange(limit.prefix(int(n))) for n in size])
        wanted = [any(i != j and limit.overlap(int(a), int(b)) <= min(a - p, b - q) and 80 * max(a, b) <= 100 * min(a, b)
                      for j, (b, q) in enumerate(zip(size, at))) for i, (a, p) in enumerate(zip(size, at))]
        found = jaccard.with_partner(size, at, limit)
        assert all(f or not w for f, w in zip(found, wanted))


def test_components_skip_only_what_is_known():
    rng = random.Random(5)
    for _ in range(100):
        base = [rng.getrandbits(40) for _ in range(30)]
        sets = []
        for _ in range(rng.randint(2, 25)):
            own = set(rng.sample(base, rng.randint(20, 30))) | {rng.getrandbits(40) for _ in range(rng.choice([0, 1, 3]))}
            sets.append(np.array(sorted(own), np.uint64))
        parent = list(range(len(sets)))
        for _ in sets:
            for i, a in enumerate(sets):
                for j, b in enumerate(sets):
                    both = len(np.intersect1d(a, b))
                    if 100 * both >= 80 * (len(a) + len(b) - both):
                        parent[i] = parent[j] = min(parent[i], parent[j])
        assert jaccard.components(sets, jaccard.Threshold(80)).tolist() == parent


def test_keep_one_tells_rows_of_an_id_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "x"), (1, b, "y"), (2, a, "x"), (None, a, "x"), (None, c, "x"), (None, c, "x"), (None, None, "x"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_ string").repartition(3)
    made = sorted(map(tuple, jaccard.keep_one(docs).collect()), key=str)
    others = [r for r in made if r[:2] == (1, b)]
    assert len(others) == 1 and made == sorted(map(tuple, jaccard.keep_one(docs.repartition(5)).collect()), key=str)
    assert [r for r in made if r[:2] != (1, b)] == sorted([(1, a, "x"), (None, c, "x"), (None, None, "x"), (3, "", "z")], key=str)


def test_keep_one(spark):
    docs = documents(spark)
    made = jaccard.keep_one(docs)
    assert made.columns == docs.columns
    found = brute.linked([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
    ids = [r["doc_id"] for r in made.collect() if r["doc_id"] is not None]
    assert sorted(ids) == sorted({c for d, _, c in found if d is not None})
    assert jaccard.keep_one(docs.limit(0)).count() == 0
    assert len(words(random.Random(1), 3)) == 3


def test_answers_derived_from_similar_sets():
    rng = np.random.default_rng(11)
    base = rng.integers(0, 2 ** 63, 300, np.uint64)
    tokens = []
    for _ in range(40):
        own = base.copy()
        own[rng.integers(0, 300, rng.integers(0, 12))] = rng.integers(0, 2 ** 63, 1, np.uint64)
        tokens.append(np.unique(own))
    tokens += [np.unique(rng.integers(0, 2 ** 63, 50, np.uint64)) for _ in range(3)]
    sets = jaccard.Sets(tokens)
    answer, derived = sets.count(sets.shared(0)), 0
    for x in range(1, len(tokens)):
        found = sets.derived(x, 0, answer)
        if found is not None:
            derived += 1
            assert (found == sets.count(sets.shared(x))).all()
            assert [int(c) for i, c in enumerate(found) if i != x] == [
                len(np.intersect1d(tokens[x], tokens[i])) for i in range(len(tokens)) if i != x]
    assert derived >= 39


def test_texts_without_ids_are_looked_up_apart(spark):
    def text(i):
        return " ".join(f"w{i}x{j}" for j in range(30))

    rows = [(None, text(i % 20) + (" end" if i % 2 else ""), "en", "a", 0) for i in range(60)] + [(7, text(3), "en", "a", 0), (9, text(50), "en", "a", 0)]
    docs = documents(spark, rows, False)
    got = Counter(tuple(r) for r in jaccard.near_duplicates(docs, 5, 80).collect())
    # texts 3 and "3 end" are one component with id 7; the others have no id to be named by
    assert got == Counter({(7, 26, 7): 1, (9, 26, 9): 1, (None, 27, 7): 3, (None, 26, None): 30, (None, 27, None): 27})
