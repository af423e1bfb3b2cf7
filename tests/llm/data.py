"""Small tables with the awkward rows that every operator must bear."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves, or that are easily taken twice.
CLASHING = ("shard", "slot", "copies", "target", "leaks", "quality", "k_", "before", "n", "c", "key", "part", "set_id", "site_", "DOC", "name")


def words(rng, n, among=40):
    return [f"w{rng.randrange(among)}" for _ in range(n)]


def awkward_rows(seed=1, n=120):
    rng = random.Random(seed)
    base = [words(rng, rng.randint(1, 90)) for _ in range(8)]
    rows = []
    for i in range(n):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            own[rng.randrange(len(own))] = rng.choice(["Ünï", "x", "W1", "w2"])
        text = rng.choice([" ", "\n", "  "]).join(own)
        rows.append((i + 3, text, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None]), len(text)))
    long = " ".join(words(rng, 30_000, 3_000))
    rows += [
        (500, None, "en", "a", None), (501, "", "de", "b", 0), (502, " \t\n", None, None, 3), (503, "12 34 !?", "en", "c", 8),
        (504, long, "en", "a", len(long)), (505, long + " end", None, "a", len(long) + 4), (None, "w1 w2 w3", "en", "a", 8),
        (None, None, None, None, None), (-7, rows[4][1], "en", "b", 5), rows[5], rows[5], rows[6],
    ]
    return rows


def documents(spark, rows=None, clashing=True):
    df = spark.createDataFrame(awkward_rows() if rows is None else rows, DOCS).repartition(3)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(1) for c in CLASHING})
    return df
