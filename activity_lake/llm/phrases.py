"""Phrase collocation mining on a weighted de Bruijn graph.

Nodes are grams one word shorter than the longest phrase, edges are grams of the longest phrase's length, and a piece of
text is a walk. Every word occurrence starts one gram: an edge, or, near the end of its piece, a shorter one. These shorter
grams are the piece-end corrections: how often a gram occurs is the flow out of it, which is the weight of the edges that
start with it, plus the pieces that end in it. So one aggregation of edges and piece ends holds all counts.

A node whose only edge in and only edge out carry its whole count is inner to a path. Edges are compacted along such nodes,
by doubling pointers to the path's first edge, so a fixed passage is one row; its inner nodes have its weight, and the
check of what lies inside a longer phrase needs the ends of paths only, not both ends of every edge.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_lake.llm.common import cut, join_spread, pack, power_of_two, text_bytes, unpack_all
from activity_lake.llm.hashing import mixed

LONGEST, LEAST, SHARE, KEPT = 3, 10, 50, 2_000
PIECE_ENDS = re.compile("[.,;:!?\x0a-\x0d]")
#: Word occurrences that a task holds, as numbers, before it counts their grams and passes them on.
WORDS_HELD = 2_000_000
#: Word occurrences behind one part of the grams; a part is added up by one task.
WORDS_PER_PART = 1_000_000
WORD_BYTES = 6
SCORE = 1_000_000
STEP = np.uint64(0x9E3779B97F4A7C15)


def pieces(text: str) -> Iterator[list[str]]:
    """The words of each piece, A-Z lower-cased."""
    for piece in PIECE_ENDS.split(text.encode().lower().decode().replace("\t", " ")):
        found = [word for word in piece.split(" ") if word]
        if found:
            yield found


def packed(lang: str, grams: pa.Array, hashes: np.ndarray, numbers: np.ndarray, parts: int) -> pd.DataFrame:
    """Grams by part of their hash: one compressed block a part, its texts in the order they came."""
    part = (hashes >> np.uint64(64 - (parts.bit_length() - 1))).astype(np.int64) if parts > 1 else np.zeros(len(hashes), np.int64)
    by = np.argsort(part, kind="stable")
    part, numbers, grams = part[by], numbers[by], grams.take(pa.array(by))
    edge = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(edge, pa.int64()), grams), pa.scalar("\n", pa.large_string()))
    press = zstandard.ZstdCompressor(level=3)
    blocks = [press.compress(text.as_buffer()) for text in joined]
    return pd.DataFrame({"lang": lang, "part": part[edge[:-1]], "grams": blocks,
                         "numbers": [pack(numbers[i:j]) for i, j in zip(edge, edge[1:])]})


def unpacked(rows: pd.DataFrame) -> tuple[pa.Array, np.ndarray]:
    """All grams of some blocks, each once, and their summed numbers."""
    unpress = zstandard.ZstdDecompressor()
    texts = [text for block in rows["grams"] for text in unpress.decompress(block).decode().split("\n")]
    table = pa.table({"gram": pa.array(texts, pa.large_string()), "n": unpack_all(list(rows["numbers"]), "i8")[0]})
    summed = table.group_by("gram").aggregate([("n", "sum")]).combine_chunks()
    return summed["gram"].chunk(0), summed["n_sum"].to_numpy()


class Walks:
    """Pieces of one language as runs of word numbers, each closed by a zero."""

    def __init__(self):
        self.numbers: dict[str, int] = defaultdict(lambda: len(self.numbers) + 1)
        self.at = array("i")

    def add(self, words: list[str]) -> None:
        self.at.extend(map(self.numbers.__getitem__, words))
        self.at.append(0)

    def counted(self, longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The grams that start at each word, each once, in the order of their words, with hashes and numbers."""
        at = np.concatenate([np.frombuffer(self.at, np.int32), np.zeros(longest, np.int32)]).astype(np.int64)
        starts = np.flatnonzero(at)
        size = bits = len(self.numbers).bit_length()
        key, going = at[starts], np.ones(len(starts), bool)
        for k in range(1, longest):
            step = np.where(going, at[starts + k], 0)
            going &= step > 0
            if size + bits > 62:
                key = np.unique(key, return_inverse=True)[1]
                size = len(starts).bit_length()
            key, size = (key << bits) | step, size + bits
        _, first, numbers = np.unique(key, return_index=True, return_counts=True)
        names = pa.array([None, *self.numbers], pa.large_string())
        hashes = np.array([0, *map(word_hash, self.numbers)], np.uint64)
        total, words, going = np.zeros(len(first), np.uint64), [], np.ones(len(first), bool)
        for k in range(longest):
            word = np.where(going, at[starts[first] + k], 0)
            going &= word > 0
            words.append(names.take(pa.array(word)))
            total = mixed(total * STEP + hashes[word])
        return pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()), null_handling="skip"), total, numbers.astype(np.int64)


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


BLOCK = "lang string, part long, grams binary, numbers binary"


def grams(docs: DataFrame, longest: int, parts: int) -> DataFrame:
    """Blocks of edges and piece ends, counted within tasks only."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Walks] = defaultdict(Walks)
        n = 0

        def release() -> Iterator[pd.DataFrame]:
            for lang in list(held):
                yield packed(lang, *held.pop(lang).counted(longest), parts)

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                for found in pieces(text):
                    held[lang].add(found)
                    n += len(found)
                    if n >= WORDS_HELD:
                        yield from release()
                        n = 0
        yield from release()

    texts = docs.filter(F.col("text").isNotNull()).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return texts.mapInPandas(work, BLOCK)


def level(words: int, least: int, parts: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One part of the grams of up to so many words: complete counts of those with so many, and blocks of what flows on.

    A gram of ``words`` words is counted here and flows on to the node it starts with; a shorter one is a piece end that
    waits for its level. At the last level the sum of all is the number of words.
    """

    def read(rows: pd.DataFrame) -> pd.DataFrame:
        made = []
        for lang, own in rows.groupby("lang", sort=False):
            found, numbers = unpacked(own)
            here = pc.equal(pc.count_substring(found, " "), words - 1).to_numpy(zero_copy_only=False)
            often = here & (numbers >= least)
            made.append(pd.DataFrame({"lang": lang, "m": words, "gram": found.filter(pa.array(often)).to_pylist(), "n": numbers[often]}))
            if words == 1:
                made.append(pd.DataFrame({"lang": [lang], "m": 0, "gram": "", "n": numbers.sum()}))
                continue
            on = [gram.rpartition(" ")[0] if whole else gram for gram, whole in zip(found.to_pylist(), here.tolist())]
            hashes = np.fromiter(map(word_hash, on), np.uint64, len(on))
            made.append(packed(lang, pa.array(on, pa.large_string()), hashes, numbers, parts))
        columns = {c.split()[0]: None for c in LEVEL.split(", ")}
        return pd.concat([x.assign(**{c: None for c in columns if c not in x}) for x in made])[list(columns)].astype({"m": "Int32", "n": "Int64", "part": "Int64"})

    return read


LEVEL = f"{BLOCK}, m int, gram string, n long"


def counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, words_per_part: int = WORDS_PER_PART) -> DataFrame:
    """lang, gram, m (its words), n: all grams of up to ``longest`` words that occur ``least`` times.

    Edges are added up over all tasks. Then, level by level, a gram's count is the flow of those that start with it plus the
    piece ends that are it. Grams travel in compressed blocks, dealt by their hash, after a task has added up its own, so
    a frequent gram is one entry a task; the number of parts follows the size of the texts. The gram of no words has the
    number of all words.
    """
    parts = power_of_two(text_bytes(docs, "text") // WORD_BYTES, words_per_part, 64)
    rows, made = grams(docs, longest, parts), []
    for words in range(longest, 0, -1):
        rows = cut(rows.groupBy("part").applyInPandas(level(words, least, parts), LEVEL), "phrase-level", packed=True)
        made.append(rows.filter("gram is not null").select("lang", "gram", "m", "n"))
        rows = rows.filter("gram is null").select("lang", "part", "grams", "numbers")
    often = functools.reduce(DataFrame.unionByName, made)
    return often.filter("m > 0").unionByName(often.filter("m = 0").groupBy("lang", "gram", "m").agg(F.sum("n").alias("n")))


def length(gram: Column) -> Column:
    return F.length(gram) - F.length(F.replace(gram, F.lit(" "))) + 1


def first_words(gram: Column, n: int) -> Column:
    return F.substring_index(gram, " ", n)


def last_words(gram: Column, n: int) -> Column:
    return F.substring_index(gram, " ", -n)


def inner_nodes(strong: DataFrame, nodes: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, before, after: pairs of edges joined by a node through which the whole count of both, and of the node, passes.

    An edge as heavy as its node is the only one on that side, so the heaviest edge of each side decides.
    """
    best = F.max_by("gram", "n")
    ins = strong.groupBy("lang", last_words(F.col("gram"), longest - 1).alias("node")).agg(best.alias("before"), F.max("n").alias("n"))
    outs = strong.groupBy("lang", first_words(F.col("gram"), longest - 1).alias("node")).agg(best.alias("after"), F.max("n").alias("n"))
    counted = nodes.select("lang", F.col("gram").alias("node"), "n")
    return ins.join(outs, ["lang", "node", "n"]).join(counted, ["lang", "node", "n"]).select("lang", "before", "after")


def compact(strong: DataFrame, nodes: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, words (array), n: edges (lang, gram, n) joined along inner nodes to paths, single edges being paths too.

    ``nodes``: lang, gram, n. Every edge of a path points to the edge before it; pointers are doubled until all point to
    the first one. A path is never longer than the longest piece, as no piece ends inside it.
    """
    links = cut(inner_nodes(strong, nodes, longest), "phrase-links")
    point = (links.select("lang", F.col("after").alias("gram"), F.col("before").alias("to"), F.lit(1).alias("steps"))
             .unionByName(links.select("lang", F.col("before").alias("gram"), F.col("before").alias("to"), F.lit(0).alias("steps")))
             .groupBy("lang", "gram").agg(F.max_by("to", "steps").alias("to"), F.max("steps").alias("steps")))
    point = cut(point.withColumn("moved", F.lit(True)), "phrase-pointers")
    while not point.filter("moved").isEmpty():
        target = point.select("lang", F.col("gram").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        point = cut(point.drop("moved").join(target, ["lang", "to"]).select(
            "lang", "gram", F.col("next").alias("to"), (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("more") > 0).alias("moved")), "phrase-pointers")
    placed = strong.join(point.drop("moved"), ["lang", "gram"], "left").select(
        "lang", F.coalesce("to", "gram").alias("first"), F.coalesce("steps", F.lit(0)).alias("place"), "gram", "n")
    joined = placed.groupBy("lang", "first").agg(
        F.sort_array(F.collect_list(F.struct("place", last_words(F.col("gram"), 1).alias("word")))).alias("edges"), F.max("n").alias("n"))
    return joined.select("lang", F.concat(
        F.split(first_words(F.col("first"), longest - 1), " "), F.col("edges.word")).alias("words"), "n")


def windows(words: str, width: int, first: int = 0, short: int = 0) -> Column:
    """The grams of ``width`` words of an array, without the first and last so many."""
    at = F.sequence(F.lit(first), F.size(words) - width - short)
    return F.when(F.size(words) - width - short >= first, F.transform(at, lambda i: F.array_join(F.slice(words, i + 1, width), " ")))


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, kept: int = KEPT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to ``longest`` words of each language.

    ``docs`` has text and lang; null languages are ``und``. A phrase occurs ``least`` times; its score is that of its
    weakest cut, ``a * a / (l * r)`` in millionths, in exact decimals; it goes if a longer phrase has ``share`` percent of
    its occurrences. Null and empty texts have no words, repeated rows count each, and without phrases there are no rows.
    """
    often = cut(counts(docs, longest, least), "phrase-counts")
    totals = often.filter("m = 0").select("lang", F.col("n").alias("total"))
    shorter = often.filter(F.col("m").between(1, longest - 1))
    strong, nodes = (often.filter(F.col("m") == m).drop("m") for m in (longest, longest - 1))
    paths = cut(compact(strong, nodes, longest), "phrase-paths")

    # phrases of full length are the windows of the paths; what lies inside a path has its weight, so ends and inner nodes
    # of paths mark all nodes that a full-length phrase covers
    candidates = paths.select("lang", F.explode(windows("words", longest)).alias("gram"), F.col("n").alias("a"))
    marks = paths.select("lang", F.explode(F.concat(
        F.array(F.array_join(F.slice("words", 1, longest - 1), " "), F.array_join(F.slice("words", -(longest - 1), longest - 1), " ")),
        F.coalesce(windows("words", longest - 1, 1, 1), F.array().cast("array<string>")))).alias("gram"), "n")
    for m in range(longest - 1, 1, -1):
        own = shorter.filter(F.col("m") == m).select("lang", "gram", F.col("n").alias("a"))
        covered = marks.groupBy("lang", "gram").agg(F.max("n").alias("most"))
        candidates = candidates.unionByName(own.join(covered, ["lang", "gram"], "left").filter(
            F.coalesce(100 * F.col("most") < share * F.col("a"), F.lit(True))).drop("most"))
        # what is dropped still covers what it contains
        marks = own.select("lang", F.explode(F.array(
            first_words(F.col("gram"), m - 1), last_words(F.col("gram"), m - 1))).alias("gram"), F.col("a").alias("n"))
    return ranked(scored(cut(candidates, "phrase-candidates"), shorter), totals, kept)


def scored(candidates: DataFrame, shorter: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the weakest cut, the earliest of equal ones."""
    words = length(F.col("gram"))
    cuts = cut(candidates.select("lang", "gram", "a", F.explode(F.sequence(F.lit(1), words - 1)).alias("k")).select(
        "lang", "gram", "a", "k", F.expr("substring_index(gram, ' ', k)").alias("left"),
        F.expr(f"substring_index(gram, ' ', k - (length(gram) - length(replace(gram, ' ')) + 1))").alias("right")), "phrase-cuts")
    left = cut(join_spread(cuts, shorter.select("lang", F.col("gram").alias("left"), F.col("n").alias("l")), ["lang", "left"]), "phrase-left")
    both = join_spread(left, shorter.select("lang", F.col("gram").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in "alr")
    return (both.withColumn("num", a * a * F.lit(SCORE).cast("decimal(7,0)")).withColumn("den", l * r)
            .groupBy("lang", F.col("gram").alias("phrase"), "a")
            .agg(F.min(F.struct(F.expr("num div den").alias("score"), "k", "l", "r")).alias("x"))
            .select("lang", "phrase", "a", "x.l", "x.r", "x.score"))


def ranked(rows: DataFrame, totals: DataFrame, kept: int) -> DataFrame:
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= kept)
            .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))


def op13_phrases(docs: DataFrame) -> DataFrame:
    return phrases(docs.select("text", "lang"))


ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM placed, (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, m, g, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
phrases AS (SELECT *, string_split(g, ' ') AS w FROM f WHERE m > 1 AND a >= 10),
inside AS (
    SELECT lang, g, max(a) AS longer FROM (
        SELECT lang, array_to_string(w[1:2], ' ') AS g, a FROM phrases WHERE m = 3
        UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM phrases WHERE m = 3) GROUP BY lang, g),
cuts AS (
    SELECT p.*, unnest(range(1, m)) AS k FROM phrases AS p LEFT JOIN inside AS i USING (lang, g)
    WHERE m = 3 OR i.longer IS NULL OR 100 * i.longer < 50 * p.a),
valued AS (
    SELECT c.lang, c.g, c.a, c.k, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
    FROM cuts AS c
    JOIN f AS x ON x.lang = c.lang AND x.g = array_to_string(c.w[1:c.k], ' ') AND x.m = c.k
    JOIN f AS y ON y.lang = c.lang AND y.g = array_to_string(c.w[c.k + 1:], ' ') AND y.m = c.m - c.k),
weakest AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM weakest)
SELECT lang, rank::INT AS rank, g AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
