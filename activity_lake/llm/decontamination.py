"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of all test items. A document's words are streamed through it; the longest
matching length at each word says which runs of an item end there. A run of ``window`` words, or a whole item that is
shorter, makes the words it covers *hit*; the state of such a run knows the items it comes from. Streaming starts only
where two neighbouring words occur next to each other in some item, which an array lookup finds for a whole text.

The items are few beside the corpus, but no number is assumed: they are put into groups of a bounded number of bytes,
each group's automaton is built and broadcast by itself, and hits of several groups are merged per text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.llm.common import unused

WINDOW = 10
GROUP_BYTES = 1_500_000  # of item text in one automaton: some 250,000 words, 0.5 million states at most
PIECE = 1 << 20
# Everything that isn't a letter A-Z (made lower case), a digit or beyond ASCII parts words.
WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some hundred thousand at a time."""
    clean, at = text.translate(WORD_TABLE), 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


class ItemAutomaton:
    """Suffix automaton over the words of all items, with the items of each state's runs."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.length, self.ids = [-1], [0], [set()]
        pairs, shortest = set(), window
        whole: dict[int, set] = {}
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if not words:
                continue
            pairs.update(zip(words, words[1:]))
            shortest = min(shortest, len(words))
            state = 0
            for word in words:
                state = self._add(state, word)
                if item_id is not None:
                    self.ids[state].add(item_id)
            if len(words) < window:
                whole.setdefault(state, set()).update([] if item_id is None else [item_id])
        self.shortest = shortest
        self._spread(whole)
        size = len(self.vocabulary)
        self.pairs = np.array(sorted(a * size + b for a, b in pairs), np.int64)

    def _new(self, length: int, steps: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.steps.append(steps)
        self.link.append(link)
        self.ids.append(set())
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of the runs of ``target`` that are no longer than a step from ``state``."""
        clone = self._new(self.length[state] + 1, dict(self.steps[target]), self.link[target])
        self.link[target] = clone
        while state >= 0 and self.steps[state].get(word) == target:
            self.steps[state][word] = clone
            state = self.link[state]
        return clone

    def _add(self, last: int, word: int) -> int:
        """The state of the item's words so far, one word further; runs that are known are not made again."""
        target = self.steps[last].get(word)
        if target is not None:
            if self.length[target] == self.length[last] + 1:
                return target
            return self._split(last, word, target)
        made = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.steps[state]:
            self.steps[state][word] = made
            state = self.link[state]
        if state >= 0:
            target = self.steps[state][word]
            if self.length[target] == self.length[state] + 1:
                self.link[made] = target
            else:
                self.link[made] = self._split(state, word, target)
        return made

    def _spread(self, whole: dict[int, set]) -> None:
        """Hand the items of long runs down to their suffixes; note where whole short items end."""
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for state in reversed(order):
            if self.link[state] > 0:
                self.ids[self.link[state]] |= self.ids[state]
        #: Per state: the window state among its suffixes, and the whole short items that are suffixes.
        self.full = [0] * len(self.length)
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.length)
        for state in order:
            link = self.link[state]
            if self.length[state] >= self.window:
                self.full[state] = state if self.length[link] < self.window else self.full[link]
            self.short[state] = self.short[link] + (((state, self.length[state]),) if state in whole else ())
        self.whole_ids = whole  # of the items that are this run, not of those that only begin with it

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set]:
        """Words of the text, hit runs of words (start, end), and the items found."""
        total, spans, found, keep = 0, [], set(), []
        for words in pieces(text):
            total += len(words)
            words = keep + words
            base = total - len(words)
            for a, b in self._hits(words, found):
                if spans and spans[-1][1] >= base + a:
                    spans[-1] = (spans[-1][0], max(spans[-1][1], base + b))
                else:
                    spans.append((base + a, base + b))
            keep = words[-(self.window - 1):] if self.window > 1 else []
        return total, _joined(spans), found

    def _hits(self, words: list[bytes], found: set) -> list[tuple[int, int]]:
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        if self.shortest > 1:
            size = max(len(self.vocabulary), 1)
            pair = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * size + ids[1:], -1)
            at = np.searchsorted(self.pairs, pair)
            known = np.zeros(len(words) + 1, np.int8)
            if len(self.pairs):
                known[1:-1] = self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair
            edges = np.flatnonzero(np.diff(known))
            runs = [(int(a), int(b) + 1) for a, b in zip(edges[::2], edges[1::2]) if b + 1 - a >= self.shortest]
        else:
            known = np.concatenate([[0], ids >= 0, [0]]).astype(np.int8)
            edges = np.flatnonzero(np.diff(known))
            runs = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
        hits: list[tuple[int, int]] = []
        for a, b in runs:
            self._stream(ids[a:b].tolist(), a, hits, found)
        return hits

    def _stream(self, ids: list[int], base: int, hits: list[tuple[int, int]], found: set) -> None:
        steps, link, length = self.steps, self.link, self.length
        state, matched, seen = 0, 0, set()
        for i, word in enumerate(ids, base + 1):
            while state and word not in steps[state]:
                state = link[state]
                matched = length[state]
            if word in steps[state]:
                state = steps[state][word]
                matched += 1
            if matched >= self.window:
                hits.append((i - self.window, i))
                full = self.full[state]
                if full not in seen:
                    seen.add(full)
                    found |= self.ids[full]
            for whole, n in self.short[state]:
                if n <= matched:
                    hits.append((i - n, i))
                    found |= self.whole_ids[whole]
        hits.sort()


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if found and a <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], b))
        else:
            found.append((a, b))
    return found


HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])


def item_groups(benchmark: DataFrame, group_bytes: int) -> list[list[tuple[str | None, bytes]]]:
    """Groups of items of at most ``group_bytes`` of text, or of one item; fetched one group at a time.

    Items pass the driver in such groups because each automaton is one object; at 200,000 words it takes some 100 MB.
    """
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).filter("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, -(-total // group_bytes))
    if groups == 1:
        yield [tuple(r) for r in items.collect()]
        return
    key = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))
    for g in range(groups):
        batch, size = [], 0
        for row in items.filter(key == g).toLocalIterator():
            if batch and size + len(row["text"]) > group_bytes:
                yield batch
                batch, size = [], 0
            batch.append(tuple(row))
            size += len(row["text"])
        if batch:
            yield batch


def scan_column(spark, automaton: ItemAutomaton):
    """A function of a binary text column to its hits by one automaton, which is broadcast."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(automaton))

    @F.pandas_udf(HITS)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        items = pickle.loads(shared.value)
        for batch in texts:
            rows = []
            for text in batch:
                n, spans, found = items.scan(text) if text is not None else (0, [], ())
                rows.append((n, [a for a, _ in spans], [b for _, b in spans], sorted(found)))
            yield pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])

    return scan


@F.pandas_udf(HITS)
def _merge(n: pd.Series, starts: pd.Series, ends: pd.Series, items: pd.Series) -> pd.DataFrame:
    rows = []
    for a, b, c, d in zip(n, starts, ends, items):
        spans = _joined([p for x, y in zip(b, c) for p in zip(x, y)])
        rows.append((a, [x for x, _ in spans], [y for _, y in spans], sorted({i for x in d for i in x})))
    return pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, out: str = "leaks", window: int = WINDOW,
               group_bytes: int = GROUP_BYTES) -> DataFrame:
    """All columns of ``docs`` and the struct ``out``: n_words, starts and ends of hit runs of words, items found (as strings).

    A null text has no words, an empty one neither; an item without words has no window. An item without an id hits words
    but isn't named. Repeated items are one item. Each row is judged by itself, so repeated rows get equal results.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("binary")
    docs = docs.drop(out)
    groups = item_groups(benchmark, group_bytes)
    first = next(groups, [])
    second = next(groups, None)
    if second is None:
        return docs.withColumn(out, scan_column(spark, ItemAutomaton(first, window))(text))
    # Several automata: texts with hits are found group by group, merged by the text's digest and joined back.
    found, group = None, first
    while group is not None:
        hits = (docs.select(F.sha2("text", 256).alias("digest"), scan_column(spark, ItemAutomaton(group, window))(text).alias("h"))
                .filter(F.size("h.starts") > 0).select("digest", "h.*").dropDuplicates(["digest"]))
        found = hits if found is None else found.unionByName(hits)
        group, second = (second, next(groups, None)) if second is not None else (None, None)
    merged = found.groupBy("digest").agg(
        F.max("n_words").alias("n"), F.collect_list("starts").alias("s"), F.collect_list("ends").alias("e"),
        F.collect_list("items").alias("i")).select("digest", _merge("n", "s", "e", "i").alias(out))
    count = scan_column(spark, ItemAutomaton([], window))(text)
    digest = unused(docs, "digest_")
    joined = docs.withColumn(digest, F.sha2("text", 256)).join(merged.withColumnRenamed("digest", digest), digest, "left")
    return joined.withColumn(out, F.coalesce(F.col(out), count)).drop(digest)


def op6_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_leaks(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", F.col("leaks.n_words").alias("n_words"),
        F.aggregate(F.arrays_zip("leaks.starts", "leaks.ends"), F.lit(0).cast("long"),
                    lambda total, run: total + run["ends"] - run["starts"]).alias("n_hit"),
        F.size("leaks.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("leaks.items")), 256).alias("items_sha256"))
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, longest: int = 2 * WINDOW, coverage: float = 0.2) -> DataFrame:
    """Documents without the leaks: columns as they came.

    A document goes if a hit run is longer than ``longest`` words or if more than ``coverage`` of its words are hit.
    Shorter runs are cut out of the text, from the first byte of the first word to the last of the last. Documents
    without a hit, null and empty texts stay as they are.
    """
    leaks = unused(docs, "leaks_")
    groups = item_groups(benchmark, GROUP_BYTES)
    first = next(groups, [])
    if next(groups, None) is None:
        # one automaton: texts are scanned, judged and cut in one call
        judge = judge_column(docs.sparkSession, ItemAutomaton(first, WINDOW), longest, coverage)
        judged = docs.withColumn(leaks, judge(F.col("text").cast("binary"))).filter(f"{leaks}.keep")
        return judged.withColumn("text", F.coalesce(F.col(f"{leaks}.text"), "text")).select(*docs.columns)
    found = find_leaks(docs, benchmark, leaks)
    hit = F.aggregate(F.arrays_zip(f"{leaks}.starts", f"{leaks}.ends"), F.lit(0).cast("long"),
                      lambda total, run: total + run["ends"] - run["starts"])
    most = F.aggregate(F.arrays_zip(f"{leaks}.starts", f"{leaks}.ends"), F.lit(0).cast("long"),
                       lambda top, run: F.greatest(top, run["ends"] - run["starts"]))
    kept = found.filter((most <= longest) & (hit <= coverage * F.col(f"{leaks}.n_words")))
    text = F.when(hit > 0, cut_words(F.col("text"), F.col(f"{leaks}.starts"), F.col(f"{leaks}.ends"))).otherwise(F.col("text"))
    return kept.withColumn("text", text).select(*docs.columns)


def judge_column(spark, automaton: ItemAutomaton, longest: int, coverage: float):
    """A function of a binary text column: whether the document stays, and its text without hit runs (null: unchanged).

    It counts as not deterministic, so that a filter on its result doesn't scan the texts a second time.
    """
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(automaton))

    @F.pandas_udf("keep boolean, text string")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        items = pickle.loads(shared.value)
        for batch in texts:
            rows = []
            for text in batch:
                n, spans, _ = items.scan(text) if text is not None else (0, [], ())
                runs = [b - a for a, b in spans]
                keep = max(runs, default=0) <= longest and sum(runs) <= coverage * n
                rows.append((keep, without(text, *zip(*spans)) if keep and spans else None))
            yield pd.DataFrame(rows, columns=["keep", "text"])

    return judge.asNondeterministic()


def without(raw: bytes, starts, ends) -> str:
    """A text without runs of words, from the first byte of the first to the last of the last."""
    clean = np.frombuffer(b" " + raw.translate(WORD_TABLE) + b" ", np.uint8) != 32
    change = np.diff(clean.astype(np.int8))
    first, last = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    keep, at = [], 0
    for x, y in zip(starts, ends):
        keep.append(raw[at:first[x]])
        at = last[y - 1]
    return b"".join([*keep, raw[at:]]).decode()


@F.pandas_udf(T.StringType())
def cut_words(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    return pd.Series([text if text is None or not len(a) else without(text.encode(), a, b)
                      for text, a, b in zip(texts, starts, ends)], dtype=object)


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_at AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS run FROM item_at),
doc_at AS (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM wanted) AS lengths WHERE len(w) >= n),
met AS (
    SELECT d.r, d.i, d.n, item_id FROM doc_at AS d JOIN wanted ON d.n = wanted.n AND array_to_string(d.w[d.i:d.i + d.n - 1], ' ') = run),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM met) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
