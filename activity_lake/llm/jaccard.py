"""Set-similarity join of documents on word shingles, exact, with set-relation skipping.

Two sets link if their Jaccard similarity reaches a threshold. In a common order of all shingles, rare ones first, linked
sets share a shingle of their short prefixes (prefix filter). Around that:

* Equal sets are one set from the start.
* Index-level skipping: the list of a shingle holds its sets in blocks by position, ordered by size within a block. From a
  set's position and size follows the range of sizes that a partner in a block can have; a block without any is skipped,
  and so is a set without any block. Only sets with a possible partner go on, to the list's hub, its smallest set id.
* Answer-level skipping: at a hub the overlaps of one set with all others are its answer. The answer of a set ``x`` that is
  highly similar to an answered ``h`` is derived from it: the lists of ``x - h`` are added and those of ``h - x`` taken
  off, where these are shorter than the lists of ``x``. Answers also bound what others can share with anyone,
  ``|x & z| <= |h & z| + |x - h|``; where the bound fails no overlap is computed, and sets that are linked to each other
  by now need none either: the result is the connected components, which lose no link.

Hubs with very many sets are split into chunks. First each chunk meets the hub's own set: what is linked with it, directly
or through others of the chunk, is settled. Only the sets left open go on, in chunks, to every chunk of the hub, so the work
of a large group of near copies grows with its number, not with its square. The order of shingles comes from a count sketch over all documents,
of fixed size; it decides what is rare, not what is found.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import cut, pack, power_of_two, text_bytes, unpack, unpack_all, unused
from activity_lake.llm.hashing import Powers, Spans, mixed

PART_BYTES = 16 << 20
TOGETHER = 1 << 19  # bytes of documents looked at together
SENT_BYTES = 4 << 20  # compressed texts that are sent together
SENT_TOGETHER = 4_000  # documents whose prefix entries are packed together
SKETCH_BITS = 20  # counters of the sketch: 4 MB, whatever the corpus
SKETCH_SLICES = 16
CHUNK = 4_096  # sets of a hub in one task
WHOLE, FIRST = -1, -2  # meetings of all sets of a hub, and of a chunk with the hub's own set
POSITION_BLOCKS = 64
ANSWERS = 16  # computed answers that a task holds to derive others from
BROADCAST_ROWS = 200_000  # keys of repeated rows that are sent to all tasks; more are joined by shuffling
NO_ID = np.iinfo(np.int64).max

LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)], bool)
STEP = np.uint64(0x9E3779B97F4A7C15)


def together(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, offsets and bytes of some documents at a time."""
    keys, held, size, begin = batch["key"].to_numpy(np.int64), [], 0, 0
    for i, text in enumerate(batch["text"]):
        held.append(text if text is not None else b"")
        size += len(held[-1])
        if size >= TOGETHER or i == len(keys) - 1:
            yield keys[begin:i + 1], np.concatenate([[0], np.cumsum([len(x) for x in held])]), np.frombuffer(b"".join(held), np.uint8)
            held, size, begin = [], 0, i + 1


def shingle_sets(offsets: np.ndarray, block: np.ndarray, words: int, powers: Powers) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each document; of all its words if they are fewer than a shingle's."""
    n, docs = len(block), len(offsets) - 1
    space = SPACE[block]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[filled]] = True
    after[offsets[filled + 1] - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    word = np.empty(len(starts), np.uint64)
    for i, j in zip(cuts := np.searchsorted(starts, np.arange(0, n + TOGETHER, TOGETHER)), cuts[1:]):
        if i < j:
            piece = LOWER[block[starts[i]:ends[j - 1]]]
            word[i:j] = Spans(piece, powers).of(starts[i:j] - starts[i], ends[i:j] - starts[i])
    of = np.searchsorted(offsets, starts, "right") - 1
    count = np.bincount(of, minlength=docs) if len(of) else np.zeros(docs, np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    m = max(len(word) - words + 1, 0)
    run = np.zeros(m, np.uint64)
    for j in range(words):
        run = run * STEP + word[j:j + m]
    run = mixed(run)
    sets = []
    for d in range(docs):
        a, k = first[d], count[d]
        if k >= words:
            sets.append(np.unique(run[a:a + k - words + 1]))
        elif k:
            value = np.array([k], np.uint64) * STEP
            for w in word[a:a + k]:
                value = value * STEP + w
            sets.append(mixed(value ^ STEP))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def set_id(tokens: np.ndarray) -> int:
    """One number for a set, as a signed 64-bit integer."""
    total = mixed(tokens).sum(dtype=np.uint64, keepdims=True) + np.array([len(tokens)], np.uint64) * STEP
    return int(mixed(total).view(np.int64)[0])


class Threshold:
    """Jaccard similarity of at least ``percent`` / 100, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def prefix(self, size: int) -> int:
        return size - -(-self.percent * size // 100) + 1

    def overlap(self, a, b):
        """The least number of common elements of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))


def sketch(docs: DataFrame, words: int) -> np.ndarray:
    """Counts of shingles by a hash of SKETCH_BITS bits, over all documents."""
    slots, width = 1 << SKETCH_BITS, (1 << SKETCH_BITS) // SKETCH_SLICES

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers, total = Powers(), np.zeros(slots, np.int64)
        for batch in batches:
            for _, offsets, block in together(batch):
                sets = shingle_sets(offsets, block, words, powers)
                hashes = np.concatenate(sets) & np.uint64(slots - 1)
                total += np.bincount(hashes.astype(np.int64), minlength=slots)
        if total.any():
            yield pd.DataFrame([(i, pack(total[i * width:(i + 1) * width])) for i in range(SKETCH_SLICES)], columns=["slice", "block"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(unpack(block, "i8")[0] for block in rows["block"])
        return pd.DataFrame({"slice": rows["slice"].iloc[:1], "block": [pack(total)]})

    schema = "slice int, block binary"
    found = docs.mapInPandas(count, schema).groupBy("slice").applyInPandas(add, schema).toPandas()
    counts = np.zeros(slots, np.int64)
    for i, block in zip(found["slice"], found["block"]):
        counts[i * width:(i + 1) * width] = unpack(block, "i8")[0]
    return np.minimum(counts, 2 ** 32 - 1).astype(np.uint32)


ENTRY = ("u8", "i8", "u4", "u4")  # shingle, set, its size, the shingle's position in it
ROW = "kind string, part long, block binary, doc_id long, spare long, n long, set_id long"


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    bits = parts.bit_length() - 1
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def find_prefixes(parts: int, words: int, limit: Threshold, counts):
    """A row per document with its set's size and id, and packed prefix entries by shingle; equal sets of a batch send one."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers, order = Powers(), pickle.loads(counts.value)
        rows, seen, entries = [], set(), []

        def taken() -> pd.DataFrame:
            if entries:
                lengths = [len(p) for p, _, _ in entries]
                token = np.concatenate([p for p, _, _ in entries])
                sid = np.repeat(np.array([s for _, s, _ in entries], np.int64), lengths)
                size = np.repeat(np.array([n for _, _, n in entries], np.uint32), lengths)
                at = np.concatenate([np.arange(k, dtype=np.uint32) for k in lengths])
                by = np.argsort(token, kind="stable")
                columns = [c[by] for c in (token, sid, size, at)]
                part = part_of(columns[0], parts)
                for i, j in zip(edges := np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]), edges[1:]):
                    tokens, *rest = (c[i:j] for c in columns)
                    rows.append(("list", int(part[i]), pack(np.diff(tokens, prepend=np.uint64(0)), *rest), None, None, None, None))
            columns = zip(*rows) if rows else [()] * 7
            kinds = (object, "int64", object, "Int64", "Int64", "Int64", "Int64")  # Int64: with nulls, not by way of doubles
            made = pd.DataFrame({c.split()[0]: pd.Series(x, dtype=k) for c, x, k in zip(ROW.split(", "), columns, kinds)})
            for held in (rows, seen, entries):
                held.clear()
            return made

        for batch in batches:
            spares = iter(batch["spare"].tolist())
            for keys, offsets, block in together(batch):
                for key, tokens in zip(keys, shingle_sets(offsets, block, words, powers)):
                    size = len(tokens)
                    sid = set_id(tokens) if size else None
                    rows.append(("doc", 0, None, int(key), next(spares), size, sid))
                    if not size or sid in seen:
                        continue
                    seen.add(sid)
                    rank = order[(tokens & np.uint64(len(order) - 1)).astype(np.int64)]
                    prefix = tokens[np.argsort(rank, kind="stable")[:limit.prefix(size)]]
                    # Among equally rare ones small hashes are chosen; mixed again they fill all partitions alike.
                    entries.append((mixed(~prefix), sid, size))
            if len(rows) >= SENT_TOGETHER:
                yield taken()
        yield taken()

    return find


def with_partner(size: np.ndarray, at: np.ndarray, limit: Threshold) -> np.ndarray:
    """Which entries of one shingle's list can have a partner in it.

    For sets of sizes a and b with the shingle at i and j, the overlap is at most min(a - i, b - j), if it is their first
    common one; linked sets pass this test in at least the list of their first common shingle.
    """
    t = limit.percent
    size, at = size.astype(np.int64), at.astype(np.int64)
    left = size - at
    # of a partner's size b: t(a + b) <= (100 + t)(a - i), and t * max <= 100 * min
    most = np.minimum(((100 + t) * left - t * size) // t, 100 * size // t)
    least = -(-t * size // 100)
    found = np.zeros(len(size), np.int64)
    positions = np.unique(at)
    for block in np.array_split(positions, min(len(positions), POSITION_BLOCKS)):
        inside = (at >= block[0]) & (at <= block[-1])
        sizes = np.sort(size[inside])
        # of the block's nearest position j: t(a + b) <= (100 + t)(b - j)
        low = np.maximum(least, -(-(t * size + (100 + t) * block[0]) // 100))
        a, b = np.searchsorted(sizes, low, "left"), np.searchsorted(sizes, most, "right")
        itself = inside & (low <= size) & (size <= most)
        found += np.maximum(b - a, 0) - itself
    return found > 0


def members(limit: Threshold) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One partition of the index: hub and set for every list that has possible pairs."""

    def read(rows: pd.DataFrame) -> pd.DataFrame:
        blocks = [unpack(block, *ENTRY) for block in rows["block"]]
        for columns in blocks:
            columns[0] = np.cumsum(columns[0], dtype=np.uint64)
        token, sid, size, at = (np.concatenate(x) for x in zip(*blocks))
        by = np.lexsort((sid, token))
        token, sid, size, at = token[by], sid[by], size[by], at[by]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
        token, sid, size, at = token[new], sid[new], size[new], at[new]
        edge = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])
        length = np.diff(edge)
        hubs, sets = [], []
        pairs = edge[:-1][length == 2]  # most lists: one comparison each
        if len(pairs):
            s = [size[pairs + k].astype(np.int64) for k in (0, 1)]
            left = np.minimum(*(s[k] - at[pairs + k] for k in (0, 1)))
            t = limit.percent
            good = (limit.overlap(s[0], s[1]) <= left) & (t * np.maximum(*s) <= 100 * np.minimum(*s))
            hub = np.minimum(sid[pairs], sid[pairs + 1])[good]
            hubs += [hub, hub]
            sets += [sid[pairs][good], sid[pairs + 1][good]]
        for i, n in zip(edge[:-1][length > 2], length[length > 2]):
            own = sid[i:i + n][with_partner(size[i:i + n], at[i:i + n], limit)]
            if len(own) > 1:
                hubs.append(np.full(len(own), own.min()))
                sets.append(own)
        found = pd.DataFrame({"hub": np.concatenate(hubs), "set_id": np.concatenate(sets)}) if hubs else pd.DataFrame(
            {"hub": np.empty(0, np.int64), "set_id": np.empty(0, np.int64)})
        return found.drop_duplicates()

    return read


class Sets:
    """Some sets with an inverted index over the shingles that at least two of them hold."""

    def __init__(self, tokens: list[np.ndarray]):
        self.size = np.array([len(x) for x in tokens], np.int64)
        owner = np.repeat(np.arange(len(tokens)), self.size)
        _, inverse, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        shared = count[inverse] > 1
        owner, inverse = owner[shared], inverse[shared]
        by = np.argsort(inverse, kind="stable")
        self.lists = owner[by].astype(np.int32)
        self.begin = np.searchsorted(inverse[by], np.arange(len(count)))
        self.end = np.searchsorted(inverse[by], np.arange(len(count)), "right")
        self.held = inverse
        self.first = np.searchsorted(owner, np.arange(len(tokens) + 1))

    def shared(self, x: int) -> np.ndarray:
        """The shingles of a set that others hold too, in order."""
        return self.held[self.first[x]:self.first[x + 1]]

    def work(self, shingles: np.ndarray) -> int:
        return int((self.end[shingles] - self.begin[shingles]).sum())

    def count(self, shingles: np.ndarray) -> np.ndarray:
        """How many of them each set holds."""
        lists = [self.lists[a:b] for a, b in zip(self.begin[shingles], self.end[shingles])]
        return np.bincount(np.concatenate(lists), minlength=len(self.size)) if lists else np.zeros(len(self.size), np.int64)

    def derived(self, x: int, h: int, common: np.ndarray) -> np.ndarray | None:
        """The answer of x from that of h, or nothing if its own lists are less work."""
        own, other = self.shared(x), self.shared(h)
        more, less = np.setdiff1d(own, other, assume_unique=True), np.setdiff1d(other, own, assume_unique=True)
        if self.work(more) + self.work(less) >= self.work(own):
            return None
        return common + self.count(more) - self.count(less)


def components(tokens: list[np.ndarray], limit: Threshold) -> np.ndarray:
    """For each set the smallest place of a set that it is linked with, directly or through others."""
    n = len(tokens)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sets = Sets(tokens)
    size, answered = sets.size, np.zeros(n, bool)
    computed: dict[int, np.ndarray] = {}  # answers by set, the newest last

    def answer(x: int) -> np.ndarray:
        """Find the overlaps of a set with all others, from a similar set's if there is one, and join it with its partners."""
        h = max(computed, key=lambda y: computed[y][x] / (size[y] + size[x] - computed[y][x]), default=None)
        common = None if h is None else sets.derived(x, h, computed[h])
        if common is None:
            common = computed[x] = sets.count(sets.shared(x))
            if len(computed) > ANSWERS:
                del computed[next(iter(computed))]
        for z in np.flatnonzero(common >= limit.overlap(size[x], size)).tolist():
            a, b = root(x), root(z)
            parent[max(a, b)] = min(a, b)
        answered[x] = True
        return common

    # Some sets answer first. Members of the largest component so far need no answer of their own: among themselves they are
    # joined, and every other set answers.
    by_size = np.argsort(size, kind="stable")
    hubs = sorted({int(by_size[n * k // 4]) for k in range(4)})
    answers = [(common := answer(h), size - common) for h in hubs]
    main = max(hubs, key=lambda h: sum(root(i) == root(h) for i in range(n)))
    for x in range(n):
        if answered[x] or root(x) == root(main):
            continue
        bound = np.minimum(size, size[x])
        for common, beyond in answers:
            bound = np.minimum(bound, np.minimum(common + beyond[x], common[x] + beyond))
        possible = (bound >= limit.overlap(size[x], size)) & ~answered
        possible[x] = False
        if possible.any():
            answer(x)
        answered[x] = True
    return np.array([root(i) for i in range(n)])


def solve(words: int, limit: Threshold) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The meetings of one partition: links from each set to the smallest one of its component, and the hub of a first meeting.

    A first meeting is a chunk of a large hub with the hub's own set; each set that it leaves open comes as a row with itself.
    """

    def read(rows: pd.DataFrame) -> pd.DataFrame:
        powers, unpress = Powers(), zstandard.ZstdDecompressor()
        sets: dict[int, np.ndarray] = {}
        texts = rows.drop_duplicates("set_id")
        batch = pd.DataFrame({"key": texts["set_id"].to_numpy(np.int64), "text": [unpress.decompress(x) for x in texts["text"]]})
        for keys, offsets, block in together(batch):
            sets.update(zip(keys.tolist(), shingle_sets(offsets, block, words, powers)))
        found: list[tuple[int | None, int, int]] = []
        for (hub, _, j), group in rows.groupby(["hub", "i", "j"], sort=False):
            ids = np.unique(group["set_id"].to_numpy(np.int64))
            if len(ids) < 2:
                continue
            root = components([sets[s] for s in ids.tolist()], limit)
            apart = root != np.arange(len(ids))
            found += [(None, a, b) for a, b in zip(ids[apart].tolist(), ids[root[apart]].tolist())]
            if j == FIRST:
                left = ids[root != root[np.searchsorted(ids, hub)]].tolist()
                found += [(hub, a, a) for a in left]
        columns = zip(*found) if found else [()] * 3
        kinds = ("Int64", "int64", "int64")  # Int64: with nulls, not by way of doubles
        return pd.DataFrame({c: pd.array(list(x), dtype=k) for c, x, k in zip(("hub", "a", "b"), columns, kinds)}).drop_duplicates()

    return read


def connected(links: DataFrame) -> DataFrame:
    """set_id, label: the smallest set id of each component of links (a, b), for sets that have a link.

    Large-star and small-star steps in turn: every step points sets at smaller ones of their component; when nothing changes,
    all point at its smallest. Each step is written, so a lost executor costs one step.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))).filter("a != b").distinct()
        edges = cut(small, "links")
        after = state(edges)
        if after == before:
            break
        before = after
    labels = edges.select(F.col("a").alias("set_id"), F.col("b").alias("label"))
    return labels.unionByName(edges.select(F.col("b").alias("set_id"), F.col("b").alias("label")).distinct())


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    component_id is the smallest doc_id that a document reaches by links of similarity ``percent`` / 100 or more, itself
    included. Texts without words, and null texts, have no shingles and no links. Rows with equal texts are linked, repeated
    rows as well; a null doc_id is never the smallest unless there is no other.
    """
    spark, limit = docs.sparkSession, Threshold(percent)
    parts = power_of_two(text_bytes(docs, "text"), part_bytes)
    text = F.col("text").cast("binary")
    # Texts without an id are told apart by a hash, so that they don't all meet where a text is looked up by its key.
    spare = F.when(F.col("doc_id").isNull(), F.shiftrightunsigned(F.xxhash64(text), 1)).otherwise(F.lit(0))
    lean = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), spare.cast("long").alias("spare"), text.alias("text"))
    counts = spark.sparkContext.broadcast(cloudpickle.dumps(sketch(lean, words)))
    first = cut(lean.mapInPandas(find_prefixes(parts, words, limit, counts), ROW), "prefixes", packed=True)
    rows = first.filter("kind = 'doc'").select("doc_id", "n", "set_id")
    # The least of both belong together: only rows without an id have another spare key than 0.
    sets = first.filter("kind = 'doc' and n > 0").groupBy("set_id").agg(F.min("doc_id").alias("key"), F.min("spare").alias("spare"))
    found = cut(first.filter("kind = 'list'").select("part", "block").groupBy("part").applyInPandas(
        members(limit), "hub long, set_id long").distinct(), "members")
    # Only hubs with more sets than a task takes are split.
    large = cut(found.groupBy("hub").agg(F.count("*").alias("n")).filter(F.col("n") > CHUNK).select(
        "hub", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "hubs")
    chunk = F.pmod(F.xxhash64("set_id"), F.col("chunks").cast("long")).cast("int")
    chunks = found.join(large, "hub", "left")
    whole = chunks.filter("chunks is null").select("set_id", "hub", F.lit(0).alias("i"), F.lit(WHOLE).alias("j"))
    split = chunks.filter("chunks is not null and set_id != hub").select("set_id", "hub", chunk.alias("i"), F.lit(FIRST).alias("j"))
    itself = large.select(F.col("hub").alias("set_id"), "hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("i"), F.lit(FIRST).alias("j"))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers, press, seen = Powers(), zstandard.ZstdCompressor(level=3), set()
        out, size = [], 0

        def taken() -> pd.DataFrame:
            made = pd.DataFrame(out, columns=["hub", "i", "j", "set_id", "text"]).astype(
                {"hub": "int64", "i": "int32", "j": "int32", "set_id": "int64"})
            out.clear()
            return made

        for batch in batches:
            at = 0
            for keys, offsets, block in together(batch):
                for k, tokens in enumerate(shingle_sets(offsets, block, words, powers)):
                    sid, places = int(batch["set_id"].iloc[at]), batch["at"].iloc[at]
                    at += 1
                    if not len(tokens) or sid in seen or set_id(tokens) != sid:  # a copy, or another text with this doc_id
                        continue
                    seen.add(sid)
                    text = press.compress(block[offsets[k]:offsets[k + 1]].tobytes())
                    for x in places:
                        out.append((x["hub"], x["i"], x["j"], sid, text))
                        size += len(text)
                        if size >= SENT_BYTES:
                            yield taken()
                            size = 0
        yield taken()

    def meet(met: DataFrame, purpose: str) -> DataFrame:
        wanted = met.groupBy("set_id").agg(F.collect_list(F.struct("hub", "i", "j")).alias("at")).join(sets, "set_id")
        sent = lean.join(wanted, ["key", "spare"]).select("key", "text", "set_id", "at").mapInPandas(
            spread, "hub long, i int, j int, set_id long, text binary")
        place = F.pmod(F.xxhash64("hub", "i", "j"), F.lit(2 * parts))
        return cut(sent.withColumn("part", place).groupBy("part").applyInPandas(solve(words, limit), "hub long, a long, b long"), purpose)

    links = meet(whole.unionByName(split).unionByName(itself), "linked")
    if not large.isEmpty():
        # What is linked with a hub's own set needs no other partner there: the open sets meet everything of the hub.
        left = cut(links.filter("hub is not null").select("hub", F.col("a").alias("set_id")).distinct(), "open")
        groups = left.groupBy("hub").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("groups")).join(large, "hub")
        group = F.pmod(F.xxhash64("set_id", F.lit(1)), F.col("groups").cast("long")).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        asked = left.join(groups, "hub").select("set_id", "hub", group.alias("j"), each("chunks").alias("i"))
        others = found.join(groups, "hub").select("set_id", "hub", chunk.alias("i"), each("groups").alias("j"))
        links = links.unionByName(meet(asked.unionByName(others).distinct(), "linked"))
    links = links.select("a", "b")
    labels = connected(links)
    labelled = sets.join(labels, "set_id", "left").select("set_id", "key", F.coalesce("label", "set_id").alias("label"))
    least = labelled.groupBy("label").agg(F.min("key").alias("component_id"))
    component = labelled.join(least, "label").select("set_id", "component_id")
    result = rows.join(component, "set_id", "left")
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return result.select(named("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, named("component_id")).otherwise(named("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Of each component one document, columns as they came: that with the smallest id, without one only if none has one.

    Rows are told apart by id and text together, so rows that share an id but not their text are documents of their own, and
    copies without ids are copies like others. Of rows equal in id and text one stays, the same in every run. Documents
    without words are linked with nothing: they stay, once for each id and text.
    """
    row = unused(docs, "row_")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull()))
    lean = keyed.select("doc_id", F.col(row).alias("row"))
    found = near_duplicates(keyed.select(F.col(row).alias("doc_id"), "text"), words, percent).select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    chosen = cut(lean.distinct().join(found.distinct(), "row").groupBy("component").agg(first.alias("x")).select(
        F.col("x.row").alias(row)), "kept")
    kept = keyed.join(chosen, row, "left_semi")
    repeated = lean.groupBy("row").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("row").alias(row))
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    # only rows that repeat are compared; their other columns decide by hash
    again = F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    single = kept.join(again, row, "left_anti").select(*docs.columns)
    one = kept.join(again, row, "left_semi").groupBy(row).agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias("x")).select("x.*")
    return single.unionByName(one)


def op10_components(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=3, percent=90)
