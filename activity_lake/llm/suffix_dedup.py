"""Removal of repeated byte strings by buckets of the corpus' suffixes, in place of recursive bucket-pointer refinement.

Two suffixes matter to each other if their first ``LENGTH`` bytes agree. Suffixes are put into buckets, the buckets are
refined until that is decided, and a bucket that holds one document's suffixes is done and goes no further:

1. Initial buckets by a gram of GRAM bytes. Of the grams inside a string of LENGTH bytes the one with the least hash stands
   for it, so equal strings choose the same gram at the same place, and one suffix in 16 or so is an anchor. An anchor keeps
   a pointer to the run of strings it stands for, and the hash of the bytes they cover.
2. In a bucket whose anchors agree in that hash, the runs are equal byte for byte: all but those of the smallest document
   are repetitions. Buckets of one document need nothing. In a bucket with several hashes the first document of each goes on.
3. The strings of what is left are told apart by the bucket identifiers at two offsets, i and i + LENGTH / 2: a pair of
   25-gram buckets is a bucket of 50 bytes. The smallest document of each pair is its origin, all others repeat it.

Buckets are spread over partitions by their identifiers. Before anything is sent, a task settles what its own documents
decide: of equal runs only the first document's is sent, and of a bucket that is known to be mixed a single notice. So a
common passage, or a group of copies with a third of all documents, sends a row per batch at most. Rows travel as packed,
compressed arrays, texts as compressed blocks.

Documents compare by doc_id alone. A row is known by its doc_id and, where that is null or repeated, by a hash of its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import cut, pack, power_of_two, text_bytes, unpack, unpack_all
from activity_lake.llm.hashing import BYTE_CODES, Powers, Spans, grams, mixed, sliding_min

LENGTH = 50
GRAM = 20
#: Text in one partition of buckets or documents. Larger parts mean fewer, longer rows; a task holds one part.
PART_BYTES = 8 << 20
PIECE = 1 << 17  # windows hashed together; positions take 20 bits
TOGETHER = 1 << 20  # bytes of documents looked at together
SETTLED = 4 << 20  # bytes of documents whose anchors are settled together before anything is sent
NO_ID = np.iinfo(np.int64).max  # a null doc_id is larger than every other

#: A bucket is known by so many bits more than the corpus has (log2 of its bytes), and by as many of a second hash: chance
#: agreements of both stay below one in 10 ** 9 for any size.
SPARE_BITS, SECOND_BITS = 14, 48

ROW = "kind string, part long, block binary"
#: gram (as differences), run hash, document, key, start, further starts, notice
QUESTION = ("u8", "u8", "i8", "u8", "u4", "u1", "u1")
RUN = ("i8", "u8", "u4", "u1")  # document, key, start, further starts
STRING = ("u8", "u8", "i8", "u8", "u4")  # the two bucket identifiers, document, key, start
#: Repeated ids are marked in so many bits by their hashes, at most 8 MB. An id marked by chance only has longer rows.
ID_BITS = 26


def row(kind: str, part: int, block: bytes) -> dict:
    return {"kind": kind, "part": part, "block": block}


def frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "part", "block"]).astype({"part": "int64"})


@dataclass(frozen=True)
class Layout:
    """Partitions, a power of two, and the bits of a bucket identifier, whose first bits name the partition."""

    parts: int
    bits: int

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - self.bits)

    def of_bucket(self, buckets: np.ndarray) -> np.ndarray:
        return (buckets >> np.uint64(self.bits - self.parts.bit_length() + 1)).astype(np.int64)

    def of_document(self, docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
        return self.of_bucket(self.bucket(mixed(docs.view(np.uint64) ^ keys)))


@dataclass(frozen=True)
class RowKeys:
    """Keys that tell apart the rows of one id: 0 for an id of its own row, else the hash of the text."""

    marked: np.ndarray | None  # a bit for each hash of a repeated id, None if there are none

    def rows(self, batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Ids, keys, copies and texts of the rows, rows of the same id and key once."""
        ids, keys = self.of(batch)
        places: dict[tuple[int, int], list[int]] = {}
        for i, name in enumerate(zip(ids.tolist(), keys.tolist())):
            places.setdefault(name, []).append(i)
        at, texts = [p[0] for p in places.values()], batch["text"].tolist()
        copies = np.array([len(p) for p in places.values()], np.int64)
        return ids[at], keys[at], copies, [texts[i] if texts[i] is not None else b"" for i in at]

    def of(self, batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Ids and keys of all rows."""
        ids, at = batch["doc_id"].to_numpy(np.int64), batch["id_bit"].to_numpy(np.int64)
        shared = ids == NO_ID
        if self.marked is not None:
            shared = shared | (self.marked[at >> 3] >> (at & 7) & 1).astype(bool)
        return ids, np.where(shared, batch["text_hash"].to_numpy(np.int64), 0).view(np.uint64)


def repeated_ids(lean: DataFrame) -> RowKeys:
    at = F.col("id_bit") + 1  # positions count from one
    found = (lean.filter(F.col("doc_id") != NO_ID).groupBy("doc_id", "id_bit").count().filter("count > 1")
             .groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
             .collect())
    if not found:
        return RowKeys(None)
    marked = np.zeros(1 << ID_BITS - 3, np.uint8)
    for r in found:
        bits = np.frombuffer(r["bits"], np.uint8)
        marked[(r["bucket"] - 1) * len(bits):][:len(bits)] = bits
    return RowKeys(marked)


def second(keys: np.ndarray) -> np.ndarray:
    return keys & np.uint64((1 << SECOND_BITS) - 1)


def dealt(kind: str, parts: np.ndarray, arrays: tuple[np.ndarray, ...]) -> Iterator[dict]:
    """A row for each part that has entries; within a part the order stays."""
    order = np.argsort(parts, kind="stable")
    at = parts[order]
    cuts = np.flatnonzero(np.diff(at)) + 1
    for piece in np.split(order, cuts) if len(order) else ():
        block = [a[piece] for a in arrays]
        if kind in ("question", "string"):  # sorted by bucket: differences are short
            block[0] = np.diff(block[0], prepend=np.uint64(0))
        yield row(kind, int(parts[piece[0]]), pack(*block))


def runs_by_document(kind: str, docs: np.ndarray, keys: np.ndarray, starts: np.ndarray, more: np.ndarray,
                     layout: Layout) -> Iterator[dict]:
    order = np.lexsort((starts, keys, docs))
    docs, keys, starts, more = docs[order], keys[order], starts[order].astype(np.uint32), more[order].astype(np.uint8)
    if len(docs):  # equal rows say the same
        new = np.ones(len(docs), bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in (docs, keys, starts, more)], axis=0)
        docs, keys, starts, more = docs[new], keys[new], starts[new], more[new]
    yield from dealt(kind, layout.of_document(docs, keys), (docs, keys, starts, more))


def anchors(block: np.ndarray, of: np.ndarray, powers: Powers) -> Iterator[tuple[np.ndarray, ...]]:
    """first start, last start, gram, hash of the bytes covered, for runs of strings with a common anchor.

    ``of`` names the document of each byte; no string crosses documents.
    """
    width = LENGTH - GRAM + 1
    low = np.uint64((1 << 20) - 1)
    for a in range(0, len(block) - LENGTH + 1, PIECE):
        piece = block[a:a + PIECE + LENGTH - 1]
        n = len(piece) - LENGTH + 1
        spans = Spans(piece, powers)
        gram = mixed(grams(spans.codes, GRAM))
        least = sliding_min((gram & ~low) | np.arange(len(gram), dtype=np.uint64), width)
        at = (least & low).astype(np.int64)
        valid = of[a:a + n] == of[a + LENGTH - 1:a + LENGTH - 1 + n]
        same = valid[1:] & valid[:-1] & (at[1:] == at[:-1])
        first = np.flatnonzero(valid & np.concatenate([[True], ~same]))
        last = np.flatnonzero(valid & np.concatenate([~same, [True]]))
        place = at[first]
        shape = ((place - first) * 64 + (last - first)).astype(np.uint64)
        # Chosen for being small, the hashes are not uniform any more; mixed again they fill all partitions alike.
        yield first + a, last + a, mixed(~gram[place]), mixed(spans.of(first, last + LENGTH) ^ (shape << np.uint64(40)))


def firsts(keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by keys and document, the place in it where each entry's group starts, and its smallest document."""
    order = np.lexsort((docs, *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
    return order, start, docs[order][start] if len(order) else docs


def settle(gram: np.ndarray, run: np.ndarray, docs: np.ndarray, notice: np.ndarray | None = None):
    """Of anchors in any order: which are repetitions, which must go on as strings, which can't be decided here.

    Returns three index arrays and, for the second, the grams it holds. Notices say that a gram is mixed elsewhere; they
    themselves are in none of the arrays.
    """
    order, start, least = firsts([gram, run], docs)
    g, d = gram[order], docs[order]
    new_gram = np.ones(len(g), bool)
    new_gram[1:] = g[1:] != g[:-1]
    number = np.cumsum(new_gram) - 1
    groups = int(number[-1]) + 1 if len(g) else 0
    own = np.ones(len(g), bool) if notice is None else ~notice[order].astype(bool)
    told = np.zeros(groups, bool)
    told[number[~own]] = True
    new_run = np.arange(len(g)) == start
    kinds = np.bincount(number, new_run & own, groups)
    low, high = np.full(groups, NO_ID), np.full(groups, np.iinfo(np.int64).min)
    np.minimum.at(low, number[own], d[own])
    np.maximum.at(high, number[own], d[own])
    mixed_here = told | (kinds > 1) & (low < high)
    repeated = own & (d > least)
    go_on = own & ~repeated & mixed_here[number]
    rest = own & ~repeated & ~mixed_here[number]
    return order[repeated], order[go_on], order[rest], g[go_on]


def find_anchors(layout: Layout, row_keys: RowKeys):
    """Documents (id, bytes) to questions by gram, and runs that are settled or mixed already."""

    def settled(found: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
        gram, run, docs, keys, starts, more = (np.concatenate(x) for x in zip(*found))
        found.clear()
        order = np.argsort(gram, kind="stable")
        g = gram[order]
        edge = np.ones(len(g) + 1, bool)
        edge[1:-1] = g[1:] != g[:-1]
        single, shared = order[edge[1:] & edge[:-1]], order[~(edge[1:] & edge[:-1])]
        hit, go_on, rest, mixed_grams = settle(gram[shared], run[shared], docs[shared])
        asked, notices = np.concatenate([single, shared[rest]]), np.unique(mixed_grams)
        by_gram = np.argsort(np.concatenate([gram[asked], notices]), kind="stable")
        extend = lambda a, fill=0: np.concatenate([a[asked], np.full(len(notices), fill, a.dtype)])[by_gram]
        columns = (np.concatenate([gram[asked], notices])[by_gram], extend(run), extend(docs), extend(keys), extend(starts),
                   extend(more), extend(np.zeros(len(gram), np.uint8), 1))
        out = list(dealt("question", layout.of_bucket(columns[0]), columns))
        for kind, at in (("hit", shared[hit]), ("mixed", shared[go_on])):
            out += runs_by_document(kind, docs[at], keys[at], starts[at], more[at], layout)
        return frame(out)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        found: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for ids, keys, offsets, block in together(batch, row_keys):
                size += len(block)
                of = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(offsets))
                for first, last, gram, run in anchors(block, of, powers):
                    doc = of[first]
                    found.append((layout.bucket(gram), second(run), ids[doc], keys[doc],
                                  (first - offsets[doc]).astype(np.uint32), (last - first).astype(np.uint8)))
                if found and size >= SETTLED:
                    yield settled(found)
                    size = 0
        if found:
            yield settled(found)

    return find


def together(batch: pd.DataFrame, row_keys: RowKeys) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, keys, offsets and bytes of some documents at a time."""
    ids, keys, _, texts = row_keys.rows(batch)
    held, size, begin = [], 0, 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= TOGETHER or i == len(ids) - 1:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in held])])
            yield ids[begin:i + 1], keys[begin:i + 1], offsets, np.frombuffer(b"".join(held), np.uint8)
            held, size, begin = [], 0, i + 1


def refine(layout: Layout) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One partition's buckets of grams; runs that were settled before pass through."""

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[rows["kind"] != "question"].to_dict("records")
        blocks = rows.loc[rows["kind"] == "question", "block"].tolist()
        if blocks:
            gram, run, docs, keys, starts, more, notice = unpack_buckets(blocks, *QUESTION)
            hit, go_on, _, _ = settle(gram, run, docs, notice)
            out += runs_by_document("hit", docs[hit], keys[hit], starts[hit], more[hit], layout)
            out += runs_by_document("mixed", docs[go_on], keys[go_on], starts[go_on], more[go_on], layout)
        return frame(out)

    return reduce


def unpack_buckets(blocks: list[bytes], *kinds: str) -> list[np.ndarray]:
    parts = [unpack(block, *kinds) for block in blocks]
    for columns in parts:
        columns[0] = np.cumsum(columns[0], dtype=np.uint64)
    return [np.concatenate(x) for x in zip(*parts)]


def text_blocks(layout: Layout, row_keys: RowKeys):
    """Documents as compressed blocks by the partition of their id and key."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, keys, copies, texts = row_keys.rows(batch)
            part = layout.of_document(ids, keys)
            out = []
            for p in np.unique(part):
                at = np.flatnonzero(part == p)
                lengths = np.array([len(texts[i]) for i in at], np.int64)
                head = np.array([len(at)], np.int64).tobytes() + b"".join(x[at].tobytes() for x in (ids, keys, copies)) + lengths.tobytes()
                out.append(row("text", int(p), press.compress(head + b"".join(texts[i] for i in at))))
            yield frame(out)

    return deal


def read_texts(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, keys, copies, offsets and the bytes of all documents of the blocks."""
    ids, keys, copies, lengths, texts = [], [], [], [], []
    for block in blocks:
        raw = zstandard.ZstdDecompressor().decompress(block)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        ids.append(np.frombuffer(raw, np.int64, n, 8))
        keys.append(np.frombuffer(raw, np.uint64, n, 8 + 8 * n))
        copies.append(np.frombuffer(raw, np.int64, n, 8 + 16 * n))
        lengths.append(np.frombuffer(raw, np.int64, n, 8 + 24 * n))
        texts.append(raw[8 + 32 * n:])
    if not blocks:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(1, np.int64), np.empty(0, np.uint8)
    return (np.concatenate(ids), np.concatenate(keys), np.concatenate(copies), np.concatenate([[0], np.cumsum(np.concatenate(lengths))]),
            np.frombuffer(b"".join(texts), np.uint8))


def placed(ids: np.ndarray, id_keys: np.ndarray, docs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of ``docs`` and ``keys`` the places of its row among ``ids`` and ``id_keys``: pairs (entry, place).

    Rows with equal ids and keys have equal texts; all count.
    """
    names, asked = ids.view(np.uint64) ^ id_keys, docs.view(np.uint64) ^ keys
    order = np.argsort(names, kind="stable")
    left, right = np.searchsorted(names[order], asked, "left"), np.searchsorted(names[order], asked, "right")
    entry = np.repeat(np.arange(len(docs)), right - left)
    nth = np.arange(len(entry)) - np.repeat(np.cumsum(right - left) - (right - left), right - left)
    place = order[left[entry] + nth]
    same = (ids[place] == docs[entry]) & (id_keys[place] == keys[entry])
    return entry[same], place[same]


def expand(layout: Layout) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The strings of mixed runs with their two bucket identifiers, a document's own repetitions settled."""
    half = LENGTH // 2

    def strings(rows: pd.DataFrame) -> pd.DataFrame:
        blocks = rows.loc[rows["kind"] == "mixed", "block"].tolist()
        if not blocks:
            return frame([])
        docs, keys, starts, more = unpack_all(blocks, *RUN)
        ids, id_keys, _, offsets, text = read_texts(rows.loc[rows["kind"] == "text", "block"].tolist())
        entry, place = placed(ids, id_keys, docs, keys)
        _, one_place = np.unique(entry, return_index=True)  # of equal texts one is looked at
        entry, place = entry[one_place], place[one_place]
        begin = offsets[place] + starts[entry]
        length = more[entry].astype(np.int64) + 1
        at = np.repeat(begin, length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        doc, key = np.repeat(docs[entry], length), np.repeat(keys[entry], length)
        start = (at - np.repeat(begin - starts[entry], length)).astype(np.uint32)
        one, two = (np.empty(len(at), np.uint64) for _ in range(2))
        order = np.argsort(at, kind="stable")
        for a in range(0, len(text), TOGETHER):
            low, high = np.searchsorted(at[order], [a, a + TOGETHER])
            if low == high:
                continue
            some = order[low:high]
            bucket = mixed(grams(BYTE_CODES[text[a:a + TOGETHER + LENGTH]], half))
            one[some], two[some] = layout.bucket(bucket[at[some] - a]), second(bucket[at[some] - a + half])
        order, _, least = firsts([one, two], doc)
        repeated = doc[order] > least
        asked = order[~repeated]
        hit = order[repeated]
        out = list(dealt("string", layout.of_bucket(one[asked]), (one[asked], two[asked], doc[asked], key[asked], start[asked])))
        out += runs_by_document("hit", doc[hit], key[hit], start[hit], np.zeros(len(hit), np.uint8), layout)
        return frame(out)

    return strings


def decide(layout: Layout) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One partition's buckets of whole strings."""

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[rows["kind"] != "string"].to_dict("records")
        blocks = rows.loc[rows["kind"] == "string", "block"].tolist()
        if blocks:
            one, two, docs, keys, starts = unpack_buckets(blocks, *STRING)
            order, _, least = firsts([one, two], docs)
            hit = order[docs[order] > least]
            out += runs_by_document("hit", docs[hit], keys[hit], starts[hit], np.zeros(len(hit), np.uint8), layout)
        return frame(out)

    return reduce


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, copies long"


def remove(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of one partition without the bytes of their hit runs."""
    ids, id_keys, copies, offsets, text = read_texts(rows.loc[rows["kind"] == "text", "block"].tolist())
    docs, keys, starts, more = unpack_all(rows.loc[rows["kind"] == "hit", "block"].tolist(), *RUN)
    change = np.zeros(len(text) + 1, np.int32)
    entry, place = placed(ids, id_keys, docs, keys)
    begin = offsets[place] + starts[entry]
    np.add.at(change, begin, 1)
    np.add.at(change, begin + more[entry] + LENGTH, -1)
    gone = np.cumsum(change[:-1], dtype=np.int32) > 0
    out = []
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        own = gone[a:b]
        removed = int(own.sum())
        spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if removed else 0
        kept = text[a:b][~own].tobytes() if removed else text[a:b].tobytes()
        out.append((None if ids[i] == NO_ID else int(ids[i]), int(b - a), removed, spans, kept, int(copies[i])))
    named = pd.Series([x[0] for x in out], dtype="Int64")  # with nulls, not by way of doubles
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "copies"]).assign(doc_id=named)


def remove_repeats(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept: the texts as bytes, repetitions cut out.

    A byte goes if a string of LENGTH bytes that covers it also starts in a document with a smaller doc_id; strings are
    judged on the input. A null text is empty. A null doc_id is larger than all others. Rows with null or equal
    ids are no smaller than each other; each loses only what its own text shares with a smaller id.
    """
    lean = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("binary").alias("text"))
    lean = lean.withColumns({"id_bit": F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - ID_BITS), "text_hash": F.xxhash64("text")})
    row_keys = repeated_ids(lean)
    size = text_bytes(docs, "text")
    parts = power_of_two(size, part_bytes)
    layout = Layout(parts, min(64, size.bit_length() + SPARE_BITS))
    found = lean.mapInPandas(find_anchors(layout, row_keys), ROW)
    first = cut(found.groupBy("part").applyInPandas(refine(layout), ROW), "suffix-grams", packed=True)
    texts = lean.mapInPandas(text_blocks(layout, row_keys), ROW)
    asked = texts.unionByName(first.filter("kind = 'mixed'")).groupBy("part").applyInPandas(expand(layout), ROW)
    second = cut(asked.groupBy("part").applyInPandas(decide(layout), ROW), "suffix-strings", packed=True)
    hits = first.filter("kind = 'hit'").unionByName(second)
    made = texts.unionByName(hits).groupBy("part").applyInPandas(remove, RESULT)
    return made.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


def op9_repeats(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
