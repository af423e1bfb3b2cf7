"""Exact k highest inner products by a Voronoi join.

Pivots part the vectors into cells. Summaries of the cells (their radii, the best scores that the pivots themselves give)
bound what each group of queries can find where: with ``s`` the k-th score that every query of the group is sure of, a
vector ``x`` in the cell of pivot ``p`` can matter only if ``max q.p + max |q| * |x - p| >= s``. Only such vectors meet the
group.

Groups that fit into a task's memory together make a set. A vector is sent once to each set that may need it, in a block
that goes to one of the set's parts; all groups of the set meet it there, each with a floor below which no score counts any
more. The k best of every part are merged. So shuffles grow with the vectors times the sets, not times the groups.

Scores are exact integers. Bounds are doubles and are widened by more than their rounding. In many dimensions without
clusters few vectors can be excluded; then the join is a blocked scan of the necessary pairs, and still exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import cut, pack, unpack

SCALE = 256
VECTORS_PER_PIVOT = 1_000
MOST_PIVOTS = 2_048  # they are fetched and broadcast; more vectors make larger cells
QUERIES_PER_GROUP = 2_048
SET_BYTES = 64_000_000  # of a set's queries as 32-bit floats, which a task holds
BLOCK_ROWS, BLOCK_BYTES = 8_192, 1_000_000
PART_VECTORS = 32_768
MOST_PARTS = 64  # each gets the set's queries and returns k rows a query; more vectors make larger parts and more sets
TILE = (1_024, 256)  # queries and vectors whose scores stay in a core's cache
SLACK = 1e-6
LEAST, MOST = -2 ** 63, 2 ** 63 - 1


def quantised(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and ints: floor(scale * x) of each component x as a double.

    Rows without an id, without a vector, or with a null or non-finite component take no part. Products beyond 64 bits
    saturate there.
    """
    x = F.col(column)
    # A null component makes forall null, so it is mapped to false before.
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    return vectors.filter(F.col(id_column).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("ints"))


def matrix(rows: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of 64-bit integers; shorter ones are filled up with zeros, which change no product."""
    sizes, flat = pc.list_value_length(rows).to_numpy(zero_copy_only=False), rows.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(rows), width)
    made = np.zeros((len(rows), width), np.int64)
    made[np.arange(width) < sizes[:, None]] = flat
    return made


def narrow(rows: np.ndarray) -> tuple[bytes, int]:
    """Integers in the fewest bytes that hold them all, packed, and the number of these bytes."""
    kind = next(kind for kind in ("i2", "i4", "i8") if rows.min(initial=0) >= np.iinfo(kind).min and rows.max(initial=0) <= np.iinfo(kind).max)
    return pack(rows.astype(kind).ravel()), int(kind[1])


def wide(block: bytes, size: int, rows: int, width: int) -> np.ndarray:
    """What ``narrow`` made, with columns of zeros up to the width."""
    found = unpack(block, f"i{size}")[0].reshape(rows, -1) if rows else np.zeros((0, width), np.int64)
    return found if found.shape[1] == width else np.pad(found, ((0, 0), (0, width - found.shape[1])))


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(float) ** 2).sum(axis=1))


def mixed(ids: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of ids, or of ids and vectors."""
    h = ids.astype(np.int64).view(np.uint64)
    if rows is not None:
        weights = np.random.default_rng(7).integers(0, 2 ** 64, rows.shape[1], np.uint64) | np.uint64(1)
        h = h * np.uint64(0x9E3779B97F4A7C15) + (rows.astype(np.int64).view(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(31))).view(np.int64)


#: Classes of norms. No sum of a product's terms exceeds the two norms' product, which tells the kind that is exact.
NORMS = np.array([2.0 ** 12, 2.0 ** 16, 2.0 ** 26, 2.0 ** 31])
NORMS_UP = [*NORMS.tolist(), np.inf]


def by_norm(rows: np.ndarray) -> np.ndarray:
    return np.argsort(np.searchsorted(NORMS, norms(rows)), kind="stable")


def exact_kind(top: float) -> type:
    """For whole numbers of ``top`` at most."""
    return np.float32 if top <= 2 ** 24 else np.float64 if top <= 2 ** 53 else np.int64 if top < 2 ** 63 else object


def products(a: np.ndarray, b: np.ndarray, room: dict[type, np.ndarray]) -> np.ndarray:
    """Exact inner products of rows of one kind. They last until the next call with the same room."""
    if a.dtype == object:
        return np.clip(a @ b.T, LEAST, MOST).astype(np.int64)
    kind = a.dtype.type
    if kind not in room:
        room[kind] = np.empty(TILE[0] * TILE[1], kind)
    return np.matmul(a, b.T, out=room[kind][:len(a) * len(b)].reshape(len(a), len(b)))


class Rows:
    """Vectors with ids, ordered by classes of norms, and their tiles in the kinds asked for."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, step: int):
        self.ids, self.rows, self.made = ids, rows, {}
        of = np.searchsorted(NORMS, norms(rows))
        ends = [*(np.flatnonzero(np.diff(of)) + 1).tolist(), len(ids)] if len(ids) else []
        self.tiles = [(i, min(i + step, end), NORMS_UP[of[i]]) for start, end in zip([0, *ends], ends) for i in range(start, end, step)]

    def tile(self, number: int, kind: type) -> np.ndarray:
        if (number, kind) not in self.made:
            start, end, _ = self.tiles[number]
            self.made[number, kind] = self.rows[start:end].astype(np.int64).astype(kind)  # objects are Python's integers
        return self.made[number, kind]


class Best:
    """The k best of each of n queries so far: higher scores first, ties to the smaller id."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.scores, self.ids, self.open = np.full((n, k), LEAST), np.full((n, k), MOST), np.ones((n, k), bool)
        #: No lower score counts any more, and of this score none with a larger id.
        self.floor, self.floor_id = np.full(n, LEAST) if floor is None else floor.copy(), np.full(n, MOST)

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        counts = (scores > self.floor[q]) | (scores == self.floor[q]) & (ids <= self.floor_id[q])
        q, scores, ids = q[counts], scores[counts], ids[counts]
        if not len(q):
            return
        own = np.unique(q)
        q = np.concatenate([q, np.repeat(own, self.k)])
        scores = np.concatenate([scores, self.scores[own].ravel()])
        ids = np.concatenate([ids, self.ids[own].ravel()])
        empty = np.concatenate([np.zeros(len(q) - len(own) * self.k, bool), self.open[own].ravel()])
        order = np.lexsort((ids, ~scores, empty, q))
        first = np.searchsorted(q[order], own)
        order = order[(first[:, None] + np.arange(self.k)).ravel()]
        for kept, new in ((self.scores, scores), (self.ids, ids), (self.open, empty)):
            kept[own] = new[order].reshape(-1, self.k)
        full = own[~self.open[own, -1]]
        self.floor[full], self.floor_id[full] = self.scores[full, -1], self.ids[full, -1]


class Group:
    """Queries of neighbouring cells, what they have found, and from which radius on a cell's vectors may matter to them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, floor: np.ndarray, reach: np.ndarray, k: int):
        self.queries, self.reach, self.best = Rows(ids, rows, TILE[0]), reach, Best(len(ids), k, floor)

    def meet(self, vectors: Rows, cell: np.ndarray, radius: np.ndarray, room: dict[type, np.ndarray]) -> None:
        need = radius >= self.reach[cell]
        if not need.all():
            if not need.any():
                return
            vectors = Rows(vectors.ids[need], vectors.rows[need], TILE[1])
        found, waiting = [], 0
        for i, (start, end, top) in enumerate(vectors.tiles):
            for j, (first, last, own) in enumerate(self.queries.tiles):
                kind = exact_kind(top * own)
                scores = products(self.queries.tile(j, kind), vectors.tile(i, kind), room)
                some = np.greater_equal(scores, self.best.floor[first:last, None].astype(scores.dtype),
                                        out=room[bool][:scores.size].reshape(scores.shape))
                at = np.flatnonzero(some.any(axis=1) if some.shape[1] % 8 else np.bitwise_or.reduce(some.view(np.uint64), axis=1))
                if len(at):
                    q, v = np.nonzero(some[at])
                    q = at[q]
                    score, q, v = scores[q, v].astype(np.int64), q + first, vectors.ids[start + v]
                    others = v != self.queries.ids[q]
                    found.append((q[others], score[others], v[others]))
                    waiting += len(q)
                if waiting > 100_000:
                    self.best.add(*map(np.concatenate, zip(*found)))
                    found, waiting = [], 0
        if found:
            self.best.add(*map(np.concatenate, zip(*found)))


class Pivots:
    """The pivots: every vector belongs to the cell of a near one."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.points = ids, points
        self.floats = points.astype(float)
        self.squares = (self.floats ** 2).sum(axis=1)
        self.top = float(np.abs(self.floats).max(initial=0))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A near cell of each row, and its distance from the cell's pivot, computed anew so that it is not a difference."""
        x = rows.astype(float)
        kind = np.float32 if max(self.top, float(np.abs(x).max(initial=0))) < 2 ** 30 else float
        points, half, near = self.floats.T.astype(kind), (self.squares / 2).astype(kind), x.astype(kind)
        cell = np.empty(len(x), np.int32)
        for i in range(0, len(x), 256):
            scores = near[i:i + 256] @ points
            scores -= half
            cell[i:i + 256] = scores.argmax(axis=1)
        return cell, np.sqrt(((x - self.floats[cell]) ** 2).sum(axis=1))


def group_queries(counts: np.ndarray, floats: np.ndarray, size: int) -> np.ndarray:
    """A group for each cell: neighbouring cells together, about ``size`` queries each."""
    groups, group, held = np.full(len(counts), -1), 0, 0
    left, at = set(range(len(counts))), 0
    while left:
        left.discard(at)
        groups[at] = group
        held += counts[at]
        if held >= size:
            group, held = group + 1, 0
        if left:
            rest = np.fromiter(left, int)
            at = int(rest[((floats[rest] - floats[at]) ** 2).sum(axis=1).argmin()])
    return groups


def undominated(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows without those that equal vectors of smaller ids keep out of every answer.

    Equal vectors have equal scores with any query, which takes the smallest ids but its own: of each id and vector k rows
    can count, and then 2 k rows of each vector.
    """
    h = mixed(np.zeros(len(ids), np.int64), rows)
    if len(np.unique(h)) == len(ids):
        return np.arange(len(ids))
    _, vector = np.unique(rows, axis=0, return_inverse=True)
    vector = vector.ravel()
    order = np.lexsort((ids, vector))

    def early(order: np.ndarray, most: int, *keys: np.ndarray) -> np.ndarray:
        new = np.ones(len(order), bool)
        new[1:] = np.any([key[order][1:] != key[order][:-1] for key in keys], axis=0)
        starts = np.flatnonzero(new)
        return order[np.arange(len(order)) - starts[np.cumsum(new) - 1] < most]

    return np.sort(early(early(order, k, vector, ids), 2 * k, vector))


def blocks_of(vectors: DataFrame) -> DataFrame:
    """vec_id and ints in written blocks: the number of rows, the longest vector's width, ids, and integers of ``size`` bytes."""
    schema = pa.schema([("rows", pa.int32()), ("width", pa.int32()), ("size", pa.int32()), ("ids", pa.binary()), ("ints", pa.binary())])

    def block(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.concat_arrays([batch.column(1) for batch in waiting])
        ids = np.concatenate([batch.column(0).to_numpy(zero_copy_only=False) for batch in waiting])
        width = pc.max(pc.list_value_length(rows)).as_py()
        ints, size = narrow(matrix(rows, width))
        return pa.RecordBatch.from_pylist([{"rows": len(ids), "width": width, "size": size, "ids": pack(ids), "ints": ints}], schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held, numbers = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            held, numbers = held + batch.num_rows, numbers + len(batch.column(1).flatten())
            if held >= BLOCK_ROWS or numbers * 2 >= BLOCK_BYTES:
                yield block(waiting)
                waiting, held, numbers = [], 0, 0
        if waiting:
            yield block(waiting)

    return cut(vectors.select("vec_id", "ints").mapInArrow(work, "rows int, width int, size int, ids binary, ints binary"), "vectors", packed=True)


def choose(blocks: DataFrame, wanted: int, n: int, width: int) -> Pivots:
    """The vectors of the least hashes, or nearly: each block offers somewhat more than its share."""

    def offer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.itertuples():
                ids = unpack(block.ids, "i8")[0]
                h = mixed(ids)
                at = np.lexsort((ids, h))[:int(np.ceil(1.2 * wanted * len(ids) / n)) + 1]
                rows = wide(block.ints, block.size, len(ids), width)[at].astype(np.int64)
                yield pd.DataFrame({"h": h[at], "vec_id": ids[at], "ints": [row.tobytes() for row in rows]})

    chosen = blocks.mapInPandas(offer, "h long, vec_id long, ints binary").orderBy("h", "vec_id", "ints").limit(wanted).toPandas()
    if not len(chosen):
        return Pivots(np.array([-1]), np.zeros((1, width), np.int64))
    return Pivots(chosen["vec_id"].to_numpy(np.int64), np.frombuffer(b"".join(map(bytes, chosen["ints"])), np.int64).reshape(-1, width))


def top_k(queries: DataFrame, data: DataFrame, k: int, parts: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with rows of another id.

    Both tables have vec_id and ints. Ties go to the smaller id; a query with fewer than k others gets all. Rows of the
    query's own id are no candidates; a repeated query counts once, repeated candidates as often as they occur. Empty
    tables give an empty table.
    """
    spark = data.sparkSession
    blocks, queries = blocks_of(data), cut(queries.dropDuplicates(["vec_id", "ints"]), "queries")
    facts = blocks.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.coalesce(F.max("width"), F.lit(0)).alias("width")).first()
    width = max(facts["width"], queries.agg(F.coalesce(F.max(F.size("ints")), F.lit(0)).alias("w")).first()["w"], 1)
    wanted = int(np.clip(facts["n"] // VECTORS_PER_PIVOT, 1, MOST_PIVOTS))
    pivots = choose(blocks, wanted, max(facts["n"], 1), width)
    cells = len(pivots.ids)
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(pivots))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pickle.loads(shared.value)
        for batch in batches:
            rows, ids = matrix(batch.column(1), width), batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                pa.array(p.nearest(rows)[0]), pa.array(mixed(ids, rows)), pa.array(ids), pa.array([row.tobytes() for row in rows], pa.binary())],
                names=["cell", "mix", "vec_id", "ints"])

    placed = cut(queries.select("vec_id", "ints").mapInArrow(place, "cell int, mix long, vec_id long, ints binary"), "queries")
    counts = np.zeros(cells, int)
    for row in placed.groupBy("cell").count().collect():  # one row a pivot
        counts[row["cell"]] = row["count"]
    group_of = group_queries(counts, pivots.floats, QUERIES_PER_GROUP)
    # A cell of very many queries makes several groups.
    several = np.maximum(1, np.rint(np.bincount(group_of, counts) / QUERIES_PER_GROUP).astype(int))
    before, groups = np.cumsum(several) - several, int(several.sum())
    groups_of_set = max(1, SET_BYTES // (QUERIES_PER_GROUP * width * 4))
    sets = -(-groups // groups_of_set)
    deal = spark.createDataFrame([(c, int(before[g]), int(several[g])) for c, g in enumerate(group_of)], "cell int, before_ int, several int")

    def summary(batch: pd.DataFrame) -> pd.DataFrame:
        """A group's queries, their sure k-th scores, and the least radius that may matter in each cell."""
        p = pickle.loads(shared.value)
        rows = np.frombuffer(b"".join(map(bytes, batch["ints"])), np.int64).reshape(-1, width)
        order = by_norm(rows)
        rows, ids = rows[order], batch["vec_id"].to_numpy(np.int64)[order]
        x = rows.astype(float)
        scores, lengths = x @ p.floats.T, norms(rows)
        norm, most = lengths.max(), scores.max(axis=0)
        sure = np.full(len(ids), -np.inf)
        if cells >= k:
            sure = np.partition(np.where(ids[:, None] == p.ids, -np.inf, scores), cells - k, axis=1)[:, cells - k]
            sure = np.minimum(sure - SLACK * (1 + np.abs(sure)) - 1e-9 * lengths * np.sqrt(p.squares.max()), np.nextafter(2.0 ** 63, 0))
            sure[sure <= LEAST] = -np.inf  # there scores saturate
        least, reach = sure.min(), np.full(cells, -np.inf)
        if norm > 0 and np.isfinite(least):
            reach = (least - most) / norm
            reach -= SLACK * (1 + (abs(least) + np.abs(most)) / norm) + 1e-9 * np.sqrt(p.squares)
        floor = np.where(np.isfinite(sure), np.floor(np.where(np.isfinite(sure), sure, 0)), LEAST).astype(np.int64)
        ints, size = narrow(rows)
        return pd.DataFrame({"g": [int(batch["g"].iloc[0])], "size": [size], "ids": [pack(ids)], "ints": [ints], "of": [pack(floor)],
                             "radius": [reach.tobytes()]})

    summed = cut(placed.join(F.broadcast(deal), "cell")
                 .select((F.col("before_") + F.pmod("mix", "several")).cast("int").alias("g"), "vec_id", "ints")
                 .groupBy("g").applyInPandas(summary, "g int, size int, ids binary, ints binary, of binary, radius binary"),
                 "queries", packed=True).withColumn("set_", F.expr(f"g div {groups_of_set}").cast("int"))

    def least_radius(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"set_": [batch["set_"].iloc[0]], "radius": [np.min([np.frombuffer(r) for r in batch["radius"]], axis=0).tobytes()]})

    # One row a set.
    reaches = {r["set_"]: np.frombuffer(r["radius"]) for r in summed.select("set_", "radius").groupBy("set_").applyInPandas(
        least_radius, "set_ int, radius binary").collect()}
    bounds = spark.sparkContext.broadcast(cloudpickle.dumps((pivots, reaches)))
    pieces = parts or int(np.clip(facts["n"] // PART_VECTORS + 1, 1, MOST_PARTS))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of the vectors that a set may need, dealt to its parts in turn."""
        p, needed = pickle.loads(bounds.value)
        waiting, held = {s: [] for s in needed}, dict.fromkeys(needed, 0)
        full, turn = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (2 * width))), int(TaskContext.get().partitionId() * 0.6180339887 % 1 * pieces)

        def block(s: int) -> pd.DataFrame:
            nonlocal turn
            turn += 1
            ids, rows, cell, radius = map(np.concatenate, zip(*waiting[s]))
            at = undominated(ids, rows, k)
            at = at[by_norm(rows[at])]
            waiting[s], held[s] = [], 0
            ints, size = narrow(rows[at])
            return pd.DataFrame({"task": [s * pieces + turn % pieces], "kind": [1], "g": [-1], "size": [size], "ids": [pack(ids[at])], "ints": [ints],
                                 "of": [pack(cell[at])], "radius": [radius[at].tobytes()]})

        for batch in batches:
            for b in batch.itertuples():
                ids, rows = unpack(b.ids, "i8")[0], wide(b.ints, b.size, b.rows, width)
                cell, radius = p.nearest(rows)
                radius = radius * (1 + SLACK) + 1e-12 * norms(rows)
                for s, reach in needed.items():
                    at = np.flatnonzero(radius >= reach[cell])
                    for i in range(0, len(at), full):
                        some = at[i:i + full]
                        waiting[s].append((ids[some], rows[some], cell[some], radius[some]))
                        held[s] += len(some)
                        if held[s] >= full:
                            yield block(s)
        for s in needed:
            if held[s]:
                yield block(s)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A part's k best of each query: first come the groups of the set, then the blocks."""
        task, groups, room = -1, {}, {bool: np.empty(TILE[0] * TILE[1], bool)}

        def found() -> Iterator[pd.DataFrame]:
            for g, group in groups.items():
                best = group.best
                yield pd.DataFrame({"g": [g], "ids": [pack(group.queries.ids)],
                                    "found": [pack(best.scores.ravel(), best.ids.ravel(), best.open.astype(np.uint8).ravel())]})

        for batch in batches:
            for row in batch.itertuples():
                if row.task != task:
                    yield from found()
                    task, groups = row.task, {}
                ids = unpack(row.ids, "i8")[0]
                rows = wide(row.ints, row.size, len(ids), width)
                if row.kind == 0:
                    groups[row.g] = Group(ids, rows, unpack(row.of, "i8")[0], np.frombuffer(row.radius), k)
                else:
                    vectors, cell, radius = Rows(ids, rows, TILE[1]), unpack(row.of, "i4")[0], np.frombuffer(row.radius)
                    for group in groups.values():
                        group.meet(vectors, cell, radius, room)
        yield from found()

    def merge(batch: pd.DataFrame) -> pd.DataFrame:
        ids = unpack(batch["ids"].iloc[0], "i8")[0]
        best, q = Best(len(ids), k), np.repeat(np.arange(len(ids)), k)
        for block in batch["found"]:
            scores, others, empty = unpack(block, "i8", "i8", "u1")
            at = empty == 0
            best.add(q[at], scores[at], others[at])
        at = np.flatnonzero(~best.open.ravel())
        return pd.DataFrame({"query_id": ids[q[at]], "rank": (at % k + 1).astype(np.int32), "vec_id": best.ids.ravel()[at],
                             "score": best.scores.ravel()[at]})

    columns = ["task", "kind", "g", "size", "ids", "ints", "of", "radius"]
    sent = blocks.mapInPandas(send, "task int, kind int, g int, size int, ids binary, ints binary, of binary, radius binary")
    asked = (summed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
             .select((F.col("set_") * pieces + F.col("part")).cast("int").alias("task"), F.lit(0).alias("kind"), *columns[2:]))
    local = (sent.select(columns).unionByName(asked).repartitionById(max(1, sets * pieces), "task")
             .sortWithinPartitions("task", "kind").mapInPandas(solve, "g int, ids binary, found binary"))
    return local.groupBy("g").applyInPandas(merge, "query_id long, rank int, vec_id long, score long")


def op3_neighbours(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    data = quantised(embeddings)
    return top_k(data.filter(F.col("vec_id") % every == 0), data, k)


ORACLE = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.e, d.e), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v AS q JOIN v AS d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
