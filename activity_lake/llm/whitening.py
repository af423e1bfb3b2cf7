"""Whitening of embeddings from exact cross-products by bit-sliced scatter.

Components become integers ``floor(scale * c) + offset``. A task takes its vectors in blocks. In a block every dimension is
shifted by its least value there, and each bit of the shifted numbers is packed across the block's rows into 64-bit words:
one bit plane per dimension and bit. The number of ones in the AND of two planes, times the weight of the two bits, is
their share of a cross-product, so the cross-products of a block are sums of weighted popcounts, and exact. Shifts are put
back exactly, and the blocks of a task are one matrix of whole numbers. Tasks send the upper triangle, which Spark sums.

The covariance is centred as integers: ``n * sum(x_i x_j) - S_i S_j``, divided by ``n * n`` only then. Its eigenvectors, a
matrix as wide as a vector, come from ``eigh`` on the driver; everything that grows with the rows stays in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import cut

SCALE, OFFSET = 1024, 100_000
BLOCK_ROWS = 4_096
COMPONENTS = 8
#: Beyond it a scaled component is no 64-bit number any more.
LARGEST = float(2 ** 51)
LIMB = 64


def integers(column: str, scale: int = SCALE, offset: int = OFFSET) -> Column:
    return F.transform(F.col(column), lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long"))


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector can be whitened, as they came.

    Vectors that are null or empty, or hold a null, non-finite or unrepresentably large component (2 ** 51), take no part.
    Of vectors of several lengths the most frequent length counts, of equally frequent ones the longer.
    """
    x = F.col(column)
    whole = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(LARGEST)), F.lit(False)))
    rows = vectors.filter(x.isNotNull() & (F.size(x) > 0) & whole)
    widths = rows.groupBy(F.size(x).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return rows.filter(F.size(x) == (widths["width"] if widths else 0))


def bit_planes(u: np.ndarray) -> np.ndarray:
    """The bits of non-negative numbers, rows packed into words: (dimensions * bits, words)."""
    rows, width = u.shape
    bits = max(int(u.max()).bit_length(), 1)
    padded = np.zeros((-(-rows // 64) * 64, width), np.int64)
    padded[:rows] = u
    planes = np.empty((width, bits, len(padded) // 64), np.uint64)
    for b in range(bits):
        ones = ((padded >> b) & 1).astype(np.uint8).T
        planes[:, b] = np.packbits(np.ascontiguousarray(ones), axis=1, bitorder="little").view(np.uint64)
    return planes.reshape(width * bits, -1)


def cross_products(u: np.ndarray) -> np.ndarray:
    """Exact sums of u_i * u_j over the rows, as whole numbers of any size."""
    width = u.shape[1]
    planes = bit_planes(u)
    bits = len(planes) // width
    ones = np.zeros((len(planes), len(planes)), np.int64)
    for p in range(len(planes)):
        ones[p, p:] = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
    ones = np.triu(ones) + np.triu(ones, 1).T
    wide = 2 * bits + len(u).bit_length() > 62
    weights = np.array([1 << b for b in range(bits)], object if wide else np.int64)
    by_bit = ones.reshape(width, bits, width, bits).astype(weights.dtype)
    return np.tensordot(weights, by_bit @ weights, axes=(0, 1)).astype(object)


class Scatter:
    """Number, sums and cross-products of the vectors seen so far."""

    def __init__(self, width: int):
        self.n, self.sums, self.products = 0, np.zeros(width, object), np.zeros((width, width), object)

    def add(self, x: np.ndarray) -> None:
        low = x.min(axis=0)
        u = x - low
        shift, parts = low.astype(object), np.array([sum(map(int, column)) for column in u.T], object)
        self.products += (cross_products(u) + np.outer(shift, parts) + np.outer(parts, shift)
                          + len(x) * np.outer(shift, shift))
        self.sums += parts + len(x) * shift
        self.n += len(x)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def scatter(x: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and cross-products of a table of integer vectors in a column ``x``: ``width`` squared numbers from each task.

    Sums travel as two numbers of at most 64 bits each plus a sign, which decimals add up exactly.
    """

    def limbs(i: int, j: int, value: int) -> tuple[int, int, Decimal, Decimal]:
        return i, j, Decimal(int(value) >> LIMB), Decimal(int(value) & (2 ** LIMB - 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, rows = Scatter(width), [], 0
        for batch in batches:
            waiting.append(matrix(batch.column(0), width))
            rows += batch.num_rows
            while rows >= BLOCK_ROWS:
                joined = np.concatenate(waiting)
                held.add(joined[:BLOCK_ROWS])
                waiting, rows = [joined[BLOCK_ROWS:]], rows - BLOCK_ROWS
        if rows:
            held.add(np.concatenate(waiting))
        if held.n:
            made = [limbs(-1, -1, held.n), *(limbs(i, -1, s) for i, s in enumerate(held.sums))]
            made += [limbs(i, j, held.products[i, j]) for i in range(width) for j in range(i, width)]
            kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.decimal128(20, 0))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["i", "j", "high", "low"])

    summed = (x.select("x").mapInArrow(work, "i int, j int, high decimal(38,0), low decimal(20,0)")
              .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    found = {(r["i"], r["j"]): (int(r["high"]) << LIMB) + int(r["low"]) for r in summed}
    cross = [[found.get((min(i, j), max(i, j)), 0) for j in range(width)] for i in range(width)]
    return found.get((-1, -1), 0), [found.get((i, -1), 0) for i in range(width)], cross


@dataclass
class Whitening:
    """Components in the order of falling eigenvalue; ``basis`` has one unit vector a column."""

    n: int
    sums: list[int]
    values: np.ndarray
    basis: np.ndarray
    explained: np.ndarray


def whitening(n: int, sums: list[int], cross: list[list[int]], components: int = COMPONENTS) -> Whitening:
    """Eigenvectors of the covariance (divisor n), as many as asked for.

    Components without variance can't be whitened and are left out: those at most the width times the double's precision of
    the largest. A single vector, or equal ones, have none.
    """
    width = len(sums)
    centred = [[(n * cross[i][j] - sums[i] * sums[j]) / (n * n) for j in range(width)] for i in range(width)]
    values, basis = np.linalg.eigh(np.array(centred, float).reshape(width, width))
    order = np.argsort(-values, kind="stable")
    floor = max(values.max(initial=0.0), 0.0) * width * np.finfo(float).eps
    kept = [k for k in order[:components] if values[k] > floor]
    # the larger half of each component decides its sign, so that reruns on other machines agree more often
    signs = np.array([1.0 if basis[np.abs(basis[:, k]).argmax(), k] > 0 else -1.0 for k in kept])
    trace = float(sum(centred[i][i] for i in range(width)))
    return Whitening(n, sums, values[kept], basis[:, kept] * signs, values[kept] / trace if trace else values[kept])


def whitened(rows: DataFrame, x: Column, model: Whitening) -> DataFrame:
    """Add whitened (array of doubles) and deviation (decimal, squared length of ``n * x - S``; null beyond 38 digits)."""
    n, sums, basis = model.n, model.sums, model.basis / np.sqrt(model.values)

    @F.pandas_udf("whitened array<double>, deviation decimal(38,0)")
    def project(vectors: pd.Series) -> pd.DataFrame:
        made, lengths = [], []
        for start in range(0, len(vectors), BLOCK_ROWS):
            block = np.stack(vectors.iloc[start:start + BLOCK_ROWS].to_numpy())
            farthest = n * max(abs(int(block.max())), abs(int(block.min()))) + max(map(abs, sums))
            exact = len(sums) * farthest ** 2 < 2 ** 63
            away = n * block.astype(np.int64 if exact else object) - np.array(sums, np.int64 if exact else object)
            lengths += [Decimal(int(s)) for s in (away * away).sum(axis=1)]
            made += list((away.astype(float) / n) @ basis)
        return pd.DataFrame({"whitened": made, "deviation": [s if s < 10 ** 38 else None for s in lengths]}, dtype=object)

    added = project(x)
    return rows.withColumn("whitened", added["whitened"]).withColumn("deviation", added["deviation"])


def identity_error(rows: DataFrame, components: int) -> float:
    """The largest difference between the covariance of ``whitened`` and the identity, centred before multiplying."""
    if not components:
        return 0.0
    w = [F.col("whitened")[k] for k in range(components)]
    means = rows.agg(*(F.avg(c).alias(f"m{k}") for k, c in enumerate(w))).first()
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = rows.agg(*(F.avg((w[i] - F.lit(means[i])) * (w[j] - F.lit(means[j]))) for i, j in pairs)).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs))


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """The usable rows and the whitening of all of them; None for a table without any."""
    rows = usable(vectors, column)
    first = rows.select(F.size(column).alias("width")).first()
    if first is None:
        return rows, None
    return rows, whitening(*scatter(rows.select(integers(column).alias("x")), first["width"]), components)


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The usable rows with all their columns, whitened and deviation, which replace columns of these names.

    Rows without an id, repeated rows and rows of one id count each by itself. No usable row: no rows.
    """
    rows, model = fit(vectors, column, components)
    if model is None:
        return rows.withColumn("whitened", F.lit(None).cast("array<double>")).withColumn("deviation", F.lit(None).cast("decimal(38,0)"))
    return whitened(rows, integers(column), model)


def op12_whitening(vectors: DataFrame) -> DataFrame:
    """A row for each usable vector and component; deviations beyond 64 bits are null."""
    lean = vectors.select("vec_id", "embedding")
    rows, model = fit(lean)
    if model is None:
        return rows.select(
            "vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")))
    made = cut(whitened(rows, integers("embedding"), model).select("vec_id", "whitened", "deviation"), "whitened")
    error = identity_error(made, len(model.values))
    shares = F.array(*map(F.lit, model.explained.tolist())).cast("array<double>")
    return (made.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "value"))
            .select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                    F.expr("try_cast(deviation as long)").alias("deviation"), F.col("value").alias("whitened"),
                    F.element_at(shares, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error")))
