"""Embedding whitening from exact integer moments by a bit-sliced scatter.

A coordinate c becomes the integer x = floor(1024 c) + 100000. A task takes CHUNK vectors at a time, subtracts each dimension's
least x, and packs every bit of what is left into words of 64 rows: a bit plane. The cross-product of two dimensions is the
sum over pairs of their planes of 2^(a + b) times the bits that both planes have (AND, then popcount), exact whatever the
values. Chunks are moved back to the common offset in whole numbers, and three 40-bit limbs carry each sum through Spark's
own aggregation, so that no sum is ever rounded. On the driver there are as many numbers as pairs of dimensions, whatever the
number of rows: n * sum(x y) - sum(x) * sum(y) is the covariance times n^2, centred as a whole number before it is made a
double for eigh.

How it is spread out: one row a pair of dimensions from each task that reads the vectors, summed by Spark; then two passes
that need no shuffle, one for the covariance of what comes out and one for the rows. Nothing is written.

Defined results
* vectors that are null, or hold null or non-finite components, take no part; nor do vectors of another length than most have
  (the shorter of two lengths that are equally common), for which there is no covariance, nor ones with a coordinate whose x
  does not fit 62 bits. A null vec_id stays null. Rows that repeat an id, or are equal, each count.
* a deviation that does not fit a long is null. Components without variance (all of them, if there is one row or all are
  equal) have a null `whitened`; `explained` is null if nothing varies; identity_error is over the components with variance.
* fewer dimensions than components give as many components as dimensions; empty vectors and an empty table give no rows.
* other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
CHUNK = 16_384
LIMB = 40
FLAT = 1e-13  # eigenvalues below this share of the largest are zero but for rounding
LARGEST = float(1 << 62)


def fixed_point(v: np.ndarray) -> np.ndarray:
    """x without its offset, of a matrix of doubles."""
    return np.floor(v * SCALE).astype(np.int64)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, dimension, bit) of a matrix of non-negative integers: a row of 64-bit words for each bit of each column."""
    rows = -(-len(y) // 64) * 64
    dims, bits, planes = [], [], []
    for d in range(y.shape[1]):
        column = np.zeros(rows, np.uint64)
        column[: len(y)] = y[:, d].astype(np.uint64)
        for b in range(int(column.max()).bit_length()):
            dims.append(d)
            bits.append(b)
            planes.append(np.packbits(((column >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little").view("<u8"))
    return np.stack(planes) if planes else np.zeros((0, rows // 64), np.uint64), np.array(dims, np.int64), np.array(bits, np.int64)


def scatter(y: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Sums and cross-products (upper triangle) of the columns of a matrix of non-negative integers, as Python's integers."""
    d = y.shape[1]
    planes, dim, bit = bit_planes(y)
    sums, cross = [0] * d, [[0] * d for _ in range(d)]
    ones = np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
    for i, b, n in zip(dim.tolist(), bit.tolist(), ones.tolist(), strict=True):
        sums[i] += n << b
    start = np.searchsorted(dim, np.arange(d + 1))
    # Popcounts of a pair of dimensions are weighted in doubles where they are exact, else one by one.
    exact = 2 * (int(bit.max()) + 1 if len(bit) else 0) + len(y).bit_length() < 53
    weight = np.ldexp(1.0, bit.astype(np.int32)) if exact else None
    for i in range(d):
        mine = planes[start[i] : start[i + 1]]
        if not len(mine):
            continue
        rest = planes[start[i] :]
        both = np.stack([np.bitwise_count(p & rest).sum(axis=1, dtype=np.int64) for p in mine])  # bits of i by planes from i on
        if exact:
            per_plane = weight[start[i] : start[i + 1]] @ both.astype(np.float64) * weight[start[i] :]
            found = np.zeros(d)
            np.add.at(found, dim[start[i] :], per_plane)
            cross[i] = [int(x) for x in found]
        else:
            for a, row in enumerate(both.tolist()):
                for j, b, n in zip(dim[start[i] :].tolist(), bit[start[i] :].tolist(), row, strict=True):
                    cross[i][j] += n << (a + b)
    return sums, cross


def _rows(v: pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow column of lists as a matrix of doubles."""
    return np.asarray(v.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def _limbs(value: int) -> tuple[int, int, int]:
    low = (1 << LIMB) - 1
    return value & low, (value >> LIMB) & low, value >> (2 * LIMB)


def moments(vectors: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """n, sums and cross-products (upper triangle) of floor(1024 c), exact. `vectors` has a column v of doubles."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, [0] * width, [[0] * width for _ in range(width)]

        def add(z: np.ndarray) -> None:
            nonlocal n
            low = z.min(axis=0)
            s, c = scatter(z - low)
            low, k = low.tolist(), len(z)
            n += k
            for i in range(width):
                sums[i] += s[i] + k * low[i]
                for j in range(i, width):  # back from the chunk's own offset
                    cross[i][j] += c[i][j] + low[i] * s[j] + low[j] * s[i] + k * low[i] * low[j]

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(fixed_point(_rows(batch.column(0), width)))
            while sum(map(len, held)) >= CHUNK:
                z = np.concatenate(held)
                add(z[:CHUNK])
                held = [z[CHUNK:]]
        if sum(map(len, held)):
            add(np.concatenate(held))
        if n:
            cells = [(-1, -1, n)] + [(i, -1, s) for i, s in enumerate(sums)] + [(i, j, cross[i][j]) for i in range(width) for j in range(i, width)]
            i, j, value = zip(*cells, strict=True)
            limbs = np.array([_limbs(x) for x in value], np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(x) for x in limbs]], names=["i", "j", "l0", "l1", "l2"])

    parts = vectors.select("v").mapInArrow(measure, "i int, j int, l0 long, l1 long, l2 long")
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("l0", "l1", "l2")]).collect()  # one row a pair of dimensions
    value = {(r.i, r.j): r.l0 + (r.l1 << LIMB) + (r.l2 << 2 * LIMB) for r in total}
    cross = [[value.get((min(i, j), max(i, j)), 0) for j in range(width)] for i in range(width)]
    return value.get((-1, -1), 0), [value.get((i, -1), 0) for i in range(width)], cross


def principal(n: int, sums: list[int], cross: list[list[int]], components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(components as columns, eigenvalues, trace) of the covariance, by falling eigenvalue; each column's largest entry is positive."""
    d = len(sums)
    v = np.array([[(n * cross[i][j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)], np.float64).reshape(d, d)
    e, q = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")[:components]
    e, q = e[order], q[:, order]
    q = q * np.where(np.take_along_axis(q, np.abs(q).argmax(axis=0)[None], 0) < 0, -1.0, 1.0)
    e = np.where(e > FLAT * max(float(np.abs(v).max(initial=0.0)), 1e-300), e, 0.0)
    return q, e, float(np.trace(v))


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that take part, and their length (0 if there are none)."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * SCALE >= LARGEST)))
    most = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if most is None:
        return v, 0
    return v.where(F.size("v") == most["d"]), most["d"]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row a vector and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    v, width = usable(vectors)
    n, sums, cross = moments(v, width) if width else (0, [], [])
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    q, e, trace = principal(n, sums, cross, components)
    k = len(e)
    varied = int((e > 0).sum())
    turned = q[:, :varied] / np.sqrt(e[:varied])

    def numerators(z: np.ndarray) -> np.ndarray:
        """n * x - S of each coordinate: 64-bit integers where they fit, else Python's."""
        fits = n * int(np.abs(z).max(initial=0)) + max(abs(s) for s in sums) < 1 << 62
        return z * n - np.array(sums, np.int64) if fits else z.astype(object) * n - np.array(sums, object)

    def projected(t: np.ndarray) -> np.ndarray:
        return (t.astype(np.float64) / n) @ turned

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(varied), np.zeros((varied, varied))
        for batch in batches:
            w = projected(numerators(fixed_point(_rows(batch.column(0), width))))
            total += w.sum(axis=0)
            square += w.T @ w
        cells = [(i, j, square[i, j]) for i in range(varied) for j in range(i, varied)] + [(i, -1, total[i]) for i in range(varied)]
        i, j, value = zip(*cells, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(value, pa.float64())], names=["i", "j", "s"])

    error = None
    if varied:
        s = {(r.i, r.j): r.s / n for r in v.select("v").mapInArrow(spread, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
        error = max(abs(s[i, j] - s[i, -1] * s[j, -1] - (i == j)) for i in range(varied) for j in range(i, varied))
    explained = [float(x) / trace if trace > 0 else None for x in e]

    def deviations(t: np.ndarray) -> list[int | None]:
        most = int(np.abs(t).max(initial=0))
        if width * most * most < 1 << 63:
            t = t.astype(np.int64)
            return (t * t).sum(axis=1).tolist()
        exact = (sum(x * x for x in row) for row in t.tolist())
        return [x if x < 1 << 63 else None for x in exact]

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            t = numerators(fixed_point(_rows(batch.column(1), width)))
            w = np.full((rows, k), np.nan)
            w[:, :varied] = projected(t)
            at = np.repeat(np.arange(rows), k)
            flat = w.reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)),
                    pa.array(deviations(t), pa.int64()).take(pa.array(at)), pa.array(flat, mask=np.isnan(flat)), pa.array(explained * rows, pa.float64()),
                    pa.array([error] * (rows * k), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return v.mapInArrow(give, schema)


def op12_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
