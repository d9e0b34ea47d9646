"""Embedding whitening by polarisation: covariances from variances alone.

Entries become long integers x = floor(1024 * entry) + 100000. For every dimension, and for the sum of every pair of
dimensions, the squared centred values (n * x - S)**2 are added up as whole numbers; since
var(a + b) = var(a) + var(b) + 2 cov(a, b), half the difference of the sums gives every covariance without rounding, and
only the d (d + 1) / 2 finished sums reach the driver, where the matrix is divided once and taken apart by ``eigh``.

1. A pass adds up n and S.
2. A pass adds up squares: in a task, 1024 vectors at a time, in two halves of 26 bits that 64-bit sums hold; larger
   numbers are added as Python's. Partial sums leave a task once, in digits of 30 bits.
3. A pass projects every vector, and is stored; the covariance of what it gave, for ``identity_error``, is measured on
   the stored rows.

Defined results: a vector that is null, or has an entry that is null or not finite, is left out; so is one whose number of
entries is not the one most vectors have (of equally frequent ones the largest). Entries beyond 2**61 / 1024 count as that.
A ``deviation`` beyond 64 bits is null. A component whose variance is below 1e-12 of the first one's is without
variance: ``whitened`` is null, and ``identity_error`` does not refer to it (null if it refers to none). Vectors of fewer
than ``components`` entries have as many components as entries. Equal rows and rows without id are rows of their own; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import stored, tidy

COMPONENTS = 8
SHIFT, SCALE = 100_000, 1024
DIGIT = 30
HALF = 26
ROWS = 1024
MOST = 1 << 61
NO_VARIANCE = 1e-12
_DIGITS = "cell int, place int, part long"


def vectors(column: pa.Array, size: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``size`` finite entries each (of any one size where None): their places, and their integers."""
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == size)
    flat = column.take(pa.array(rows)).flatten()
    entry = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(len(rows), size)
    finite = np.isfinite(entry).all(axis=1)
    scaled = np.floor(np.clip(entry[finite] * SCALE, -float(MOST), float(MOST)))
    return rows[finite], scaled.astype(np.int64) + SHIFT


def digits(sums: list[int]) -> pa.RecordBatch:
    """Whole numbers of any size as ``cell, place, part``: part * 2**(30 * place) added up is the cell's number."""
    cells, places, parts = [], [], []
    for cell, value in enumerate(sums):
        sign, left, place = (-1 if value < 0 else 1), abs(value), 0
        while left:
            cells.append(cell)
            places.append(place)
            parts.append(sign * (left & ((1 << DIGIT) - 1)))
            left, place = left >> DIGIT, place + 1
    return pa.RecordBatch.from_arrays(
        [pa.array(cells, pa.int32()), pa.array(places, pa.int32()), pa.array(parts, pa.int64())], names=["cell", "place", "part"]
    )


def added(parts: DataFrame, cells: int) -> list[int]:
    """The numbers whose digits ``parts`` holds: as many as the matrix has cells, times a few digits."""
    sums = [0] * cells
    for row in parts.groupBy("cell", "place").agg(F.sum("part").alias("part")).toArrow().to_pylist():
        sums[row["cell"]] += row["part"] << DIGIT * row["place"]
    return sums


def row_sums(x: np.ndarray) -> list[int]:
    """Sum of each column, in halves that cannot overflow."""
    high, low = x >> 32, x & 0xFFFFFFFF
    return [(int(h) << 32) + int(v) for h, v in zip(high.sum(axis=0), low.sum(axis=0), strict=True)]


def square_sums(x: np.ndarray, n: int, total: list[int]) -> list[int]:
    """Sums of (n * x - S)**2 over the rows, for every dimension and every sum of two, in the order of pairs i <= j."""
    d = x.shape[1]
    sums: list[int] = []
    spread = max(abs(n * int(f(x[:, i])) - total[i]) for i in range(d) for f in (np.min, np.max))
    if 2 * spread >= 1 << 2 * HALF:
        y = x.astype(object) * n - np.array(total, object)
        for i in range(d):
            for j in range(i, d):
                sums.append(int(((y[:, i] + y[:, j] if j > i else y[:, i]) ** 2).sum()))
        return sums
    # n * x - S fits, though n * x and S by themselves need not: 64-bit arithmetic is exact modulo 2**64
    with np.errstate(over="ignore"):
        wrapped = np.array([t & ((1 << 64) - 1) for t in total], np.uint64)
        y = (x.view(np.uint64) * np.uint64(n & ((1 << 64) - 1)) - wrapped).view(np.int64)
    for i in range(d):
        both = y[:, i:] + y[:, i : i + 1]
        both[:, 0] = y[:, i]
        high, low = both >> HALF, both & ((1 << HALF) - 1)
        products = [np.einsum("rc,rc->c", a, b) for a, b in ((high, high), (high, low), (low, low))]
        for hh, hl, ll in zip(*(p.tolist() for p in products), strict=True):
            sums.append((hh << 2 * HALF) + (hl << HALF + 1) + ll)
    return sums


def covariance(squares: list[int], d: int, n: int) -> np.ndarray:
    """Covariance matrix from the sums of squares: whole numbers until the one division."""
    cell = {(i, j): squares[k] for k, (i, j) in enumerate((i, j) for i in range(d) for j in range(i, d))}
    found = np.empty((d, d))
    for (i, j), both in cell.items():
        cross = both if i == j else both - cell[i, i] - cell[j, j]  # twice the covariance where i < j
        found[i, j] = found[j, i] = cross / (n**3 if i == j else 2 * n**3)
    return found


def whitened(docs: DataFrame, id_col="vec_id", vector_col="embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``; see the module."""
    spark = docs.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    given = docs.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sizes = given.where(F.col("vector").isNotNull() & finite).groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.where("size > 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return spark.createDataFrame([], schema)
    d, n = most["size"], most["n"]

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * d
        for batch in batches:
            _, x = vectors(batch["vector"], d)
            sums = [a + b for a, b in zip(sums, row_sums(x), strict=True)]
        yield digits(sums)

    total = added(given.select("vector").mapInArrow(add, _DIGITS), d)
    pairs = d * (d + 1) // 2

    @tidy
    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * pairs
        for batch in batches:
            _, x = vectors(batch["vector"], d)
            for at in range(0, len(x), ROWS):
                sums = [a + b for a, b in zip(sums, square_sums(x[at : at + ROWS], n, total), strict=True)]
        yield digits(sums)

    v = covariance(added(given.select("vector").mapInArrow(square, _DIGITS), pairs), d, n)
    value, vector = np.linalg.eigh(v)
    order = np.argsort(-value, kind="stable")[:components]
    e, axes = value[order], vector[:, order]
    usable = e > NO_VARIANCE * max(float(e[0]), 0.0)
    whole = float(np.trace(v))
    explained = e / whole if whole > 0 else np.zeros(len(e))
    scaling = np.where(usable, 1 / np.sqrt(np.where(usable, e, 1.0)), 0.0)
    centre = [divmod(t, n) for t in total]
    base = np.array([q for q, _ in centre], np.int64)
    rest = np.array([r / n for _, r in centre])

    @tidy
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = vectors(batch["vector"], d)
            if not len(rows):
                continue
            w = ((x - base).astype(np.float64) - rest) @ axes * scaling
            y = x.astype(object) * n - np.array(total, object)
            deviation = [int(s) if s < 1 << 63 else None for s in (y * y).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"].take(pa.array(rows)),
                    pa.array(deviation, pa.int64()),
                    pa.array(w.tolist(), pa.list_(pa.float64())),
                ],
                names=["vec_id", "deviation", "w"],
            )

    done = stored(given.mapInArrow(project, "vec_id long, deviation long, w array<double>"), "whitened")
    used = np.flatnonzero(usable).tolist()
    error = None
    if used:
        cells = [(i, j) for i in used for j in used if i <= j]
        found = done.agg(*(F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in cells)).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(found, cells, strict=True))
    per = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("component"),
                (F.col("w")[i] if usable[i] else F.lit(None).cast("double")).alias("whitened"),
                F.lit(float(explained[i])).alias("explained"),
            )
            for i in range(len(e))
        ]
    )
    return done.select(
        "vec_id", "deviation", F.lit(n).cast("long").alias("n"), F.lit(error).cast("double").alias("identity_error"), F.inline(per)
    ).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
