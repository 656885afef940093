"""Embedding whitening by spectral divide and conquer with QDWH polar decompositions.

Vectors become whole numbers, ``floor(scale * c)``. The mean and covariance are
taken over the distinct whole-number vectors (the fit list); the covariance is
split into its eigenvectors, and every vector is projected on the first ones
and divided by the square root of their eigenvalues.

The eigenvectors come from polar decompositions. The polar factor of the
symmetric matrix ``A - s I`` is its matrix sign, so ``(U + I) / 2`` projects on the
eigenvectors above ``s``. Its range and the rest of the space are invariant under
``A``; ``A`` restricted to each is split again until blocks of one row are left. The
polar factor itself is found by the dynamically weighted Halley iteration in
its QR form, which needs no inverse and takes at most about six rounds.

What Spark does: the fit list is a grouping of packed vectors (equal ones meet in
the map side's partial aggregation), sums and products are added up by index in
shuffles, and the whitening is one pass over the rows with ``components x
dimension`` numbers. The driver holds a few square matrices of the dimension, which
does not grow with the data.

Defined cases:

* Rows whose vector is null, empty, or holds null or non-finite entries are left out,
  and so are rows whose vectors have another length than the commonest one (the
  longer of equally common lengths) or an entry whose scaled value does not fit a long.
* Repeated rows and repeated or null ids: each row gives its own results; equal
  vectors count once in the fit list.
* Components without variance (an eigenvalue of at most ``1e-13`` of the trace)
  have no direction and are not returned: a table of equal vectors gives no rows,
  as does an empty one. Ties between eigenvalues: any orthonormal pair.
* ``deviation`` is exact; where it does not fit a long, it is null.
* Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.llm.common import settled

SCALE = 256.0
COMPONENTS = 4
_EPS = np.finfo(float).eps
_NO_VARIANCE = 1e-13
_LONG = 2.0**63
_ROWS = 4096  # vectors that are worked on at once


# ---- polar decomposition and the splitting, on one square matrix


def polar_factor(matrix: np.ndarray, rounds: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by the QR form of the weighted Halley iteration."""
    size = len(matrix)
    scale = np.linalg.norm(matrix, "fro")
    if scale == 0:
        return np.eye(size)
    x, low = matrix / scale, _EPS / 4  # a lower bound of the smallest singular value only costs rounds
    eye = np.eye(size)
    for _ in range(rounds):
        inner = np.cbrt(4 * (1 - low * low) / low**4)
        root = np.sqrt(1 + inner)
        a = root + 0.5 * np.sqrt(max(8 - 4 * inner + 8 * (2 - low * low) / (low * low * root), 0.0))
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        after = (b / c) * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        after = (after + after.T) / 2
        low = min(low * (a + b * low * low) / (1 + c * low * low), 1.0)
        moved = np.linalg.norm(after - x, "fro")
        x = after
        if moved <= 4 * np.sqrt(size) * _EPS ** (1 / 3) and abs(1 - low) < 1e-8:
            break
    return x


def _split(matrix: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the eigenvectors above some shift, and their number.

    None where the matrix is a multiple of the identity up to rounding.
    """
    size = len(matrix)
    eye = np.eye(size)
    norm = np.linalg.norm(matrix, "fro")
    middle = np.trace(matrix) / size
    if np.linalg.norm(matrix - middle * eye, "fro") <= 8 * _EPS * norm:
        return None
    # The mean of the eigenvalues has some on either side; the median splits more evenly where it does.
    for shift in (float(np.median(np.diag(matrix))), middle, middle * (1 + 1e-10) + 1e-3 * _EPS * norm):
        factor = polar_factor(matrix - shift * eye)
        if np.linalg.norm(factor @ factor - eye, "fro") > 1e-8 * size:
            continue  # the shift is an eigenvalue
        above = int(round((np.trace(factor) + size) / 2))
        if not 0 < above < size:
            continue
        projector = (factor + eye) / 2
        # Its range, from the columns with most in them, projected once more to clean it; the rest is the complement.
        span, _ = np.linalg.qr(projector[:, _pivots(projector, above)])
        return np.linalg.qr(projector @ span, mode="complete")[0], above
    return None


def _pivots(matrix: np.ndarray, count: int) -> list[int]:
    """Columns for a basis of the matrix's range: each the one with most left after those before it."""
    rest = matrix.copy()
    chosen = []
    for _ in range(count):
        sizes = np.einsum("ij,ij->j", rest, rest)
        sizes[chosen] = -1
        best = int(np.argmax(sizes))
        chosen.append(best)
        unit = rest[:, best] / max(np.linalg.norm(rest[:, best]), 1e-300)
        rest -= np.outer(unit, unit @ rest)
    return chosen


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    matrix = (matrix + matrix.T) / 2
    found: list[tuple[float, np.ndarray]] = []
    todo = [(matrix, np.eye(len(matrix)))]
    while todo:
        block, basis = todo.pop()
        split = _split(block) if len(block) > 1 else None
        if split is None:
            found += [(0.0, basis[:, i]) for i in range(basis.shape[1])]
            continue
        turn, above = split
        for part in (turn[:, :above], turn[:, above:]):
            inner = part.T @ block @ part
            todo.append(((inner + inner.T) / 2, basis @ part))
    vectors, _ = np.linalg.qr(np.column_stack([v for _, v in found]))
    values = np.einsum("ij,ik,kj->j", vectors, matrix, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---- the passes over the rows


@dataclass(frozen=True)
class Whitening:
    """The fit: how many distinct vectors, their sums, the eigenpairs kept, and what the check found."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    largest: int


def packed(vectors: pa.Array, scale: float) -> pa.Array:
    """Each row's whole numbers as bytes: the width of an entry, then the entries; equal vectors give equal bytes."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(pc.list_value_length(vectors).to_numpy(zero_copy_only=False)) if len(vectors) else []
    out, low = [], 0
    for high in ends:
        x = np.floor(scale * values[low:high])
        low = high
        if not np.all(np.abs(x) < _LONG):
            out.append(None)
            continue
        x = x.astype(np.int64)
        most = max(int(x.max()), -int(x.min()) - 1)
        kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        out.append(bytes([int(kind[2])]) + x.astype(kind).tobytes())
    return pa.array(out, pa.binary())


def unpacked(column: pa.Array) -> Iterator[np.ndarray]:
    """Blocks of rows of whole numbers, in order; all rows have one length."""
    rows = column.to_pylist()
    for low in range(0, len(rows), _ROWS):
        part = rows[low : low + _ROWS]
        yield np.array([np.frombuffer(r, f"<i{r[0]}", offset=1) for r in part], dtype=np.int64)


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id_col, size, x``: the usable rows with their packed whole numbers."""
    entries = F.col("v")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    given = rows.select(F.col(id_col).alias(id_col), F.col(vector_col).cast("array<double>").alias("v"))
    given = given.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    schema = T.StructType([given.schema[id_col], T.StructField("size", T.IntegerType()), T.StructField("x", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(1)).cast(pa.int32())
            columns = [batch.column(0), sizes, packed(batch.column(1), scale)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return given.mapInArrow(run, schema).where("x IS NOT NULL")


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int], int]:
    """Number of vectors, exact sum of each entry, and the largest absolute entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, most = 0, [0] * size, 0
        for batch in batches:
            for x in unpacked(batch.column(0)):
                n += len(x)
                # Halves are added apart, so no sum of longs overflows.
                high, low = x >> 32, x & 0xFFFFFFFF
                sums = [s + (int(h) << 32) + int(w) for s, h, w in zip(sums, high.sum(0), low.sum(0))]
                most = max(most, int(x.max()), -int(x.min()))
        entries = [str(v) for v in [*sums, n]]
        columns = [pa.array(range(size + 1), pa.int32()), pa.array(entries), pa.array([str(most)] * (size + 1))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "exact", "most"])

    parts = fit.select("x").mapInArrow(run, "i int, exact string, most string")
    total = parts.groupBy("i").agg(
        F.sum(F.col("exact").cast("decimal(38,0)")).alias("total"), F.max(F.col("most").cast("decimal(38,0)")).alias("most")
    )
    rows = {r["i"]: r for r in total.collect()}  # one row per dimension
    return int(rows[size]["total"]), [int(rows[i]["total"]) for i in range(size)], int(rows[size]["most"])


def _products(fit: DataFrame, mean: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Sum over the fit list of the products of centred (and projected) entries."""
    size = len(mean) if project is None else project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for x in unpacked(batch.column(0)):
                centred = x - mean
                if project is not None:
                    centred = centred @ project
                total += centred.T @ centred
        i, j = np.divmod(np.arange(size * size, dtype=np.int32), size)
        columns = [pa.array(i), pa.array(j), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "value"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, value double")
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("total")).toLocalIterator():  # a row per pair of dimensions
        out[r["i"], r["j"]] = r["total"]
    return out


def fit_whitening(fit: DataFrame, size: int, components: int) -> Whitening | None:
    """The fit over ``fit(x)``, distinct packed vectors of ``size`` entries; None where nothing varies."""
    n, sums, largest = _sums(fit, size)
    mean = np.array([s / n for s in sums])
    covariance = _products(fit, mean) / n
    trace = float(np.trace(covariance))
    if trace <= 0:
        return None
    values, vectors = eigenvectors(covariance)
    kept = [i for i in range(min(components, size)) if values[i] > _NO_VARIANCE * trace]
    values, vectors = values[kept], vectors[:, kept]
    whitened = _products(fit, mean, vectors / np.sqrt(values)) / n
    error = float(np.max(np.abs(whitened - np.eye(len(kept)))))
    return Whitening(n, tuple(sums), values, vectors, trace, error, largest)


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Exact sums over dimensions of ``(n x - S)^2``."""
    bound = max([model.n * model.largest + abs(s) for s in model.sums])
    if bound * bound * len(model.sums) < 2**63:
        gap = model.n * x - np.array(model.sums, dtype=np.int64)
        return np.einsum("ij,ij->i", gap, gap).tolist()
    exact = [sum((model.n * v - s) ** 2 for v, s in zip(row, model.sums)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


def whiten(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: float = SCALE,
) -> DataFrame:
    """One row per usable row and component: ``id_col, component, n, deviation, whitened, explained, identity_error``."""
    vectors = whole_vectors(rows, id_col, vector_col, scale)
    name = rows.select(id_col).schema[id_col]
    schema = T.StructType(
        [
            name,
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    spark = rows.sparkSession
    distinct = settled(vectors.groupBy("x").agg(F.count(F.lit(1)).alias("rows"), F.first("size").alias("size")), "whole-vectors")
    sizes = distinct.groupBy("size").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), F.desc("size")).first()
    model = None
    if sizes is not None:
        model = fit_whitening(distinct.where(F.col("size") == sizes["size"]), sizes["size"], components)
    if model is None:
        return spark.createDataFrame([], schema)
    mean = np.array([s / model.n for s in model.sums])
    project, shares, count = model.vectors / np.sqrt(model.values), model.values / model.trace, len(model.values)
    shared = spark.sparkContext.broadcast((model, mean, project, shares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, mean, project, shares = shared.value
        for batch in batches:
            low = 0
            for x in unpacked(batch.column(1)):
                many = len(x)
                taken = pa.array(np.repeat(np.arange(low, low + many), count))
                low += many
                gone = _deviations(x, model)
                columns = [
                    batch.column(0).take(taken),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * count, model.n)),
                    pa.array([d for d in gone for _ in range(count)], pa.int64()),
                    pa.array(((x - mean) @ project).ravel()),
                    pa.array(np.tile(shares, many)),
                    pa.array(np.full(many * count, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return vectors.where(F.col("size") == sizes["size"]).select(id_col, "x").mapInArrow(run, schema)
