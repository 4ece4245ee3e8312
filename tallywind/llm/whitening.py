"""Whitening of embeddings along their principal components.

Vectors become whole numbers x = floor(64 c) + 1,000,000. Their covariance is summed up
by the tasks (a small matrix each); its eigenvectors are found by spectral divide and
conquer: the polar factor of the shifted covariance, from dynamically weighted Halley
iterations (QDWH), gives the projector on the eigenvectors above the shift, whose range
and complement are split again until single components are left. The matrix that whitens
is sent to the tasks; its size follows from the number of dimensions, never of rows.

Nulls: a row whose vector is null, empty, or holds a null or non-finite entry takes no
part; a null id is an id. Rows of one id are rows of their own. Where vectors differ in
size only those of the commonest size take part (of several the larger). Components
without variance (equal vectors, fewer vectors than dimensions) can't be whitened and are
left out, so a table of equal vectors, or an empty one, has no result rows. Only the two
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallywind.llm.common import ready_for_python
from tallywind.llm.vectors import common_size, finite_vectors, matrix

#: Scale and offset of the whole numbers, and components returned.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32

_EPS = np.finfo(float).eps


# Eigenvectors by polar decompositions


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH: Halley iterations whose
    weights follow a lower bound of the smallest singular value, at most some eight of
    them; the first by QR, later, better conditioned ones by Cholesky."""
    size = len(a)
    eye = np.eye(size)
    x = a / np.linalg.norm(a)
    low = _EPS / size  # holds for any matrix that is not singular to double precision
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        w_a = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root))
        w_b = (w_a - 1) ** 2 / 4
        w_c = w_a + w_b - 1
        if w_c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(w_c) * x, eye]))
            step = (w_a - w_b / w_c) / np.sqrt(w_c) * (q[:size] @ q[size:].T)
        else:
            lower = np.linalg.cholesky(eye + w_c * (x.T @ x))
            half = np.linalg.solve(lower, x.T)
            step = (w_a - w_b / w_c) * np.linalg.solve(lower.T, half).T
        after = w_b / w_c * x + step
        after = (after + after.T) / 2
        low = min(1.0, low * (w_a + w_b * square) / (1 + w_c * square))
        moved = np.linalg.norm(after - x)
        x = after
        if abs(low - 1) < 10 * _EPS and moved < np.cbrt(10 * _EPS):
            break
    return x


def _range_of(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector and of its complement, from a QR
    decomposition of its largest columns, made exact by one step of subspace iteration."""
    left = projector.copy()
    chosen = []
    for _ in range(rank):  # columns as a pivoted QR takes them
        at = int(np.argmax(np.einsum("ij,ij->j", left, left)))
        chosen.append(at)
        column = left[:, at] / np.linalg.norm(left[:, at])
        left -= np.outer(column, column @ left)
    basis, _ = np.linalg.qr(projector[:, chosen])
    whole, _ = np.linalg.qr(np.hstack([projector @ basis, np.eye(len(projector))]))
    return whole[:, :rank], whole[:, rank:]


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift, or None if the matrix is
    a multiple of the identity to working precision."""
    size = len(a)
    level = np.trace(a) / size
    spread = np.linalg.norm(a - level * np.eye(size))
    if spread <= 4 * _EPS * size * abs(level):
        return None
    # The mean eigenvalue lies between the outermost two. Other shifts are tried where
    # it is an eigenvalue itself, since no projector comes of that.
    shifts = [np.median(np.diag(a)), level]
    shifts += [level + spread / size * t for t in (0.11, -0.13, 0.29, -0.31, 0.47, -0.53)]
    for shift in shifts:
        polar = polar_factor(a - shift * np.eye(size))
        projector = (np.eye(size) + polar) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < size:
            continue
        if np.linalg.norm(projector @ projector - projector) > 1e-10 * size:
            continue
        above, below = _range_of(projector, rank)
        if np.linalg.norm(above.T @ a @ below) <= 1e-11 * np.linalg.norm(a):
            return above, below
    return None


def eigenvectors(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues of a symmetric matrix, falling, and their unit
    eigenvectors as columns. Subspaces below the wanted ones are not split further."""
    a = (a + a.T) / 2
    size = len(a)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    stack = [np.eye(size)]
    while stack and len(values) < wanted:
        basis = stack.pop()
        inner = basis.T @ a @ basis
        parts = _split((inner + inner.T) / 2) if basis.shape[1] > 1 else None
        if parts is None:  # one component, or several of one eigenvalue
            values += list(np.diag(inner))
            vectors += list(basis.T)
        else:
            above, below = parts
            stack += [basis @ below, basis @ above]
    if not values:
        return np.zeros(0), np.zeros((size, 0))
    found = np.array(vectors).T
    # What rounding has left of the other components is taken out once.
    found, _ = np.linalg.qr(found)
    rest = found.T @ a @ found
    level = np.diag(rest).copy()
    gaps = level[None, :] - level[:, None]
    close = np.abs(gaps) <= 1e-9 * max(abs(level).max(), 1e-300)
    turn = np.where(close, 0.0, rest / np.where(close, 1.0, gaps))
    np.fill_diagonal(turn, 0.0)
    found, triangle = np.linalg.qr(found + found @ turn)
    found *= np.where(np.diag(triangle) < 0, -1, 1)
    level = np.einsum("ij,ij->j", found, a @ found)
    order = np.argsort(-level, kind="stable")[:wanted]
    return level[order], found[:, order]


# Sums over the rows


@dataclass(frozen=True)
class Fit:
    """What whitening needs to know of all vectors."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    total: float

    @property
    def matrix(self) -> np.ndarray:
        """Dimensions by components: centred vectors times this are whitened."""
        return self.vectors / np.sqrt(self.values)


def _whole_numbers(vectors: DataFrame, size: int) -> DataFrame:
    whole = F.transform("vec", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    return vectors.where(F.size("vec") == size).select("vec_id", whole.alias("x"))


_CELL = T.StructType(
    [
        T.StructField("i", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("v", T.DoubleType()),
    ]
)
_PLACE = T.StructType(
    [
        T.StructField("i", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("s", T.LongType()),
    ]
)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less its mean. Values are first taken less the mean's whole part, in whole
    numbers, so only a small rest is ever rounded."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def _second_moments(vectors: DataFrame, size: int, transform) -> np.ndarray:
    """The sum of y yT over all rows, y = transform(x): a matrix per task, summed up by
    place. Only the upper triangle is sent."""
    places = np.triu_indices(size)
    schema = to_arrow_schema(_CELL)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                y = transform(matrix(batch.column("x")))
                moments += y.T @ y
        columns = [places[0].astype("int32"), places[1].astype("int32"), moments[places]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    ready_for_python(vectors)
    cells = vectors.select("x").mapInArrow(per_task, _CELL)
    summed = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (summed.column(name).to_numpy() for name in "ijv")
    found = np.zeros((size, size))
    found[i, j] = found[j, i] = v
    return found


def _sums(numbers: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the sum of x per dimension; each task sends its own."""
    schema = to_arrow_schema(_PLACE)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(0, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                sums = matrix(batch.column("x")).sum(axis=0) + (sums if n else 0)
                n += batch.num_rows
        columns = [np.arange(len(sums), dtype="int32"), np.full(len(sums), n), sums]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    ready_for_python(numbers)
    places = numbers.select("x").mapInArrow(per_task, _PLACE).groupBy("i")
    found = sorted(places.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    return (found[0]["n"] if found else 0), [row["s"] for row in found]


def fit(numbers: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Sums, covariance and components of `x` (whole numbers); None without rows."""
    n, sums = _sums(numbers)
    if not n:
        return None
    size, totals = len(sums), np.array(sums, dtype=np.int64)
    covariance = _second_moments(numbers, size, lambda x: _centred(x, n, totals)) / n
    values, vectors = eigenvectors(covariance, min(components, size))
    total = float(np.trace(covariance))
    with_variance = values > 16 * size * _EPS * total
    return Fit(n, tuple(sums), values[with_variance], vectors[:, with_variance], total)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The sum of (n x - S)^2 over the dimensions, exact; an error beyond a long."""
    whole = sums // n
    off = (x - whole) * n - (sums - whole * n) if n < 2**31 else None
    if off is not None:
        most = int(np.abs(x - whole).max(initial=0)) * n + n
        if most * most * x.shape[1] < 2**63:
            return np.einsum("ij,ij->i", off, off)
    exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    return np.array(exact, dtype=np.int64)  # raises OverflowError


def whiten(
    df: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """Each vector that takes part, projected on the components and scaled to variance 1:
    `vec_id, component, n, deviation, whitened, explained, identity_error`, a row per
    component. `identity_error` is measured on the whitened rows themselves."""
    finite = finite_vectors(df, vec_id, embedding)
    numbers = _whole_numbers(finite, common_size(finite))
    schema = T.StructType(
        [
            finite.schema["vec_id"],
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    found = fit(numbers, components)
    if found is None or not len(found.values):
        return df.sparkSession.createDataFrame([], schema)
    session = df.sparkSession
    n, kept = found.n, len(found.values)
    sums, to_white = np.array(found.sums, dtype=np.int64), found.matrix
    explained = found.values / found.total
    whitening = session.sparkContext.broadcast((sums, to_white))

    def white(x: np.ndarray) -> np.ndarray:
        sums, to_white = whitening.value
        return _centred(x, n, sums) @ to_white

    covariance = _second_moments(numbers, kept, white) / n
    error = float(np.abs(covariance - np.eye(kept)).max())
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            count = len(x)
            every = np.repeat(np.arange(count), kept)
            columns = [
                batch.column("vec_id").take(pa.array(every)),
                pa.array(np.tile(np.arange(1, kept + 1, dtype="int32"), count)),
                pa.array(np.full(count * kept, n, dtype="int64")),
                pa.array(_deviations(x, n, whitening.value[0])[every]),
                pa.array(white(x).ravel()),
                pa.array(np.tile(explained, count)),
                pa.array(np.full(count * kept, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    ready_for_python(df)
    return numbers.mapInArrow(rows, schema)
