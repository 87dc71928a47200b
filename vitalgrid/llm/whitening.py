"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The rows are packed into blocks of whole numbers once. Every step then sends one
vector to the tasks, which multiply it with the centred rows (u = Xw) and the
result with the rows again (Xᵀu); the products are summed by place. Left vectors
are as long as the table and are never gathered: each is X times a short vector,
so its reorthogonalisation against all earlier ones needs only inner products of
short vectors. The singular values of the small bidiagonal matrix give the
deviations, its right vectors the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import stored, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 30)  # entries this large cannot be held exactly; their rows count as non-finite
BLOCK = 1 << 22  # bytes of numbers in a block
EPS = np.finfo(float).eps
CONVERGED = 8 * EPS  # residual over the largest singular value
NOTHING = 64 * EPS  # of the largest norm seen: a right vector this short is noise
NO_LEFT = 1e-6  # the same of a left vector, whose length comes from its square
OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def blocks(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """dim, ids, x, sums, squares, most: rows of one length, their whole numbers as bytes, sums by place, sum of squares, largest size.

    Rows are left out if the vector is null, empty, or holds a null, a non-finite
    entry or one of ``LARGEST`` or more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector, ids = batch.column(1), batch.column(0)
            lengths = vector.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = vector.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(lengths) - lengths
            for dim in np.unique(lengths[lengths > 0]):
                at = np.flatnonzero(lengths == dim)
                step = max(1, BLOCK // (8 * int(dim)))
                for part in (at[i : i + step] for i in range(0, len(at), step)):
                    c = flat[starts[part][:, None] + np.arange(dim)]
                    fits = (np.abs(c) < LARGEST).all(axis=1)  # false for NaN too
                    if fits.any():
                        x = np.floor(SCALE * c[fits]).astype(np.int64) + SHIFT
                        squares = sum(int(s) for s in (x.astype(object) ** 2).sum(axis=0)) if np.abs(x).max() >= 1 << 24 else int((x * x).sum())
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([int(dim)], pa.int32()),
                                pa.array([ids.take(pa.array(part[fits])).to_pylist()], pa.list_(pa.int64())),
                                pa.array([x.tobytes()], pa.binary()),
                                pa.array([x.sum(axis=0).tolist()], pa.list_(pa.int64())),
                                pa.array([str(squares)], pa.string()),
                                pa.array([int(np.abs(x).max())], pa.int64()),
                            ],
                            ["dim", "ids", "x", "sums", "squares", "most"],
                        )

    rows = vectors.select(F.col(id_column).cast("bigint"), F.col(column).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, "dim int, ids array<bigint>, x binary, sums array<bigint>, squares string, most bigint")


def summed(parts: DataFrame, length: int) -> np.ndarray:
    """The sum by place of arrays of doubles; one array leaves each task."""
    rows = parts.select(F.posexplode("part").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(length)
    for r in rows:
        out[r["at"]] = r["value"]
    return out


class Rows:
    """The fit list: packed blocks of one length, their number of rows, sums and total scatter."""

    def __init__(self, packed: DataFrame, dim: int):
        self.packed, self.dim = packed.filter(F.col("dim") == dim), dim
        by_place = self.packed.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        found = {r["at"]: int(r["value"]) for r in by_place.collect()}
        self.sums = [found[i] for i in range(dim)]
        count = self.packed.agg(F.sum(F.size("ids").cast("long")).alias("n"), F.sum(F.col("squares").cast("decimal(38,0)")).alias("squares"), F.max("most").alias("most")).first()
        self.n, self.most = count["n"], count["most"]
        # Sum over rows and places of (n x - S)^2, from whole numbers.
        self.scatter = self.n * (self.n * int(count["squares"]) - sum(s * s for s in self.sums))

    def trace(self) -> float:
        return self.scatter / self.n / self.n / self.n

    def centred(self) -> Callable[[bytes], np.ndarray]:
        """From the bytes of a block to x - S/n, each entry rounded once."""
        deviations, n = self.deviations(), self.n
        return lambda x: deviations(x).astype(np.float64) / n

    def deviations(self) -> Callable[[bytes], np.ndarray]:
        """From the bytes of a block to n x - S, exact."""
        n, dim, sums = self.n, self.dim, self.sums
        small = n * self.most < 1 << 62
        total = np.array(sums, np.int64 if small else object)

        def of(x: bytes) -> np.ndarray:
            rows = np.frombuffer(x, np.int64).reshape(-1, dim)
            return (rows if small else rows.astype(object)) * n - total

        return of

    def fold(self, length: int, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over blocks of ``add`` of the centred rows."""
        centred = self.centred()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(length)
            for batch in batches:
                for x in batch.column(0):
                    total += add(centred(x.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["part"])

        return summed(self.packed.select("x").mapInArrow(run, "part array<double>"), length)

    def twice(self, w: np.ndarray) -> np.ndarray:
        """Xᵀ(Xw) over the centred rows."""
        return self.fold(self.dim, lambda x: (x @ w) @ x)


def without(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """The vector less its part along an orthonormal basis, taken off twice."""
    for _ in range(2 if basis else 0):
        q = np.array(basis)
        vector = vector - q.T @ (q @ vector)
    return vector


def bidiagonalise(twice: Callable[[np.ndarray], np.ndarray], dim: int, scatter: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest singular values of the centred rows, falling, and their right vectors as columns.

    ``twice`` gives Xᵀ(Xw); ``scatter`` is the sum of all squared singular values.
    Stops when the wanted vectors have converged and what the steps have not seen
    of ``scatter`` is less than the least of them, so that no equal value can be
    missing; else after ``dim`` steps. Where the steps run dry, they go on from a
    new vector across all earlier ones.
    """
    random = np.random.default_rng(11)
    rights: list[np.ndarray] = []  # v
    shorts: list[np.ndarray] = []  # w of the left vectors u = Xw
    images: list[np.ndarray] = []  # Xᵀu
    alphas: list[float] = []
    betas: list[float] = []  # betas[j] joins step j to the next
    v, beta, norm = random.standard_normal(dim), 0.0, 0.0
    v /= np.linalg.norm(v)
    while True:
        w = v - beta * shorts[-1] if shorts else v.copy()
        z = twice(w)
        for _ in range(2 if shorts else 0):  # against all earlier left vectors
            along = np.array(shorts) @ z
            w, z = w - np.array(shorts).T @ along, z - np.array(images).T @ along
        alpha = float(np.sqrt(max(w @ z, 0.0)))
        norm = max(norm, alpha, beta)
        alive = alpha > NO_LEFT * norm
        rights.append(v)
        alphas.append(alpha if alive else 0.0)
        shorts.append(w / alpha if alive else np.zeros(dim))
        images.append(z / alpha if alive else np.zeros(dim))
        p = without(images[-1] - alphas[-1] * v, rights)
        beta = float(np.linalg.norm(p))
        if beta <= NOTHING * norm:
            beta = 0.0
        left, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        rest = scatter - float((values**2).sum())
        settled = len(values) >= wanted and (beta * np.abs(left[-1, :wanted]) <= CONVERGED * values[0]).all() and rest < values[wanted - 1] ** 2 * (1 - 1e-9)
        if len(rights) == dim or settled:
            return values[:wanted], np.array(rights).T @ right.T[:, :wanted]
        betas.append(beta)
        p = p if beta else without(random.standard_normal(dim), rights)
        v = without(p / np.linalg.norm(p), rights)
        v /= np.linalg.norm(v)


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    Entries become floor(1024 c) + 100000. The length of most places counts;
    shorter vectors are left out, as are those that ``blocks`` leaves out. Rows
    with the same or a null id are rows like others. ``deviation`` is null where
    it is beyond a long. Components whose value is zero to rounding cannot be
    whitened and are left out, so equal vectors, a single one or an empty table
    give no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    packed = stored(blocks(vectors, id_column, column))
    dim = packed.agg(F.max("dim")).first()[0]
    none = spark.createDataFrame([], OUT)
    if dim is None:
        return none
    rows = Rows(packed, dim)
    trace, n = rows.trace(), rows.n
    if rows.scatter == 0:
        return none
    values, vectors_ = bidiagonalise(rows.twice, dim, trace * n, min(wanted, dim))
    e = values**2 / n
    use = e > trace * dim * 16 * EPS
    e, project = e[use], vectors_[:, use] / np.sqrt(e[use])
    k = len(e)
    if not k:
        return none

    def moments(x: np.ndarray) -> np.ndarray:
        y = x @ project
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

    sums = rows.fold(k * k + k, moments) / n
    mean = sums[k * k :]
    error = float(np.abs(sums[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
    deviations, explained = rows.deviations(), e / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column(0), batch.column(1)):
                whole = deviations(x.as_py())
                rough = (whole.astype(np.float64) ** 2).sum(axis=1)
                if rough.max() < 1 << 62:
                    squares = pa.array((whole.astype(np.int64) ** 2).sum(axis=1), pa.int64())
                else:  # exact where it may fit a long
                    exact = [int((row.astype(object) ** 2).sum()) if r < 1 << 64 else 1 << 64 for row, r in zip(whole, rough)]
                    squares = pa.array([q if q < 1 << 63 else None for q in exact], pa.int64())
                y = (whole.astype(np.float64) / n) @ project
                m = len(y)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        squares.take(each),
                        pa.array(y.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.packed.select("ids", "x").mapInArrow(run, OUT)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


QUERIES = {"op11_whitening": op11_whitening}

# Eigenvectors cannot be written in SQL.
SQL: dict[str, str] = {}
