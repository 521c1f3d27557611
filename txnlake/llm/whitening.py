"""Whitening of embeddings on leading components, found by Jacobi-Davidson from distributed products."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txnlake.llm.common import stage

COMPONENTS = 8
#: Entries become floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Scaled entries must stay below this in size, so that sums in a task are exact.
MOST = float(1 << 40)
#: Directions that a subspace starts with and keeps beyond the wanted ones, and its largest size for each wanted one.
SPARE, LARGEST = 2, 8
#: Steps of MINRES in one correction, and the share of the residual at which it ends earlier.
INNER, INNER_SHARE = 3, 0.01
#: Rounds after which missing convergence is an error.
ROUNDS = 300
#: A residual is zero in double precision below so many rounding units of the largest value, for each root of the dimensions.
UNITS = 4
#: Components with less than this share of the largest variance are rounding errors.
NOTHING = 1e-12
#: Vectors of a stored block.
BLOCK = 4096

Product = Callable[[np.ndarray], np.ndarray]


def integer_vector(embedding: Column) -> Column:
    """An embedding as array<long>; null if it is null or empty or has an entry that is null, not finite or 2^30 or more."""
    size = lambda entry: F.abs(entry.cast("double")) * SCALE
    good = F.forall(embedding, lambda entry: entry.isNotNull() & (size(entry) < MOST))
    return F.when(good & (F.size(embedding) > 0), F.transform(
        embedding, lambda entry: (F.floor(entry.cast("double") * SCALE) + OFFSET).cast("long")))


def packed(vectors: DataFrame) -> DataFrame:
    """Rows of an array<long> x as blocks: the number of vectors, the type of an entry and all entries as bytes."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.column("x").slice(low, BLOCK)
                flat = part.flatten().to_numpy(zero_copy_only=False)
                kind = "<i4" if np.abs(flat).max(initial=0) < 1 << 31 else "<i8"
                yield pa.RecordBatch.from_pydict({
                    "size": pa.array([len(part)], pa.int64()), "kind": pa.array([kind]),
                    "block": pa.array([flat.astype(kind).tobytes()], pa.binary())})

    return vectors.select("x").mapInArrow(pack, "size long, kind string, block binary")


class Vectors:
    """Stored blocks of integer vectors: exact sums, and centred products that take one pass over the blocks each.

    Only matrices whose size depends on the dimensions come to the driver, never rows.
    """

    def __init__(self, blocks: DataFrame, width: int):
        self.blocks, self.width, self.passes = blocks, width, 0
        self.n = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        sums = self._summed(lambda x: x.sum(axis=0, dtype=np.int64)[None], exact=True)[0]
        # The mean as a whole number and a rest: the difference of an entry and the whole number is exact.
        self.low = np.array([value // self.n for value in sums], np.int64)
        self.rest = np.array([value % self.n for value in sums], np.int64)

    def _summed(self, part: Callable[[np.ndarray], np.ndarray], exact: bool = False) -> np.ndarray:
        """The sum over all blocks of a small matrix for each block of vectors."""
        width = self.width

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block")):
                    own = part(np.frombuffer(block.as_buffer(), kind).reshape(-1, width))
                    total = own if total is None else total + own
            if total is not None:
                row, place = np.divmod(np.arange(total.size, dtype=np.int32), np.int32(total.shape[1]))
                yield pa.RecordBatch.from_pydict({"row": row, "place": place, "value": total.ravel()})

        self.passes += 1
        parts = self.blocks.mapInArrow(add, f"row int, place int, value {'long' if exact else 'double'}")
        value = F.col("value").cast("decimal(38,0)") if exact else F.col("value")
        found = parts.groupBy("row", "place").agg(F.sum(value).alias("value")).toArrow().to_pydict()
        shape = (max(found["row"]) + 1, max(found["place"]) + 1)
        result = np.zeros(shape, object if exact else np.float64)
        result[found["row"], found["place"]] = [int(one) for one in found["value"]] if exact else found["value"]
        return result

    def _centre(self) -> Callable[[np.ndarray], np.ndarray]:
        low, rest = self.low, self.rest / self.n
        return lambda x: (x - low) - rest

    def trace(self) -> float:
        """The trace of the covariance."""
        centre = self._centre()
        return float(self._summed(lambda x: np.square(centre(x)).sum(axis=0)[None]).sum() / self.n)

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance times some vectors (columns), without ever forming it."""
        centre = self._centre()

        def part(x: np.ndarray) -> np.ndarray:
            z = centre(x)
            return (z.T @ (z @ vectors)).T

        return self._summed(part).T / self.n

    def identity_error(self, axes: np.ndarray) -> float:
        """The largest entry of the covariance of the vectors on some axes, minus the identity."""
        centre, n = self._centre(), self.n
        mean = self._summed(lambda x: (centre(x) @ axes).sum(axis=0)[None]) / n

        def part(x: np.ndarray) -> np.ndarray:
            w = centre(x) @ axes - mean
            return w.T @ w

        return float(np.abs(self._summed(part) / n - np.eye(axes.shape[1])).max())


def orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal directions that some vectors add to an orthonormal basis; none for what lies in it."""
    basis = against
    for vector in vectors.T:
        size = np.linalg.norm(vector)
        if not size or basis.shape[1] == len(vector):
            continue
        vector = vector / size
        for _ in range(3):
            vector = vector - basis @ (basis.T @ vector)
            left = np.linalg.norm(vector)
            if left < 1e-12:
                break
            vector = vector / left
        if left >= 1e-12:
            basis = np.column_stack([basis, vector])
    return basis[:, against.shape[1]:]


def minres(product: Product, right: np.ndarray, steps: int, share: float = INNER_SHARE) -> np.ndarray:
    """Approximate solutions of symmetric equations, one for each column, by MINRES from zero.

    All columns take a step together, so a step is one product; a column whose residual has
    fallen to a share of its start stands still.
    """
    beta = np.linalg.norm(right, axis=0)
    start, eta, live = beta, beta, beta > 0
    v, before = right / np.where(live, beta, 1.0), np.zeros_like(right)
    w = w_before = solution = np.zeros_like(right)
    beta, cos, cos_before, sin, sin_before = np.zeros_like(eta), np.ones_like(eta), np.ones_like(eta), np.zeros_like(eta), np.zeros_like(eta)
    for _ in range(steps):
        if not live.any():
            break
        image = product(v)
        alpha = (v * image).sum(axis=0)
        image = image - alpha * v - beta * before
        following = np.linalg.norm(image, axis=0)
        # The next column of the tridiagonal matrix after the two rotations before it, then a rotation of its own.
        last, middle, top = cos * alpha - cos_before * sin * beta, sin * alpha + cos_before * cos * beta, sin_before * beta
        size = np.hypot(last, following)
        live = live & (size > 0)
        size = np.where(size > 0, size, 1.0)
        cos_before, cos, sin_before, sin = cos, last / size, sin, following / size
        w, w_before = (v - middle * w - top * w_before) / size, w
        solution = solution + np.where(live, cos * eta, 0.0) * w
        eta = -sin * eta
        live = live & (np.abs(eta) > share * start)
        v, before, beta = image / np.where(following > 0, following, 1.0), v, following
    return solution


def jacobi_davidson(product: Product, width: int, wanted: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric operator, falling, and their unit eigenvectors as columns.

    Rayleigh-Ritz in a growing subspace gives the leading pairs. A pair whose residual is
    zero in double precision is locked and taken out. For all others the correction equations,
    projected away from all locked and leading directions, are solved roughly by MINRES, all in the same
    products, and the corrections widen the subspace. A full subspace starts again from its leading pairs.
    """
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((width, 0)), []
    basis = orthonormal(rng.standard_normal((width, min(width, wanted + SPARE))), locked)
    images, largest = product(basis), 0.0
    for _ in range(ROUNDS):
        projected = basis.T @ images
        theta, turn = np.linalg.eigh((projected + projected.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        largest = max(largest, abs(theta[0]))
        residual = images - theta * basis
        residual = residual - locked @ (locked.T @ residual)
        whole = locked.shape[1] + basis.shape[1] == width
        done = np.linalg.norm(residual, axis=0) <= UNITS * np.sqrt(width) * np.finfo(float).eps * largest
        # In a subspace of all directions, what is left is rounding.
        ready = 0
        while ready < min(len(theta), wanted - len(values)) and (done[ready] or whole):
            ready += 1
        if ready:
            locked = np.column_stack([locked, basis[:, :ready]])
            values += theta[:ready].tolist()
            basis, images, theta, residual = basis[:, ready:], images[:, ready:], theta[ready:], residual[:, ready:]
        missing = wanted - len(values)
        if not missing:
            break
        leading = min(missing, len(theta))
        if basis.shape[1] + leading > LARGEST * wanted:
            basis, images = basis[:, :missing + SPARE], images[:, :missing + SPARE]
        known = np.column_stack([locked, basis[:, :leading]])
        outside = lambda x: x - known @ (known.T @ x)  # noqa: B023, E731
        shift = theta[:leading]
        step = minres(lambda x: outside(product(x) - shift * x), outside(-residual[:, :leading]), INNER)  # noqa: B023
        added = orthonormal(outside(step), np.column_stack([locked, basis]))
        if not added.shape[1]:
            added = orthonormal(rng.standard_normal((width, 1)), np.column_stack([locked, basis]))
        basis, images = np.column_stack([basis, added]), np.column_stack([images, product(added)])
    else:
        raise ArithmeticError(f"{wanted - len(values)} components have not reached double precision")
    # Locked one after the other; one more Rayleigh-Ritz step among them puts all in order.
    locked = orthonormal(locked, np.zeros((width, 0)))
    projected = locked.T @ product(locked)
    theta, turn = np.linalg.eigh((projected + projected.T) / 2)
    return theta[::-1], locked @ turn[:, ::-1]


@dataclass
class Whitening:
    """What a fit gives: the number of vectors, their mean and the components."""

    n: int
    low: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    explained: list[float]
    identity_error: float

    def apply(self, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """Deviation and whitened coordinates of some vectors.

        The deviation is the exact sum of squares of n times an entry minus the sum of the
        entries; null where it doesn't fit a long.
        """
        bound = (float(np.abs(x - self.low).max(initial=0)) + 1) * self.n
        kind = np.int64 if bound ** 2 * x.shape[1] < 1 << 62 else object
        apart = (x - self.low).astype(kind) * self.n - self.rest.astype(kind)
        deviation = [value if value < 1 << 63 else None for value in np.square(apart).sum(axis=1).tolist()]
        return deviation, (apart / self.n).astype(np.float64) @ self.axes


def fit(blocks: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Leading components of all stored vectors; those without any variance are left out."""
    vectors = Vectors(blocks, width)
    trace = vectors.trace()
    values, axes = jacobi_davidson(vectors.product, width, min(components, width)) if trace > 0 else (np.zeros(0), np.zeros((width, 0)))
    some = values > NOTHING * max([0.0, *values])
    values, axes = values[some], axes[:, some]
    # The largest entry of a component is positive.
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]) if axes.size else axes
    scaled = axes / np.sqrt(values)
    error = vectors.identity_error(scaled) if len(values) else 0.0
    return Whitening(vectors.n, vectors.low, vectors.rest, values, scaled, (values / trace).tolist() if trace > 0 else [], error)


def whitened_components(embeddings: DataFrame, row_id: str = "vec_id", embedding: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: id, component, n, deviation, whitened, explained and identity_error.

    Entries become floor(1024 * entry) + 100000. Vectors that are null or empty, or hold an entry that
    is null, not finite or 2^30 or more are dropped, and so are those of another length than the
    most frequent one (the greater of two equally frequent). Components are the leading unit
    eigenvectors of the covariance of all others, by Jacobi-Davidson; every product with the
    covariance is one pass over the stored vectors. There are fewer where the vectors have fewer
    dimensions or vary in fewer directions, so vectors that are all equal, a single one, and an empty
    table give no rows. Null, repeated ids and repeated vectors count like any other. Other columns
    are left out.
    """
    rows = embeddings.select(F.col(row_id).alias("vec_id"), integer_vector(F.col(embedding)).alias("x")).filter("x IS NOT NULL")
    rows = stage(rows, "vectors")
    schema = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double".format(
        rows.schema["vec_id"].dataType.simpleString())
    # One row for each length.
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if widths is None:
        return rows.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.size("x") == widths["width"])
    found = fit(stage(packed(rows), "blocks"), widths["width"], components)
    if not found.explained:
        return rows.sparkSession.createDataFrame([], schema)

    @F.pandas_udf("deviation long, whitened array<double>")
    def run(vectors: pd.Series) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame({"deviation": pd.Series(dtype="Int64"), "whitened": pd.Series(dtype=object)})
        deviation, whitened = found.apply(np.stack(vectors.to_numpy()))
        return pd.DataFrame({"deviation": pd.array(deviation, "Int64"), "whitened": list(whitened)})

    told = rows.select("vec_id", run("x").alias("_found")).select(
        "vec_id", F.col("_found.deviation").alias("deviation"), F.posexplode("_found.whitened").alias("place", "whitened"))
    return told.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, found.explained)), F.col("place")).alias("explained"),
        F.lit(found.identity_error).alias("identity_error"))
