"""Whitening of embeddings by polarisation: every covariance from variances alone.

Entries become whole numbers x. With n vectors and sums S, y = n * x - S is centred and whole.
For every dimension i and every pair of dimensions i < j the squares of y_i and of y_i + y_j are
summed exactly; half of what the square of a pair sum has beyond its two own squares is the
cross-covariance, so no product of two dimensions is ever taken. The covariances, in whole
numbers until one division, are assembled and decomposed by eigh.

A task squares z = x minus the rounded mean, which stays small, in 64-bit integers; since the sum
of z is known, the squares of y follow from those of z without rounding:
sum((n * z - r)^2) = n^2 * sum(z^2) - n * r^2 with r = S - n * rounded mean. Each task hands on
one row per pair of dimensions, so the shuffle and what reaches the driver depend on the number
of dimensions and tasks, not on the rows. The sums are whole, so a task that runs again on
another executor adds the same. No row meets another one: copies, however many, are no hot key.

Defined results: vectors that are null or hold null, NaN or infinity are dropped, and so are those
of another length than most have (of lengths equally common the larger counts). Null ids are kept,
repeated rows count one by one. Components without variance (all vectors equal, fewer vectors than
dimensions) have a null ``whitened`` and do not enter ``identity_error``, which is null if none is
left; ``explained`` is null where nothing varies. A ``deviation`` beyond a long is null;
``deviation_exact`` holds it. Entries of 2^14 and more raise an error, their squares would not
be exact. Columns of other names are never read. An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.texts import pin

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
CHUNK = 1_024  # rows squared at once
LARGEST = 1 << 25  # of z: chunks of squared pair sums stay below 2^62
HALF = 31  # bits of the lower part of a partial sum


def usable(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, c) of complete, finite vectors."""
    c = F.col(vector_col).cast("array<double>")
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = embeddings.select(F.col(id_col).alias("vec_id"), c.alias("c"), bad.alias("bad"))
    return rows.filter(F.col("c").isNotNull() & ~F.col("bad")).drop("bad")


def _whole(column, width: int) -> np.ndarray:
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if c.size and np.abs(c).max() * SCALE >= LARGEST // 2:
        raise ValueError(f"an entry of a vector is {LARGEST // 2 // SCALE} or more in size")
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _sums(width: int):
    """(dim, n, total) of a task."""

    def run(batches):
        n, total = 0, np.zeros(width, np.int64)
        for batch in batches:
            x = _whole(batch.column(0), width)
            n += len(x)
            total += x.sum(axis=0)
        if n:
            yield _table(dim=np.arange(width, dtype=np.int32), n=np.full(width, n), total=total)

    return run


def _squares(centre: np.ndarray):
    """(i, j, high, low) of a task: squares of z_i (i = j) and of z_i + z_j, summed."""
    width = len(centre)
    starts = np.cumsum([0, *range(width, 0, -1)])

    def run(batches):
        high, low = np.zeros(starts[-1], np.int64), np.zeros(starts[-1], np.int64)
        rows = 0
        for batch in batches:
            z = _whole(batch.column(0), width) - centre
            rows += len(z)
            for at in range(0, len(z), CHUNK):
                part = np.ascontiguousarray(z[at : at + CHUNK].T)
                for i in range(width):
                    pair = part[i:] + part[i]
                    pair[0] = part[i]
                    found = np.einsum("ij,ij->i", pair, pair)
                    high[starts[i] : starts[i + 1]] += found >> HALF
                    low[starts[i] : starts[i + 1]] += found & ((1 << HALF) - 1)
        if rows:
            i, j = np.triu_indices(width)
            yield _table(i=i.astype(np.int32), j=j.astype(np.int32), high=high, low=low)

    return run


def covariance(squares: dict, n: int, rest: list[int]) -> np.ndarray:
    """The matrix from exact sums of squares of z_i and z_i + z_j, by polarisation."""
    width = len(rest)

    def centred(i: int, j: int) -> int:
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * n * squares[i, j] - n * r * r

    own = [centred(i, i) for i in range(width)]
    found = np.zeros((width, width))
    for i in range(width):
        found[i, i] = own[i] / n**3
        for j in range(i + 1, width):
            found[i, j] = found[j, i] = (centred(i, j) - own[i] - own[j]) / (2 * n**3)
    return found


def principal(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, largest entry positive."""
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(len(order))] < 0, -1.0, 1.0)


def _projected(centre: np.ndarray, rest: np.ndarray, n: int, values: np.ndarray, vectors: np.ndarray):
    """vec_id, squares (of z) and product (of z and r) for the deviation, and w."""
    scaled = vectors / np.sqrt(values)

    def run(batches):
        for batch in batches:
            z = _whole(batch.column(1), len(centre)) - centre
            if z.size and len(centre) * int(np.abs(z).max()) * int(np.abs(rest).max()) >= 1 << 63:
                raise ValueError("too many and too large vectors for exact deviations")
            w = ((n * z - rest) / n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.einsum("ij,ij->i", z, z)),
                    pa.array(z @ rest),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel())
                    ),
                ],
                ["vec_id", "squares", "product", "w"],
            )

    return run


def _identity_error(rows: DataFrame, kept: int, n: int) -> float | None:
    """The largest entry of the covariance of ``w`` minus the identity, over all rows."""
    if not kept:
        return None
    w = [F.col("w")[k] for k in range(kept)]
    pairs = [(a, b) for a in range(kept) for b in range(a, kept)]
    sums = rows.agg(*[F.sum(x) for x in w], *[F.sum(w[a] * w[b]) for a, b in pairs]).first()
    means = [s / n for s in sums[:kept]]
    return max(
        abs(s / n - means[a] * means[b] - (a == b)) for (a, b), s in zip(pairs, sums[kept:])
    )


def whiten(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact:
    one row per usable vector and component."""
    vectors = usable(embeddings, id_col, vector_col)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double,"
        " identity_error double, deviation_exact decimal(38,0)"
    )
    lengths = vectors.groupBy(F.size("c").alias("size")).count().filter("size > 0")
    common = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    width = common["size"]
    rows = vectors.filter(F.size("c") == width)
    entries = rows.select("c")

    summed = entries.mapInArrow(_sums(width), "dim int, n long, total long")
    summed = summed.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    by_dim = {r["dim"]: (r["n"], r["total"]) for r in summed.collect()}  # a row per dimension
    n = by_dim[0][0]
    totals = [by_dim[i][1] for i in range(width)]
    centre = [(2 * s + n) // (2 * n) for s in totals]
    rest = [s - n * m for s, m in zip(totals, centre)]

    parts = entries.mapInArrow(_squares(np.array(centre)), "i int, j int, high long, low long")
    parts = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    squares = {(r["i"], r["j"]): (r["high"] << HALF) + r["low"] for r in parts.collect()}
    v = covariance(squares, n, rest)
    values, axes = principal(v, components)
    trace = float(np.trace(v))
    kept = int((values > width * np.finfo(float).eps * max(values[0], 0)).sum())

    run = _projected(np.array(centre), np.array(rest), n, values[:kept], axes[:, :kept])
    found = pin(
        rows.mapInArrow(run, f"vec_id {kind}, squares long, product long, w array<double>"), "whitened"
    )
    error = _identity_error(found, kept, n)
    number = [F.lit(x).cast("decimal(38,0)") for x in (n * n, 2 * n, sum(r * r for r in rest))]
    exact = (
        F.col("squares").cast("decimal(38,0)") * number[0]
        - F.col("product").cast("decimal(38,0)") * number[1]
        + number[2]
    ).cast("decimal(38,0)")
    share = [float(e) / trace if trace > 0 else None for e in np.maximum(values, 0.0)]
    each = [
        F.struct(
            F.lit(k + 1).alias("component"),
            (F.col("w")[k] if k < kept else F.lit(None).cast("double")).alias("whitened"),
            F.lit(share[k]).cast("double").alias("explained"),
        )
        for k in range(len(values))
    ]
    found = found.select("vec_id", exact.alias("deviation_exact"), F.explode(F.array(*each)).alias("at"))
    return found.select(
        "vec_id",
        "at.component",
        F.lit(n).cast("long").alias("n"),
        F.expr("try_cast(deviation_exact as long)").alias("deviation"),
        "at.whitened",
        "at.explained",
        F.lit(error).cast("double").alias("identity_error"),
        "deviation_exact",
    )
