"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V are found without forming V: a block Q of a few
vectors is multiplied by V = XᵀX / n (X centred) in passes over the rows, each pass one Spark
job whose tasks add up Xᵀ(XQ) over their rows. Between two Rayleigh-Ritz steps the block
goes through a Chebyshev polynomial of V, by its three-term recurrence: the polynomial stays
within [-1, 1] on the unwanted interval from 0 to the least Ritz value of the block, and
grows steeply beyond it. Then QR, one more product, and Rayleigh-Ritz in the block. The
product also gives the residual of every pair; the iteration ends when those of the wanted
pairs certify them (:data:`TOLERANCE`), or when they stopped falling within rounding.

The vectors are packed once into blocks of rows (numbers as small integers, with the ids),
written to the shared checkpoint folder; every pass reads only the numbers. Sums are exact
integers, so centring costs no precision however far the numbers are from zero. The driver
holds Q and V Q: dimensions times block width, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import in_batches, table, written

COMPONENTS = 8
#: Vectors in the block for each wanted component.
OVERSAMPLING = 4
#: A pair is certified if |V u - e u| is at most this part of the largest eigenvalue.
TOLERANCE = 1e-13
#: Residuals within this part of it that no longer fall are as small as rounding allows.
ROUNDING = 1e-11
#: Components with less than this part of the largest eigenvalue have no direction.
RANK = 1e-10
MAX_DEGREE = 12
MAX_ROUNDS = 200
#: Scale and offset that turn an entry into a whole number.
SCALE, OFFSET = 1024, 100_000
#: Bytes of a block of rows.
BLOCK_BYTES = 1 << 20


@dataclass
class Whitening:
    """Fitted components: everything that a row needs, of the size of the dimensions."""
    n: int
    sums: list[int]              # exact sum of the whole numbers per dimension
    values: np.ndarray           # eigenvalues, falling
    vectors: np.ndarray          # unit eigenvectors, one per column
    trace: float
    passes: int                  # products with V
    residual: float              # the largest of the wanted pairs, as part of the largest value


def pack(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
         scale: int = SCALE, offset: int = OFFSET) -> tuple[DataFrame, int]:
    """(ids, numbers) blocks of usable rows, and their dimension.

    Left out are null vectors, those with null, non-finite or too large entries (their whole
    number would not fit a long) and those of another length than most (of equally frequent
    lengths the longest; empty vectors never count). Repeated rows each count.
    """
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * scale))
    whole = F.transform(F.col(vector_col), lambda c: (
        c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double") * scale) < 2.0 ** 62)))
    usable = rows.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).filter(
        F.forall(whole, lambda good: good)).select(F.col(id_col).alias("_id"), F.col(vector_col).alias(vector_col))
    sizes = usable.groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0
    kind = usable.schema["_id"].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("wide", T.BooleanType()),
                           T.StructField("numbers", T.BinaryType())])
    per_block = max(1, BLOCK_BYTES // (8 * max(d, 1)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, per_block):
                part = batch.slice(at, per_block)
                numbers = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                small = numbers.astype(np.int32)
                wide = not np.array_equal(small, numbers)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([wide]), pa.array([(numbers if wide else small).tobytes()], pa.binary())],
                    ["ids", "wide", "numbers"])

    # The offset is added to whole numbers, so that no entry is rounded by it.
    packed = usable.filter(F.size(vector_col) == d).select("_id", x.alias("x")).mapInArrow(blocks, schema)
    return written(packed).withColumn("offset", F.lit(offset).cast("bigint")), d


def _numbers(batch: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    """The rows of each block as longs, offset included."""
    for wide, data, offset in zip(*(batch.column(name).to_pylist() for name in ("wide", "numbers", "offset"))):
        yield np.frombuffer(data, np.int64 if wide else np.int32).astype(np.int64).reshape(-1, d) + offset


def _added(blocks: DataFrame, partial, size: int, d: int) -> np.ndarray:
    """The sum over all rows of ``partial(rows)``, arrays of ``size`` doubles.

    Each task adds up its rows; the sums of the tasks meet by place, so what reaches the
    driver has the size of the result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for rows in _numbers(batch, d):
                part = partial(rows)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)),
                                              pa.array(np.asarray(total, np.float64).ravel())], ["place", "part"])

    got = (blocks.select("wide", "numbers", "offset").mapInArrow(run, "place int, part double")
           .groupBy("place").agg(F.sum("part").alias("total")).toArrow())
    out = np.zeros(size)
    out[got["place"].to_numpy()] = got["total"].to_numpy()
    return out


def exact_sums(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows, and the exact sum of each dimension (halves of 32 bits are summed, as
    decimals across blocks)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _numbers(batch, d):
                high = rows >> 32
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, len(rows), np.int64)),
                     pa.array(high.sum(0)), pa.array((rows - (high << 32)).sum(0))], ["place", "n", "high", "low"])

    exact = T.DecimalType(38, 0)
    got = (blocks.select("wide", "numbers", "offset").mapInArrow(run, "place int, n bigint, high bigint, low bigint")
           .groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(28,0)")).cast(exact).alias("high"),
                                 F.sum(F.col("low").cast("decimal(28,0)")).cast(exact).alias("low")).collect())
    sums = {r["place"]: int(r["high"]) * (1 << 32) + int(r["low"]) for r in got}
    return (got[0]["n"] if got else 0), [sums[k] for k in range(len(sums))]


def _centre(n: int, sums: list[int]):
    """A function of rows that takes the mean off: the whole part exactly, then the rest."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])

    def centred(rows: np.ndarray) -> np.ndarray:
        return (rows - whole).astype(np.float64) - rest
    return centred


def _degree(top: float, bound: float) -> int:
    """Degree of the filter: what it adds to the largest value stays far from rounding."""
    growth = np.arccosh(max(2 * top / bound - 1, 1 + 1e-9))
    return int(np.clip(np.log(2e8) / growth, 2, MAX_DEGREE))


def fit(blocks: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The leading components of the covariance of all rows; None if there are no rows.

    Directions whose eigenvalue is 0 (up to rounding) are no components: there are fewer
    then, none for equal rows. Equal eigenvalues give some basis of their space.
    """
    n, sums = exact_sums(blocks, d)
    if not n:
        return None
    centred = _centre(n, sums)
    context = blocks.sparkSession.sparkContext
    passes = 0

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        block = context.broadcast(q)

        def partial(rows: np.ndarray) -> np.ndarray:
            x = centred(rows)
            return x.T @ (x @ block.value)
        out = _added(blocks, partial, q.size, d).reshape(q.shape) / n
        block.unpersist()
        return out

    trace = float(_added(blocks, lambda rows: (centred(rows) ** 2).sum(0), d, d).sum() / n)
    if trace == 0:
        return Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), trace, 0, 0.0)
    width = min(d, OVERSAMPLING * components)
    wanted = min(components, width)
    q = np.linalg.qr(np.random.default_rng(20_260_801).standard_normal((d, width)))[0]
    last = np.inf
    for _ in range(MAX_ROUNDS):
        vq = product(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        u, vu = q @ turn, vq @ turn
        off = np.linalg.norm(vu - u * values, axis=0)[:wanted].max() / values[0]
        if off <= TOLERANCE or off <= ROUNDING and off > last / 2:
            break
        last = off
        # The filter on [0, bound]; its first product is known already.
        bound = max(values[-1], values[0] * 1e-6)
        before, now = u, (2 / bound) * vu - u
        for _ in range(_degree(values[0], bound) - 1):
            before, now = now, (4 / bound) * product(now) - 2 * now - before
            size = np.abs(now).max(0)           # the recurrence is linear: each column in its own scale
            before, now = before / size, now / size
        q = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
    else:
        raise RuntimeError(f"the components are not certified after {MAX_ROUNDS} rounds (residual {off:.1e})")
    real = values[:wanted] > RANK * values[0]
    u = u[:, :wanted][:, real]
    u = u * np.sign(u[np.abs(u).argmax(0), np.arange(u.shape[1])])
    return Whitening(n, sums, values[:wanted][real], u, trace, passes, float(off))


def identity_error(blocks: DataFrame, d: int, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    centred, project = _centre(model.n, model.sums), model.vectors / np.sqrt(model.values)
    mean = _added(blocks, lambda rows: (centred(rows) @ project).sum(0), k, d) / model.n

    def partial(rows: np.ndarray) -> np.ndarray:
        w = centred(rows) @ project - mean
        return w.T @ w
    covariance = _added(blocks, partial, k * k, d).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """For each row the exact sum over dimensions of (n x - S) ** 2; None if no long holds it."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    about = ((float(n) * (rows - whole) - rest) ** 2).sum(1)
    # Where the sum fits a long, so do its terms and their roots.
    fast = about < 2.0 ** 62
    away = np.where(fast[:, None], n * (rows - whole) - rest, 0)
    out: list[int | None] = (away * away).sum(1).tolist()
    for k in np.flatnonzero(~fast):
        exact = sum((n * x - s) ** 2 for x, s in zip(rows[k].tolist(), sums)) if about[k] < 2.0 ** 64 else 1 << 64
        out[k] = exact if exact < 1 << 63 else None
    return out


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each usable row
    and component (from 1, by falling eigenvalue).

    Fitted on all usable rows (see :func:`pack` for those left out: null vectors, null,
    non-finite or too large entries, another length than most). Ids are passed through, null or
    repeated; repeated rows each count and each give their rows; other columns are ignored.
    Fewer components come back if fewer directions vary: none for one row or equal rows, and
    an empty table gives an empty result. ``deviation`` is null where a long cannot hold it.
    """
    blocks, d = pack(rows, id_col, vector_col, scale, offset)
    model = fit(blocks, d, components) if d else None
    kind = rows.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(blocks, d, model)
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        k = len(model.values)
        centred, project = _centre(model.n, model.sums), model.vectors / np.sqrt(model.values)
        explained = model.values / model.trace
        for batch in batches:
            for block, numbers in enumerate(_numbers(batch, d)):
                ids = batch.column("ids")[block].values
                count = len(numbers)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(np.arange(count), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                     pa.array(np.full(count * k, model.n, np.int64)),
                     pa.array(deviations(numbers, model.n, model.sums), pa.int64()).take(
                         pa.array(np.repeat(np.arange(count), k))),
                     pa.array((centred(numbers) @ project).ravel()), pa.array(np.tile(explained, count)),
                     pa.array(np.full(count * k, error))], schema.names)

    return blocks.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
