"""Operator 12, embedding whitening: exact scatter from bit-sliced planes, integer centring, eigh."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import staged

SCALE, SHIFT = 1024, 100_000      # fixed values: x = floor(SCALE * c) + SHIFT
COMPONENTS = 8
ROWS = 8192                       # rows packed into one set of bit planes (a multiple of 64)
LARGEST = 2.0 ** 50               # entries of this size times SCALE or more have no exact place here


def fixed_point(values: np.ndarray) -> np.ndarray:
    """``floor(1024 * c)`` as int64 (the +100000 shift is added where sums leave here)."""
    x = np.floor(values * float(SCALE))
    if x.size and np.abs(x).max() >= LARGEST:
        raise ValueError("an entry is too large for a fixed-point number")
    return x.astype(np.int64)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes of the non-negative rows x dims integers ``y``: words (planes, words), and dimension and bit of each plane.

    Bit k of dimension d across all rows is one run of 64-bit words; the last word is filled up with zeros.
    """
    rows, dims = y.shape
    width = -(-rows // 64) * 8
    planes, of, bits = [], [], []
    for d in range(dims):
        for k in range(int(y[:, d].max()).bit_length() if rows else 0):
            packed = np.packbits(((y[:, d] >> k) & 1).astype(np.uint8))
            planes.append(np.pad(packed, (0, width - len(packed))))
            of.append(d)
            bits.append(k)
    words = np.ascontiguousarray(planes, np.uint8).reshape(len(planes), width).view(np.uint64)
    return words, np.array(of, np.int64), np.array(bits, np.int64)


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact ``y.T @ y`` (Python integers) from AND-popcounts of plane pairs, each weighted by 2**(both bits)."""
    dims = y.shape[1]
    words, of, bits = bit_planes(y)
    out = np.zeros((dims, dims), object)
    starts = np.searchsorted(of, np.arange(dims))
    ends = np.searchsorted(of, np.arange(dims), "right")
    for i in range(dims):
        if starts[i] == ends[i]:
            continue
        right = slice(starts[i], None)                                  # dimensions i and after
        js, first = np.unique(of[right], return_index=True)
        for a in range(starts[i], ends[i]):
            ones = np.bitwise_count(words[a] & words[right]).sum(axis=1, dtype=np.int64)
            weight = bits[right] + bits[a]
            for limb in range(0, int(weight.max()) + 1, 32):            # below 2**32 * rows * 32 in each: fits int64
                own = (weight >= limb) & (weight < limb + 32)
                sums = np.add.reduceat(np.where(own, ones << np.where(own, weight - limb, 0), 0), first)
                out[i, js] += sums.astype(object) << limb
    upper = np.triu(out, 1)
    return np.triu(out) + upper.T


def block_sums(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross products of a block; planes hold ``u`` less its smallest entry per dimension."""
    low = u.min(axis=0)
    y = u - low
    low, sums = low.astype(object), y.sum(axis=0).astype(object)
    cross = cross_products(y) + np.outer(low, sums) + np.outer(sums, low) + len(u) * np.outer(low, low)
    return sums + len(u) * low, cross


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, rows: int) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and vectors (float64) in blocks of ``rows``."""
    ids, parts, have = [], [], 0
    for b in batches:
        vectors = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dims)
        ids += b.column("vec_id").to_pylist()
        parts.append(vectors)
        have += b.num_rows
        while have >= rows:
            both = np.concatenate(parts)
            yield ids[:rows], both[:rows]
            ids, parts, have = ids[rows:], [both[rows:]], have - rows
    if have:
        yield ids, np.concatenate(parts)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the rows whose vector is there and holds finite entries only."""
    v = F.col("v")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(v.isNotNull() & (F.size(v) > 0)).where(~bad))


def scatter(rows: DataFrame, dims: int, block_rows: int = ROWS) -> tuple[int, list[int], list[list[int]]]:
    """``n``, the sums of x and ``n * sum(x_i x_j) - S_i S_j`` of all rows, exact.

    Each task adds up its blocks and returns one row per pair of dimensions; the
    pairs are added up by Spark. The driver gets dims * (dims + 3) / 2 numbers, whatever the number of rows.
    """
    kind = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.decimal128(38, 0))])

    def part(batches):
        n, total, cross = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for ids, v in _blocks(batches, dims, block_rows):
            s, c = block_sums(fixed_point(v))
            n, total, cross = n + len(ids), total + s, cross + c
        if n:
            i, j = np.triu_indices(dims)
            i, j = [-1, *[-1] * dims, *i.tolist()], [-1, *range(dims), *j.tolist()]
            values = [n, *total.tolist(), *cross[np.triu_indices(dims)].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([Decimal(x) for x in values], kind.field("s").type)], schema=kind)

    sums = rows.mapInArrow(part, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    at = {(r.i, r.j): int(r.s) for r in sums}
    n = at.get((-1, -1), 0)
    u = [at.get((-1, d), 0) for d in range(dims)]
    c = [[n * at[min(i, j), max(i, j)] - u[i] * u[j] for j in range(dims)] for i in range(dims)] if n else []
    return n, [s + n * SHIFT for s in u], c


def components(n: int, centred: list[list[int]], k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues and unit eigenvectors (rows) by falling eigenvalue, and the trace, of ``centred / n**2``."""
    v = np.array([[x / (n * n) for x in row] for row in centred], float)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(values)[::-1][:k]
    trace = sum(centred[d][d] for d in range(len(centred))) / (n * n)
    return values[order], vectors[:, order].T, trace


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS,
           block_rows: int = ROWS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact`` per remaining row and component.

    Rows whose vector is null or empty, or holds null, NaN or infinite entries, are
    left out; so are vectors of another length than the most frequent one (of ties the
    longer). Repeated rows count each. ``n, deviation`` are exact; a deviation
    beyond a long is null there and kept in ``deviation_exact`` (decimal). A
    direction without variance (to double precision) has null ``whitened`` and does not enter
    ``identity_error``; without any variance ``explained`` is null too. No
    remaining row: no rows. An entry of 2**40 or more has no fixed-point form and raises. Other columns, whatever their names, are left
    behind.

    Two passes over the vectors: the first packs blocks of ``block_rows`` rows
    into bit planes and adds up weighted AND-popcounts, the second projects.
    What reaches the driver is bounded by dims squared.
    """
    rows = usable(vectors, id_col, vector_col)
    common = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = common["dims"] if common else 1
    rows = rows.where(F.size("v") == dims)
    n, sums, centred = scatter(rows, dims, block_rows)
    values, axes, trace = components(n, centred, k) if n else (np.zeros(0), np.zeros((0, dims)), 0.0)
    without = values <= max([0.0, *values[:1]]) * dims * np.finfo(float).eps
    scale = np.where(without, np.nan, 1 / np.sqrt(np.where(without, 1.0, values)))
    total = np.array(sums, object)
    kind = pa.schema([("vec_id", to_arrow_type(rows.schema["vec_id"].dataType)), ("deviation_exact", pa.decimal128(38, 0)),
                      ("w", pa.list_(pa.float64()))])

    def project(batches):
        for ids, v in _blocks(batches, dims, block_rows):
            d = n * (fixed_point(v) + SHIFT).astype(object) - total            # n x - S
            w = (d.astype(float) / n) @ axes.T * scale
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, kind.field(0).type), pa.array(map(Decimal, (d * d).sum(axis=1)), kind.field(1).type),
                pa.array([[None if x != x else x for x in r] for r in w.tolist()], kind.field(2).type)], schema=kind)

    out = staged(rows.mapInArrow(project, T.StructType([rows.schema["vec_id"], T.StructField("deviation_exact", T.DecimalType(38, 0)),
                                                        T.StructField("w", T.ArrayType(T.DoubleType()))])), "whitened")
    error = _identity_error(out, [c for c in range(len(values)) if not without[c]])
    share = F.array(*[F.lit(float(e) / trace if trace else None).cast("double") for e in values]).cast("array<double>")
    return (out.select("vec_id", "deviation_exact", F.posexplode("w").alias("k", "whitened"))
            .select("vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
                    F.col("deviation_exact").try_cast("long").alias("deviation"), "whitened",
                    F.get(share, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
                    "deviation_exact"))


def _identity_error(out: DataFrame, used: list[int]) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows less the identity."""
    if not used:
        return None
    means = out.agg(*[F.avg(F.col("w")[c]) for c in used]).first()
    parts = [(F.col("w")[c] - F.lit(m)) for c, m in zip(used, means)]
    pairs = [(a, b) for a in range(len(used)) for b in range(a, len(used))]
    cov = out.agg(*[F.avg(parts[a] * parts[b]) for a, b in pairs]).first()
    return max(abs(x - (a == b)) for x, (a, b) in zip(cov, pairs))
