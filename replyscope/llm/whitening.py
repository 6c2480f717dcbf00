"""Whitening of integer vectors by a bit-sliced scatter matrix.

Every entry becomes ``floor(256 * c)``. The fit list, each distinct vector once,
is dealt out by hash. A block of it packs, per dimension, the bit planes of the
entries (shifted by the block's least entry, so that none is negative) into
64-bit words, one bit per row: the cross-product of two dimensions is the sum,
over pairs of planes, of the popcount of their AND times both planes' weights.
Blocks undo their shifts in whole numbers, so what is added up over the blocks
in Spark are exact sums and cross-products of the entries, and the covariance is
centred as whole numbers, ``n * sum(x y) - sum(x) * sum(y)``, before ``eigh``.

The driver holds one cross-product per pair of dimensions, whatever the number
of rows."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import map_batches, only

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 1 << 15           # vectors whose planes are held at once
WIDEST = 4096                  # dimensions: the driver holds their square
# Below this share of the largest eigenvalue a component is rounding noise.
FLAT = 1e-12
LIMB = 40                      # bits of a part of an exact sum


def quantised(df: DataFrame) -> DataFrame:
    """``vec_id, x``: rows whose vector and entries are neither null nor
    infinite nor NaN, each entry as ``floor(256 * c)``. Entries beyond 64 bits
    stop at the ends of the range."""
    c = F.col("embedding")
    usable = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return (only(df, vec_id="bigint", embedding="array<double>")
            .where(c.isNotNull()).where(usable)
            .select("vec_id", F.transform(
                c, lambda e: F.floor(F.lit(float(SCALE)) * e).cast("bigint")).alias("x")))


def matrices(column: pa.Array):
    """Rows of equal length as matrices, with the rows' numbers."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(lengths) - lengths
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield int(d), rows, flat[start[rows][:, None] + np.arange(d)]


# ---------------------------------------------------------- bit-sliced scatter
def planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the columns of non-negative entries, packed over the rows
    into 64-bit words, with the dimension and the power of two of each."""
    n, d = shifted.shape
    words = -(-n // 64)
    packed, dims, powers = [], [], []
    for j in range(d):
        for power in range(int(shifted[:, j].max()).bit_length()):
            bits = (shifted[:, j] >> np.uint64(power) & np.uint64(1)).astype(np.uint8)
            row = np.zeros(8 * words, dtype=np.uint8)
            row[:-(-n // 8)] = np.packbits(bits)
            packed.append(row.view(np.uint64))
            dims.append(j)
            powers.append(power)
    planes_ = np.stack(packed) if packed else np.zeros((0, words), dtype=np.uint64)
    return planes_, np.asarray(dims, dtype=np.int64), np.asarray(powers, dtype=np.int64)


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact column sums and cross-products (upper triangle) of whole numbers,
    by weighted AND-popcounts of shifted bit planes. Where 64 bits might not
    hold them they are Python's integers."""
    n, d = x.shape
    low = x.min(axis=0)
    shifted = x.astype(np.uint64) - low.astype(np.uint64)
    bits, dims, powers = planes(shifted)
    reach = max(abs(int(x.min())), abs(int(x.max())), int(shifted.max()), 1)
    kind = np.int64 if 8 * n * reach * reach < 1 << 63 else object
    powers, low = powers.astype(kind), low.astype(kind)
    first = np.searchsorted(dims, np.arange(d + 1))
    sums = np.zeros(d, dtype=kind)
    np.add.at(sums, dims, np.bitwise_count(bits).sum(axis=1, dtype=np.int64).astype(kind) << powers)
    product = np.zeros((d, d), dtype=kind)
    for i in range(d):
        for p in range(first[i], first[i + 1]):
            both = np.bitwise_count(bits[p] & bits[first[i]:]).sum(axis=1, dtype=np.int64)
            np.add.at(product[i], dims[first[i]:], both.astype(kind) << powers[first[i]:] + powers[p])
    undone = np.outer(low, sums)
    product += undone + undone.T + n * np.outer(low, low)
    return sums + n * low, np.triu(product)


def _scatter(batches):
    """Per block and vector length: the number of vectors, the sums and the
    cross-products, each cut into ``LIMB``-bit parts, whose sums over all blocks
    fit 64 bits whatever the entries."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            for d, rows, x in matrices(batch.column(0).slice(start, BLOCK_ROWS)):
                if not d:
                    continue
                sums, product = cross_products(x)
                i, j = np.triu_indices(d)
                value = np.concatenate([np.asarray([len(rows)], dtype=sums.dtype), sums,
                                        product[i, j]])
                # Place -1 stands for the number, places 0.. for sums and products.
                left = np.concatenate([[-1], np.arange(d), i])
                right = np.concatenate([[-1], np.full(d, -1), j])
                limb = 0
                while True:
                    last = bool(np.all(abs(value) < 1 << LIMB))
                    part = value if last else value & (1 << LIMB) - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(value), d), pa.int32()), pa.array(left, pa.int32()),
                         pa.array(right, pa.int32()),
                         pa.array(np.full(len(value), limb), pa.int32()),
                         pa.array(part.astype(np.int64))], ["d", "i", "j", "limb", "value"])
                    if last:
                        break
                    value, limb = value >> LIMB, limb + 1


# ----------------------------------------------------------------------- model
class Whitener:
    """Sums, leading eigenvectors and eigenvalues for one vector length."""

    def __init__(self, d: int, cells: dict[tuple[int, int], int]):
        self.n = cells[-1, -1]
        self.sums = [cells[i, -1] for i in range(d)]
        centred = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                whole = self.n * cells[i, j] - self.sums[i] * self.sums[j]
                centred[i, j] = centred[j, i] = whole / (self.n * self.n)
        values, vectors = np.linalg.eigh(centred)
        trace = float(np.trace(centred))
        order = np.argsort(-values, kind="stable")[:COMPONENTS]
        self.values = np.maximum(values[order], 0.0)
        self.vectors = vectors[:, order]
        self.explained = self.values / trace if trace > 0 else np.zeros(len(order))
        self.alive = self.values > FLAT * max(float(values.max()), 0.0)
        self.error: float | None = None

    def apply(self, x: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Exact deviations and whitened coordinates of whole-number rows; NaN
        along a component without variance."""
        reach = max(abs(int(x.min())), abs(int(x.max())), 1) * self.n + max(map(abs, self.sums))
        kind = np.int64 if x.shape[1] * reach * reach < 1 << 63 else object
        away = self.n * x.astype(kind) - np.asarray(self.sums, dtype=kind)
        deviation = (away * away).sum(axis=1).tolist()
        scale = np.where(self.alive, np.sqrt(self.values), np.nan)
        return deviation, away.astype(np.float64) / self.n @ self.vectors / scale


def _whiteners(fit: DataFrame) -> dict[int, Whitener]:
    spark = fit.sparkSession
    lengths = fit.select(F.size("x").cast("bigint").alias("d")).distinct()
    room = lengths.agg(F.sum(F.col("d") * F.col("d"))).first()[0] or 0
    if room > WIDEST * WIDEST:
        raise ValueError(f"vectors too wide to whiten: {room} cross-products")
    parts = fit.mapInArrow(_scatter, spark.createDataFrame(
        [], "d int, i int, j int, limb int, value bigint").schema)
    cells: dict[int, dict[tuple[int, int], int]] = {}
    rows = parts.groupBy("d", "i", "j", "limb").agg(F.sum("value").alias("value")).toArrow()
    for d, i, j, limb, value in zip(*(rows[c].to_pylist() for c in rows.column_names)):
        of = cells.setdefault(d, {})
        of[i, j] = of.get((i, j), 0) + (value << LIMB * limb)
    models = {d: Whitener(d, of) for d, of in cells.items()}
    for d, worst in _identity_errors(fit, models).items():
        models[d].error = worst
    return models


def _identity_errors(fit: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """Largest absolute entry of the covariance of the whitened fit list minus
    the identity, over the components that have variance."""
    def moments(part: pa.RecordBatch, _):
        out: dict[str, list] = {"d": [], "i": [], "j": [], "value": []}
        for d, _, x in matrices(part.column(0)):
            if d:
                white = models[d].apply(x)[1]
                held = np.column_stack([np.ones(len(white)), white])
                for (i, j), value in np.ndenumerate(held.T @ held):
                    for name, v in zip(out, (d, i, j, float(value))):
                        out[name].append(v)
        return out

    sums = map_batches(fit, moments, "d int, i int, j int, value double") \
        .groupBy("d", "i", "j").agg(F.sum("value").alias("value")).collect()
    found = {(r["d"], r["i"], r["j"]): r["value"] for r in sums}     # at most 25 a length
    errors = {}
    for d, model in models.items():
        live = [int(c) + 1 for c in np.flatnonzero(model.alive)]
        mean = {c: found[d, 0, c] / model.n for c in live}
        errors[d] = max((abs(found[d, i, j] / model.n - mean[i] * mean[j] - (i == j))
                         for i in live for j in live), default=None)
    return errors


def whiten(embeddings: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    of every row of ``embeddings(vec_id, embedding)`` with a usable vector, for
    its first ``COMPONENTS`` components (fewer for shorter vectors).

    Rows whose vector is null, empty, or holds a null, an infinity or a NaN have
    no result. Repeated rows, equal vectors and rows without an id each have
    theirs; equal vectors count once in the fit list. Vectors of another length
    are a table of their own, with their own ``n`` and components. Along a
    component without variance ``whitened`` is null (``identity_error``, too, if
    there is none with any), and so is a ``deviation`` beyond 64 bits. Components
    that tie in variance come in any order, the same for all rows. An empty table
    gives no rows; other columns are ignored."""
    x = quantised(embeddings)
    fit = Scratch(embeddings.sparkSession).table(x.select("x").where(F.size("x") > 0).distinct())
    models = _whiteners(fit)

    def batch(part: pa.RecordBatch, _):
        ids = part.column(0)
        out: dict[str, list] = {n: [] for n in ("vec_id", "component", "n", "deviation",
                                                "whitened", "explained", "identity_error")}
        for d, rows, values in matrices(part.column(1)):
            if not d:
                continue
            model = models[d]
            deviation, white = model.apply(values)
            m = len(model.values)
            out["vec_id"] += [v for v in ids.take(pa.array(rows)).to_pylist() for _ in range(m)]
            out["component"] += list(range(1, m + 1)) * len(rows)
            out["n"] += [model.n] * (m * len(rows))
            out["deviation"] += [v if v < 1 << 63 else None for v in deviation for _ in range(m)]
            out["whitened"] += [None if v != v else v for v in white.ravel().tolist()]
            out["explained"] += model.explained.tolist() * len(rows)
            out["identity_error"] += [model.error] * (m * len(rows))
        return out

    return map_batches(x, batch, "vec_id bigint, component int, n bigint, deviation bigint, "
                                 "whitened double, explained double, identity_error double")
