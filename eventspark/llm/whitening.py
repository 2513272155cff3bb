"""Embedding whitening from an exact, bit-sliced scatter matrix.

An entry c becomes the integer ``x = floor(scale * c) + shift``.  Three passes over the vectors, none of which shuffles
one:

1. Per dimension: sum, smallest and largest x, in integers that cannot overflow.
2. Scatter.  ``y = x - smallest`` of a dimension has as many bits as its range needs.  Every task packs, for blocks of
   rows, each bit of each dimension across rows into 64-bit words; the popcount of the AND of two such planes counts the
   rows that have both bits, and weighted by the bits' values these counts add up to the exact sums of products of y.
   Tasks hand on one number per pair of dimensions, which Spark sums.
3. ``n * sum(y_a y_b) - sum(y_a) sum(y_b)``, the covariance times n squared, is exact as an integer; only then it is
   divided and decomposed, and the centred rows are projected on the leading eigenvectors.

The whitened rows are written once; the covariance that they really have is summed from them.

Integers go between tasks in limbs of 32 bits, so sums stay exact for any size of entry and any number of rows.

Nulls and odd inputs: vectors that are null or hold null or non-finite entries are left out; entries beyond 2^61 after
scaling are held there; vectors of each length are whitened among themselves; an empty vector has no component;
components whose eigenvalue is below 1e-11 of the largest (constant or dependent dimensions, a single row) are left
out, as nothing can be divided by them; a deviation that no long holds is null; null and repeated ids are rows like any
other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventspark.llm.vectors import matrices, usable
from eventspark.session import reliable_checkpoint

U = np.uint64
LIMB, LIMBS = 32, 6
_LIMB_COLS = [f"l{i}" for i in range(LIMBS)]
_LIMB_SCHEMA = ", ".join(f"{c} long" for c in _LIMB_COLS)


def integers(values: np.ndarray, scale: int, shift: int) -> np.ndarray:
    limit = float(1 << 61)
    return np.clip(np.floor(values * scale), -limit, limit).astype(np.int64) + shift


def limbs(numbers: list[int]) -> list[pa.Array]:
    """Whole numbers as columns of 32-bit limbs, the last one signed: sums of limbs give the limbs of the sum."""
    mask = (1 << LIMB) - 1
    out = [[(x >> LIMB * i) & mask for x in numbers] for i in range(LIMBS - 1)]
    return [pa.array(col, pa.int64()) for col in [*out, [x >> LIMB * (LIMBS - 1) for x in numbers]]]


def from_limbs(row) -> int:
    return sum(int(row[c]) << LIMB * i for i, c in enumerate(_LIMB_COLS))


def exact_sum(x: np.ndarray) -> list[int]:
    """Column sums; halves of 32 bits cannot overflow."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(w) for h, w in zip(high, low, strict=True)]


def _ranges(scale: int, shift: int):
    """One row per task, vector length and dimension: rows, smallest and largest x, limbs of the sum."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in it:
            for _, values in matrices(batch.column(0)):
                if not values.shape[1]:
                    continue
                x = integers(values, scale, shift)
                new = [len(x), x.min(axis=0), x.max(axis=0), exact_sum(x)]
                old = seen.get(x.shape[1])
                seen[x.shape[1]] = new if old is None else [
                    old[0] + new[0], np.minimum(old[1], new[1]), np.maximum(old[2], new[2]),
                    [a + b for a, b in zip(old[3], new[3], strict=True)]]
        for size, (n, low, high, total) in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, size)), pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(low),
                 pa.array(high), *limbs(total)], names=["size", "dim", "n", "low", "high", *_LIMB_COLS])

    return run


def planes(y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes of the columns of ``y``, dimension after dimension from the lowest bit, packed across rows into words."""
    rows = -(-len(y) // 64) * 64
    out = np.zeros((int(bits.sum()), rows // 8), np.uint8)
    at = np.cumsum(bits) - bits
    for bit in range(int(bits.max(initial=0))):
        dims = np.flatnonzero(bits > bit)
        plane = np.zeros((len(dims), rows), np.uint8)
        plane[:, :len(y)] = (y[:, dims] >> bit & 1).T
        out[at[dims] + bit] = np.packbits(plane, axis=1)
    return out.view(U)


def and_counts(words: np.ndarray, counts: np.ndarray) -> None:
    """Adds the popcounts of all ANDs of two planes to ``counts`` (upper triangle)."""
    for p in range(len(words)):
        counts[p, p:] += np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)


def products(counts: np.ndarray, bits: np.ndarray) -> list[list[int]]:
    """Sums of products ``y_a y_b`` (a <= b) from the plane counts, as whole numbers."""
    at = np.cumsum(bits) - bits
    size, depth = len(bits), int(bits.max(initial=0))
    both = counts + np.triu(counts, 1).T
    by_weight = np.zeros((max(1, 2 * depth - 1), size, size), np.int64)  # planes whose bits' values multiply to 2^w
    for i in range(depth):
        a = np.flatnonzero(bits > i)
        for j in range(depth):
            b = np.flatnonzero(bits > j)
            by_weight[i + j][np.ix_(a, b)] += both[np.ix_(at[a] + i, at[b] + j)]
    return [[sum(int(k) << w for w, k in enumerate(by_weight[:, a, b])) for b in range(a, size)] for a in range(size)]


def _scatter(fits: dict[int, tuple[list[int], list[int]]], scale: int, shift: int, block: int):
    """One row per task, vector length and pair of dimensions: limbs of the sum of products of y."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in it:
            for _, values in matrices(batch.column(0)):
                size = values.shape[1]
                if not size:
                    continue
                low, bits = (np.array(v, np.int64) for v in fits[size])
                own = counts.setdefault(size, np.zeros((int(bits.sum()), int(bits.sum())), np.int64))
                y = integers(values, scale, shift) - low
                for first in range(0, len(y), block):
                    and_counts(planes(y[first:first + block], bits), own)
        for size, own in counts.items():
            bits = np.array(fits[size][1], np.int64)
            sums = products(own, bits)
            a, b = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), size)), pa.array(a), pa.array(b), *limbs([s for row in sums for s in row])],
                names=["size", "a", "b", *_LIMB_COLS])

    return run


@dataclass
class Fit:
    """What whitens the vectors of one length: rows, sums of x, unit eigenvectors in columns and their eigenvalues."""
    n: int
    total: list[int]
    widest: list[int]  # per dimension, the largest |n x - total| of any row
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @classmethod
    def of(cls, n: int, low: list[int], high: list[int], total: list[int], sums: dict[tuple[int, int], int],
           components: int) -> Fit:
        size = len(total)
        y = [t - n * m for t, m in zip(total, low, strict=True)]
        cov = np.zeros((size, size))
        for (a, b), s in sums.items():
            cov[a, b] = cov[b, a] = (n * s - y[a] * y[b]) / (n * n)  # a whole number, rounded once
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        keep = int((values[:components] > max(values[0], 0) * 1e-11).sum())
        vectors = vectors[:, :keep]
        sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)])
        widest = [max(abs(n * a - t), abs(n * b - t)) for a, b, t in zip(low, high, total, strict=True)]
        return cls(n, total, widest, vectors * sign, values[:keep], float(np.trace(cov)))

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """``x - total / n`` and the sum of squares of ``n x - total`` per row."""
        most = (1 << 63) - 1
        small = sum(w * w for w in self.widest) <= most and all(
            abs(t) + w <= most for t, w in zip(self.total, self.widest, strict=True))
        whole = x if small else x.astype(object)
        apart = whole * self.n - np.array(self.total, np.int64 if small else object)
        squares = [int(s) for s in (apart * apart).sum(axis=1)]
        return (apart / self.n).astype(np.float64), [s if s <= most else None for s in squares]


def _projected(fits: dict[int, Fit], scale: int, shift: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for rows, values in matrices(batch.column(1)):
                fit = fits.get(values.shape[1])
                if fit is None:
                    continue
                apart, deviation = fit.centred(integers(values, scale, shift))
                white = apart @ fit.vectors / np.sqrt(fit.values)
                ends = pa.array(np.arange(len(rows) + 1) * white.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), values.shape[1])),
                     pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(white.ravel()))],
                    names=["vec_id", "size", "deviation", "whitened"])

    return run


def fit_whitening(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000, block: int = 4096,
                  vector_col: str = "embedding") -> dict[int, Fit]:
    """Per vector length, the fit over all usable vectors.  The driver holds one row per pair of dimensions."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.when(usable(v), v).alias("v")).filter("v IS NOT NULL")
    total = [F.sum(c).alias(c) for c in _LIMB_COLS]
    ranges = rows.mapInArrow(_ranges(scale, shift), f"size long, dim long, n long, low long, high long, {_LIMB_SCHEMA}")
    ranges = ranges.groupBy("size", "dim").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
                                               *total).collect()
    by_size: dict[int, list] = {}
    for r in sorted(ranges, key=lambda r: r["dim"]):
        by_size.setdefault(r["size"], []).append((r["n"], r["low"], r["high"], from_limbs(r)))
    spans = {size: ([d[1] for d in dims], [(d[2] - d[1]).bit_length() for d in dims]) for size, dims in by_size.items()}
    sums = rows.mapInArrow(_scatter(spans, scale, shift, block), f"size long, a long, b long, {_LIMB_SCHEMA}")
    found: dict[int, dict] = {size: {} for size in by_size}
    for r in sums.groupBy("size", "a", "b").agg(*total).collect():
        found[r["size"]][r["a"], r["b"]] = from_limbs(r)
    return {size: Fit.of(dims[0][0], [d[1] for d in dims], [d[2] for d in dims], [d[3] for d in dims], found[size], components)
            for size, dims in by_size.items()}


def _identity_error(projected: DataFrame, components: int) -> Column:
    """Largest absolute entry of the whitened rows' covariance minus the identity, per vector length."""
    w = F.col("whitened")
    at = [F.get(w, F.lit(i)) for i in range(components)]
    mean = [F.sum(a) / F.count(a) for a in at]
    off = []
    for i in range(components):
        for j in range(i, components):
            cov = F.sum(at[i] * at[j]) / F.count(at[i] * at[j]) - mean[i] * mean[j]
            off.append(F.abs(cov - F.lit(1.0 if i == j else 0.0)))
    return projected.groupBy(F.col("size").alias("of")).agg(
        (F.greatest(*off) if len(off) > 1 else off[0]).alias("identity_error"))


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per usable vector and component."""
    spark = vectors.sparkSession
    fits = fit_whitening(vectors, components, scale, shift, vector_col=vector_col)
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable(v), v).alias("v")).filter("v IS NOT NULL")
    projected = reliable_checkpoint(rows.mapInArrow(
        _projected(fits, scale, shift), "vec_id long, size long, deviation long, whitened array<double>"))
    per = spark.createDataFrame([(size, i, f.n, float(e / f.trace)) for size, f in fits.items() for i, e in enumerate(f.values)],
                                "fit long, at int, n long, explained double")
    per = per.join(_identity_error(projected, components), F.col("fit") == F.col("of"))
    # a row per vector length and component: bounded by the number of lengths
    per = spark.createDataFrame(per.select("fit", "at", "n", "explained", "identity_error").collect(),
                                "fit long, at int, n long, explained double, identity_error double")
    out = projected.select("vec_id", "size", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    return out.join(F.broadcast(per), (F.col("size") == F.col("fit")) & (F.col("pos") == F.col("at"))).select(
        "vec_id", (F.col("pos") + 1).cast("int").alias("component"), "n", "deviation", "whitened", "explained", "identity_error")
