"""Whitening of embeddings by the leading components of their covariance, found by FEAST contour integration.

Moments: each task sums its vectors as integers, then, about the rounded mean, their products. A block's products are exact in
double precision while they stay under 2**53, so blocks are cut to that and large entries are split into limbs; the sums go on
as decimals. The covariance is therefore the exact one rounded once, whatever the partitioning. What reaches the driver is one
square matrix of the embedding's width.

Components: inertia counts (signs of the pivots of V - s I) bisect for an interval that holds the wanted eigenvalues. The
contour around it is sampled at Gauss-Legendre points; the weighted sum of the complex solves (z I - V)^-1 Y projects Y onto
the interval's eigenvectors, Rayleigh-Ritz in the projected space extracts them, and this is repeated until every residual is
at rounding level and the count equals the inertia's. A subspace that proves too small is enlarged.

Left out of the fit and the result: null vectors and vectors with a null or non-finite entry, with an entry beyond 2**52 when
scaled, without entries, or of another length than most (of equally frequent lengths the larger holds). Components have a
positive eigenvalue beyond rounding, so equal vectors have none and give no rows. Ids may be null or repeat; each row counts. A
deviation that no long holds is null. An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
LIMB, EXACT = 20, 1 << 53  # bits of a limb; doubles hold smaller integers exactly
BEYOND = 1 << 52
POINTS, ROUNDS = 8, 60
EPS = np.finfo(float).eps


# vectors to integers


def usable(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lengths, entries) of a batch: the rows that can be fitted, their lengths, and their entries as scaled longs, end to
    end. A row is usable if it has entries and all of them are finite and in range."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    lengths = np.asarray(vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = vectors.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(SCALE * flat)
        bad = ~(np.abs(scaled) < BEYOND)  # also what is no number
    owner = np.repeat(np.arange(len(lengths)), lengths)
    good = (lengths > 0) & (np.bincount(owner[bad], minlength=len(lengths)) == 0)
    return np.nonzero(good)[0], lengths[good], scaled[good[owner]].astype(np.int64) + SHIFT


def sums(df: DataFrame, vec_col: str) -> tuple[int, list[int]]:
    """Number of vectors of the most frequent length, and their exact sums by dimension."""

    def run(batches):
        found: dict[int, tuple[int, list[int]]] = {}
        for b in batches:
            _, lengths, flat = usable(b.column(0))
            starts = np.cumsum(lengths) - lengths
            for d in np.unique(lengths).tolist():
                x = flat[starts[lengths == d][:, None] + np.arange(d)]
                total = [h * (1 << LIMB) + low for h, low in zip((x >> LIMB).sum(axis=0).tolist(), (x & ((1 << LIMB) - 1)).sum(axis=0).tolist())]
                n, old = found.get(d, (0, [0] * d))
                found[d] = n + len(x), [a + c for a, c in zip(old, total)]
        for d, (n, total) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d), pa.array(range(d)), pa.array([n] * d), pa.array(map(Decimal, total), pa.decimal128(38, 0))], names=["d", "i", "n", "s"])

    parts = df.select(F.col(vec_col)).mapInArrow(run, "d long, i long, n long, s decimal(38,0)")
    rows = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    most = rows.agg(F.max(F.struct("n", "d"))).first()[0]
    if most is None:
        return 0, []
    kept = {r["i"]: int(r["s"]) for r in rows.where(F.col("d") == most["d"]).collect()}  # one row a dimension
    return most["n"], [kept[i] for i in range(most["d"])]


def exact_gram(x: np.ndarray) -> list[list[int]]:
    """x.T @ x of a matrix of longs, exactly."""
    d = x.shape[1]
    out = np.zeros((d, d), object)
    sign, rest, limbs = np.sign(x), np.abs(x), []
    while not limbs or rest.any():
        limbs.append((sign * (rest & ((1 << LIMB) - 1))).astype(float))
        rest = rest >> LIMB
    block = EXACT >> (2 * LIMB)
    for at in range(0, len(x), block):
        part = [m[at : at + block] for m in limbs]
        for i, a in enumerate(part):
            for j, b in enumerate(part):
                out += (a.T @ b).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return out.tolist()


def covariance(df: DataFrame, vec_col: str, n: int, total: list[int]) -> np.ndarray:
    """Covariance of the fit list, divisor n. Vectors are centred at the rounded mean before they are multiplied; what the mean
    was rounded by is taken out exactly."""
    d = len(total)
    near = [round(Fraction(s, n)) for s in total]
    centre = np.array(near, np.int64)
    above = [(i, j) for i in range(d) for j in range(i, d)]

    def run(batches):
        gram = None
        for b in batches:
            _, lengths, flat = usable(b.column(0))
            x = flat[np.repeat(lengths == d, lengths)].reshape(-1, d) - centre
            part = exact_gram(x)
            gram = part if gram is None else [[a + c for a, c in zip(p, q)] for p, q in zip(gram, part)]
        if gram is not None:
            values = pa.array([Decimal(gram[i][j]) for i, j in above], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(above))), values], names=["at", "v"])

    parts = df.select(F.col(vec_col)).mapInArrow(run, "at long, v decimal(38,0)")
    left = [s - n * c for s, c in zip(total, near)]
    out = np.zeros((d, d))
    for at, v in parts.groupBy("at").agg(F.sum("v")).collect():  # one row a pair of dimensions
        i, j = above[at]
        out[i, j] = out[j, i] = float(Fraction(n * int(v) - left[i] * left[j], n * n))
    return out


# eigenvalues in an interval


def inertia(m: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix, by Sylvester's law: the signs of the pivots, of one or two rows each,
    of a diagonally pivoted factorisation."""
    a, n, at, positive = m.copy(), len(m), 0, 0
    ratio = (1 + np.sqrt(17)) / 8
    while at < n:
        rest = a[at:, at:]
        diagonal = np.abs(np.diagonal(rest))
        p = int(np.argmax(diagonal))
        off = np.abs(rest - np.diag(np.diagonal(rest)))
        r, c = divmod(int(np.argmax(off)), len(rest))
        size = 1 if diagonal[p] >= ratio * off[r, c] else 2
        if size == 1 and diagonal[p] == 0:
            break  # nothing but zeros is left
        for k, other in enumerate([p] if size == 1 else sorted((r, c))):
            rest[[k, other]] = rest[[other, k]]
            rest[:, [k, other]] = rest[:, [other, k]]
        pivot = rest[:size, :size]
        positive += int((np.linalg.eigvalsh(pivot) > 0).sum()) if size == 2 else int(pivot[0, 0] > 0)
        rest[size:, size:] -= rest[size:, :size] @ np.linalg.solve(pivot, rest[:size, size:])
        at += size
    return positive


def interval(v: np.ndarray, wanted: int) -> tuple[float, float, int]:
    """(low, high, count): an interval above low that holds the `wanted` largest eigenvalues, and as few more as a few halvings
    tell, and how many it holds."""
    d = len(v)
    high = float(np.max(np.sum(np.abs(v), axis=1)) * (1 + 1e-9))  # no eigenvalue is beyond
    above = lambda s: inertia(v - s * np.eye(d))
    low, top, held = -high * 1e-9, high, above(-high * 1e-9)
    for _ in range(60):
        if held == wanted or top - low <= 1e-7 * high:
            break
        mid = (low + top) / 2
        n = above(mid)
        low, top, held = (mid, top, n) if n >= wanted else (low, mid, held)
    return low, high, held


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The `count` eigenvalues between low and high, falling, and unit eigenvectors as columns. Raises where they can't be found
    whole."""
    d = len(v)
    at, weights = np.polynomial.legendre.leggauss(POINTS)
    turn = np.pi / 2 * (at + 1)  # the upper half; the lower one gives the conjugates
    middle, radius = (low + high) / 2, (high - low) / 2
    shifts = [(middle + radius * np.exp(1j * t), w * radius * np.exp(1j * t) / 2) for t, w in zip(turn, weights)]
    rng = np.random.default_rng(seed)
    size = min(d, max(count + 2, (3 * count + 1) // 2))
    while True:
        y, settled = rng.standard_normal((d, size)), False
        for _ in range(ROUNDS):
            q = np.zeros((d, size))
            for z, w in shifts:
                q += (w * np.linalg.solve(z * np.eye(d) - v, y.astype(complex))).real
            u, s, _ = np.linalg.svd(q, full_matrices=False)
            u = u[:, s > s[0] * 1e-14]
            values, w = np.linalg.eigh(u.T @ v @ u)
            x = u @ w
            inside = (values > low) & (values < high)
            off = np.linalg.norm(v @ x - x * values, axis=0)
            if inside.sum() == count and off[inside].max(initial=0) <= 8 * EPS * d * high:
                if settled:  # one projection more has taken the residuals on to where they stay
                    order = np.argsort(-values[inside], kind="stable")
                    return values[inside][order], x[:, inside][:, order]
                settled = True
            y = x if x.shape[1] == size else np.hstack([x, rng.standard_normal((d, size - x.shape[1]))])
        if size == d:
            raise RuntimeError(f"the interval ({low}, {high}) holds {count} eigenvalues, of which {int(inside.sum())} were found")
        size = min(d, 2 * size)


def leading(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues of a covariance that are positive beyond rounding, falling, and their unit eigenvectors as
    columns, each with its largest coordinate positive."""
    d = len(v)
    scale = float(np.abs(v).max(initial=0))
    if scale == 0:
        return np.zeros(0), np.zeros((d, 0))
    low, high, count = interval(v / scale, min(wanted, d))
    values, vectors = feast(v / scale, low, high, count)
    keep = np.arange(len(values)) < wanted
    keep &= values > d * EPS * values[0]
    values, vectors = values[keep], vectors[:, keep]
    vectors /= np.linalg.norm(vectors, axis=0)
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return values * scale, vectors * signs


# whitening


def _centred(flat: np.ndarray, lengths: np.ndarray, n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray, list]:
    """(which rows have the fit's length, x - S/n, deviations) of a batch."""
    d = len(total)
    held = lengths == d
    x = flat[np.repeat(held, lengths)].reshape(-1, d)
    most = int(np.abs(x).max(initial=0))
    if d * (n * most + max(map(abs, total))) ** 2 < 1 << 63:
        apart = n * x - np.array(total, np.int64)
        deviation = (apart * apart).sum(axis=1).tolist()
    else:
        apart = n * x.astype(object) - np.array(total, object)
        deviation = [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]
    return held, (apart / n).astype(float), deviation


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), one per usable vector and component.

    identity_error is measured: the whitened vectors of the fit list are read once for their own covariance."""
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    df = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"))
    n, total = sums(df, "embedding")
    if not n:
        return df.sparkSession.createDataFrame([], out)
    v = covariance(df, "embedding", n, total)
    values, vectors = leading(v, components)
    k = len(values)
    if not k:
        return df.sparkSession.createDataFrame([], out)
    turned = vectors / np.sqrt(values)
    explained = (values / np.trace(v)).tolist()

    def run(batches):
        for b in batches:
            rows, lengths, flat = usable(b.column(1))
            held, x, deviation = _centred(flat, lengths, n, total)
            ids = b.column(0).take(pa.array(rows[held]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(deviation, pa.int64()), pa.array(list(x @ turned), pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])

    white = stored(df.mapInArrow(run, "vec_id long, deviation long, w array<double>"))
    means = white.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(k)]).first()
    centred = [F.col("w")[i] - F.lit(means[i]) for i in range(k)]
    apart = white.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    error = max(abs(apart[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i, k))
    return white.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*map(F.lit, explained)), F.col("at") + 1).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
