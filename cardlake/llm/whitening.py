"""PCA whitening of embeddings by spectrum slicing.

Each entry c becomes the whole number x = floor(64 c) + 1000000, and the fit
list holds each distinct x vector once.  Spark counts it, sums it, and adds up
the products of x less the whole part of its mean, all in whole numbers, so
the covariance does not depend on the order of rows: the part of the mean below
one is taken off in whole numbers too, before the one division by n squared.
Only sums of dim x dim values reach the driver.

The leading eigenvalues of that small matrix are found one by one.  An LDLT
factorisation (symmetric pivoting, blocks of one and two) of the shifted
covariance has as many positive pivots as there are eigenvalues above the
shift.  Bisection on these counts isolates an eigenvalue; Rayleigh quotient
iteration started inside the isolating interval converges cubically, and the
counts on both sides of the result certify its number.  Eigenvalues that lie
closer than CLUSTER of their size are handled as one: iteration runs in the
complement of the vectors found, so a multiple eigenvalue gets orthonormal
vectors.

Defined cases: vectors that are null or hold a null or a non-finite entry take
no part; repeated rows are each returned and fitted once; a null vec_id is
kept; a vector shorter than the longest counts as filled up with 0 at its end;
components whose eigenvalue is zero to double precision (fewer distinct
vectors than dimensions, constant dimensions) have no whitened value and are
not returned, so one distinct vector, empty vectors or an empty table give no
rows; tied eigenvalues are numbered as they are found; columns of other names
are not read.  An entry beyond 2^46, or a deviation that no long can hold, is
an error, not a dropped row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import Scratch, prepare, table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Eigenvalues closer than this part of their size are handled together.
CLUSTER = 1e-9
LARGEST = 2.0 ** 46
_ROOT = (1 + 17 ** 0.5) / 8


# ------------------------------------------------------------ spectrum of a small matrix
def positive_pivots(a: np.ndarray) -> int:
    """How many eigenvalues of the symmetric `a` are positive: those of D in its
    pivoted LDLT factorisation (Sylvester's law of inertia)."""
    a, k, n, positive = a.copy(), 0, len(a), 0
    while k < n:
        rest = a[k:, k:]
        column = np.abs(rest[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        most = column[r - 1] if r else 0.0
        pivot, wide = 0, False
        if abs(rest[0, 0]) < _ROOT * most:
            row = np.abs(rest[r])
            row[r] = 0.0
            if abs(rest[0, 0]) * row.max() < _ROOT * most * most:
                pivot, wide = r, abs(rest[r, r]) < _ROOT * row.max()
        place = 1 if wide else 0
        if pivot != place:
            rest[[place, pivot]] = rest[[pivot, place]]
            rest[:, [place, pivot]] = rest[:, [pivot, place]]
        if wide:
            positive += 1  # such a block has a negative determinant
            rest[2:, 2:] -= rest[2:, :2] @ np.linalg.solve(rest[:2, :2], rest[:2, 2:])
            k += 2
        else:
            positive += rest[0, 0] > 0
            if rest[0, 0] != 0:
                rest[1:, 1:] -= np.outer(rest[1:, 0], rest[1:, 0] / rest[0, 0])
            k += 1
    return int(positive)


def leading(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The up to `most` largest eigenvalues of the covariance `v`, falling, and
    their unit eigenvectors (columns); those that are zero to double precision
    are left out."""
    d = len(v)
    scale = float(np.abs(v).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(0), np.zeros((d, 0))
    a, identity = v / scale, np.eye(d)
    top = float(np.abs(a).sum(axis=1).max())  # no eigenvalue lies beyond
    zero = d * np.finfo(float).eps * top
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = positive_pivots(a - shift * identity)
        return counts[shift]

    def margin(value: float) -> float:
        return max(CLUSTER * value, 8 * zero)

    def certified(value: float, k: int) -> bool:
        """Numbers up to k lie above the value less a margin, fewer than k above it and a margin."""
        return above(value - margin(value)) >= k > above(value + margin(value))

    most = min(most, above(zero))
    found, random = np.zeros((d, 0)), np.random.default_rng(11)
    values: list[float] = []
    while len(values) < most:
        k = len(values) + 1
        low, high = zero, 1.01 * top + zero
        for shift in counts:  # what earlier counts say about number k
            if counts[shift] >= k:
                low = max(low, shift)
            else:
                high = min(high, shift)
        # until the interval holds number k alone, apart from a cluster
        while above(low) > k or high - low > 1e-3 * high:
            if high - low <= margin(high) / 8:
                break
            middle = (low + high) / 2
            if above(middle) >= k:
                low = middle
            else:
                high = middle
        value, vector = _rayleigh(a, (low + high) / 2, zero, found, random)
        if not certified(value, k):  # a neighbour was nearer to the middle
            while high - low > margin(high) / 8:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= k else (low, middle)
            value, vector = _rayleigh(a, (low + high) / 2, zero, found, random)
            if not certified(value, k):
                raise ArithmeticError(f"eigenvalue {k} is not certified by the counts")
        values.append(value)
        found = np.c_[found, vector]
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order] * scale, found[:, order]


def _rayleigh(a: np.ndarray, shift: float, tiny: float, found: np.ndarray, random) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from `shift`, in the complement of `found`."""
    identity = np.eye(len(a))

    def unit(x):
        for _ in range(2):
            x = x - found @ (found.T @ x)
        return x / np.linalg.norm(x)

    x, value, residual = unit(random.standard_normal(len(a))), shift, np.inf
    for step in range(60):
        try:
            y = np.linalg.solve(a - value * identity, x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue
            y = np.linalg.solve(a - (value + tiny / 3) * identity, x)
        x = unit(y / np.abs(y).max())
        if step < 2:
            continue  # inverse iteration turns x to the isolated eigenvalue first
        value = float(x @ (a @ x))
        new = float(np.linalg.norm(a @ x - value * x))
        if new == 0.0 or new >= residual / 2 and new < 1e-12:
            break
        residual = new
    return value, x


# ------------------------------------------------------------------- Spark
def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x: array<long>) of every vector that takes part."""
    e = F.transform("embedding", lambda c: c.cast("double"))
    good = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    far = F.exists("e", lambda c: F.abs(c) > LARGEST)
    whole = F.transform("e", lambda c: (F.floor(c * SCALE) + OFFSET).cast("long"))
    return (embeddings.select("vec_id", e.alias("e")).where(F.col("e").isNotNull() & good)
            .select("vec_id", F.when(far, F.raise_error(F.lit("an embedding has an entry beyond 2^46"))).otherwise(whole).alias("x")))


def _matrix(lists: pd.Series, dim: int) -> np.ndarray:
    out = np.full((len(lists), dim), OFFSET, np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _products(dim: int, mean: np.ndarray):
    """(i, j, product): sums over the task of the products of whole centred entries."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(dim)
        total = None
        for pdf in batches:
            c = _matrix(pdf["x"], dim) - mean
            if len(c) * float(np.abs(c).max(initial=0)) ** 2 < 2.0 ** 53:
                f = c.astype(float)
                add = (f.T @ f).astype(np.int64).astype(object)  # whole and exact
            else:
                c = c.astype(object)
                add = c.T @ c
            total = add if total is None else total + add
        if total is not None:
            yield pd.DataFrame({"i": upper[0], "j": upper[1], "product": [str(p) for p in total[upper]]})

    return run


def covariance(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """(n, sums by dimension, covariance) of the fit list's x."""
    width = fit.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dim")).first()
    n, dim = width["n"], width["dim"] or 0
    if not n or not dim:
        return n, [], np.zeros((0, 0))
    added = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum(F.col("c").cast("decimal(38,0)") - OFFSET).alias("s")).collect()
    sums = [OFFSET * n] * dim
    for r in added:
        sums[r["i"]] += int(r["s"])
    mean = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    rows = (fit.mapInPandas(_products(dim, mean), "i int, j int, product string")
            .groupBy("i", "j").agg(F.sum(F.col("product").cast("decimal(38,0)")).alias("product")).collect())
    v = np.zeros((dim, dim))
    for r in rows:
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = (n * int(r["product"]) - rest[i] * rest[j]) / (n * n)
    return n, sums, v


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (x - np.array([s // n for s in sums], np.int64)) - np.array([(s % n) / n for s in sums])


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exact."""
    c, rest = x - np.array([s // n for s in sums], np.int64), [s % n for s in sums]
    if (n * (float(np.abs(c).max(initial=0)) + 1)) ** 2 * x.shape[1] < 2.0 ** 62:
        d = n * c - np.array(rest, np.int64)
    else:
        d = n * c.astype(object) - np.array(rest, object)
    out = [int(s) for s in (d * d).sum(axis=1)]
    if out and max(out) >= 1 << 63:
        raise OverflowError("a deviation does not fit a long")
    return out


def _check(n: int, sums: list[int], projection: np.ndarray):
    """(i, j, product): the task's sums of products of whitened entries."""
    k = projection.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper, total, single = np.triu_indices(k), np.zeros((k, k)), np.zeros(k)
        for pdf in batches:
            w = _centred(_matrix(pdf["x"], len(sums)), n, sums) @ projection
            total += w.T @ w
            single += w.sum(axis=0)
        yield pd.DataFrame({"i": np.r_[upper[0], np.full(k, -1)], "j": np.r_[upper[1], np.arange(k)], "product": np.r_[total[upper], single]})

    return run


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of
    every vector that takes part."""
    spark = prepare(embeddings.sparkSession)
    sc = Scratch(spark)
    rows = quantised(embeddings).withColumn("vec_id", F.col("vec_id").cast("long"))
    fit = sc.write(rows.select("x").distinct(), "fit")
    n, sums, v = covariance(fit)
    values, vectors = leading(v, components)
    k = len(values)
    if k == 0:
        return spark.createDataFrame([], _RESULT)
    projection = vectors / np.sqrt(values)
    explained = values / np.trace(v)
    error = 0.0
    got = (fit.mapInPandas(_check(n, sums, projection), "i int, j int, product double")
           .groupBy("i", "j").agg(F.sum("product").alias("product")).collect())
    mean = {r["j"]: r["product"] / n for r in got if r["i"] < 0}
    for r in got:
        if r["i"] >= 0:
            error = max(error, abs(r["product"] / n - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"])))
    sc.drop("fit")

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x = _matrix(pdf["x"], len(sums))
            w = _centred(x, n, sums) @ projection
            yield pd.DataFrame({
                "vec_id": pdf["vec_id"].astype("Int64").repeat(k).array,
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                "n": n,
                "deviation": np.repeat(np.array(_deviations(x, n, sums), np.int64), k),
                "whitened": w.ravel(),
                "explained": np.tile(explained, len(x)),
                "identity_error": error,
            })

    return rows.mapInPandas(project, _RESULT)


def op11_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 leading whitened components of every vector."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
