"""Small symmetric matrices as arrays of numbers, row by row, worked on by column expressions: no Python on executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITE = float("inf")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def entry(m: Column, i: Column | int, j: Column | int, k: int) -> Column:
    return F.get(m, i * k + j if isinstance(i, Column) or isinstance(j, Column) else F.lit(i * k + j))


def cells(k: int) -> Column:
    """(i, j) of all entries, row by row."""
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(k) for j in range(k)])


def correlation_matrix(cov: Column, valid: Column, k: int) -> Column:
    """k x k correlations from the upper triangle of covariances; rows and columns of what is not valid are those of the unit matrix.

    Null where a valid column has no variance. The other columns' inflation factors and the condition number
    are as without the columns that are not valid: a unit row is an eigenvalue of 1, which lies between the
    least and the greatest one of any correlation matrix.
    """
    triangle = {(i, j): i * k - i * (i - 1) // 2 + j - i for i in range(k) for j in range(i, k)}
    of = lambda i, j: F.get(cov, F.lit(triangle[min(i, j), max(i, j)]))
    varies = F.lit(True)
    for i in range(k):
        varies = varies & (~F.get(valid, F.lit(i)) | F.coalesce(of(i, i) > 0, F.lit(False)))

    def correlation(i: int, j: int) -> Column:
        if i == j:
            return F.lit(1.0)
        both = F.get(valid, F.lit(i)) & F.get(valid, F.lit(j))
        return F.when(both, F.try_divide(of(i, j), F.sqrt(of(i, i)) * F.sqrt(of(j, j)))).otherwise(F.lit(0.0))

    return F.when(varies, F.array(*[correlation(i, j) for i in range(k) for j in range(k)]))


def eigenvalues(matrix: Column, k: int, sweeps: int = 10) -> Column:
    """Eigenvalues of a symmetric k x k matrix, in no order: cyclic Jacobi rotations, as a fold over the pairs of rows.

    A rotation makes one entry beside the diagonal 0; what is left of the others falls quadratically from
    sweep to sweep.
    """
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p in range(k) for q in range(p + 1, k)])

    def rotated(m: Column, turn: Column) -> Column:
        p, q = turn["p"], turn["q"]
        ratio = F.try_divide(entry(m, q, q, k) - entry(m, p, p, k), 2 * entry(m, p, q, k))
        tangent = F.when(ratio.isNull(), F.lit(0.0)).otherwise(F.when(ratio < 0, -1.0).otherwise(1.0) / (F.abs(ratio) + F.sqrt(ratio * ratio + 1)))

        def turned(cs: Column) -> Column:
            c, s = cs["c"], cs["s"]
            behind = lambda i, j: (
                F.when(j == p, c * entry(m, i, p, k) - s * entry(m, i, q, k)).when(j == q, s * entry(m, i, p, k) + c * entry(m, i, q, k)).otherwise(entry(m, i, j, k))
            )
            both = lambda i, j: F.when(i == p, c * behind(p, j) - s * behind(q, j)).when(i == q, s * behind(p, j) + c * behind(q, j)).otherwise(behind(i, j))
            return F.transform(cells(k), lambda e: both(e["i"], e["j"]))

        cosine = lambda t: 1 / F.sqrt(t * t + 1)
        return let(tangent, lambda t: let(F.struct(cosine(t).alias("c"), (t * cosine(t)).alias("s")), turned))

    done = F.aggregate(F.flatten(F.array_repeat(pairs, sweeps)), matrix, rotated) if k > 1 else matrix
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get(done, i * (k + 1)))


def condition_number(matrix: Column, k: int, tolerance: float = 1e-12) -> Column:
    """Root of the ratio of the greatest and the least eigenvalue; infinite where the least is 0 but for rounding."""

    def of(values: Column) -> Column:
        least, most = F.array_min(values), F.array_max(values)
        return F.when(least <= tolerance * most, F.lit(INFINITE)).otherwise(F.sqrt(F.try_divide(most, least)))

    return F.when(matrix.isNotNull(), let(eigenvalues(matrix, k), of))


def inflation_factors(matrix: Column, k: int, tolerance: float = 1e-10, tied: float = 1e-6) -> Column:
    """Variance inflation of each column from a correlation matrix, by the sweep operator as a fold over its pivots.

    Each step takes the largest pivot that is left, which is the part of a column's variance that the columns
    before it leave. Columns without such a part follow from others: they are infinite, and so is every column
    on which one of them depends. The rest is the diagonal of the inverse, to which those add nothing.
    """
    places = F.sequence(F.lit(0), F.lit(k - 1))

    def step(state: Column, _: Column) -> Column:
        m, done = state["m"], state["done"]
        left = F.transform(places, lambda i: F.struct(F.when(F.get(done, i), F.lit(-1.0)).otherwise(entry(m, i, i, k)).alias("d"), (-i).alias("i")))

        def swept(best: Column) -> Column:
            r, d = -best["i"], best["d"]
            value = lambda i, j: (
                F.when((i == r) & (j == r), 1 / d).when(i == r, entry(m, i, j, k) / d).when(j == r, -entry(m, i, j, k) / d).otherwise(entry(m, i, j, k) - entry(m, i, r, k) * entry(m, r, j, k) / d)
            )
            after = F.struct(F.transform(cells(k), lambda e: value(e["i"], e["j"])).alias("m"), F.transform(done, lambda x, i: x | (i == r)).alias("done"))
            return F.when(d > tolerance, after).otherwise(state)

        return let(F.array_max(left), swept)

    start = F.struct(matrix.alias("m"), F.array_repeat(F.lit(False), k).alias("done"))

    def factors(state: Column) -> Column:
        m, done = state["m"], state["done"]
        depends = lambda i: F.exists(places, lambda r: ~F.get(done, r) & (F.abs(entry(m, i, r, k)) > tied))
        return F.transform(places, lambda i: F.when(~F.get(done, i) | depends(i), F.lit(INFINITE)).otherwise(entry(m, i, i, k)))

    return F.when(matrix.isNotNull(), let(F.aggregate(places, start, step), factors))
