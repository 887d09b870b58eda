"""Small systems of linear equations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Sum of products of two arrays of doubles, as far as both reach; 0 for empty ones."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def solve(rows: Column, n: int, tolerance: float = 1e-10) -> Column:
    """Solution (array of ``n`` doubles) of a symmetric positive semidefinite system.

    ``rows`` is an array of ``n`` arrays, each a row of the matrix and its right side.  Gauss-Jordan steps along the
    diagonal; an unknown whose pivot falls below ``tolerance`` of its own diagonal element depends on those before
    it and becomes 0.
    """
    if n == 0:
        return F.array().cast("array<double>")

    def step(m: Column, k: Column) -> Column:
        pivot_row = F.get(m, k)
        pivot = F.get(pivot_row, k)
        solvable = pivot > F.lit(tolerance) * F.get(F.get(rows, k), k)

        def reduced(row: Column, i: Column) -> Column:
            factor = F.try_divide(F.get(row, k), pivot)
            scaled = F.transform(row, lambda x: F.try_divide(x, pivot))
            less = F.zip_with(row, pivot_row, lambda x, y: x - factor * y)
            alone = F.transform(row, lambda x: F.lit(0.0))
            return F.when(i == k, F.when(solvable, scaled).otherwise(alone)).otherwise(F.when(solvable, less).otherwise(row))

        return F.transform(m, reduced)

    done = F.aggregate(F.array(*[F.lit(k) for k in range(n)]), rows, step)
    return F.transform(done, lambda row: F.get(row, F.lit(n)))
