"""Least squares from sums of products, as column expressions.

The sums of a group of rows hold all that a linear model of it needs, and those of two groups add up. So
a model for any union of groups is solved from a few numbers, without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PIVOT = 1e-10  # of its own sum of squares; below, a column depends on those before it and gets no weight


def pairs(n: int) -> list[tuple[int, int]]:
    """The pairs (i, j), i <= j, of n values, in the order of their sums."""
    return [(i, j) for i in range(n) for j in range(i, n)]


def sums_of_products(inputs: Sequence[Column], target: Column) -> list[Column]:
    """Aggregates of all products of 1, the inputs and the target; none of them may be null."""
    values = [F.lit(1.0), *[x.cast("double") for x in inputs], target.cast("double")]
    return [F.sum(values[i] * values[j]) for i, j in pairs(len(values))]


def solve(sums: Column, n_inputs: int, ridge: Column | float = 0.0, used: Column | None = None) -> Column:
    """Coefficients (the constant, then one per input) that minimise the squared error plus ``ridge`` times their squares.

    ``sums`` is an array in the order of ``sums_of_products``. The constant is not penalised. ``used`` is an array<boolean>
    over the inputs; those left out, and those that depend on earlier ones, get 0.
    """
    n = n_inputs + 2
    at = {pair: k for k, pair in enumerate(pairs(n))}
    ridge = F.lit(float(ridge)) if not isinstance(ridge, Column) else ridge

    def entry(i: int, j: int) -> Column:
        found = F.get(sums, F.lit(at[min(i, j), max(i, j)]))
        return found + ridge if i == j > 0 else found

    matrix = F.array(*[F.array(*[entry(i, j) for j in range(n)]) for i in range(n - 1)])
    kept = F.concat(F.array(F.lit(True)), used) if used is not None else F.array_repeat(F.lit(True), n - 1)
    squares = F.array(*[entry(i, i) for i in range(n - 1)])

    def eliminate(m: Column, k: Column) -> Column:
        row = F.get(m, k)
        pivot = F.get(row, k)
        usable = F.get(kept, k) & (pivot > F.get(squares, k) * PIVOT)
        scaled = F.transform(row, lambda x: F.when(usable, x / pivot).otherwise(0.0))
        return F.transform(m, lambda other, i: F.when(i == k, scaled).otherwise(F.zip_with(other, scaled, lambda a, b: a - F.get(other, k) * b)))

    reduced = F.aggregate(F.sequence(F.lit(0), F.lit(n - 2)), matrix, eliminate)
    return F.transform(reduced, lambda row: F.get(row, F.lit(n - 1)))


def squared_error(sums: Column, coefficients: Column, n_inputs: int) -> Column:
    """Sum of squared errors of a linear model over the rows behind ``sums``."""
    order = pairs(n_inputs + 2)
    left, right = (F.array(*[F.lit(p[side]) for p in order]) for side in (0, 1))
    weights = F.concat(coefficients, F.array(F.lit(-1.0)))
    signs = F.zip_with(left, right, lambda i, j: F.get(weights, i) * F.get(weights, j) * F.when(i == j, 1.0).otherwise(2.0))
    total = F.aggregate(F.zip_with(sums, signs, lambda s, w: s * w), F.lit(0.0), lambda a, x: a + x)
    return F.greatest(total, F.lit(0.0))


def linear_value(coefficients: Column, inputs: Sequence[Column]) -> Column:
    """The constant plus the weighted inputs."""
    total = F.get(coefficients, F.lit(0))
    for i, x in enumerate(inputs):
        total = total + F.get(coefficients, F.lit(i + 1)) * x
    return total
