"""Random variates as Column expressions over draws from (0, 1)."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


# Larger means want more branches than an expression should have.
MOST_POISSON_MEAN = 200.0


def normal(u1: Column, u2: Column, mean: float, std: float) -> Column:
    """Box-Muller, cosine branch."""
    radius = F.sqrt(F.lit(-2.0) * F.log(u1))
    return F.lit(mean) + F.lit(std) * (radius * F.cos(F.lit(2.0 * math.pi) * u2))


def lognormal(u1: Column, u2: Column, mean: float, std: float) -> Column:
    return F.exp(normal(u1, u2, mean, std))


def uniform(u: Column, low: float, high: float) -> Column:
    return F.lit(low) + F.lit(high - low) * u


def beta(us: list[Column], a: int) -> Column:
    """Beta(a, b) with whole a, b: the a-th smallest of a + b - 1 uniforms."""
    return F.sort_array(F.array(*us))[a - 1]


def poisson(u: Column, mean: float) -> Column:
    """Inverse of the distribution function, up to the first value whose mass
    above a 32-bit draw cannot reach."""
    steps = poisson_steps(mean)
    ladder = F.when(u <= F.lit(steps[0]), F.lit(0))
    for k, step in enumerate(steps[1:], start=1):
        ladder = ladder.when(u <= F.lit(step), F.lit(k))
    return ladder.otherwise(F.lit(len(steps))).cast("bigint")


def poisson_steps(mean: float) -> list[float]:
    """Cumulative probabilities up to the first that a 32-bit draw cannot
    exceed. There are about ``mean + 7 * sqrt(mean)`` of them, each a branch of
    the expression, so a mean beyond ``MOST_POISSON_MEAN`` raises."""
    if not 0.0 <= mean <= MOST_POISSON_MEAN:
        raise ValueError(f"a Poisson mean from 0 to {MOST_POISSON_MEAN}, not {mean}")
    steps, term, total, k = [], math.exp(-mean), 0.0, 0
    while not steps or 1.0 - total >= 2.0**-33:
        if k:
            term *= mean / k
        total += term
        steps.append(total)
        k += 1
    return steps


def weighted_choice(u: Column, values: list, weights: list[float]) -> Column:
    """Pick a value with the given probability, by cumulative weight."""
    total, ladder = 0.0, F
    for value, weight in zip(values[:-1], weights[:-1]):
        total = round(total + weight, 12)
        ladder = ladder.when(u < F.lit(total), F.lit(value))
    return ladder.otherwise(F.lit(values[-1]))


def choice(u: Column, values: list) -> Column:
    """Pick one of the values with equal probability."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.floor(u * F.lit(len(values))) + 1).cast("int"))
