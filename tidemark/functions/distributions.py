"""Tails of distributions as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_gamma(a: Column, x: Column, log_gamma: Column, steps: int = 400) -> Column:
    """The regularised upper incomplete gamma function Q(a, x); log_gamma is the logarithm of gamma at a.

    Below a + 1 its complement by the power series, above by the continued fraction (Lentz's way), both as
    folds of a fixed number of steps: enough for a up to some hundreds. 1 for x of 0 or less, null for null.
    """
    counts = F.sequence(F.lit(1), F.lit(steps))
    scale = F.exp(a * F.log(x) - x - log_gamma)
    one = F.lit(1.0)
    series = F.aggregate(
        counts, F.struct(one.alias("term"), one.alias("total")),
        lambda s, n: F.struct((s["term"] * x / (a + n)).alias("term"), (s["total"] + s["term"] * x / (a + n)).alias("total")),
        lambda s: s["total"],
    )
    tiny = F.lit(1e-300)
    away = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)
    d_of = lambda s, n: 1 / away(x + 2 * n + 1 - a - n * (n - a) * s["d"])
    c_of = lambda s, n: away(x + 2 * n + 1 - a - n * (n - a) / s["c"])
    first = 1 / away(x + 1 - a)
    fraction = F.aggregate(
        counts, F.struct((1 / tiny).alias("c"), first.alias("d"), first.alias("h")),
        lambda s, n: F.struct(c_of(s, n).alias("c"), d_of(s, n).alias("d"), (s["h"] * d_of(s, n) * c_of(s, n)).alias("h")),
        lambda s: s["h"],
    )
    return F.when(x <= 0, one).when(x > 1e4, F.lit(0.0)).when(x < a + 1, 1 - scale / a * series).otherwise(scale * fraction)


def chi_squared_tail(statistic: Column, degrees: Column, possible: Sequence[int]) -> Column:
    """The probability of a larger chi-squared value, for any of the possible degrees of freedom."""
    log_gamma = F.create_map(*[x for k in possible for x in (F.lit(int(k)), F.lit(math.lgamma(k / 2)))])
    return upper_gamma(degrees / 2, statistic / 2, F.try_element_at(log_gamma, degrees.cast("int")))
