"""Closed-form statistics over columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ks_p_value(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Two-sided p-value of the two-sample KS statistic ``d``.

    2 * sum over k of (-1)^(k-1) exp(-2 k^2 L^2), with Stephens' argument
    L = d * (s + 0.12 + 0.11 / s), s = sqrt(n m / (n + m)), which holds for small samples too.
    """
    n, m = n.cast("double"), m.cast("double")
    root = F.sqrt(n * m / (n + m))
    scaled = d * (root + 0.12 + 0.11 / root)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    return F.when(scaled < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series)))
