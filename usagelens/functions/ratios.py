"""Ratio and rounding helpers.

Spark 4 runs ANSI: ``x / 0`` raises.  Every ratio here goes through
``try_divide`` (NULL on a zero or NULL denominator).  Rounded percentages are
computed in exact integer arithmetic (round half up) so they do not depend on
how a binary double happens to sit next to a decimal tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den, 0 when there is nothing to divide by (display form)."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def pct_round(num: Column, den: Column, digits: int = 1, scale: int = 100) -> Column:
    """round_half_up(num * scale / den, digits) for non-negative integer
    num/den, exactly: floor((2 * num * scale * 10^k + den) / (2 * den)) / 10^k.
    NULL when den is 0."""
    k = 10 ** digits
    n = num.cast("bigint") * (2 * scale * k) + den.cast("bigint")
    d2 = den.cast("bigint") * 2
    q = F.floor(F.try_divide(n.cast("double"), d2.cast("double")))
    return F.when(den.cast("bigint") > 0, q.cast("double") / k)


def format_pct(num: Column, den: Column, digits: int = 1, empty: str = "--") -> Column:
    """Display string ``12.3%``; ``empty`` when the denominator is 0."""
    p = pct_round(num, den, digits)
    return F.when(p.isNull(), F.lit(empty)).otherwise(
        F.concat(F.format_number(p, digits), F.lit("%")))
