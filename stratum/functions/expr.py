"""Null, zero and rounding rules shared by every operator.

The rules follow the reference's R semantics, decided once here:

* ``strict_sum``: a grouped sum with one missing value is missing (R ``sum``
  without ``na.rm``); a group with no rows sums to 0.
* ``ratio``: an unguarded division; x/0 and 0/0 give NULL instead of Inf/NaN.
* ``ratio0``: the division whose missing result is replaced by 0
  (``is.na(x) -> 0``); x/0 with x != 0 stays NULL (R would give Inf).
* ``clip0``: ``pmax(0, x)`` that keeps NULL.
* ``half_even``: R ``round(x)`` at 0 digits (banker's rounding), i.e. ``rint``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c) -> Column:
    c = col_of(c)
    return c.isNull() | F.isnan(c)


def strict_sum(c) -> Column:
    """Sum that is NULL when any input row is NULL; 0 for zero rows."""
    c = col_of(c)
    return F.when(F.count(F.lit(1)) > F.count(c), F.lit(None).cast("double")) \
        .otherwise(F.coalesce(F.sum(c), F.lit(0.0)))


def cond_sum(cond: Column, c) -> Column:
    """``DT[cond, sum(x)]``: filtered sum in the same pass, 0 when no row matches."""
    return F.coalesce(F.sum(F.when(cond, col_of(c))), F.lit(0.0))


def ratio(n, d) -> Column:
    """Guarded ``n / d``: NULL when d is 0 or either side is NULL."""
    n, d = col_of(n), col_of(d)
    return F.when(d != 0, n / d)


def ratio0(n, d) -> Column:
    """``n / d`` with missing -> 0: NULL/NaN operand -> 0, 0/0 -> 0, x/0 -> NULL."""
    n, d = col_of(n), col_of(d)
    return (F.when(is_missing(n) | is_missing(d), F.lit(0.0))
            .when(d == 0, F.when(n == 0, F.lit(0.0)))
            .otherwise(n / d))


def clip0(c) -> Column:
    """``pmax(0, x)`` keeping NULL (Spark's greatest would turn NULL into 0)."""
    c = col_of(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), c))


def half_even(c) -> Column:
    """R ``round(x)``: round half to even, as double."""
    return F.rint(col_of(c))
