"""Join and group-total helpers.

Sizing policy (see README): a side is broadcast by a hint only when its row
count is bounded by the run configuration (one row per scenario, scheme,
indicator and year).  Group-total and level tables joined back to city rows
carry no hint: Spark broadcasts them by their size in bytes, at run time too,
and otherwise shuffles, where AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.expr import strict_sum


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by the run configuration."""
    return F.broadcast(df)


def common_keys(left: DataFrame, right: DataFrame, keys) -> list:
    """Keys of ``keys`` present on both sides (e.g. totals carry no scheme)."""
    return [k for k in keys if k in left.columns and k in right.columns]


def with_group_sums(df: DataFrame, keys, sums: dict, strict: bool = True) -> DataFrame:
    """``DT[, tot := sum(x), by = keys]`` as groupBy + join back.

    A window over ``keys`` would put a whole group in one task; the
    aggregate is combined map-side and joined back, so a hot group costs
    no more than any other.
    """
    agg = strict_sum if strict else (lambda c: F.sum(c))
    totals = df.groupBy(*keys).agg(*[agg(expr).alias(name) for name, expr in sums.items()])
    return df.join(totals, list(keys), "left")


def lookup(df: DataFrame, table: DataFrame, on, cols: dict | list, how: str = "left") -> DataFrame:
    """``X[Y, new := i.c, on = k]``: attach columns of a keyed lookup table."""
    if isinstance(cols, (list, tuple)):
        cols = {c: c for c in cols}
    on = [on] if isinstance(on, str) else list(on)
    right = table.select(*on, *[F.col(src).alias(dst) for dst, src in cols.items()])
    return df.join(right, on, how)
