"""Dense date grids and as-of reads.

A grid is built by exploding ``sequence(lo, hi)`` on each key row -- keys x
days rows, no join.  ``lo``/``hi`` are either literals (report parameters) or
scalar subqueries over the data (the whole span), so nothing is collected to
the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def span_bounds(df: DataFrame, col: str = "d") -> tuple[Column, Column]:
    """(first, last) value of ``col`` as one scalar subquery (both bounds
    come from the same subquery, which Spark executes once).  Pass the
    narrowest input that has the dates (e.g. the raw log's date column)
    rather than a derived summary, so the subquery is a one-column scan."""
    s = df.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    return s.getField("lo"), s.getField("hi")


def date_grid(keys: DataFrame, lo: Column, hi: Column, out: str = "d") -> DataFrame:
    """Every key row x every date in [lo, hi]."""
    return keys.select("*", F.explode(F.sequence(lo.cast("date"), hi.cast("date"),
                                                 F.expr("INTERVAL 1 DAY"))).alias(out))


def densify(df: DataFrame, keys: list[str], zero_cols: list[str], asof_cols: list[str] = (),
            lo: Column | None = None, hi: Column | None = None, key_rows: DataFrame | None = None,
            span_src: DataFrame | None = None) -> DataFrame:
    """Left-align ``df`` (keys, d, metrics) on the dense grid.

    ``zero_cols`` are filled with 0; ``asof_cols`` carry the latest known
    value forward (running max of a cumulative column = as-of read), 0 before
    the first known value.  Rows before ``lo`` still feed the as-of values.
    A null key is a key of its own, with its own grid.
    The default span is that of ``span_src`` (default ``df``).
    """
    data_lo, data_hi = (lo, hi) if lo is not None and hi is not None and not asof_cols else span_bounds(span_src if span_src is not None else df)
    lo = data_lo if lo is None else lo
    hi = data_hi if hi is None else hi
    kr = key_rows if key_rows is not None else df.select(*keys).distinct()
    grid_lo = F.least(lo.cast("date"), data_lo) if asof_cols else lo
    grid = date_grid(kr, grid_lo, hi)
    metrics = [*zero_cols, *asof_cols]
    found = df.select(*[F.col(k).alias(f"_{k}") for k in [*keys, "d"]], *metrics)
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("d") == F.col("_d")]
    out = grid.select(*keys, "d").join(found, on, "left")
    sel = [*keys, "d"] + [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in zero_cols]
    if asof_cols:
        w = Window.partitionBy(*keys).orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
        sel += [F.coalesce(F.max(c).over(w), F.lit(0)).alias(c) for c in asof_cols]
    res = out.select(*sel)
    if asof_cols:
        res = res.where(F.col("d") >= lo.cast("date"))
    return res


def ffill(df: DataFrame, keys: list[str], col: str, order: str = "d") -> DataFrame:
    """Carry the last non-null value of ``col`` forward."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(col, ignorenulls=True).over(w))
