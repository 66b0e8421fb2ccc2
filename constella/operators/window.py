"""Incremental window (half-open high-water-mark slice) and the global max."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Bound = Column | str | _dt.datetime | _dt.date | None


def as_bound(df: DataFrame, ts: str, value: Bound) -> Column | None:
    """A bound value as a column of ``ts``'s type (datetimes travel as wall-clock text)."""
    if value is None or isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        # wall-clock text: no driver time zone enters the literal
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast(df.schema[ts].dataType)


def max_of(df: DataFrame, ts: str) -> Column:
    """``(select max(ts) from df)`` as a scalar subquery column: planned once,
    computed by a partial + final aggregate, no cross join, nothing collected."""
    return df.select(F.max(ts)).scalar()


def incremental_window(df: DataFrame, ts: str, last: Bound = None,
                       upper: Bound = None, lookback: str | None = None) -> DataFrame:
    """Rows with ``last < ts <= upper``.

    ``upper`` defaults to the max of ``df`` itself (the uncorrelated scalar
    subquery form); a pipeline run pins it once and passes a literal so that
    every step sees the same slice.  ``last=None`` means no lower bound (first
    run).  Rows whose ``ts`` is NULL never qualify.  ``lookback`` (an interval
    literal such as ``'2 days'``) lowers the bound to re-admit late rows; safe
    because every load downstream is insert-only.
    Both bounds are plain comparisons, so Parquet scans receive them as
    pushed filters.
    """
    c = F.col(ts)
    up = as_bound(df, ts, upper)
    cond = c <= (max_of(df, ts) if up is None else up)
    lo = as_bound(df, ts, last)
    if lo is not None:
        if lookback:
            lo = lo - F.expr(f"INTERVAL {lookback}")
        lower = c > lo
        if isinstance(last, Column):
            # a computed mark is NULL while nothing was ever loaded
            lower = lo.isNull() | lower
        cond = lower & cond
    return df.filter(cond)


def advance_mark(window: DataFrame, ts: str, last: Bound) -> Column:
    """New high-water mark: max of the window, or the old mark when the window
    is empty (an empty window must never reset the mark)."""
    lo = as_bound(window, ts, last)
    mx = max_of(window, ts)
    return mx if lo is None else F.coalesce(mx, lo)


def incremental_window_sql(spark, table: str, ts: str, last, columns: str = "*"):
    """The window as SQL text over a table or view, with named parameters
    (no values spliced into the text): ``ts > :last AND ts <= (SELECT max(ts)
    FROM t)``.  ``last`` is wall-clock text or a datetime."""
    if isinstance(last, (_dt.datetime, _dt.date)):
        last = last.isoformat(sep=" ") if isinstance(last, _dt.datetime) else last.isoformat()
    return spark.sql(
        f"SELECT {columns} FROM IDENTIFIER(:t) "
        f"WHERE {ts} > CAST(:last AS TIMESTAMP_NTZ) AND {ts} <= (SELECT max({ts}) FROM IDENTIFIER(:t))",
        args={"t": table, "last": last})
