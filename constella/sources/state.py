"""Run state: one row per committed batch (page and date high-water marks, the
first live batch, zone maps).

The row of batch N is written after every table of batch N, so its presence
is the commit.  Reading the state for a (re)run of batch N uses only rows with
``batch_id < N``, which makes replaying N deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from constella import schemas as S
from constella.sources.literal import literal_rows
from constella.sources.tables import Warehouse


def read_state(wh: Warehouse, below: int | None = None) -> Row | None:
    """Latest state row (with ``batch_id < below`` when given); None before the
    first commit.  One directory is read, one row reaches the driver."""
    return wh.attach() if below is None else wh.state_row(below)


def write_state(wh: Warehouse, batch_id: int, last_date, last_page, window_rows: int,
                null_date_rows: int, late_rows: int = 0, source: str | None = None,
                zone: dict | None = None) -> None:
    zone = zone or {}
    row = (batch_id, last_date, last_page, window_rows, null_date_rows,
           dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), late_rows, source, wh.base, wh.buckets,
           *[zone.get(c) for c in ("min_date", "max_date", "min_id", "max_id", "null_ids")])
    wh.write("state", literal_rows(wh.spark, S.STATE, [row]), batch_id)


def batches_after(wh: Warehouse, below: int, bound) -> list[int]:
    """Live batches below ``below`` that may hold silver rows dated after ``bound`` (a column), by their zones.  A
    batch without a zone (written before there were any, or without dated rows) may where it has rows at all."""
    if wh.last < wh.base:
        return []
    may = F.col("max_date").isNull() & (F.col("window_rows") > 0) | (F.col("max_date") > bound)
    return [r[0] for r in wh.commits().filter((F.col("batch_id") < below) & may).select("batch_id").collect()]


def batches_with_ids(wh: Warehouse, below: int, low: int | None, high: int | None, nulls: bool) -> list[int]:
    """Live batches below ``below`` whose loaded ids may lie in ``low .. high``, or be null if ``nulls``."""
    if wh.last < wh.base:
        return []
    may = F.col("null_ids").isNull() & (F.col("window_rows") > 0)      # written before there were zones
    if low is not None:
        may = may | (F.col("min_id") <= high) & (F.col("max_id") >= low)
    if nulls:
        may = may | (F.col("null_ids") > 0)
    return [r[0] for r in wh.commits().filter((F.col("batch_id") < below) & may).select("batch_id").collect()]
