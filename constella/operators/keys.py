"""Dense surrogate keys without a single-partition window.

``row_number() over (order by k) + offset`` is what the keys mean, but a global
window runs in one task.  Instead: a global sort (range-partitioned, sampled
by Spark), a per-row id that encodes (partition, position), a lineage cut
(Parquet in the shared folder) so that the sort's sampled bounds can never be
re-drawn on recomputation, and a prefix sum over per-partition counts (one row
per partition: a proven bound, so it is broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constella.session import materialize

# monotonically_increasing_id(): partition index in the upper 31 bits, row
# position within the partition in the lower 33 bits.
_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _order(c: str | Column) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def dense_keys(df: DataFrame, order_by: Sequence[str | Column], key: str,
               offset: int | Column = 0, key_type: str = "bigint",
               stage_path: str | None = None) -> DataFrame:
    """Add ``key`` = 1-based rank in ``order_by`` order (NULLs first) + ``offset``.

    ``order_by`` must be a total order over ``df`` (a unique key) for the
    numbering to be deterministic.  ``offset`` may be a scalar-subquery column
    such as ``coalesce(max(key), 0)`` of the existing dimension.
    ``stage_path`` is where the sorted rows are cut (default: a fresh folder
    below the shared checkpoint folder); a retry may overwrite it.
    """
    order = [_order(c) for c in order_by]
    off = offset if isinstance(offset, Column) else F.lit(offset)
    ranked = materialize(df.orderBy(*order)
                           .withColumn("_rid", F.monotonically_increasing_id()),
                         stage_path, "keys")
    part = F.shiftright(F.col("_rid"), _POS_BITS)
    counts = ranked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(
        F.col("_part"),
        (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"),
    )
    keyed = ranked.join(F.broadcast(starts), part == F.col("_part"))
    value = F.col("_start") + F.col("_rid").bitwiseAND(F.lit(_POS_MASK)) + F.lit(1) + off
    return keyed.withColumn(key, value.cast(key_type)).drop("_rid", "_part", "_start")


def key_offset(dim: DataFrame, key: str) -> Column:
    """``coalesce(max(key), 0)`` of an existing dimension as a scalar subquery.
    The max, not ``count(*)``: a count under-counts whenever keys have gaps
    and would then hand out a key twice."""
    return dim.select(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()
