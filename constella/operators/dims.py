"""Incremental dimensions: distinct members of the window that the dimension
does not hold yet, numbered after the dimension's current max key.

Every variant is distinct -> null-safe anti-join -> dense keys.  DISTINCT and
the one-row-per-key reduction are aggregates with a map-side partial step, so
a value that fills a third of the window is collapsed before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from constella.functions.dates import DATE_ATTRIBUTES, date_attributes, date_grain
from constella.operators.keys import dense_keys, key_offset
from constella.operators.merge import absent_by_key, absent_from
from constella.sources.literal import literal_rows


def distinct_values(window: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """``select distinct(column) as alias`` (NULL kept as one value)."""
    return window.select(F.col(column).alias(alias or column)).distinct()


def exploded_values(window: DataFrame, array_col: str, alias: str) -> DataFrame:
    """Distinct elements of an array column (NULL and empty arrays add nothing)."""
    return window.select(F.explode(array_col).alias(alias)).distinct()


def one_row_per_key(window: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """One row per natural key: the attribute tuple that sorts first (NULLs
    first).  ``min(struct)`` aggregates partially on the map side, so a hot key
    never lands in one task as a whole."""
    return (window.groupBy(key)
                  .agg(F.min(F.struct(*attrs)).alias("_attrs"))
                  .select(key, *[F.col(f"_attrs.{a}").alias(a) for a in attrs]))


def new_members(values: DataFrame, dim: DataFrame, natural_key: str, key: str,
                key_type: str = "bigint") -> DataFrame:
    """Members of ``values`` (unique on ``natural_key``) absent from ``dim``,
    keyed ``max(dim.key) + 1, + 2, ...`` in natural-key order; columns in the
    dimension's order."""
    fresh = absent_from(values, dim, [natural_key])
    keyed = dense_keys(fresh, [natural_key], key, key_offset(dim, key), key_type)
    return keyed.select(*dim.columns)


def with_sentinels(values: DataFrame, column: str, sentinels: Sequence[object]) -> DataFrame:
    """``values UNION ALL sentinel rows``, de-duplicated."""
    if not sentinels:
        return values
    schema = StructType([StructField(column, values.schema[column].dataType, True)])
    extra = literal_rows(values.sparkSession, schema, [(s,) for s in sentinels])
    return values.select(column).unionByName(extra).distinct()


def new_date_members(window: DataFrame, ts: str, dim: DataFrame,
                     grain: str = "timestamp") -> DataFrame:
    """Date-dimension rows for timestamps (or days) not in ``dim`` yet.
    The key is derived (``yyyyMMdd``), not numbered."""
    days = (window.select(date_grain(ts, grain).alias("date"))
                  .where(F.col("date").isNotNull())
                  .distinct())
    fresh = absent_from(days, dim, ["date"], null_safe=False)
    attrs = date_attributes("date")
    return fresh.select(*[attrs[c].alias(c) for c in DATE_ATTRIBUTES])


def new_entity_members(window: DataFrame, natural_key: str, attrs: Sequence[str],
                       dim: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """Multi-attribute dimension (the movie): one row per natural key, then
    only keys absent from ``dim``, numbered after its max key.  The dimension
    grows with history; one bucketed by its natural key isn't shuffled."""
    fresh = absent_by_key(one_row_per_key(window, natural_key, attrs), dim, natural_key, buckets)
    return dense_keys(fresh, [natural_key], key, key_offset(dim, key)).select(*dim.columns)
