"""Small literal tables built inside the JVM (no Python worker, no RDD of
Python objects): inline rows such as sentinel members or a state row, and
empty tables of a given schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, MapType, StructType, TimestampNTZType


def _from_id(t: DataType) -> Column:
    # derived from Range(0).id, so Catalyst cannot fold the column to a
    # constant (a folded NULL would turn an equi-join into a nested loop)
    if isinstance(t, TimestampNTZType):
        return F.timestamp_seconds(F.col("id")).cast(t)
    if isinstance(t, DateType):
        return F.date_from_unix_date(F.col("id").cast("int"))
    if isinstance(t, (ArrayType, MapType, StructType)):
        return F.lit(None).cast(t)                      # never a join key here
    return F.col("id").cast(t)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, ``schema``'s columns, zero-size statistics (broadcastable)."""
    return spark.range(0).select(*[_from_id(f.dataType).alias(f.name) for f in schema.fields])


def _lit(v, t: DataType) -> Column:
    if v is None:
        return F.lit(None).cast(t)
    if isinstance(t, TimestampNTZType) and isinstance(v, dt.datetime):
        return F.lit(v.isoformat(sep=" ")).cast(t)      # wall-clock text: no driver time zone
    return F.lit(v).cast(t)


def literal_rows(spark: SparkSession, schema: StructType, rows: Sequence[Sequence[object]]) -> DataFrame:
    """``rows`` (tuples in ``schema`` order) as a DataFrame."""
    if not rows:
        return empty_table(spark, schema)
    structs = [F.struct(*[_lit(v, f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
