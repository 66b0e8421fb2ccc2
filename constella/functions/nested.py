"""Nested-value helpers: safe first element, default arrays, text timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_element(array_col: str | Column, field: str | None = None) -> Column:
    """``array[0]`` (optionally ``.field``) that is NULL -- not an error under
    ANSI mode -- for NULL or empty arrays."""
    elem = F.get(_col(array_col), F.lit(0))
    return elem.getField(field) if field else elem


def default_array(array_col: str | Column, default: str = "other",
                  empty_as_default: bool = False) -> Column:
    """NULL array -> ``[default]``.  An empty array stays empty (and then
    yields no exploded rows) unless ``empty_as_default`` is set."""
    c = _col(array_col)
    fallback = F.array(F.lit(default))
    if empty_as_default:
        return F.when(c.isNull() | (F.size(c) == 0), fallback).otherwise(c)
    return F.coalesce(c, fallback)


def parse_timestamp(text_col: str | Column) -> Column:
    """Text -> ``timestamp_ntz``; malformed text becomes NULL instead of failing."""
    return _col(text_col).try_cast("timestamp_ntz")
