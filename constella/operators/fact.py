"""Star lookup and the insert-only fact load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constella.operators.merge import absent_from, beside, reduce_to_probe


@dataclass(frozen=True)
class Lookup:
    """Resolve ``source`` (a column or expression of the fact source) through
    ``dim`` (unique on ``natural_key``) to ``key``.  ``reduce`` marks a
    dimension that grows with history (one member per movie or per upload
    time): it is first cut down to the probe's keys, see ``lookup_keys``."""
    dim: DataFrame
    source: str | Column
    natural_key: str
    key: str
    reduce: bool = False


def one_row_per_id(src: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """One source row per id: the smallest tuple of ``columns`` (put an ordering
    column such as ``batch_id`` first).  An aggregate, so duplicates of a hot
    id are combined map-side."""
    cols = [c for c in columns if c != id_col]
    return (src.groupBy(id_col)
               .agg(F.min(F.struct(*cols)).alias("_row"))
               .select(id_col, *[F.col(f"_row.{c}").alias(c) for c in cols]))


def lookup_keys(src: DataFrame, lookups: Sequence[Lookup], probe: DataFrame | None = None,
                buckets: int | None = None) -> DataFrame:
    """Chained left joins that add each lookup's surrogate key.  Only
    ``(natural_key, key)`` of each dimension is read; plain equality, so a NULL
    attribute gets a NULL key.  Join strategy is Spark's: small dimensions are
    broadcast when their (estimated or, under AQE, measured) size is below
    the broadcast threshold, large ones sort-merge, with AQE splitting skewed
    partitions.  A ``reduce`` lookup with a ``probe`` (a cheap superset of the
    source rows, e.g. the window) first keeps only dimension members whose
    key the probe holds (a semi-join that Spark broadcasts if the keys'
    measured size allows it)."""
    out = src
    for i, lk in enumerate(lookups):
        nk, value = f"_nk{i}", f"_value{i}"
        left = F.col(lk.source) if isinstance(lk.source, str) else lk.source
        dim = lk.dim
        if lk.reduce and probe is not None:
            dim = reduce_to_probe(dim, probe.select(left.alias(lk.natural_key)), [lk.natural_key],
                                  null_safe=False, buckets=buckets)
        d = dim.select(F.col(lk.natural_key).alias(nk), F.col(lk.key))
        out = (out.withColumn(value, left)
                  .join(d, F.col(value) == F.col(nk), "left")
                  .drop(value, nk))
    return out


def fact_rows(src: DataFrame, lookups: Sequence[Lookup], columns: Sequence[str],
              probe: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """Fact rows: source joined to every dimension, projected to ``columns``."""
    return lookup_keys(src, lookups, probe, buckets).select(*columns)


def new_fact_rows(rows: DataFrame, fact: DataFrame, id_col: str = "movie_id",
                  probe: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """Insert-only: rows whose id the fact table does not hold yet.  With a
    cheap ``probe`` of the candidate ids (e.g. the window) the fact history is
    first reduced to those ids by a semi-join.  A history in ``buckets`` by id
    isn't shuffled for either join, whatever its size."""
    if probe is not None:
        fact = reduce_to_probe(fact, probe, [id_col], null_safe=False, buckets=buckets)
    return absent_from(beside(rows, id_col, buckets), fact, [id_col], null_safe=False).select(*fact.columns)
