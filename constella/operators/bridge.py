"""Many-to-many bridge rows (entity id <-> exploded member key)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constella.operators.merge import absent_from, beside, reduce_to_probe


def bridge_rows(window: DataFrame, id_col: str, array_col: str, dim: DataFrame,
                natural_key: str, key: str, existing: DataFrame | None = None,
                buckets: int | None = None) -> DataFrame:
    """``(id, key)`` pairs: explode the array, keep distinct pairs (a member
    repeated in one array or a row replayed gives one pair), resolve the member
    to its key by an inner join on the natural key (a NULL member resolves to
    nothing), and drop pairs ``existing`` already holds; the history
    of pairs is first reduced to the window's ids by a semi-join."""
    pairs = window.select(F.col(id_col), F.explode(array_col).alias(natural_key)).distinct()
    keyed = pairs.join(dim.select(natural_key, key), on=natural_key, how="inner").select(id_col, key)
    if existing is not None:
        keyed = absent_pairs(keyed, existing, window, id_col, key, buckets)
    return keyed


def absent_pairs(keyed: DataFrame, existing: DataFrame, window: DataFrame, id_col: str, key: str,
                 buckets: int | None = None) -> DataFrame:
    """Pairs that ``existing`` lacks.  The id alone is the join key, the member's key a condition beside it, so that
    pairs bucketed by id are joined where they lie; pairs without an id are compared apart, null with null."""
    known = reduce_to_probe(existing, window, [id_col], null_safe=False, buckets=buckets).alias("_known")
    named = beside(keyed.filter(F.col(id_col).isNotNull()), id_col, buckets).alias("_new")
    match = ((F.col(f"_new.{id_col}") == F.col(f"_known.{id_col}")) &
             F.col(f"_new.{key}").between(F.col(f"_known.{key}"), F.col(f"_known.{key}")))
    fresh = named.join(known, match, "left_anti").select(id_col, key)
    # of the history's pairs without an id there are as many as members
    unnamed = absent_from(keyed.filter(F.col(id_col).isNull()), existing.filter(F.col(id_col).isNull()), [key])
    return fresh.unionByName(unnamed)
