"""Insert-only merge = anti-join against the target on the merge keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _match(left: str, right: str, keys: Sequence[str], null_safe: bool):
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    return reduce(lambda a, b: a & b, [eq(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys])


def beside(df: DataFrame, key: str, buckets: int | None) -> DataFrame:
    """``df`` dealt out as a table bucketed by ``key`` lies.  Without it Spark shuffles the table instead where ``df``
    is already partitioned by the key (after an aggregate) into more parts than there are buckets."""
    return df if buckets is None else df.repartition(buckets, key)


def reduce_to_probe(target: DataFrame, probe: DataFrame, keys: Sequence[str],
                    null_safe: bool = True, buckets: int | None = None) -> DataFrame:
    """``target`` rows whose ``keys`` occur in ``probe`` -- a superset of what
    any anti-join of the probe's rows against ``target`` can match.  A plain
    semi-join on the anti-join's keys: where the probe's size allows it, Spark
    broadcasts it and the history is filtered map-side; otherwise both joins
    share one exchange.  ``buckets``: those of a target bucketed by its key."""
    keys = list(keys)
    t = target.alias("_t")
    p = beside(probe.select(*keys).distinct(), keys[0], buckets).alias("_p")
    return t.join(p, on=_match("_t", "_p", keys, null_safe), how="left_semi").select(
        *[F.col(f"_t.{c}") for c in target.columns])


def absent_from(src: DataFrame, target: DataFrame, keys: Sequence[str],
                null_safe: bool = True) -> DataFrame:
    """Rows of ``src`` whose ``keys`` do not occur in ``target``.

    ``null_safe`` matches NULL with NULL (``<=>``), so a NULL member is inserted
    at most once; Spark still plans ``<=>`` as an equi-join (hash or sort-merge,
    broadcast when the target is small), never as a nested loop.
    """
    keys = list(keys)
    if not null_safe:
        return src.join(target.select(*keys), on=keys, how="left_anti")
    s = src.alias("_src")
    t = target.select(*keys).alias("_tgt")
    return s.join(t, on=_match("_src", "_tgt", keys, True), how="left_anti").select(
        *[F.col(f"_src.{c}") for c in src.columns])


def absent_by_key(src: DataFrame, target: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """As null-safe ``absent_from`` on one key, but joined by plain equality, which a target bucketed (or otherwise
    partitioned) by ``key`` meets without a shuffle; ``<=>`` would shuffle it.  An outer join, since Spark moves an
    anti-join below the dealing out of its left side.  Whether the target has a NULL key is a scalar subquery of its
    own, whose filter reaches the scan."""
    has_null = target.filter(F.col(key).isNull()).agg(F.count(F.lit(1)) > 0).scalar()
    known = target.select(key, F.lit(True).alias("_known"))
    return (beside(src, key, buckets).join(known, on=key, how="left")
               .filter(F.col("_known").isNull() & (F.col(key).isNotNull() | ~has_null)).select(*src.columns))


def insert_only(src: DataFrame, target: DataFrame, keys: Sequence[str],
                null_safe: bool = True) -> DataFrame:
    """Rows a ``MERGE ... WHEN NOT MATCHED THEN INSERT *`` would add, in the
    target's column order.  Writing them is the caller's (append) step."""
    rows = absent_from(src, target, keys, null_safe=null_safe)
    return rows.select(*target.columns)
