"""Several incremental batches over one silver DataFrame, without writing.

Batch ``k`` sees the rows landed in batches ``1..k``; its window is
``(mark_{k-1}, max(landed_k)]`` and its mark is the window max (unchanged when
the window is empty).  Dimensions grow batch by batch: each batch's new
members are keyed after the max key of the union of the earlier batches.
The same steps against committed Parquet tables are in
``constella.plans.pipeline``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from constella import schemas as S
from constella.operators import (
    Lookup,
    bridge_rows,
    distinct_values,
    exploded_values,
    fact_rows,
    new_date_members,
    new_entity_members,
    new_fact_rows,
    new_members,
    one_row_per_id,
    with_sentinels,
)
from constella.operators.window import incremental_window
from constella.plans.concurrent import run_all
from constella.session import materialize
from constella.sources.literal import empty_table

TS = "date_uploaded"
SENTINEL_YEARS = (4000,)          # fixed value: sentinel member of the year dimension
FACT_SOURCE = ["imdb_code", "slug", "date_uploaded", "language", "runtime", "rating", "year"]
FACT_COLUMNS = [f.name for f in S.FACT_MOVIES.fields]


def batch_windows(silver: DataFrame, n_batches: int, ts: str = TS,
                  landing: str = "landing", lookback: str | None = None) -> list[DataFrame]:
    """Window of every batch.  Each batch's upper bound and mark are computed once -- one scalar each to the driver,
    as a run does -- so the many steps reading a window do not re-run the bound aggregates."""
    windows, mark = [], None
    for k in range(1, n_batches + 1):
        landed = silver.filter(F.col(landing) <= k)
        upper = landed.agg(F.max(ts)).first()[0]
        windows.append(incremental_window(landed, ts, last=mark, upper=upper, lookback=lookback))
        top = windows[-1].agg(F.max(ts)).first()[0]
        mark = top if top is not None else mark
    return windows


def empty(spark, schema: StructType) -> DataFrame:
    """An empty table with ``schema`` whose size statistics are zero, so joins
    against it plan as broadcasts (see ``sources.literal``)."""
    return empty_table(spark, schema)


def grow_states(windows: Sequence[DataFrame], start: DataFrame,
                step: Callable[..., DataFrame],
                cut: bool = True) -> list[DataFrame]:
    """``states[k]`` = table after batch k (``states[0]`` = ``start``), where
    ``step(window, table_so_far)`` returns the rows batch k inserts.  With
    ``cut`` each batch's rows are written (Parquet in the shared folder), as
    a committed run writes them, so later batches read a table with real
    statistics instead of re-planning the earlier batches."""
    states = [start]
    for w in windows:
        rows = step(w, states[-1])
        if cut:
            rows = materialize(rows, name="batch-rows")
        states.append(states[-1].unionByName(rows))
    return states


def grow(windows, start, step) -> DataFrame:
    return grow_states(windows, start, step)[-1]


# --- steps of one batch (also used by the committed pipeline) -----------------

def language_step(w, d):
    return new_members(distinct_values(w, "language"), d, "language", "language_key")


def runtime_step(w, d):
    return new_members(distinct_values(w, "runtime"), d, "runtime", "runtime_key")


def rating_step(w, d):
    return new_members(distinct_values(w, "rating"), d, "rating", "rating_key")


def year_step(w, d, sentinels=SENTINEL_YEARS):
    return new_members(with_sentinels(distinct_values(w, "year"), "year", sentinels), d, "year", "year_key")


def date_step(w, d, grain="timestamp", ts=TS):
    return new_date_members(w, ts, d, grain)


def movie_step(w, d, buckets=None):
    return new_entity_members(w, "slug", S.MOVIE_ATTRIBUTES, d, "movie_key", buckets)


def genre_step(w, d):
    return new_members(exploded_values(w, "genres", "genre_name"), d, "genre_name", "genre_id", "int")


def bridge_step(w, dim_genre, existing, buckets=None):
    return bridge_rows(w, "movie_id", "genres", dim_genre, "genre_name", "genre_id", existing, buckets)


def fact_lookups(dims: dict[str, DataFrame], date_source: Column | str = TS) -> list[Lookup]:
    return [
        Lookup(dims["dim_movie"], "slug", "slug", "movie_key", reduce=True),
        Lookup(dims["dim_date"], date_source, "date", "date_key", reduce=True),
        Lookup(dims["dim_language"], "language", "language", "language_key"),
        Lookup(dims["dim_runtime"], "runtime", "runtime", "runtime_key"),
        Lookup(dims["dim_rating"], "rating", "rating", "rating_key"),
        Lookup(dims["dim_released_year"], "year", "year", "year_key"),
    ]


def fact_step(w, dims, existing, order_first=("landing",), buckets=None):
    src = one_row_per_id(w, "movie_id", [*order_first, *FACT_SOURCE])
    return new_fact_rows(fact_rows(src, fact_lookups(dims), FACT_COLUMNS, probe=w, buckets=buckets),
                         existing, probe=w, buckets=buckets)


DIM_STEPS = {
    "dim_language": (S.DIM_LANGUAGE, language_step),
    "dim_runtime": (S.DIM_RUNTIME, runtime_step),
    "dim_rating": (S.DIM_RATING, rating_step),
    "dim_released_year": (S.DIM_RELEASED_YEAR, year_step),
    "dim_date": (S.DIM_DATE, date_step),
    "dim_movie": (S.DIM_MOVIE, movie_step),
    "dim_genre": (S.DIM_GENRE, genre_step),
}


FACT_DIMS = ("dim_movie", "dim_date", "dim_language", "dim_runtime", "dim_rating", "dim_released_year")


def star_states(silver: DataFrame, n_batches: int,
                tables: Sequence[str] | None = None) -> dict[str, list[DataFrame]]:
    """Gold tables after each of ``n_batches`` batches (lists indexed by k).
    Only ``tables`` (default: all) and what they depend on are built."""
    spark = silver.sparkSession
    wanted = set(tables or [*DIM_STEPS, "genre_junction", "fact_movies"])
    if "genre_junction" in wanted:
        wanted.add("dim_genre")
    if "fact_movies" in wanted:
        wanted.update(FACT_DIMS)
    ws = batch_windows(silver, n_batches)
    tasks = {name: (lambda schema=schema, step=step: grow_states(ws, empty(spark, schema), step))
             for name, (schema, step) in DIM_STEPS.items() if name in wanted}
    out = run_all(tasks)
    if "genre_junction" in wanted:
        bridge = [empty(spark, S.GENRE_JUNCTION)]
        for k, w in enumerate(ws, start=1):
            rows = materialize(bridge_step(w, out["dim_genre"][k], bridge[-1]),
                               name="batch-rows")
            bridge.append(bridge[-1].unionByName(rows))
        out["genre_junction"] = bridge
    if "fact_movies" in wanted:
        fact = [empty(spark, S.FACT_MOVIES)]
        for k, w in enumerate(ws, start=1):
            dims_k = {name: out[name][k] for name in FACT_DIMS}
            rows = fact_step(w, dims_k, fact[-1])
            if k < n_batches:
                rows = materialize(rows, name="batch-rows")
            fact.append(fact[-1].unionByName(rows))
        out["fact_movies"] = fact
    return out
