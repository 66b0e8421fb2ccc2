import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from constella import schemas as S
from constella.operators import (
    Lookup,
    absent_from,
    bridge_rows,
    clean,
    dense_keys,
    distinct_values,
    exploded_values,
    incremental_window,
    lookup_keys,
    new_date_members,
    new_entity_members,
    new_members,
    one_row_per_id,
    one_row_per_key,
    with_sentinels,
)
from constella.plans.batches import empty
from tests.helpers import movie, raw_df, torrent

T = dt.datetime


def _silver(spark, rows):
    return clean(raw_df(spark, rows))


# --- cleaning (C1, H14, H15, H18) ---------------------------------------------

def test_clean_fallbacks(spark):
    rows = [
        movie(1, date=None, unix=None, torrents=[torrent("2024-01-02 03:04:05", 1704164645)]),
        movie(2, date=None, torrents=[]),
        movie(3, date=None, torrents=None),
        movie(4, date="2024-02-01 00:00:00", unix=None, torrents=[torrent("2024-01-01 00:00:00", 99)]),
        movie(5, date="oops", unix=7),
        movie(6, date="2024-03-01 12:00:00", unix=8, genres=["a", "b"]),
    ]
    got = {r.movie_id: r for r in _silver(spark, rows).collect()}
    assert got[1].date_uploaded == T(2024, 1, 2, 3, 4, 5) and got[1].date_uploaded_unix == 1704164645
    assert got[2].date_uploaded is None and got[3].date_uploaded is None
    assert got[4].date_uploaded == T(2024, 2, 1) and got[4].date_uploaded_unix is None  # H15
    assert got[5].date_uploaded is None and got[5].date_uploaded_unix == 7                # H18
    assert got[1].genres == ["other"] and got[6].genres == ["a", "b"]
    assert _silver(spark, rows).columns == S.SILVER_COLUMNS


# --- window (C2, H8, H18, H19) ---------------------------------------------------

def test_window_bounds(spark):
    df = spark.createDataFrame(
        [(1, T(2024, 1, 1)), (2, T(2024, 1, 2)), (3, T(2024, 1, 3)), (4, None)],
        "id long, ts timestamp_ntz")
    ids = lambda w: sorted(r.id for r in w.collect())
    assert ids(incremental_window(df, "ts", last=T(2024, 1, 1))) == [2, 3]      # equal to mark excluded
    assert ids(incremental_window(df, "ts", last="2024-01-01", upper=T(2024, 1, 2))) == [2]
    assert ids(incremental_window(df, "ts")) == [1, 2, 3]                        # NULL never qualifies
    assert ids(incremental_window(df, "ts", last=T(2024, 1, 3), lookback="1 day")) == [3]
    assert ids(incremental_window(df, "ts", last=T(2024, 1, 3))) == []


def test_window_filter_reaches_parquet_scan(spark, scratch):
    df = spark.createDataFrame([(1, T(2024, 1, 1))], "id long, ts timestamp_ntz")
    df.write.parquet(f"{scratch}/t")
    w = incremental_window(spark.read.parquet(f"{scratch}/t"), "ts", last=T(2023, 1, 1), upper=T(2025, 1, 1))
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


# --- merge / anti join (S13, J3, H4) ----------------------------------------------

def test_absent_from_null_safe(spark):
    src = spark.createDataFrame([("a",), (None,), ("c",)], "k string")
    tgt = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted(r.k for r in absent_from(src, tgt, ["k"]).collect()) == ["c"]
    plain = absent_from(src, tgt, ["k"], null_safe=False).collect()
    assert sorted(map(str, (r.k for r in plain))) == ["None", "c"]


# --- keys (W1, H1, H3) -----------------------------------------------------------

@pytest.mark.parametrize("limit", [None, 1_000_000])
def test_dense_keys_matches_row_number(spark, limit):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("v")).repartition(7)
    keyed = dense_keys(df, ["v"], "k", offset=10)
    rows = sorted((r.v, r.k) for r in keyed.collect())
    assert [k for _, k in rows] == list(range(11, 5011))


def test_dense_keys_nulls_first_and_scalar_offset(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "v string")
    dim = spark.createDataFrame([(41, "x"), (42, "y")], "k long, v string")
    off = dim.select(F.max("k")).scalar()
    got = {r.v: r.k for r in dense_keys(df, ["v"], "k", off).collect()}
    assert got == {None: 43, "a": 44, "b": 45}


def test_new_members_known_and_new_slugs_keep_keys_unique(spark):
    # H1: 2 known + 1 new slug, then 2 new: all keys distinct and dense
    dim = empty(spark, S.DIM_LANGUAGE)
    b1 = spark.createDataFrame([("x",), ("y",), ("z",)], "language string")
    dim = dim.unionByName(new_members(b1, dim, "language", "language_key"))
    b2 = spark.createDataFrame([("x",), ("y",), ("w",)], "language string")
    dim = dim.unionByName(new_members(b2, dim, "language", "language_key"))
    b3 = spark.createDataFrame([("u",), ("v",)], "language string")
    dim = dim.unionByName(new_members(b3, dim, "language", "language_key"))
    rows = {r.language: r.language_key for r in dim.collect()}
    assert sorted(rows.values()) == list(range(1, 7))
    assert rows == {"x": 1, "y": 2, "z": 3, "w": 4, "u": 5, "v": 6}


def test_null_member_inserted_once(spark):
    # H4: NULL language in two batches -> one NULL member
    dim = empty(spark, S.DIM_LANGUAGE)
    for _ in range(2):
        vals = spark.createDataFrame([(None,), ("en",)], "language string")
        dim = dim.unionByName(new_members(vals, dim, "language", "language_key"))
    rows = dim.collect()
    assert len(rows) == 2 and sum(r.language is None for r in rows) == 1


def test_year_sentinel_once(spark):
    # H22: the sentinel is added once even when the data holds it
    vals = spark.createDataFrame([(2000,), (4000,)], "year long")
    v = with_sentinels(vals, "year", [4000])
    assert sorted(r.year for r in v.collect()) == [2000, 4000]
    dim = new_members(v, empty(spark, S.DIM_RELEASED_YEAR), "year", "year_key")
    again = new_members(with_sentinels(vals, "year", [4000]), dim, "year", "year_key")
    assert again.count() == 0


# --- entity dimension (C6, H2) ------------------------------------------------------

def test_one_row_per_slug(spark):
    w = _silver(spark, [movie(1, slug="s", title="B"), movie(2, slug="s", title="A"), movie(3, slug="t")])
    one = one_row_per_key(w, "slug", S.MOVIE_ATTRIBUTES).collect()
    assert sorted((r.slug, r.title) for r in one) == [("s", "A"), ("t", None)]
    dim = new_entity_members(w, "slug", S.MOVIE_ATTRIBUTES, empty(spark, S.DIM_MOVIE), "movie_key")
    assert dim.columns == [f.name for f in S.DIM_MOVIE.fields]
    assert sorted((r.slug, r.movie_key) for r in dim.collect()) == [("s", 1), ("t", 2)]


# --- date dimension (C5, H17) --------------------------------------------------------

def test_date_dimension_grains(spark):
    w = spark.createDataFrame([(T(2024, 1, 6, 1),), (T(2024, 1, 6, 2),), (None,)], "ts timestamp_ntz")
    ts_grain = new_date_members(w, "ts", empty(spark, S.DIM_DATE)).collect()
    assert len(ts_grain) == 2 and {r.date_key for r in ts_grain} == {20240106}
    day = new_date_members(w, "ts", empty(spark, S.DIM_DATE), grain="day").collect()
    assert [(r.date, r.date_key, r.is_weekend) for r in day] == [(T(2024, 1, 6), 20240106, True)]


# --- genre dimension and bridge (C7, C8, H9, H13, H4) -------------------------------

def test_genre_dimension_and_bridge(spark):
    w = _silver(spark, [
        movie(1, genres=["drama", "drama", "comedy"]),   # repeated genre -> one pair
        movie(2, genres=[]),                              # empty -> no bridge row
        movie(3, genres=None),                            # NULL -> 'other'
        movie(4, genres=["drama", None]),                 # NULL element -> member, no pair
    ])
    vals = exploded_values(w, "genres", "genre_name")
    dim = new_members(vals, empty(spark, S.DIM_GENRE), "genre_name", "genre_id", "int")
    names = {r.genre_name: r.genre_id for r in dim.collect()}
    assert names == {None: 1, "comedy": 2, "drama": 3, "other": 4}
    pairs = sorted((r.movie_id, r.genre_id) for r in bridge_rows(w, "movie_id", "genres", dim,
                                                                   "genre_name", "genre_id").collect())
    assert pairs == [(1, 2), (1, 3), (3, 4), (4, 3)]
    existing = spark.createDataFrame([(1, 2)], S.GENRE_JUNCTION)
    again = bridge_rows(w, "movie_id", "genres", dim, "genre_name", "genre_id", existing).collect()
    assert sorted((r.movie_id, r.genre_id) for r in again) == [(1, 3), (3, 4), (4, 3)]


# --- fact (C9, J5) -----------------------------------------------------------------

def test_lookup_keeps_row_count_and_null_keys(spark):
    src = spark.createDataFrame([(1, "en"), (2, None), (3, "fr")], "movie_id long, language string")
    dim = spark.createDataFrame([(1, "en"), (2, None)], S.DIM_LANGUAGE)
    out = lookup_keys(src, [Lookup(dim, "language", "language", "language_key")]).collect()
    assert sorted((r.movie_id, r.language_key) for r in out) == [(1, 1), (2, None), (3, None)]


def test_one_row_per_id_picks_lowest_batch(spark):
    schema = StructType([StructField("movie_id", LongType()), StructField("batch_id", LongType()),
                         StructField("imdb_code", StringType())])
    src = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (2, 1, "c")], schema)
    got = sorted((r.movie_id, r.imdb_code) for r in one_row_per_id(src, "movie_id", ["batch_id", "imdb_code"]).collect())
    assert got == [(1, "z"), (2, "c")]


def test_distinct_values_keeps_one_null(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("a",)], "v string")
    assert sorted(map(str, (r.v for r in distinct_values(df, "v").collect()))) == ["None", "a"]
