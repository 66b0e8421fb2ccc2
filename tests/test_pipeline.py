import datetime as dt

import pytest
from pyspark.sql import functions as F

from constella.plans.pipeline import RunOptions, committed, run_batch
from constella.plans.run_queries import land_standin, resolve_fact
from constella.plans.standins import CUTS_3, raw_movies
from constella.sources.state import read_state
from constella.sources.tables import Warehouse
from constella.streaming import run_stream
from tests.conftest import SF_SMALL
from tests.helpers import movie, raw_df, torrent

T = dt.datetime
GOLD = ["dim_genre", "genre_junction", "dim_movie", "dim_date", "dim_language", "dim_runtime",
        "dim_rating", "dim_released_year", "fact_movies"]


def snapshot(wh):
    return {name: sorted(map(tuple, committed(wh, name).collect()), key=repr) for name in GOLD}


def batch1(spark):
    return raw_df(spark, [
        movie(1, slug="a", date="2024-01-01 10:00:00", language="en", runtime=90, rating=7.5, year=2001,
              genres=["drama", "drama", "comedy"], title="A1"),
        movie(2, slug="a", date="2024-01-01 11:00:00", language=None, runtime=90, rating=7.5, year=2001,
              genres=[], title="A0"),                                        # same slug, other title (H2)
        movie(3, slug="b", date=None, torrents=[torrent("2024-01-02 00:00:00", 1)], language="fr",
              year=4000, genres=None),                                       # fallback date; year = sentinel
        movie(4, slug="c", date="oops", language="en"),                      # unparseable date (H18)
    ])


def batch2(spark):
    return raw_df(spark, [
        movie(5, slug="d", date="2024-01-02 00:00:00", language="en"),        # equal to the mark (H8)
        movie(6, slug="e", date="2024-01-03 00:00:00", language=None, genres=["drama", None]),
        movie(1, slug="a", date="2024-01-04 00:00:00", language="de"),        # same movie again (H20)
    ])


def new_wh(spark, scratch, name="wh"):
    return Warehouse(spark, f"{scratch}/{name}").setup()


def test_two_batches_semantics(spark, scratch):
    wh = new_wh(spark, scratch)
    r1 = run_batch(wh, batch1(spark))
    assert (r1.batch_id, r1.last_date, r1.window_rows, r1.null_date_rows) == (1, T(2024, 1, 2), 3, 1)
    r2 = run_batch(wh, batch2(spark), options=RunOptions(strict_window=True))
    assert (r2.batch_id, r2.last_date, r2.window_rows) == (2, T(2024, 1, 4), 2)

    fact = {r.movie_id: r for r in committed(wh, "fact_movies").collect()}
    assert sorted(fact) == [1, 2, 3, 6]                    # 4: NULL date, 5: at the mark
    movies = {r.slug: r for r in committed(wh, "dim_movie").collect()}
    assert set(movies) == {"a", "b", "e"} and movies["a"].title == "A0"
    assert fact[1].movie_key == fact[2].movie_key == movies["a"].movie_key
    langs = committed(wh, "dim_language").collect()
    assert sum(r.language is None for r in langs) == 1     # one NULL member over two batches
    lang = {r.language_key: r.language for r in langs}
    assert lang[fact[1].language_key] == "en"             # first version stays (H20)
    assert fact[2].language_key is None and fact[6].language_key is None
    years = sorted(r.year for r in committed(wh, "dim_released_year").collect() if r.year is not None)
    assert years == [2001, 4000]
    for name, key in [("dim_movie", "movie_key"), ("dim_language", "language_key"),
                      ("dim_genre", "genre_id"), ("dim_released_year", "year_key")]:
        keys = [r[key] for r in committed(wh, name).collect()]
        assert sorted(keys) == list(range(1, len(keys) + 1)), name
    pairs = [tuple(r) for r in committed(wh, "genre_junction").collect()]
    assert len(pairs) == len(set(pairs))
    genre = {r.genre_id: r.genre_name for r in committed(wh, "dim_genre").collect()}
    # movie 1 comes back in batch 2 without genres: its fact row stays, but the
    # bridge (new pairs of every window are appended, SURVEY C8) gains 'other'
    assert sorted(genre[g] for m, g in pairs if m == 1) == ["comedy", "drama", "other"]
    assert sorted(genre[g] for m, g in pairs if m == 3) == ["other"]
    assert not [p for p in pairs if p[0] == 2]             # empty genres: no pair (H13)


def test_empty_batch_keeps_mark_and_tables(spark, scratch):
    wh = new_wh(spark, scratch)
    run_batch(wh, batch1(spark))
    before = snapshot(wh)
    r = run_batch(wh, raw_df(spark, []))
    assert r.last_date == T(2024, 1, 2) and r.window_rows == 0
    assert snapshot(wh) == before


def test_replay_and_crash_are_idempotent(spark, scratch, monkeypatch):
    clean_wh = new_wh(spark, scratch, "clean")
    run_batch(clean_wh, batch1(spark))
    run_batch(clean_wh, batch2(spark))
    expected = snapshot(clean_wh)

    wh = new_wh(spark, scratch, "crash")
    run_batch(wh, batch1(spark))
    original = Warehouse.write

    def failing(self, name, df, b):
        if name == "fact_movies":
            raise RuntimeError("executor lost")
        return original(self, name, df, b)

    monkeypatch.setattr(Warehouse, "write", failing)
    with pytest.raises(RuntimeError):
        run_batch(wh, batch2(spark))
    monkeypatch.setattr(Warehouse, "write", original)
    assert read_state(wh)["batch_id"] == 1                  # batch 2 not committed
    run_batch(wh, batch2(spark))                            # retry
    assert snapshot(wh) == expected
    run_batch(wh, batch2(spark), batch_id=2)                # replay of a committed batch
    assert snapshot(wh) == expected


def test_split_batches_give_same_facts(spark, scratch):
    raw = raw_movies(spark, SF_SMALL, CUTS_3)
    one = new_wh(spark, scratch, "one")
    run_batch(one, raw.drop("landing"))
    three = new_wh(spark, scratch, "three")
    for k in (1, 2, 3):
        run_batch(three, raw.filter(F.col("landing") == k).drop("landing"))

    def natural(wh):
        dims = {n: committed(wh, n) for n in GOLD if n.startswith("dim_")}
        f = resolve_fact(committed(wh, "fact_movies"), dims)
        return sorted(map(tuple, f.select("movie_id", "imdb_code", "slug", "language", "runtime",
                                          "rating", "year").collect()), key=repr)

    assert natural(one) == natural(three)


def test_stream_equals_batch(spark, scratch):
    landing = land_standin(spark, SF_SMALL)
    streamed = new_wh(spark, scratch, "stream")
    run_stream(streamed, landing)
    assert read_state(streamed)["batch_id"] == 1
    run_stream(streamed, landing)                           # nothing new: no batch
    assert read_state(streamed)["batch_id"] == 1
    batch = new_wh(spark, scratch, "batch")
    run_batch(batch, raw_movies(spark, SF_SMALL).drop("landing"))
    assert snapshot(streamed) == snapshot(batch)


def test_day_grain_option(spark, scratch):
    wh = new_wh(spark, scratch)
    run_batch(wh, batch1(spark), options=RunOptions(date_grain="day"))
    dates = committed(wh, "dim_date").collect()
    assert sorted(r.date for r in dates) == [T(2024, 1, 1), T(2024, 1, 2)]
    keys = {r.movie_id: r.date_key for r in committed(wh, "fact_movies").collect()}
    assert keys[1] == keys[2] == 20240101 and keys[3] == 20240102


def test_each_batch_partition_holds_only_its_rows(spark, scratch):
    wh = new_wh(spark, scratch)
    run_batch(wh, batch1(spark))
    r2 = run_batch(wh, batch2(spark))
    for name in ("raw_data", "cleaned_data"):
        assert wh.read(name, only=1).count() == 4
        assert wh.read(name, only=2).count() == 3
    assert r2.null_date_rows == 0                          # counted for batch 2 alone


def test_catalog_tables_drop_and_reset(spark, scratch):
    from constella.plans.pipeline import committed_sql
    wh = new_wh(spark, scratch)
    wh.register_tables(prefix="t_cat")
    wh.register_tables(prefix="t_cat")                      # idempotent
    run_batch(wh, batch1(spark))
    assert committed_sql(wh, "fact_movies").count() == committed(wh, "fact_movies").count() == 3
    assert spark.table("t_cat_gold.dim_language").count() >= 2
    wh.drop_tables()
    assert not spark.catalog.tableExists("t_cat_gold.fact_movies")
    assert committed(wh, "fact_movies").count() == 3        # external: files stay
    wh.reset()
    assert committed(wh, "fact_movies").count() == 0 and read_state(wh) is None


def test_run_landed_page_mark(spark, scratch):
    import shutil
    from pyspark.sql import functions as F

    from constella.plans.pipeline import run_landed
    from constella.sources.pages import write_pages

    def land(folder, ids, pages, count):
        rows = raw_df(spark, [movie(i, date=f"2024-01-{i:02d} 00:00:00") for i in ids])
        rows = rows.withColumn("page", ((F.col("id") - 1) / 3).cast("long") + 1).filter(F.col("page").isin(pages))
        write_pages(rows, folder, "page", F.lit(count).cast("long"), 3, one_dir_per_page=True)

    landing = f"{scratch}/landing"
    land(landing, range(1, 15), [1, 2, 4, 5], 14)         # page 3 missing, page 5 partial (2 of 3)
    wh = new_wh(spark, scratch)
    r = run_landed(wh, landing, limit=3)
    assert read_state(wh)["last_page"] == 2                 # stops before the gap (H10)
    assert r.window_rows == 6                               # pages after the gap wait
    assert sorted(x.movie_id for x in committed(wh, "fact_movies").collect()) == [1, 2, 3, 4, 5, 6]
    shutil.rmtree(landing)
    land(landing, range(1, 15), [1, 2, 3, 4, 5], 14)        # gap filled; page 5 still partial
    run_landed(wh, landing, limit=3)
    assert read_state(wh)["last_page"] == 4                 # partial page stays open (H11)
    assert sorted(x.movie_id for x in committed(wh, "fact_movies").collect()) == list(range(1, 15))
    shutil.rmtree(landing)
    land(landing, range(1, 16), [1, 2, 3, 4, 5], 15)        # last page now full
    run_landed(wh, landing, limit=3)
    assert read_state(wh)["last_page"] == 5
    assert sorted(x.movie_id for x in committed(wh, "fact_movies").collect()) == list(range(1, 16))
    assert run_landed(wh, landing, limit=3) is None         # nothing new (F7)
    assert run_landed(wh, f"{scratch}/never-landed", limit=3) is None


def test_lookback_readmits_late_rows_once(spark, scratch):
    wh = new_wh(spark, scratch)
    run_batch(wh, raw_df(spark, [movie(1, date="2024-01-10 00:00:00", language="en")]))
    late = raw_df(spark, [movie(2, date="2024-01-08 00:00:00", language="fr"),     # older than the mark
                          movie(3, date="2024-01-11 00:00:00", language="en")])
    admitted = new_wh(spark, scratch, "admitted")
    run_batch(admitted, raw_df(spark, [movie(1, date="2024-01-10 00:00:00", language="en")]))
    assert run_batch(admitted, late).late_rows == 1
    assert sorted(r.movie_id for r in committed(admitted, "fact_movies").collect()) == [1, 2, 3]  # by batch
    plain = new_wh(spark, scratch, "plain")
    run_batch(plain, raw_df(spark, [movie(1, date="2024-01-10 00:00:00", language="en")]))
    run_batch(plain, late, options=RunOptions(strict_window=True))
    assert sorted(r.movie_id for r in committed(plain, "fact_movies").collect()) == [1, 3]   # H19 as coded
    r = run_batch(wh, late, options=RunOptions(lookback="3 days"))
    assert r.window_rows == 3                              # movie 1 again, plus 2 and 3
    assert sorted(r.movie_id for r in committed(wh, "fact_movies").collect()) == [1, 2, 3]
    langs = sorted(x.language for x in committed(wh, "dim_language").collect())
    assert langs == ["en", "fr"]


def test_star_invariants_after_three_batches(spark, scratch):
    raw = raw_movies(spark, SF_SMALL, CUTS_3)
    wh = new_wh(spark, scratch)
    for k in (1, 2, 3):
        run_batch(wh, raw.filter(F.col("landing") == k).drop("landing"))
    for name, nk, key in [("dim_movie", "slug", "movie_key"), ("dim_language", "language", "language_key"),
                          ("dim_runtime", "runtime", "runtime_key"), ("dim_rating", "rating", "rating_key"),
                          ("dim_released_year", "year", "year_key"), ("dim_genre", "genre_name", "genre_id")]:
        rows = committed(wh, name).select(nk, key).collect()
        naturals = [r[0] for r in rows]
        assert len(naturals) == len(set(naturals)), name            # NULL counted once, too
        assert sorted(r[1] for r in rows) == list(range(1, len(rows) + 1)), name
    dates = [r.date for r in committed(wh, "dim_date").collect()]
    assert len(dates) == len(set(dates))
    ids = [r.movie_id for r in committed(wh, "fact_movies").collect()]
    assert len(ids) == len(set(ids))
    pairs = [tuple(r) for r in committed(wh, "genre_junction").collect()]
    assert len(pairs) == len(set(pairs))
    # every non-NULL attribute resolves to a key
    fact = committed(wh, "fact_movies")
    assert fact.filter(F.col("movie_key").isNull() | F.col("year_key").isNull()).count() == \
        raw.filter(F.col("slug").isNull()).join(fact.select(F.col("movie_id").alias("id")), "id").count()


def test_stream_several_micro_batches(spark, scratch):
    landing = land_standin(spark, SF_SMALL, one_dir_per_page=True)     # 30 page files
    wh = new_wh(spark, scratch)
    run_stream(wh, landing, max_files_per_trigger=10)
    st = read_state(wh)
    assert st["batch_id"] == 3                                          # one warehouse batch per micro-batch
    run_stream(wh, landing, max_files_per_trigger=10)
    assert read_state(wh)["batch_id"] == 3                              # restart: nothing new
    for name, key in [("dim_movie", "movie_key"), ("dim_language", "language_key"), ("dim_genre", "genre_id")]:
        keys = [r[key] for r in committed(wh, name).collect()]
        assert sorted(keys) == list(range(1, len(keys) + 1)), name
    ids = [r.movie_id for r in committed(wh, "fact_movies").collect()]
    one = new_wh(spark, scratch)
    run_stream(one, landing)                                            # the same files in one micro-batch
    assert sorted(ids) == sorted(r.movie_id for r in committed(one, "fact_movies").collect()) and len(ids) > 1400
    assert committed(wh, "raw_data").count() == 1500                    # every landed row kept in bronze
