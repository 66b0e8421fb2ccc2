from pyspark.sql import functions as F

from constella.sources.pages import (
    contiguous_mark,
    landed_movies,
    page_plan,
    page_status,
    read_pages,
    total_pages,
    write_pages,
)
from tests.helpers import movie, raw_df


def _land(spark, landing, n_rows, limit, one_dir_per_page=False):
    raw = raw_df(spark, [movie(i, date="2024-01-01 00:00:00") for i in range(1, n_rows + 1)])
    rows = raw.withColumn("page", ((F.col("id") - 1) / limit).cast("long") + 1)
    write_pages(rows, landing, "page", F.lit(n_rows).cast("long"), limit, one_dir_per_page)


def test_round_trip_both_layouts(spark, scratch):
    for layout in (False, True):
        landing = f"{scratch}/l{int(layout)}"
        _land(spark, landing, 23, 5, layout)
        pages = read_pages(spark, landing)
        got = {r.page: r.n_movies for r in pages.collect()}
        assert got == {1: 5, 2: 5, 3: 5, 4: 5, 5: 3}
        assert pages.select(total_pages(pages, 5)).first()[0] == 5
        assert sorted(r.id for r in landed_movies(pages).collect()) == list(range(1, 24))


def test_corrupt_and_empty_pages(spark, scratch):
    landing = f"{scratch}/bad"
    with open(f"{scratch}/bad.json", "w") as fh:
        fh.write('{"page": 1, "data": {"movie_count": 2, "movies": [{"id": 1, "rating": 7}]}}\n')
        fh.write('{"page": 2, "data": {"movie_count": 2, "movies": []}}\n')
        fh.write('{"page": 3, "data": {"movie_count": 2, "movies": [{"id": 3\n')
    import os
    os.makedirs(landing)
    os.rename(f"{scratch}/bad.json", f"{landing}/part-0.json")
    pages = {r.page: r for r in read_pages(spark, landing).collect()}
    assert pages[1].n_movies == 1 and not pages[1].failed
    assert pages[1].movies[0].rating == 7.0          # integer rating read as double
    assert pages[2].n_movies == 0 and not pages[2].failed
    assert [r for r in pages.values() if r.failed]    # the truncated record is flagged, not raised


def test_plan_status_and_mark(spark):
    plan = page_plan(spark, 2, 8)
    assert [r.page for r in plan.collect()] == [3, 4, 5, 6, 7, 8]
    assert page_plan(spark, 8, 8).count() == 0 and page_plan(spark, 9, 8).count() == 0
    landed = spark.createDataFrame(
        [(3, 5, False), (4, 5, False), (6, 5, False), (7, 5, False), (8, 2, False)],
        "page long, n_movies long, failed boolean")
    st = page_status(plan, landed, 5)
    status = {r.page: (r.status, r.complete) for r in st.collect()}
    assert status[5] == ("missing", None) and status[8] == ("landed", False)
    assert st.select(contiguous_mark(st, 2)).first()[0] == 4      # stops before the gap (H10)
    full = spark.createDataFrame([(p, 5, False) for p in range(3, 8)] + [(8, 2, False)],
                                 "page long, n_movies long, failed boolean")
    st2 = page_status(plan, full, 5)
    assert st2.select(contiguous_mark(st2, 2)).first()[0] == 7    # partial last page stays open (H11)
    first_bad = spark.createDataFrame([(3, 5, True)], "page long, n_movies long, failed boolean")
    st3 = page_status(plan, first_bad, 5)
    assert st3.select(contiguous_mark(st3, 2)).first()[0] == 2


def test_multiline_page_files(spark, scratch):
    import json
    import os
    landing = f"{scratch}/ml"
    for page, ids in [(1, [1, 2]), (2, [3])]:
        os.makedirs(f"{landing}/page={page}")
        doc = {"data": {"movie_count": 3, "movies": [{"id": i, "slug": f"s{i}", "rating": 5} for i in ids]}}
        with open(f"{landing}/page={page}/p.json", "w") as fh:
            json.dump(doc, fh, indent=2)
    pages = read_pages(spark, landing, multiline=True)
    assert {r.page: r.n_movies for r in pages.collect()} == {1: 2, 2: 1}
    movies = landed_movies(pages, keep_page=True).collect()
    assert sorted((r.page, r.id, r.rating) for r in movies) == [(1, 1, 5.0), (1, 2, 5.0), (2, 3, 5.0)]
