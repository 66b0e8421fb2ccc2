"""Landed pages in the form that runs cut them to: a row per movie."""

from pyspark.sql import functions as F

from constella.session import materialize
from constella.sources.pages import movie_rows, movies_of, page_heads, read_pages


def put(folder, page, text):
    import os
    os.makedirs(f"{folder}/page={page}")
    with open(f"{folder}/page={page}/p.json", "w") as fh:
        fh.write(text)


def test_no_page_is_held_whole_and_none_is_lost(spark, scratch):
    landing = f"{scratch}/landing"
    put(landing, 1, '{"data": {"movie_count": 5, "movies": [{"id": 1}, {"id": 2}, null]}}')
    put(landing, 2, '{"data": {"movie_count": 5, "movies": []}}')
    put(landing, 3, '{"data": {"movie_count": "none", "movies": [{"id": 3}, {"id": 4}]}}')      # failed, yet with movies
    put(landing, 4, '{"data": {"movie_count": 5}}')
    put(landing, 5, '{"data": {"movie_count": 5, "movies": [{"id": 9}]}}')
    pages = read_pages(spark, landing)
    rows = materialize(movie_rows(pages), f"{scratch}/rows")
    assert "movies" not in rows.columns and rows.count() == 3 + 1 + 1 + 1 + 1
    heads = page_heads(rows)
    kept = [c for c in pages.columns if c != "movies"]
    plain = lambda df: sorted(map(tuple, df.select(kept).collect()), key=repr)
    assert plain(heads) == plain(pages)
    ids = lambda pages: sorted((r.id for r in movies_of(rows, heads.filter(F.col("page").isin(pages))).collect()), key=repr)
    assert ids([1, 2, 3, 4, 5]) == [1, 2, 9, None] and ids([5, 3]) == [9]
