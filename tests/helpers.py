"""Literal raw movie rows for unit tests."""

from __future__ import annotations

from constella.schemas import RAW_MOVIE, TORRENT

TORRENT_FIELDS = [f.name for f in TORRENT.fields]


def torrent(date=None, unix=None, **kw):
    d = {f: None for f in TORRENT_FIELDS}
    d.update(kw, date_uploaded=date, date_uploaded_unix=unix)
    return tuple(d[f] for f in TORRENT_FIELDS)


def movie(id, slug=None, date=None, unix=None, genres=None, torrents=None, **kw):
    d = {f.name: None for f in RAW_MOVIE.fields}
    d.update(id=id, slug=slug if slug is not None else f"m{id}", date_uploaded=date,
             date_uploaded_unix=unix, genres=genres, torrents=torrents, **kw)
    return tuple(d[f.name] for f in RAW_MOVIE.fields)


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_MOVIE)
