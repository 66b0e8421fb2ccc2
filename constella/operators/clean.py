"""Bronze -> silver cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constella.functions.nested import default_array, first_element, parse_timestamp
from constella.schemas import SILVER_COLUMNS


DEFAULT_GENRE = "other"   # fixed value: genre of movies without genres


def clean(raw: DataFrame, default_genre: str = DEFAULT_GENRE,
          empty_genres_as_default: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw movie rows -> the 25 silver columns.

    * ``id`` is renamed ``movie_id``; ``torrents`` is dropped.
    * A NULL ``date_uploaded`` falls back to the first torrent's date; the unix
      seconds are patched from the first torrent only on those same rows.
    * The text date is parsed to ``timestamp_ntz``; unparseable text is NULL
      (and so stays outside every incremental window).
    * NULL ``genres`` becomes ``[default_genre]``.
    A projection, not a self-join: duplicate ids are never multiplied.
    ``keep`` names extra columns (e.g. a landing batch) passed through as is.
    """
    date_missing = F.col("date_uploaded").isNull()
    exprs = {c: F.col(c) for c in SILVER_COLUMNS if c in raw.columns}
    exprs["movie_id"] = F.col("id")
    exprs["genres"] = default_array("genres", default_genre, empty_genres_as_default)
    exprs["date_uploaded"] = parse_timestamp(
        F.coalesce(F.col("date_uploaded"), first_element("torrents", "date_uploaded")))
    exprs["date_uploaded_unix"] = F.when(
        date_missing,
        F.coalesce(F.col("date_uploaded_unix"), first_element("torrents", "date_uploaded_unix")),
    ).otherwise(F.col("date_uploaded_unix"))
    return raw.select(*[exprs[c].alias(c) for c in SILVER_COLUMNS], *keep)
