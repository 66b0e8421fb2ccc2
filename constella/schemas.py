"""Explicit schemas for every layer: landed page envelope, raw movie rows,
silver, the nine gold tables and the run-state dataset.

Nothing is inferred.  Raw integer ids, years and runtimes are 64-bit, the
``torrents`` element is a struct (not a map of strings) and timestamps are
``timestamp_ntz``: the API sends wall-clock text without a zone.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# --- fixed values: field names and order of the movie API payload ----------
TORRENT = _s(
    ("url", StringType()),
    ("hash", StringType()),
    ("quality", StringType()),
    ("type", StringType()),
    ("is_repack", StringType()),
    ("video_codec", StringType()),
    ("bit_depth", StringType()),
    ("audio_channels", StringType()),
    ("seeds", IntegerType()),
    ("peers", IntegerType()),
    ("size", StringType()),
    ("size_bytes", LongType()),
    ("date_uploaded", StringType()),
    ("date_uploaded_unix", LongType()),
)

RAW_MOVIE = _s(
    ("id", LongType()),
    ("url", StringType()),
    ("imdb_code", StringType()),
    ("title", StringType()),
    ("title_english", StringType()),
    ("title_long", StringType()),
    ("slug", StringType()),
    ("year", LongType()),
    ("rating", DoubleType()),
    ("runtime", LongType()),
    ("genres", ArrayType(StringType())),
    ("summary", StringType()),
    ("description_full", StringType()),
    ("synopsis", StringType()),
    ("yt_trailer_code", StringType()),
    ("language", StringType()),
    ("mpa_rating", StringType()),
    ("background_image", StringType()),
    ("background_image_original", StringType()),
    ("small_cover_image", StringType()),
    ("medium_cover_image", StringType()),
    ("large_cover_image", StringType()),
    ("state", StringType()),
    ("torrents", ArrayType(TORRENT)),
    ("date_uploaded", StringType()),
    ("date_uploaded_unix", LongType()),
)

ENVELOPE = _s(
    ("data", _s(
        ("movie_count", LongType()),
        ("movies", ArrayType(RAW_MOVIE)),
    )),
)

# Silver column order (25 columns).
SILVER_COLUMNS = [
    "movie_id", "imdb_code", "slug", "url", "title", "title_english", "title_long",
    "year", "rating", "mpa_rating", "runtime", "language", "state", "genres",
    "description_full", "summary", "synopsis", "date_uploaded", "date_uploaded_unix",
    "background_image", "background_image_original", "large_cover_image",
    "medium_cover_image", "small_cover_image", "yt_trailer_code",
]

# Attributes of the movie dimension besides its natural key ``slug``.
MOVIE_ATTRIBUTES = [
    "url", "title", "description_full", "summary", "synopsis",
    "background_image_original", "large_cover_image",
]

DIM_GENRE = _s(("genre_id", IntegerType()), ("genre_name", StringType()))
GENRE_JUNCTION = _s(("movie_id", LongType()), ("genre_id", IntegerType()))
DIM_MOVIE = _s(("movie_key", LongType()), ("slug", StringType()),
               *[(c, StringType()) for c in MOVIE_ATTRIBUTES])
DIM_DATE = StructType([
    StructField("date_key", IntegerType(), False),
    StructField("date", TimestampNTZType(), False),
    StructField("date_iso", StringType(), True),
    StructField("date_full", StringType(), True),
    StructField("day_of_week", StringType(), True),
    StructField("day_of_month", IntegerType(), True),
    StructField("day_of_year", IntegerType(), True),
    StructField("week_of_year", IntegerType(), True),
    StructField("month", IntegerType(), True),
    StructField("month_name", StringType(), True),
    StructField("quarter", IntegerType(), True),
    StructField("year", IntegerType(), True),
    StructField("is_weekend", BooleanType(), True),
])
DIM_LANGUAGE = _s(("language_key", LongType()), ("language", StringType()))
DIM_RUNTIME = _s(("runtime_key", LongType()), ("runtime", LongType()))
DIM_RATING = _s(("rating_key", LongType()), ("rating", DoubleType()))
DIM_RELEASED_YEAR = _s(("year_key", LongType()), ("year", LongType()))
FACT_MOVIES = _s(
    ("movie_id", LongType()),
    ("imdb_code", StringType()),
    ("movie_key", LongType()),
    ("date_key", IntegerType()),
    ("language_key", LongType()),
    ("runtime_key", LongType()),
    ("rating_key", LongType()),
    ("year_key", LongType()),
)

GOLD = {
    "dim_genre": DIM_GENRE,
    "genre_junction": GENRE_JUNCTION,
    "dim_movie": DIM_MOVIE,
    "dim_date": DIM_DATE,
    "dim_language": DIM_LANGUAGE,
    "dim_runtime": DIM_RUNTIME,
    "dim_rating": DIM_RATING,
    "dim_released_year": DIM_RELEASED_YEAR,
    "fact_movies": FACT_MOVIES,
}

# One row per page that a run has taken or found unreadable; the ledger of landed files.  A page is known by its file's
# path, length and modification time; ``raw`` keeps the text of a failed page.
LANDED_PAGES = _s(
    ("path", StringType()),
    ("length", LongType()),
    ("modified", TimestampType()),
    ("page", LongType()),
    ("movie_count", LongType()),
    ("n_movies", LongType()),
    ("status", StringType()),
    ("raw", StringType()),
)

# One row per committed batch; written last, it is the commit record.
STATE = _s(
    ("batch_id", LongType()),
    ("last_date", TimestampNTZType()),
    ("last_page", LongType()),
    ("window_rows", LongType()),
    ("null_date_rows", LongType()),
    ("committed_at", TimestampNTZType()),
    ("late_rows", LongType()),
    ("source", StringType()),
    ("base", LongType()),          # first live batch: older ones were rewritten into it
    ("buckets", LongType()),       # of the tables that are bucketed
    ("min_date", TimestampNTZType()),   # zone map: of the batch's silver rows
    ("max_date", TimestampNTZType()),
    ("min_id", LongType()),        # zone map: of the ids that the batch's window loaded
    ("max_id", LongType()),
    ("null_ids", LongType()),
)

# Commit rows of batches that a compaction has rewritten.
RUN_LOG = StructType([StructField("run", LongType(), True), *[f for f in STATE.fields if f.name != "batch_id"]])


def silver_schema() -> StructType:
    raw = {f.name: f.dataType for f in RAW_MOVIE.fields}
    raw["movie_id"] = raw.pop("id")
    raw["date_uploaded"] = TimestampNTZType()
    return StructType([StructField(c, raw[c], True) for c in SILVER_COLUMNS])


SILVER = silver_schema()
