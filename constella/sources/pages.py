"""Landed page files of a paged JSON API (one envelope per page).

The HTTP fetch is outside Spark; what lands is one JSON envelope
``{"data": {"movie_count": n, "movies": [...]}}`` per page, either as one
file per page under ``<landing>/page=<n>/`` or ``<landing>/run=<id>/page=<n>/``
(page from the path; a run's page mark prunes folders) or as
JSON-lines records that carry a ``page`` field.  Executors read the files
directly (no rows pass through the driver).  Page planning, missing/failed/partial pages and the
page high-water mark are DataFrame operations over the landed pages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, StringType, StructField, StructType

from constella.schemas import ENVELOPE

CORRUPT = "_corrupt_record"


def _rating_as_text(t: DataType) -> DataType:
    if isinstance(t, ArrayType):
        return ArrayType(_rating_as_text(t.elementType))
    if isinstance(t, StructType):
        return StructType([StructField(f.name, StringType() if f.name == "rating" else _rating_as_text(f.dataType))
                           for f in t.fields])
    return t


def envelope_schema(with_page: bool = True) -> StructType:
    # ratings are read as text: one that isn't a number costs its field and not the page
    fields = [StructField(f.name, _rating_as_text(f.dataType), True) for f in ENVELOPE.fields] + [StructField(CORRUPT, StringType(), True)]
    if with_page:
        fields.append(StructField("page", LongType(), True))
    return StructType(fields)


#: What tells one landed page from another: its file as it lies there, and its number in it.
IDENTITY = ["path", "length", "modified", "page"]


def read_pages(spark: SparkSession, landing: str, multiline: bool = False, after: int | None = None) -> DataFrame:
    """One row per landed page: ``page, movie_count, n_movies, failed, raw, movies`` and its file's ``path, length,
    modified``.  A truncated / malformed file gives ``failed = true`` (its text in ``raw``) instead of an error;
    ratings may be numbers or text, and missing fields as NULL (declared schema, nothing inferred).

    ``after`` keeps pages above a page mark, and records without a page number.  In a landing folder partitioned by
    page (``page=<n>/``, below ``run=<id>/`` or not) it's a partition filter: older pages' files aren't opened."""
    df = (spark.read.schema(envelope_schema())
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("multiLine", multiline)
              .json(landing))
    if after is not None:
        df = df.filter((F.col("page") > after) | F.col("page").isNull())
    return pages_of(df)


def pages_of(df: DataFrame) -> DataFrame:
    """Pages of envelopes read from files, in a batch or a stream."""
    return envelopes(df, {"path": F.col("_metadata.file_path"), "length": F.col("_metadata.file_size"),
                          "modified": F.col("_metadata.file_modification_time")})


def envelopes(df: DataFrame, file: dict[str, Column]) -> DataFrame:
    return df.select(
        F.col("page"),
        F.col("data.movie_count").alias("movie_count"),
        F.coalesce(F.size("data.movies"), F.lit(0)).alias("n_movies"),
        F.col(CORRUPT).isNotNull().alias("failed"),
        F.transform("data.movies", lambda m: m.withField("rating", m["rating"].try_cast("double"))).alias("movies"),
        F.col(CORRUPT).alias("raw"),
        *[c.alias(name) for name, c in file.items()],
    )


def parse_text(rows: DataFrame, text: Column) -> DataFrame:
    """Pages of envelopes held as text (``rows`` has the columns of IDENTITY and ``raw``, kept as ``was``)."""
    schema = envelope_schema()
    parsed = rows.select("*", F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_env"))
    named = parsed.select("path", "length", "modified", F.coalesce("_env.page", "page").alias("page"), "_env.data",
                          F.col("raw").alias("was"),
                          F.coalesce(F.col(f"_env.{CORRUPT}"), F.when(F.col("_env.data").isNull(), text)).alias(CORRUPT))
    return envelopes(named, {c: F.col(c) for c in ("path", "length", "modified", "was")})


def unseen(pages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Pages that no committed batch has taken or recorded.  A file landed again (other length or time) is new."""
    p, l = pages.alias("_p"), ledger.select(*IDENTITY).alias("_l")
    same = reduce(lambda a, b: a & b, [F.col(f"_p.{c}").eqNullSafe(F.col(f"_l.{c}")) for c in IDENTITY])
    return p.join(l, same, "left_anti").select("_p.*")


def movie_rows(pages: DataFrame) -> DataFrame:
    """A row per movie (``_pos``, ``m``) of the pages that can be read, with its page's columns; a page without movies,
    or that can't be read, has one row without ``_pos``.  ``_page`` tells the pages apart.  Cut in this form, a page's
    movies are never one value, of which a columnar reader would hold a whole batch."""
    kept = [c for c in pages.columns if c != "movies"]
    return pages.withColumn("_page", F.monotonically_increasing_id()).select(
        "_page", *kept, F.posexplode_outer(F.when(~F.col("failed"), F.col("movies"))).alias("_pos", "m"))


def page_heads(rows: DataFrame) -> DataFrame:
    """One row per page of (cut) ``movie_rows``, without its movies."""
    return rows.filter(F.coalesce("_pos", F.lit(0)) == 0).drop("_pos", "m")


def movies_of(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """The movies that (cut) ``movie_rows`` holds of the pages ``heads``."""
    return rows.filter(F.col("_pos").isNotNull()).join(heads.select("_page"), "_page", "left_semi").select("m.*")


def landed_movies(pages: DataFrame, keep_page: bool = False) -> DataFrame:
    """Movie rows of the landed pages (``explode`` of ``data.movies``)."""
    m = pages.select("page", F.explode("movies").alias("m"))
    return m.select(*(["page"] if keep_page else []), "m.*")


def total_pages(pages: DataFrame, limit: int) -> Column:
    """``ceil(movie_count / limit)`` of the newest count, as a scalar subquery."""
    return pages.select(F.ceil(F.max_by("movie_count", F.when(F.col("movie_count").isNotNull(), F.col("page"))) / F.lit(limit)).cast("bigint")).scalar()


def page_plan(spark: SparkSession, last_page: int, max_page: int) -> DataFrame:
    """Pages ``last_page+1 .. max_page`` (none when ``last_page >= max_page``),
    generated distributed by ``spark.range``."""
    return spark.range(last_page + 1, max(last_page, max_page) + 1).select(F.col("id").alias("page"))


def page_status(plan: DataFrame, pages: DataFrame, limit: int) -> DataFrame:
    """Every planned page with ``status`` in missing / failed / empty / landed
    and ``complete`` (a full page of ``limit`` rows).  A join on the page
    number; a re-landed page counts once (its largest landing)."""
    landed = pages.groupBy("page").agg(F.max("n_movies").alias("n_movies"),
                                       F.min(F.col("failed").cast("int")).cast("boolean").alias("failed"))
    j = plan.join(landed, "page", "left")
    status = (F.when(F.col("n_movies").isNull(), "missing")
                .when(F.col("failed"), "failed")
                .when(F.col("n_movies") == 0, "empty")
                .otherwise("landed"))
    return j.select("page", status.alias("status"),
                    F.coalesce("n_movies", F.lit(0)).cast("bigint").alias("n_movies"),
                    (F.col("n_movies") == F.lit(limit)).alias("complete"))


def contiguous_mark(status: DataFrame, last_page: int | Column) -> Column:
    """New page high-water mark: the highest page reached without a gap of
    missing, failed or partly filled pages (those stay open for the next run).
    Scalar subquery; equals ``last_page`` when the first planned page is bad."""
    last = last_page if isinstance(last_page, Column) else F.lit(last_page).cast("bigint")
    top = status.select(F.max("page")).scalar()
    # only the last page may still be filling; a short or empty page before it is final
    open_ = F.col("status").isin("missing", "failed") | (
        (F.col("page") == top) & ~F.coalesce(F.col("complete"), F.lit(False)))
    first_open = status.select(F.min(F.when(open_, F.col("page")))).scalar()
    return F.coalesce(first_open - 1, top, last)


def landed_prefix(status: DataFrame, last_page: int | Column) -> Column:
    """Last page of the contiguous run of landed pages after ``last_page``
    (partly filled pages included; a missing or failed page ends it).  Rows
    of pages after a gap are not loaded yet: loading them first would move
    the date mark past the gap's rows, which would then never qualify."""
    last = last_page if isinstance(last_page, Column) else F.lit(last_page).cast("bigint")
    first_gap = status.select(F.min(F.when(F.col("status").isin("missing", "failed"), F.col("page")))).scalar()
    top = status.select(F.max("page")).scalar()
    return F.coalesce(first_gap - 1, top, last)


def write_pages(rows: DataFrame, landing: str, page_col: str, movie_count: Column, limit: int,
                one_dir_per_page: bool = False, run: str | None = None) -> None:
    """Land rows as page envelopes (test and replay helper): JSON-lines
    records ``{"data": ..., "page": n}``, or one ``page=<n>/`` folder per page,
    below ``run=<run>/`` if one is given.  ``rows`` must carry at most
    ``limit`` rows per page -- the page size bounds every collected group."""
    movies = [c for c in rows.columns if c != page_col]
    # dealt out first: pages begun in every task before the shuffle would be many, and spill
    env = (rows.repartition(page_col).groupBy(F.col(page_col).alias("page"))
               .agg(F.collect_list(F.struct(*movies)).alias("movies"))
               .select(F.struct(movie_count.alias("movie_count"), F.col("movies")).alias("data"), "page"))
    writer = env.write.mode("overwrite")
    if one_dir_per_page or run is not None:
        writer = writer.partitionBy("page")
    writer.json(landing if run is None else f"{landing.rstrip('/')}/run={run}")


def page_numbers(rows: DataFrame, rank_col: str, limit: int) -> Column:
    """Page of a 1-based rank: ``(rank - 1) div limit + 1``."""
    return ((F.col(rank_col) - 1) / F.lit(limit)).cast("bigint") + 1

