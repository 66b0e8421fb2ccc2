"""The driver's TPC-H-like tables standing in for movie pages.

``orders`` rows are movies (``o_orderkey`` = id, ``o_orderdate`` = upload
date, ``o_orderpriority`` = language, ``o_orderstatus`` = state), the line
items of an order (0 to 7, in order) are its torrents, and the first one's
``part`` is the movie entity (``p_name`` = slug, its words = genres, ``p_brand`` = title,
``p_type`` = url, ``p_size`` = runtime, ``l_discount`` = rating).
Orders in status ``P`` arrive without a text date (the first torrent's ship
date is the fallback); priority ``5-LOW`` orders arrive without unix seconds.
Orders land in batches by their effective upload date (the order date, or
for ``P`` orders the fallback ship date; ``landing`` column, cut dates in
``CUTS_*``), so a batch's window holds the rows that landed with it.

Every function has a DuckDB twin below so ``oracle_sql`` can recompute the
same rows independently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from constella.schemas import RAW_MOVIE, TORRENT

# Landing cuts: two batches split at 1998-01-01, three at 1997-01-01 / 1999-01-01.
CUTS_2 = ("1998-01-01",)
CUTS_3 = ("1997-01-01", "1999-01-01")

LINE_FIELDS = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_NUMBERS = range(1, 8)     # fixed value: line numbers of the generator
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Every order's line items as an ordered array: the smallest (by the full tuple) of each line number.  Rows are
    shuffled once, by order; the minima of an order's line numbers stream through one sort, so its rows are never
    collected however many, and what is collected is one line a line number."""
    dealt = lineitem.filter(F.col("l_linenumber").isin(list(LINE_NUMBERS))).repartition("l_orderkey")
    firsts = dealt.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct(*LINE_FIELDS)).alias("line"))
    return firsts.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def _unix(ts: str | F.Column) -> F.Column:
    """Unix seconds of a wall-clock (``timestamp_ntz``) value, read as UTC,
    independent of the session time zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts) if isinstance(ts, str) else ts)


def landing_batch(ts: F.Column, cuts: Sequence[str]) -> F.Column:
    """1 + number of cut dates strictly before ``ts``."""
    n = F.lit(1)
    for c in cuts:
        n = n + F.when(ts > F.lit(c).cast("timestamp_ntz"), 1).otherwise(0)
    return n.cast("int")


def raw_movies(spark: SparkSession, sf_dir: str, cuts: Sequence[str] = ()) -> DataFrame:
    """Raw movie rows (``RAW_MOVIE`` schema) plus a ``landing`` batch number."""
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    lines = order_lines(table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_FIELDS))
    j = (orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
               .withColumn("line", F.get("lines", F.lit(0)))
               .join(part, F.col("line.l_partkey") == part["p_partkey"], "left"))
    def torrent(line):
        of = {
            "quality": line["l_returnflag"],
            "type": line["l_linestatus"],
            "seeds": line["l_linenumber"],
            "date_uploaded": F.date_format(line["l_shipdate"], TS_TEXT),
            "date_uploaded_unix": _unix(line["l_shipdate"]),
        }
        return F.struct(*[of.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TORRENT.fields])

    no_date = F.col("o_orderstatus") == "P"
    values = {
        "id": F.col("o_orderkey"),
        "url": F.col("p_type"),
        "imdb_code": F.concat(F.lit("tt"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0")),
        "title": F.col("p_brand"),
        "slug": F.col("p_name"),
        "year": F.year("o_orderdate"),
        "rating": F.col("line.l_discount"),
        "runtime": F.col("p_size"),
        "genres": F.split(F.col("p_name"), " "),
        "language": F.col("o_orderpriority"),
        "state": F.col("o_orderstatus"),
        "torrents": F.coalesce(F.transform("lines", torrent), F.array().cast(ArrayType(TORRENT))),
        "date_uploaded": F.when(no_date, F.lit(None)).otherwise(F.date_format("o_orderdate", TS_TEXT)),
        "date_uploaded_unix": F.when(no_date | (F.col("o_orderpriority") == "5-LOW"), F.lit(None))
                               .otherwise(_unix("o_orderdate")),
    }
    cols = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_MOVIE.fields]
    effective = F.coalesce(F.when(no_date, F.col("line.l_shipdate")).otherwise(F.col("o_orderdate")),
                           F.col("o_orderdate"))
    return j.select(*cols, landing_batch(effective, cuts).alias("landing"))


# ---------------------------------------------------------------------------
# DuckDB twins (tables are pre-registered views named like the parquet files)
# ---------------------------------------------------------------------------

def sql_landing(cuts: Sequence[str]) -> str:
    eff = "coalesce(CASE WHEN o.o_orderstatus = 'P' THEN fl.l_shipdate ELSE o.o_orderdate END, o.o_orderdate)"
    parts = " + ".join(f"CASE WHEN {eff} > TIMESTAMP '{c}' THEN 1 ELSE 0 END" for c in cuts)
    return f"CAST(1{' + ' + parts if parts else ''} AS INTEGER)"


def sql_raw_ctes(cuts: Sequence[str] = ()) -> str:
    """CTEs ``fl`` and ``raw`` (raw movie columns used downstream, the first
    torrent's date fields as ``t0_date`` / ``t0_unix``, and ``landing``)."""
    order = ", ".join(LINE_FIELDS)
    return f"""
fl AS (
  SELECT * FROM (
    SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS rn_
    FROM lineitem l) WHERE rn_ = 1
),
raw AS (
  SELECT o.o_orderkey AS id,
         p.p_type AS url,
         'tt' || lpad(CAST(o.o_orderkey AS VARCHAR), 7, '0') AS imdb_code,
         p.p_brand AS title,
         p.p_name AS slug,
         CAST(year(o.o_orderdate) AS BIGINT) AS year,
         fl.l_discount AS rating,
         CAST(p.p_size AS BIGINT) AS runtime,
         string_split(p.p_name, ' ') AS genres,
         o.o_orderpriority AS language,
         o.o_orderstatus AS state,
         CASE WHEN o.o_orderstatus = 'P' THEN NULL
              ELSE strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') END AS date_uploaded,
         CASE WHEN o.o_orderstatus = 'P' OR o.o_orderpriority = '5-LOW' THEN NULL
              ELSE CAST(epoch(o.o_orderdate) AS BIGINT) END AS date_uploaded_unix,
         strftime(fl.l_shipdate, '%Y-%m-%d %H:%M:%S') AS t0_date,
         CAST(epoch(fl.l_shipdate) AS BIGINT) AS t0_unix,
         {sql_landing(cuts)} AS landing
  FROM orders o
  LEFT JOIN fl ON fl.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON p.p_partkey = fl.l_partkey
)"""


def sql_silver_ctes(cuts: Sequence[str] = ()) -> str:
    """Adds CTE ``silver``: cleaned rows (fallback date, patched unix seconds,
    default genres, parsed timestamp) plus ``landing``."""
    return sql_raw_ctes(cuts) + """,
silver AS (
  SELECT id AS movie_id, imdb_code, slug, url, title,
         CAST(NULL AS VARCHAR) AS description_full, CAST(NULL AS VARCHAR) AS summary,
         CAST(NULL AS VARCHAR) AS synopsis, CAST(NULL AS VARCHAR) AS background_image_original,
         CAST(NULL AS VARCHAR) AS large_cover_image,
         year, rating, runtime, language, state,
         coalesce(genres, ['other']) AS genres,
         TRY_CAST(coalesce(date_uploaded, t0_date) AS TIMESTAMP) AS date_uploaded,
         CASE WHEN date_uploaded IS NULL THEN coalesce(date_uploaded_unix, t0_unix)
              ELSE date_uploaded_unix END AS date_uploaded_unix,
         landing
  FROM raw
)"""
