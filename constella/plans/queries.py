"""Registered queries: each is a Spark plan over the driver tables plus, where
SQL can express it, a DuckDB twin used as the correctness oracle.

Stand-ins (see ``standins``): orders = movies, first line item = first
torrent, part = movie entity.  Two landing batches split at 1998-01-01.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType

from constella import schemas as S
from constella.functions import date_grain, default_array, first_element, parse_timestamp
from constella.operators import (
    Lookup,
    absent_from,
    advance_mark,
    bridge_rows,
    clean,
    dense_keys,
    distinct_values,
    exploded_values,
    incremental_window,
    incremental_window_sql,
    insert_only,
    lookup_keys,
    new_date_members,
    new_members,
)
from constella.plans.batches import TS, batch_windows, empty, grow, star_states
from constella.plans.sqlgen import (
    genre_ctes,
    grow_dim_ctes,
    grow_date_ctes,
    star_ctes,
    windows_ctes,
    with_,
)
from constella.plans.standins import CUTS_2, raw_movies, sql_raw_ctes, sql_silver_ctes, table
from constella.session import materialize
from constella.sources.literal import literal_rows

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def silver(spark: SparkSession, sf_dir: str, cuts=CUTS_2) -> DataFrame:
    """Cleaned stand-in rows, written once per query (Parquet in the shared
    folder) so the many window/dimension steps read it, not the joins."""
    return materialize(clean(raw_movies(spark, sf_dir, cuts), keep=("landing",)), name="silver")


def _windows(spark, sf_dir, n=2):
    return batch_windows(silver(spark, sf_dir), n)


RAW = with_(sql_raw_ctes(CUTS_2))
SILVER = with_(sql_silver_ctes(CUTS_2))
W2 = with_(sql_silver_ctes(CUTS_2), windows_ctes(2))
STAR2 = with_(sql_silver_ctes(CUTS_2), windows_ctes(2), *star_ctes(2))

# --- C2 F2 F3 A4: incremental window -----------------------------------------
@query("q_window", """
SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
WHERE o_orderdate > TIMESTAMP '1998-01-01'
  AND o_orderdate <= (SELECT max(o_orderdate) FROM orders)""")
def q_window(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return (incremental_window(orders, "o_orderdate", "1998-01-01")
            .select("o_orderkey", "o_orderdate", "o_orderpriority"))


# --- S7 S8 F3: the same window as parameterised SQL over a catalog view --------
@query("q_window_sql", """
SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
WHERE o_orderdate > TIMESTAMP '1998-01-01'
  AND o_orderdate <= (SELECT max(o_orderdate) FROM orders)""")
def q_window_sql(spark, sf_dir):
    view = f"orders_{uuid.uuid4().hex[:8]}"
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    return incremental_window_sql(spark, view, "o_orderdate", "1998-01-01",
                                  "o_orderkey, o_orderdate, o_orderpriority")


@query("q_window_batches", W2 + """
SELECT movie_id, date_uploaded, CAST(1 AS INTEGER) AS batch FROM w1
UNION ALL SELECT movie_id, date_uploaded, CAST(2 AS INTEGER) AS batch FROM w2""")
def q_window_batches(spark, sf_dir):
    w1, w2 = _windows(spark, sf_dir)
    return (w1.select("movie_id", TS, F.lit(1).alias("batch"))
              .unionByName(w2.select("movie_id", TS, F.lit(2).alias("batch"))))


# --- F1 P7 X8: rows with a missing date and the first torrent's values -----------
@query("q_isnull", RAW + """
SELECT id, t0_date AS date_uploaded, t0_unix AS date_uploaded_unix FROM raw WHERE date_uploaded IS NULL""")
def q_isnull(spark, sf_dir):
    undated = raw_movies(spark, sf_dir).filter(F.col("date_uploaded").isNull())
    return undated.select("id", first_element("torrents").alias("first")).select(
        "id", "first.date_uploaded", "first.date_uploaded_unix")


# --- C1 X1 X2: cleaning (projection form) -----------------------------------------
SILVER_OUT = ["movie_id", "imdb_code", "slug", "url", "title", "year", "rating", "runtime",
              "language", "state", "date_uploaded", "date_uploaded_unix"]


@query("q_coalesce_nested", SILVER + f"""
SELECT {', '.join(SILVER_OUT)}, to_json(genres) AS genres_json FROM silver""")
def q_coalesce_nested(spark, sf_dir):
    s = clean(raw_movies(spark, sf_dir))
    return s.select(*SILVER_OUT, F.to_json("genres").alias("genres_json"))


# --- J1: rows and the fallback values of those without a date, by a left join ----------
@query("q_left_join", RAW + """
SELECT r.id AS movie_id, coalesce(r.date_uploaded, u.date_uploaded) AS date_text,
       coalesce(r.date_uploaded_unix, u.date_uploaded_unix) AS date_uploaded_unix
FROM raw r LEFT JOIN (SELECT id, t0_date AS date_uploaded, t0_unix AS date_uploaded_unix
                      FROM raw WHERE date_uploaded IS NULL) u ON r.id = u.id""")
def q_left_join(spark, sf_dir):
    # written once: both sides read it, not the joins
    raw = materialize(raw_movies(spark, sf_dir).select("id", "date_uploaded", "date_uploaded_unix", first_element("torrents").alias("first")), name="raw")
    fallback = raw.filter(F.col("date_uploaded").isNull()).select(F.col("id").alias("_id"), "first")
    found = raw.drop("first").join(fallback, F.col("id") == F.col("_id"), "left")
    return found.select(F.col("id").alias("movie_id"), F.coalesce("date_uploaded", "first.date_uploaded").alias("date_text"),
                        F.coalesce("date_uploaded_unix", "first.date_uploaded_unix").alias("date_uploaded_unix"))


# --- J1: a left join as a lookup that keeps the rows it finds nothing for ---------
@query("q_left_lookup", """
SELECT o.o_orderkey, c.c_mktsegment AS segment FROM orders o
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) c ON c.c_custkey = o.o_custkey""")
def q_left_lookup(spark, sf_dir):
    """Orders and the market segment of customers with a high balance."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rich = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 5000)
    members = rich.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return lookup_keys(orders, [Lookup(members, "o_custkey", "c_custkey", "segment")]).select("o_orderkey", "segment")


# --- X2 / X3: default array and explode --------------------------------------------
@query("q_default_array", RAW + """
SELECT id AS movie_id, to_json(coalesce(genres, ['other'])) AS genres_json FROM raw""")
def q_default_array(spark, sf_dir):
    raw = raw_movies(spark, sf_dir)
    return raw.select(F.col("id").alias("movie_id"), F.to_json(default_array("genres")).alias("genres_json"))


@query("q_explode", SILVER + """
SELECT movie_id, unnest(genres) AS genre FROM silver""")
def q_explode(spark, sf_dir):
    s = clean(raw_movies(spark, sf_dir))
    return s.select("movie_id", F.explode("genres").alias("genre"))


# --- A1 A2: distinct one / several columns ------------------------------------------
@query("q_distinct", W2 + """
SELECT DISTINCT year FROM w2""")
def q_distinct(spark, sf_dir):
    return distinct_values(_windows(spark, sf_dir)[1], "year")


@query("q_distinct_multi", W2 + """
SELECT DISTINCT slug, url, title FROM w1""")
def q_distinct_multi(spark, sf_dir):
    return _windows(spark, sf_dir)[0].select("slug", "url", "title").distinct()


# --- J2 J4: the inner genre join and an anti join on an expression ----------------------------
def _genre_dim_1(spark, sf_dir):
    ws = _windows(spark, sf_dir)
    d1 = grow(ws[:1], empty(spark, S.DIM_GENRE),
              lambda w, d: new_members(exploded_values(w, "genres", "genre_name"), d,
                                       "genre_name", "genre_id", "int"))
    return ws, d1


G1 = with_(sql_silver_ctes(CUTS_2), windows_ctes(2), genre_ctes(1))


@query("q_inner_join", G1 + """
SELECT DISTINCT p.movie_id, g.genre_id FROM (SELECT movie_id, unnest(genres) AS genre_name FROM w1) p
JOIN dg_1 g ON g.genre_name = p.genre_name""")
def q_inner_join(spark, sf_dir):
    ws, d1 = _genre_dim_1(spark, sf_dir)
    return bridge_rows(ws[0], "movie_id", "genres", d1, "genre_name", "genre_id")


@query("q_anti_expr", W2 + """
SELECT DISTINCT CAST(CAST(s.date_uploaded AS DATE) AS TIMESTAMP) AS day FROM w2 s
WHERE NOT EXISTS (SELECT 1 FROM w1 e WHERE CAST(e.date_uploaded AS DATE) = CAST(s.date_uploaded AS DATE))""")
def q_anti_expr(spark, sf_dir):
    """Left anti join on an expression: upload days of the second window that the first doesn't have."""
    earlier, later = [w.select(date_grain(TS, "day").alias("day")).distinct() for w in _windows(spark, sf_dir)]
    return absent_from(later, earlier, ["day"], null_safe=False)


@query("q_anti_customers", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate > TIMESTAMP '2000-01-01')""")
def q_anti_customers(spark, sf_dir):
    """Left anti join on an expression: customers without an order in the newest window."""
    newest = incremental_window(table(spark, sf_dir, "orders"), "o_orderdate", "2000-01-01")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return absent_from(customers, newest.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


# --- J3 H4: anti joins that many rows survive, by column name and null-safe -------
_DAYS = "(SELECT DISTINCT {0} AS day FROM {1})"
_DAY = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END"
_HALVES = ("(SELECT * FROM orders WHERE o_orderkey % 3 <> 0)", "(SELECT * FROM orders WHERE o_orderkey % 3 = 0)")


def _order_days(spark, sf_dir):
    """Order days of two thirds of the orders and of the others; NULL for orders in status P."""
    o = table(spark, sf_dir, "orders")
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    halves = [o.filter(F.col("o_orderkey") % 3 != 0), o.filter(F.col("o_orderkey") % 3 == 0)]
    return [h.select(day.alias("day")).distinct() for h in halves]


@query("q_anti_days", f"""
SELECT s.day FROM {_DAYS.format(_DAY, _HALVES[0])} s
WHERE NOT EXISTS (SELECT 1 FROM {_DAYS.format(_DAY, _HALVES[1])} e WHERE e.day = s.day)""")
def q_anti_days(spark, sf_dir):
    many, others = _order_days(spark, sf_dir)
    return absent_from(many, others, ["day"], null_safe=False)


@query("q_anti_days_nullsafe", f"""
SELECT s.day FROM {_DAYS.format(_DAY, _HALVES[0])} s
WHERE NOT EXISTS (SELECT 1 FROM {_DAYS.format(_DAY, _HALVES[1])} e WHERE e.day IS NOT DISTINCT FROM s.day)""")
def q_anti_days_nullsafe(spark, sf_dir):
    many, others = _order_days(spark, sf_dir)
    return absent_from(many, others, ["day"])


@query("q_anti_using", W2 + """
SELECT DISTINCT runtime FROM w2 s
WHERE NOT EXISTS (SELECT 1 FROM w1 e WHERE e.runtime = s.runtime)""")
def q_anti_using(spark, sf_dir):
    w1, w2 = _windows(spark, sf_dir)
    return distinct_values(w2, "runtime").join(distinct_values(w1, "runtime"), on="runtime", how="left_anti")


@query("q_anti_nullsafe", W2 + """
SELECT DISTINCT runtime FROM w2 s
WHERE NOT EXISTS (SELECT 1 FROM w1 e WHERE e.runtime IS NOT DISTINCT FROM s.runtime)""")
def q_anti_nullsafe(spark, sf_dir):
    w1, w2 = _windows(spark, sf_dir)
    return absent_from(distinct_values(w2, "runtime"), distinct_values(w1, "runtime"), ["runtime"])


# --- J6 J7: text date -> timestamp join, double equality join -----------------
@query("q_string_ts_join", STAR2 + """
SELECT r.id AS movie_id, d.date_key FROM raw r
LEFT JOIN dd_2 d ON d.date = TRY_CAST(r.date_uploaded AS TIMESTAMP)""")
def q_string_ts_join(spark, sf_dir):
    dd = star_states(silver(spark, sf_dir), 2, ["dim_date"])["dim_date"][2]
    raw = raw_movies(spark, sf_dir)
    return (raw.join(dd, parse_timestamp(raw["date_uploaded"]) == dd["date"], "left")
               .select(raw["id"].alias("movie_id"), dd["date_key"]))


@query("q_double_join", STAR2 + """
SELECT s.movie_id, r.rating_key FROM silver s LEFT JOIN dra_2 r ON r.rating = s.rating""")
def q_double_join(spark, sf_dir):
    s = silver(spark, sf_dir)
    dr = star_states(s, 2, ["dim_rating"])["dim_rating"][2]
    return s.join(dr, s["rating"] == dr["rating"], "left").select("movie_id", "rating_key")


# --- W1 C3: keys --------------------------------------------------------------------
@query("q_rownum_key", with_(sql_silver_ctes(CUTS_2), windows_ctes(2),
                             grow_dim_ctes("du", "upload_key", "date_uploaded", "BIGINT", "TIMESTAMP",
                                           [f"SELECT DISTINCT date_uploaded FROM w{k}" for k in (1, 2)])) + """
SELECT * FROM du_2 WHERE upload_key > (SELECT coalesce(max(upload_key), 0) FROM du_1)""")
def q_rownum_key(spark, sf_dir):
    """Batch 2's new members of a dimension over the upload timestamps
    (a natural key that grows), keyed after batch 1's max key."""
    w1, w2 = _windows(spark, sf_dir)
    schema = StructType([StructField("upload_key", LongType()), StructField("date_uploaded", TimestampNTZType())])
    step = lambda w, d: new_members(distinct_values(w, "date_uploaded"), d, "date_uploaded", "upload_key")
    d1 = grow([w1], empty(spark, schema), step)
    return step(w2, d1)


@query("q_dense_key", """
SELECT o_orderkey, o_orderdate,
       CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_seq
FROM orders""")
def q_dense_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return dense_keys(o, ["o_orderdate", "o_orderkey"], "order_seq")


# --- C3 C4 C5 C6 C7 C8 C9: the gold tables after two batches ---------------------
def _star_query(table_name, sql_name, cols):
    def fn(spark, sf_dir):
        return star_states(silver(spark, sf_dir), 2, [table_name])[table_name][2].select(*cols)
    return fn, STAR2 + f"\nSELECT {', '.join(cols)} FROM {sql_name}_2"


for _name, _tbl, _sql, _schema in [
    ("q_dim_language", "dim_language", "dl", S.DIM_LANGUAGE),
    ("q_dim_runtime", "dim_runtime", "dr", S.DIM_RUNTIME),
    ("q_dim_rating", "dim_rating", "dra", S.DIM_RATING),
    ("q_dim_year", "dim_released_year", "dy", S.DIM_RELEASED_YEAR),
    ("q_dim_date", "dim_date", "dd", S.DIM_DATE),
    ("q_dim_movie", "dim_movie", "dm", S.DIM_MOVIE),
    ("q_dim_genre", "dim_genre", "dg", S.DIM_GENRE),
    ("q_bridge", "genre_junction", "b", S.GENRE_JUNCTION),
    ("q_fact", "fact_movies", "f", S.FACT_MOVIES),
]:
    _fn, _q = _star_query(_tbl, _sql, [f.name for f in _schema.fields])
    REGISTRY[_name] = (_fn, _q)


# --- C5 H17 on events.ts: timestamp grain (date_key repeats) and day grain --------
def _events_dates(spark, sf_dir, grain):
    ev = table(spark, sf_dir, "events").select("ts")
    return new_date_members(incremental_window(ev, "ts"), "ts", empty(spark, S.DIM_DATE), grain)


_EV = "(SELECT ts FROM events WHERE ts <= (SELECT max(ts) FROM events))"


@query("q_dim_date_events", with_(grow_date_ctes("de", [f"SELECT ts AS date FROM {_EV}"])) +
       "\nSELECT * FROM de_1")
def q_dim_date_events(spark, sf_dir):
    return _events_dates(spark, sf_dir, "timestamp")


@query("q_dim_date_day", with_(grow_date_ctes("de", [f"SELECT date_trunc('day', ts) AS date FROM {_EV}"])) +
       "\nSELECT * FROM de_1")
def q_dim_date_day(spark, sf_dir):
    return _events_dates(spark, sf_dir, "day")


# --- A3 A5 A6 L1: counts and maxima --------------------------------------------
@query("q_count_max", W2 + """
SELECT (SELECT count(*) FROM w1) AS w1_rows, (SELECT count(*) FROM w2) AS w2_rows,
       (SELECT m FROM wm1) AS mark1, (SELECT m FROM wm2) AS mark2,
       (SELECT count(*) FROM silver WHERE date_uploaded IS NULL) AS null_dates""")
def q_count_max(spark, sf_dir):
    s = silver(spark, sf_dir)
    w1, w2 = batch_windows(s, 2)
    m1 = advance_mark(w1, TS, None)
    m2 = advance_mark(w2, TS, m1)
    n = lambda df: df.select(F.count(F.lit(1))).scalar()
    one = s.select(F.count(F.when(F.col(TS).isNull(), 1)).alias("null_dates"))
    return one.select(n(w1).alias("w1_rows"), n(w2).alias("w2_rows"),
                      m1.alias("mark1"), m2.alias("mark2"), "null_dates")


# --- U1 S6: union all with an inline sentinel row ------------------------------
@query("q_union", W2 + """
SELECT DISTINCT year FROM w1 UNION ALL SELECT CAST(4000 AS BIGINT) AS year""")
def q_union(spark, sf_dir):
    w1 = _windows(spark, sf_dir)[0]
    sentinel = literal_rows(spark, StructType([StructField("year", LongType())]), [(4000,)])
    return distinct_values(w1, "year").union(sentinel)


# --- A1 A2 J3 U1 over both windows (the queries above each read one of them) ----
_BOTH = "(SELECT * FROM w1 UNION ALL SELECT * FROM w2)"


def _both_windows(spark, sf_dir):
    w1, w2 = _windows(spark, sf_dir)
    return w1.unionByName(w2)


@query("q_distinct_both", W2 + f"""
SELECT DISTINCT year FROM {_BOTH}""")
def q_distinct_both(spark, sf_dir):
    return distinct_values(_both_windows(spark, sf_dir), "year")


@query("q_distinct_multi_both", W2 + f"""
SELECT DISTINCT slug, url, title FROM {_BOTH}""")
def q_distinct_multi_both(spark, sf_dir):
    return _both_windows(spark, sf_dir).select("slug", "url", "title").distinct()


@query("q_inner_join_both", STAR2 + f"""
SELECT DISTINCT p.movie_id, g.genre_id FROM (SELECT movie_id, unnest(genres) AS genre_name FROM {_BOTH}) p
JOIN dg_2 g ON g.genre_name = p.genre_name""")
def q_inner_join_both(spark, sf_dir):
    s = silver(spark, sf_dir)
    w1, w2 = batch_windows(s, 2)
    dim = star_states(s, 2, ["dim_genre"])["dim_genre"][2]
    return bridge_rows(w1.unionByName(w2), "movie_id", "genres", dim, "genre_name", "genre_id")


@query("q_union_both", W2 + f"""
SELECT DISTINCT year FROM {_BOTH} UNION ALL SELECT CAST(4000 AS BIGINT) AS year""")
def q_union_both(spark, sf_dir):
    sentinel = literal_rows(spark, StructType([StructField("year", LongType())]), [(4000,)])
    return distinct_values(_both_windows(spark, sf_dir), "year").union(sentinel)


# --- S13 U2: insert-only merge with an overlapping second window --------------------
@query("q_merge_insert", with_(sql_silver_ctes(CUTS_2), windows_ctes(2, lookback="90 days")) + """
SELECT movie_id, imdb_code, language FROM w1
UNION ALL
SELECT s.movie_id, s.imdb_code, s.language FROM w2 s
WHERE NOT EXISTS (SELECT 1 FROM w1 t WHERE t.movie_id = s.movie_id)""")
def q_merge_insert(spark, sf_dir):
    w1, w2 = batch_windows(silver(spark, sf_dir), 2, lookback="90 days")
    target = w1.select("movie_id", "imdb_code", "language")
    source = w2.select("movie_id", "imdb_code", "language")
    return target.unionByName(insert_only(source, target, ["movie_id"], null_safe=False))


__all__ = ["REGISTRY", "query", "silver"]


# run-level queries (pipeline, landed pages, stream) register themselves
from constella.plans import run_queries  # noqa: E402,F401
