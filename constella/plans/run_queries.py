"""Registered queries that run the committed pipeline, land JSON pages or
drive the stream.  Their folders are created below the session's shared
checkpoint folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constella.operators import dense_keys
from constella.operators.clean import clean
from constella.plans.pipeline import RunOptions, committed, committed_sql, run_batch, run_landed
from constella.plans.queries import SILVER_OUT, query
from constella.plans.sqlgen import star_ctes, windows_ctes, with_
from constella.plans.standins import CUTS_3, raw_movies, sql_silver_ctes, table
from constella.session import materialize, shared_dir
from constella.sources.pages import (
    contiguous_mark,
    landed_movies,
    landed_prefix,
    page_numbers,
    page_plan,
    page_status,
    read_pages,
    write_pages,
)
from constella.sources.tables import Warehouse
from constella.streaming.landed import run_stream

API_PAGE_SIZE = 50     # fixed value: rows per landed page
RUN_PAGE_SIZE = 1000    # page size of the queries that land a folder a page
DAY_PAGE_SIZE = 250     # of the five days, so that the first one has a page at the smallest scale
TRUNCATED = '{"data": {"movie_count": 9, "movies": [{"id": 1, "title": "cut'      # a page whose transfer broke off
EMPTY_PAGE = '{"data": {"movie_count": 9, "movies": []}}'
PLAN_PAGE_SIZE = 64    # page size of the planning queries (leaves a partly filled last page)


def resolve_fact(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with the natural values behind their keys (keys are unique)."""
    out = fact
    for name, key, value in [("dim_movie", "movie_key", "slug"), ("dim_language", "language_key", "language"),
                             ("dim_runtime", "runtime_key", "runtime"), ("dim_rating", "rating_key", "rating"),
                             ("dim_released_year", "year_key", "year")]:
        out = out.join(dims[name].select(key, value), on=key, how="left")
    return out


RESOLVED = """
SELECT f.*, m.slug, l.language, r.runtime, ra.rating, y.year FROM f_{n} f
LEFT JOIN dm_{n} m ON m.movie_key = f.movie_key LEFT JOIN dl_{n} l ON l.language_key = f.language_key
LEFT JOIN dr_{n} r ON r.runtime_key = f.runtime_key LEFT JOIN dra_{n} ra ON ra.rating_key = f.rating_key
LEFT JOIN dy_{n} y ON y.year_key = f.year_key"""


def _resolved_committed(wh: Warehouse) -> DataFrame:
    read = committed_sql if wh.registered else committed
    names = ["dim_movie", "dim_language", "dim_runtime", "dim_rating", "dim_released_year"]
    return resolve_fact(read(wh, "fact_movies"), {n: read(wh, n) for n in names})


# --- C10: three committed batches end to end ------------------------------------
@query("q_batch_end_to_end", with_(sql_silver_ctes(CUTS_3), windows_ctes(3), *star_ctes(3)) +
       RESOLVED.format(n=3))
def q_batch_end_to_end(spark, sf_dir):
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    wh.register_tables(prefix=f"wh{uuid.uuid4().hex[:8]}")   # S16 S17: namespaces + tables
    raw = materialize(raw_movies(spark, sf_dir, CUTS_3), name="landed")
    for k in (1, 2, 3):
        run_batch(wh, raw.filter(F.col("landing") == k).drop("landing"))
    return _resolved_committed(wh)


def paged(spark, sf_dir: str, limit: int = API_PAGE_SIZE, cuts=()) -> tuple[DataFrame, F.Column]:
    """The stand-in movie rows with their page (pages of ``limit`` rows in id order), and their count as a scalar."""
    raw = raw_movies(spark, sf_dir, cuts)
    # cut before the sort, which would run the joins once more to sample its bounds
    raw = materialize(raw if cuts else raw.drop("landing"), name="raw")
    ranked = dense_keys(raw, ["id"], "_rank")
    rows = ranked.withColumn("page", page_numbers(ranked, "_rank", limit)).drop("_rank")
    return rows, table(spark, sf_dir, "orders").select(F.count(F.lit(1))).scalar()


def land_standin(spark, sf_dir: str, limit: int = API_PAGE_SIZE, one_dir_per_page: bool = False) -> str:
    """Write the stand-in movie rows as page envelopes (pages of ``limit`` rows
    in id order) into a fresh shared folder; returns the folder."""
    landing = shared_dir(spark, "landing")
    rows, count = paged(spark, sf_dir, limit)
    write_pages(rows, landing, "page", count, limit, one_dir_per_page)
    return landing


# --- S1 S5: landed JSON pages read back with the declared schema ----------------
@query("q_landed_json", with_(sql_silver_ctes(())) +
       f"\nSELECT {', '.join(SILVER_OUT)}, to_json(genres) AS genres_json FROM silver")
def q_landed_json(spark, sf_dir):
    landing = land_standin(spark, sf_dir)
    s = clean(landed_movies(read_pages(spark, landing)))
    return s.select(*SILVER_OUT, F.to_json("genres").alias("genres_json"))


# --- R1: availableNow stream over the landed pages -> committed star ------------
@query("q_stream", with_(sql_silver_ctes(()), windows_ctes(1), *star_ctes(1)) + RESOLVED.format(n=1))
def q_stream(spark, sf_dir):
    landing = land_standin(spark, sf_dir)
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    run_stream(wh, landing)
    return _resolved_committed(wh)


# --- batches by page: what each run takes, in pages ------------------------------------
def _windows_by_page(*ranges: str, size: int) -> str:
    """``w1 ..`` as the runs see them: the dated rows of the pages that each batch takes."""
    ranked = (f"ranked AS (SELECT *, (row_number() OVER (ORDER BY movie_id) - 1) // {size} + 1 AS page FROM silver),\n"
              "top AS (SELECT max(page) AS m FROM ranked)")
    return ",\n".join([ranked, *[f"w{k} AS (SELECT r.* EXCLUDE (landing), {k} AS landing FROM ranked r, top "
                                 f"WHERE ({cond}) AND date_uploaded IS NOT NULL)" for k, cond in enumerate(ranges, start=1)]])


# --- R1 S3: a stream that loses its checkpoint, then the daily run: every page once ----
@query("q_stream_split", with_(sql_silver_ctes(()), _windows_by_page("page <= m // 2", "page > m // 2", size=RUN_PAGE_SIZE), *star_ctes(2)) +
       RESOLVED.format(n=2))
def q_stream_split(spark, sf_dir):
    """Streamed over half of the pages; the checkpoint is lost; streamed again over all of them; then the daily run
    over the same folder.  The ledger lets each page in once."""
    landing, checkpoints = shared_dir(spark, "landing"), shared_dir(spark, "checkpoints")
    rows, count = paged(spark, sf_dir, RUN_PAGE_SIZE)
    top = rows.agg(F.max("page")).first()[0] or 0
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    for run, half in enumerate([F.col("page") <= top // 2, F.col("page") > top // 2], start=1):
        write_pages(rows.filter(half), landing, "page", count, RUN_PAGE_SIZE, run=str(run))
        run_stream(wh, landing, checkpoint=f"{checkpoints}/{run}", limit=RUN_PAGE_SIZE)
    run_landed(wh, landing, limit=RUN_PAGE_SIZE)
    return _resolved_committed(wh)


# --- C10 S1-S4 H10 H11: five days of a daily run ------------------------------------------
@query("q_run_landed_days", with_(sql_silver_ctes(()), _windows_by_page(
    "page < m // 6 + 1", "page BETWEEN m // 6 + 1 AND 2 * m // 3", "page > 2 * m // 3", size=DAY_PAGE_SIZE), *star_ctes(3)) + RESOLVED.format(n=3))
def q_run_landed_days(spark, sf_dir):
    """A page that lands a day late, one that lands partly filled and then whole, one that can't be read until it is
    landed again, pages beyond gaps, dates out of order, and a day without news: every page's rows once."""
    landing = shared_dir(spark, "landing")
    rows, _ = paged(spark, sf_dir, DAY_PAGE_SIZE)
    rows = materialize(rows, name="paged")
    total, top = rows.agg(F.count(F.lit(1)), F.max("page")).first()
    top = top or 0
    a, b, late = top // 3, 2 * top // 3, top // 6 + 1
    page, bad = F.col("page"), b + 1
    partly = (page < a) | ((page == a) & (F.col("id") % 3 == 0))
    days = [
        ((page <= a) & (page != late) & partly, a * DAY_PAGE_SIZE),
        (page.isin(late, a) | (page > a) & (page <= b), b * DAY_PAGE_SIZE),
        (page > bad, total),
        (page == bad, total),
    ]
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    for day, (taken, movie_count) in enumerate(days, start=1):
        write_pages(rows.filter(taken), landing, "page", F.lit(movie_count).cast("long"), DAY_PAGE_SIZE, run=str(day))
        if day == 3:
            spark.range(1).select(F.lit(TRUNCATED)).write.text(f"{landing}/run={day}/page={bad}")
        run_landed(wh, landing, limit=DAY_PAGE_SIZE)
    run_landed(wh, landing, limit=DAY_PAGE_SIZE)
    return _resolved_committed(wh)


# --- S1 S4 P8: the outcome of every page, and ratings that aren't numbers -----------------
@query("q_page_outcomes", with_(sql_silver_ctes(())) + f""",
ranked AS (SELECT *, (row_number() OVER (ORDER BY movie_id) - 1) // {RUN_PAGE_SIZE} + 1 AS page FROM silver)
SELECT page, CASE page WHEN 2 THEN 'missing' WHEN 3 THEN 'failed' WHEN 4 THEN 'empty' ELSE 'landed' END AS status,
       CASE WHEN page IN (2, 3, 4) THEN 0 ELSE count(*) END AS n_movies,
       CASE WHEN page IN (2, 3, 4) THEN 0 ELSE count(rating) FILTER (WHERE page <> 5 OR movie_id % 2 = 0) END AS n_ratings,
       page = 3 AS kept_text
FROM ranked GROUP BY page""")
def q_page_outcomes(spark, sf_dir):
    """Streamed over pages of which one is missing, one can't be read, one is empty and one has ratings as text, half
    of them no numbers; what the ledger says of each."""
    landing = shared_dir(spark, "landing")
    rows, count = paged(spark, sf_dir, RUN_PAGE_SIZE)
    odd = (F.col("page") == 5) & (F.col("id") % 2 != 0)
    rows = rows.withColumn("rating", F.when(odd, "n/a").otherwise(F.col("rating").cast("string")))
    rows = materialize(rows, name="paged")
    write_pages(rows.filter(~F.col("page").isin(2, 3, 4)), landing, "page", count, RUN_PAGE_SIZE, run="1")
    top = rows.agg(F.max("page")).first()[0] or 0
    for page, text in [(3, TRUNCATED), (4, EMPTY_PAGE)]:
        if page <= top:
            spark.range(1).select(F.lit(text)).write.text(f"{landing}/run=1/page={page}")
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    run_stream(wh, landing, limit=RUN_PAGE_SIZE)
    ledger = committed(wh, "landed_pages")
    outcome = page_status(page_plan(spark, 0, top), ledger.withColumn("failed", F.col("status") == "failed"), RUN_PAGE_SIZE)
    rated = read_pages(spark, landing).select("page", F.size(F.filter("movies", lambda m: m["rating"].isNotNull())).alias("n"))
    texts = ledger.filter(F.col("raw").isNotNull()).select("page", F.lit(True).alias("text")).distinct()
    return (outcome.join(rated, "page", "left").join(texts, "page", "left")
            .select("page", "status", "n_movies", F.greatest(F.coalesce("n", F.lit(0)), F.lit(0)).cast("bigint").alias("n_ratings"),
                    F.coalesce("text", F.lit(False)).alias("kept_text")))


# --- F6 F7: runs with nothing new commit nothing ------------------------------------------
@query("q_nothing_new", with_(sql_silver_ctes(())) + """
SELECT step, CAST(1 AS BIGINT) AS batches, (SELECT count(*) FROM silver WHERE date_uploaded IS NOT NULL) AS facts
FROM (VALUES ('first run'), ('run again'), ('streamed'), ('empty folder')) v(step)""")
def q_nothing_new(spark, sf_dir):
    landing = land_standin(spark, sf_dir, RUN_PAGE_SIZE)
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    steps = [("first run", lambda: run_landed(wh, landing, limit=RUN_PAGE_SIZE)),
             ("run again", lambda: run_landed(wh, landing, limit=RUN_PAGE_SIZE)),
             ("streamed", lambda: run_stream(wh, landing, limit=RUN_PAGE_SIZE)),
             ("empty folder", lambda: run_landed(wh, shared_dir(spark, "nowhere")))]
    seen = None
    for name, step in steps:
        step()
        now = committed(wh, "fact_movies").agg(F.count(F.lit(1)).alias("facts")).select(
            F.lit(name).alias("step"), F.lit(len(wh.batches())).cast("bigint").alias("batches"), "facts")
        seen = now if seen is None else seen.unionByName(now)
    return seen


# --- S18: reset and reload -------------------------------------------------------------------
@query("q_reset_reload", with_(sql_silver_ctes(CUTS_3), windows_ctes(1), *star_ctes(1)) + RESOLVED.format(n=1))
def q_reset_reload(spark, sf_dir):
    """Two batches, everything dropped, then the first one alone."""
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    raw = materialize(raw_movies(spark, sf_dir, CUTS_3), name="landed")
    for k in (2, 1):
        run_batch(wh, raw.filter(F.col("landing") == k).drop("landing"))
    wh.reset()
    run_batch(wh, raw.filter(F.col("landing") == 1).drop("landing"))
    return _resolved_committed(wh)


# --- S9 C2 H19: runs with a lookback, which read the batches that reach into it --------------
@query("q_lookback", with_(sql_silver_ctes(CUTS_3), windows_ctes(3, lookback="90 days"), *star_ctes(3)) + RESOLVED.format(n=3))
def q_lookback(spark, sf_dir):
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    raw = materialize(raw_movies(spark, sf_dir, CUTS_3), name="landed")
    for k in (1, 2, 3):
        run_batch(wh, raw.filter(F.col("landing") == k).drop("landing"), options=RunOptions(lookback="90 days"))
    return _resolved_committed(wh)


# --- S11 S12: batches rewritten into one between the runs -------------------------------------
@query("q_compacted", with_(sql_silver_ctes(CUTS_3), windows_ctes(3), *star_ctes(3)) + RESOLVED.format(n=3))
def q_compacted(spark, sf_dir):
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    raw = materialize(raw_movies(spark, sf_dir, CUTS_3), name="landed")
    for k in (1, 2, 3):
        run_batch(wh, raw.filter(F.col("landing") == k).drop("landing"), options=RunOptions(compact_every=1))
    return _resolved_committed(wh)


# --- S2-S4 + C10: the daily run over landed pages (page plan, load, page mark) ----
@query("q_run_landed", with_(sql_silver_ctes(()), windows_ctes(1), *star_ctes(1)) + RESOLVED.format(n=1))
def q_run_landed(spark, sf_dir):
    landing = land_standin(spark, sf_dir)
    wh = Warehouse(spark, shared_dir(spark, "warehouse")).setup()
    run_landed(wh, landing, limit=API_PAGE_SIZE)
    return _resolved_committed(wh)


# --- S2 S3 S4 H10 H11: page plan, missing pages, page mark ----------------------
def _standin_pages(spark, sf_dir, limit=PLAN_PAGE_SIZE):
    """Pages over orders in key order; a page whose first order is urgent did
    not land (stands for a failed fetch).  Returns (stats, max_page)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    ranked = dense_keys(o, ["o_orderkey"], "_rank")
    paged = ranked.withColumn("page", page_numbers(ranked, "_rank", limit))
    per_page = paged.groupBy("page").agg(
        F.count(F.lit(1)).alias("n_movies"),
        F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"))
    stats = (per_page.filter(F.col("first_priority") != "1-URGENT")
                     .select("page", "n_movies", F.lit(False).alias("failed")))
    total = o.count()
    max_page = -(-total // limit)
    return stats, max_page


_PAGES_SQL = f"""WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY o_orderkey) AS rk FROM orders),
p AS (SELECT CAST((rk - 1) // {PLAN_PAGE_SIZE} + 1 AS BIGINT) AS page, count(*) AS n,
             arg_min(o_orderpriority, o_orderkey) AS first_pri FROM r GROUP BY 1),
landed AS (SELECT page, n AS n_movies FROM p WHERE first_pri <> '1-URGENT'),
plan AS (SELECT range AS page FROM range(1, (SELECT CAST(ceil(count(*) / {PLAN_PAGE_SIZE}) AS BIGINT) + 1 FROM orders))),
st AS (SELECT plan.page,
              CASE WHEN l.n_movies IS NULL THEN 'missing' WHEN l.n_movies = 0 THEN 'empty' ELSE 'landed' END AS status,
              CAST(coalesce(l.n_movies, 0) AS BIGINT) AS n_movies, l.n_movies = {PLAN_PAGE_SIZE} AS complete
       FROM plan LEFT JOIN landed l ON l.page = plan.page)
"""


@query("q_page_plan", _PAGES_SQL + "SELECT * FROM st")
def q_page_plan(spark, sf_dir):
    stats, max_page = _standin_pages(spark, sf_dir)
    return page_status(page_plan(spark, 0, max_page), stats, PLAN_PAGE_SIZE)


@query("q_missing_pages", _PAGES_SQL + """
SELECT max(page) AS max_page, count(*) FILTER (WHERE status = 'missing') AS n_missing,
       min(page) FILTER (WHERE status = 'missing') AS first_missing,
       CAST(coalesce(min(page) FILTER (WHERE status <> 'landed' OR NOT coalesce(complete, false)) - 1,
                     max(page), 0) AS BIGINT) AS mark,
       CAST(coalesce(min(page) FILTER (WHERE status IN ('missing', 'failed')) - 1, max(page), 0) AS BIGINT)
         AS load_upto
FROM st""")
def q_missing_pages(spark, sf_dir):
    stats, max_page = _standin_pages(spark, sf_dir)
    st = page_status(page_plan(spark, 0, max_page), stats, PLAN_PAGE_SIZE)
    return st.agg(
        F.max("page").alias("max_page"),
        F.count(F.when(F.col("status") == "missing", 1)).alias("n_missing"),
        F.min(F.when(F.col("status") == "missing", F.col("page"))).alias("first_missing"),
    ).select("*", contiguous_mark(st, 0).alias("mark"), landed_prefix(st, 0).alias("load_upto"))
